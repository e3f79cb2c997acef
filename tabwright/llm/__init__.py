"""Operators over text corpora: one module each, their registered queries in ``queries``."""
