"""Queries over the driver's tables: the library's operators at work, with their SQL twins."""
