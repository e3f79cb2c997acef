import random

import pytest

#: Columns whose names operators use inside, beside the ones they read.
CLASHING = ["bucket", "component", "kept", "size", "score", "spans", "copy", "range", "c0", "hit_doc_id", "boiler_key", "mix_id", "u", "v"]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and", "idiot", "ÄÖ", "日本", "x|y", "a@b.com", "+1 (487) 555-7209"]
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    some = " ".join(rnd.choice(words) for _ in range(60))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, "b", 4), (4, "one", "en", None, 3),
        (5, long, "en", "a", len(long)), (6, some, "de", "b", len(some)), (7, some, "de", "c", len(some)), (8, some + " more", None, "a", None),
        (9, "line\n" * 50, "en", "b", 250), (10, "line\n\nother", "en", "c", 11), (10, "line\n\nother", "en", "c", 11),
        (None, "no name", "en", "a", 7), (None, None, None, None, None), (11, "9" * 5000, "en", "b", 5000),
        (12, some.upper(), "en", "a", len(some)), (-3, "the of and to " * 40, "en", "c", 560), (13, "!!! ??? ###", "en", "d", 11),
    ]
    rows += [(100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))), "en", rnd.choice("abc"), 1) for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The awkward table with more columns, named as operators may name theirs."""
    from pyspark.sql import functions as F

    return awkward.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
