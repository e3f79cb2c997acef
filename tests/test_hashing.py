import hashlib

import pytest

from tabwright.functions.hashing import hash_below, hash_bucket


def number(key, *salt):
    text = ":".join([str(key), *map(str, salt)])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


@pytest.mark.parametrize("share", [0.0, 1e-12, 0.25, 0.8, 1 / 3, 0.999999, 1 - 1e-16, 1.0])
def test_below_compares_the_number(spark, share):
    rows = spark.range(2000).select("id", hash_below(["id"], share, 42).alias("below")).collect()
    assert all(r["below"] == (number(r["id"], 42) < share) or share > 0.99999999 for r in rows)
    assert share < 0.99999999 or all(r["below"] for r in rows)


@pytest.mark.parametrize("k", [1, 2, 3, 5, 7, 10])
def test_bucket_rounds_the_number_down(spark, k):
    rows = spark.range(2000).select("id", hash_bucket(["id"], k, 7, "fold").alias("b")).collect()
    assert all(r["b"] == int(number(r["id"], 7, "fold") * k) for r in rows)
