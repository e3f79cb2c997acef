import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabwright.operators.split import (
    FOLD_COLUMN,
    example_record,
    random_split,
    sample_rows,
    time_split,
    with_folds,
)
from tabwright.operators.weights import class_list, with_class_weights


def ids(df, name="id"):
    return sorted(r[name] for r in df.select(name).collect())


def test_random_split_is_a_partition_that_survives_repartitioning(spark):
    df = spark.range(2000)
    split = random_split(df, 0.8, 42, ["id"])
    train, test = ids(split.train), ids(split.test)
    assert sorted(train + test) == list(range(2000)) and 1500 < len(train) < 1700
    assert ids(random_split(df.repartition(13).orderBy(F.desc("id")), 0.8, 42, ["id"]).train) == train
    assert ids(random_split(df, 0.8, 0, ["id"]).train) != train
    assert {r[0]: r[1] for r in split.sizes().collect()} == {"train": len(train), "test": len(test)}


def test_written_split_keeps_rows_and_prunes_folds(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    split = random_split(df, 0.7, 7, ["id"])
    written = split.write(str(tmp_path / "split"), 3, 7, ["id"])
    assert written.train.columns == ["id", "x"]
    assert ids(written.train) == ids(split.train) and ids(written.test) == ids(split.test)
    expected = {r["id"]: r[FOLD_COLUMN] for r in with_folds(split.train, 3, 7, ["id"]).collect()}
    folded = written.folded_train(3, 7, ["id"])
    assert {r["id"]: r[FOLD_COLUMN] for r in folded.collect()} == expected
    plan = folded.where(F.col(FOLD_COLUMN) != 1)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "split_side" in filters and "NOT (" in filters  # the plan text is cut after a hundred characters


def test_time_split_cut_on_a_value_and_missing_times(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i)) for i in range(11)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    split = time_split(df, "ts", 0.8)
    assert ids(split.train) == list(range(8)) and ids(split.test) == [8, 9, 10]
    same = spark.createDataFrame([(1, start), (2, start)], "id int, ts timestamp_ntz")
    assert ids(time_split(same, "ts", 0.8).train) == [] and ids(time_split(same, "ts", 0.8).test) == [1, 2]
    assert ids(time_split(df.where("ts is null"), "ts", 0.8).test) == []


def test_sample_is_the_smallest_hashes_with_or_without_threshold(spark):
    df = spark.range(5000).withColumn("hot", F.lit(1))
    few = ids(sample_rows(df, 20, 3, ["id"]))
    assert len(few) == 20 and few == ids(sample_rows(df.repartition(9), 20, 3, ["id"]))
    assert set(few) <= set(ids(sample_rows(df, 4000, 3, ["id"])))
    assert sample_rows(df, 20, 3, ["hot"]).count() == 20  # one key for all rows
    assert sample_rows(df, 9999, 3, ["id"]).count() == 5000


def test_example_record_takes_the_first_value_present(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5.0, None), (3, 6.0, "c")], "id int, x double, s string")
    assert tuple(example_record(df, ["id"]).first()) == (1, 5.0, "a")
    empty = spark.createDataFrame([(1, None)], "id int, x double")
    assert tuple(example_record(empty, ["id"]).first()) == (1, None)


def test_class_weights(spark):
    df = spark.createDataFrame([(i, 0 if i < 30 else 1) for i in range(40)] + [(40, None)], "id int, y int")
    rows = {r["id"]: r["SAMPLE_WEIGHTS"] for r in with_class_weights(df, "y").collect()}
    assert len(rows) == 41 and rows[40] is None
    assert rows[0] == pytest.approx(40 / (2 * 30)) and rows[35] == pytest.approx(40 / (2 * 10))
    assert sum(v for v in rows.values() if v) == pytest.approx(40)


def test_many_classes_are_refused(spark):
    assert class_list(spark.range(5).withColumnRenamed("id", "y"), "y") == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        class_list(spark.range(50), "id", max_classes=10)


@pytest.mark.parametrize("k", [2, 3, 5])
def test_stratified_folds_part_each_class_evenly(spark, k, tmp_path):
    df = spark.range(5000).select("id", F.when(F.col("id") % 97 == 0, "rare").when(F.col("id") % 3 == 0, "some").otherwise("many").alias("y"))
    df = df.unionByName(spark.createDataFrame([(9000, "single"), (9001, None)], "id long, y string"))
    split = random_split(df, 0.8, 7, ["id"])
    made = [split.write(str(tmp_path / str(p)), k, 7, ["id"], "y").labelled.repartition(p).where("split_side = 'train' AND y IS NOT NULL") for p in (1, 5)]
    counts = {}
    for y, fold, n in made[0].groupBy("y", "split_fold").count().collect():
        counts.setdefault(y, {})[fold] = n
    for y, folds in counts.items():
        sizes = [folds.get(f, 0) for f in range(k)]
        assert set(folds) <= set(range(k)) and max(sizes) - min(sizes) <= 1, (y, sizes)
    assert made[0].exceptAll(made[1]).isEmpty()
