import math

import pytest
from pyspark.sql import functions as F

from tabwright.operators import prep
from tabwright.operators.prep import FEATURES, WHOLE, FeatureSpec, PrepModel, fit_prep, fit_prep_per_fold
from tabwright.operators.split import FOLD_COLUMN
from tabwright.plans.spec import feature_specs
from tabwright.sources.tables import (
    AVERAGE,
    CONSTANT,
    DUMMY,
    MEDIAN,
    MIN_MAX,
    MOST_FREQUENT,
    NO_RESCALING,
    ORDINAL,
    STANDARD,
)


def numbers(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")


def outputs(model, df):
    rows = model.transform_columns(df, ["id"]).orderBy("id").collect()
    return [list(r)[1:] for r in rows]


def test_mode_of_equals_is_the_smallest(spark):
    df = texts(spark, ["b", "a", "b", "a", "c", None])
    assert fit_prep(df, [FeatureSpec("s", DUMMY, MOST_FREQUENT)]).plans[0].fill == "a"
    df = numbers(spark, [7.0, 2.0, 7.0, 2.0, 9.0, None, math.nan])
    assert fit_prep(df, [FeatureSpec("x", NO_RESCALING, MOST_FREQUENT)]).plans[0].fill == 2.0


def test_median_interpolates(spark):
    df = numbers(spark, [1.0, 2.0, 3.0, 10.0, None])
    assert fit_prep(df, [FeatureSpec("x", NO_RESCALING, MEDIAN)]).plans[0].fill == 2.5


def test_standard_uses_imputed_rows_and_population_spread(spark):
    values = [1.0, 5.0, None, None, math.nan]
    df = numbers(spark, values)
    got = [v for (v,) in outputs(fit_prep(df, [FeatureSpec("x", STANDARD, CONSTANT, 0)]), df)]
    assert sum(got) == pytest.approx(0) and sum(v * v for v in got) / 5 == pytest.approx(1)
    filled = [1.0, 5.0, 0.0, 0.0, 0.0]
    mean = sum(filled) / 5
    spread = math.sqrt(sum((v - mean) ** 2 for v in filled) / 5)
    assert got == pytest.approx([(v - mean) / spread for v in filled])


def test_min_max_spans_the_fill_value(spark):
    df = numbers(spark, [2.0, 4.0, None])
    got = [v for (v,) in outputs(fit_prep(df, [FeatureSpec("x", MIN_MAX, CONSTANT, 12)]), df)]
    assert got == pytest.approx([0, 0.2, 1])


@pytest.mark.parametrize("encoding", [STANDARD, MIN_MAX])
def test_constant_column_gives_zero(spark, encoding):
    df = numbers(spark, [3.0, 3.0, None])
    assert outputs(fit_prep(df, [FeatureSpec("x", encoding, AVERAGE)]), df) == [[0.0]] * 3


def test_ten_categories_have_a_column_each_and_eleven_share(spark):
    ten = texts(spark, [f"c{i}" for i in range(10)])
    plan = fit_prep(ten, [FeatureSpec("s", DUMMY, MOST_FREQUENT)]).plans[0]
    assert len(plan.kept) == 10 and not plan.has_rare
    eleven = texts(spark, [f"c{i:02d}" for i in range(11)])
    model = fit_prep(eleven, [FeatureSpec("s", DUMMY, MOST_FREQUENT)])
    # all equally frequent: the later in sort order stay
    assert model.plans[0].kept == [f"c{i:02d}" for i in range(2, 11)] and model.plans[0].has_rare
    got = outputs(model, texts(spark, ["c00", "c05", "unseen", None]))
    assert got[0] == [0.0] * 9 + [1.0] == got[2]
    assert got[1][3] == 1.0 and sum(got[1]) == 1.0
    assert got[3] == got[0]  # the fill c00 is itself rare


def test_imputed_rows_make_their_value_frequent(spark):
    df = texts(spark, [f"c{i:02d}" for i in range(11)] + [None])
    assert "c00" in fit_prep(df, [FeatureSpec("s", DUMMY, MOST_FREQUENT)]).plans[0].kept


def test_unseen_without_rare_column_is_all_zero(spark):
    model = fit_prep(texts(spark, ["a", "b", ""]), [FeatureSpec("s", DUMMY, MOST_FREQUENT)])
    assert model.plans[0].kept == ["", "a", "b"]
    assert outputs(model, texts(spark, ["z", "a"])) == [[0.0, 0.0, 0.0], [0.0, 1.0, 0.0]]


def test_ordinal_codes(spark):
    model = fit_prep(texts(spark, ["b", "a", None, "c", "b"]), [FeatureSpec("s", ORDINAL, CONSTANT, "m")])
    assert outputs(model, texts(spark, ["a", "b", "c", None, "zz"])) == [[0.0], [1.0], [2.0], [3.0], [-1.0]]


def test_ordinal_codes_of_numbers_follow_their_size(spark):
    values = [11.0, 9.0, 100.0, 2.0, -0.0, 1.0, 0.0, 10.0, 3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s double")
    model = fit_prep(df, [FeatureSpec("s", ORDINAL, MOST_FREQUENT)])
    order = sorted({v + 0.0 for v in values})
    assert outputs(model, df) == [[float(order.index(v))] for v in values]


def test_dummy_ties_of_numbers_follow_their_size(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 2, 9, 10, 11, 100])], "id int, s int")
    model = fit_prep(df, [FeatureSpec("s", DUMMY, MOST_FREQUENT, max_categories=4)])
    assert model.outputs == ["s=10", "s=11", "s=100", "s=(rare)"]


@pytest.mark.parametrize("most", [0, 3, 200_000])
def test_large_dictionaries_are_joined(spark, monkeypatch, most):
    monkeypatch.setattr(prep, "BROADCAST_VALUES", most)
    rows = [(i, None if i % 3 == 0 else "abcd"[i % 4], None if i % 5 == 0 else i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, s string, n int")
    model = fit_prep(df, [FeatureSpec("s", ORDINAL, MOST_FREQUENT), FeatureSpec("n", ORDINAL, CONSTANT, 9)])
    frame, _ = model.columns(df)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == {0: 0, 3: 0, 200_000: 2}[most]
    mode = min("abcd", key=lambda v: (-sum(r[1] == v for r in rows), v))
    want = [["abcd".index(s or mode), [0, 1, 2, 3, 4, 5, 6, 9].index(9 if n is None else n)] for _, s, n in rows]
    assert outputs(model, df) == [[float(a), float(b)] for a, b in want]


def test_column_without_values_is_left_out(spark):
    df = spark.createDataFrame([(1, None, 1.0, None), (2, None, 2.0, None)], "id int, x double, y double, s string")
    specs = [FeatureSpec("x", STANDARD, MEDIAN), FeatureSpec("s", DUMMY, MOST_FREQUENT), FeatureSpec("y", NO_RESCALING, MEDIAN)]
    model = fit_prep(df, specs)
    assert model.outputs == ["y"] and outputs(model, df) == [[1.0], [2.0]]
    with pytest.raises(ValueError):
        fit_prep(df, specs[:1]).transform(df)


def test_names_with_dots_spaces_and_quotes(spark):
    df = spark.createDataFrame([(1, 1.0, "u", "p"), (2, 3.0, "v", "q")], "id int, `My Col` double, `a.b` string, `c``d` string")
    specs = feature_specs(df, ["My Col", "a.b", "c`d"], encodings={"c`d": ORDINAL})
    model = fit_prep(df, specs)
    assert outputs(model, df) == [[-1.0, 1.0, 0.0, 0.0], [1.0, 0.0, 1.0, 1.0]]
    assert model.transform(df, ["id"]).first()[FEATURES].size == 4


def test_boolean_features(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, b boolean")
    model = fit_prep(df, [FeatureSpec("b", DUMMY, CONSTANT, True)])
    assert outputs(model, df) == [[0.0, 1.0], [1.0, 0.0], [0.0, 1.0]]


def test_folds_equal_separate_fits(spark):
    rows = [(i, i % 3, None if i % 7 == 0 else float(i * i % 31), None if i % 5 == 0 else f"c{i * i % 13:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, f"id int, {FOLD_COLUMN} int, x double, s string")
    specs = [
        FeatureSpec("x", STANDARD, MEDIAN),
        FeatureSpec("s", DUMMY, MOST_FREQUENT),
    ]
    preps = fit_prep_per_fold(df, specs, 3)
    for left_out, model in preps.items():
        alone = fit_prep(df if left_out == WHOLE else df.where(F.col(FOLD_COLUMN) != left_out), specs)
        for together, single in zip(model.plans, alone.plans):
            assert together.kept == single.kept and together.fill == single.fill and together.has_rare == single.has_rare
            assert together.center == pytest.approx(single.center) and together.scale == pytest.approx(single.scale)


def test_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, "u", "p"), (2, None, "v", None)], "id int, x double, s string, o string")
    specs = [FeatureSpec("x", STANDARD, AVERAGE), FeatureSpec("s", DUMMY, MOST_FREQUENT), FeatureSpec("o", ORDINAL, MOST_FREQUENT)]
    model = fit_prep(df, specs)
    model.save(spark, str(tmp_path / "prep"))
    assert outputs(PrepModel.load(spark, str(tmp_path / "prep")), df) == outputs(model, df)


def test_treatments_must_fit_the_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, s string, x double")
    for bad in (
        FeatureSpec("s", STANDARD, MEDIAN),
        FeatureSpec("s", DUMMY, MEDIAN),
        FeatureSpec("x", STANDARD, CONSTANT),
    ):
        with pytest.raises(ValueError):
            fit_prep(df, [bad])
    with pytest.raises(ValueError):
        fit_prep(df, [])


def test_defaults_by_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True)], "i int, s string, x double, b boolean")
    got = {f.name: (f.encoding, f.imputation) for f in feature_specs(df, df.columns)}
    assert got["i"] == got["x"] == (STANDARD, MEDIAN)
    assert got["s"] == got["b"] == (DUMMY, MOST_FREQUENT)
