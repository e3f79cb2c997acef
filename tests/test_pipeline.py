import pytest
from pyspark.sql import functions as F

from tabwright import MULTI_CLASS, REGRESSION, TWO_CLASS, AlgoSpec, FeatureSpec, Registry, TrainSpec, feature_specs, score, train
from tabwright.operators.estimators import MLLIB_MAX_DEPTH, build_learner, growth_of
from tabwright.operators.search import best_algorithm, best_candidates, candidate_table, cv_results, draw_candidates
from tabwright.plans.registry import MODEL_ID_TAG, PARENT_MODEL, PROJECT_TAG, stale_entries
from tabwright.plans.tracking import Tracker
from tabwright.plans.model import TrainedModel
from tabwright.plans.train import fit_one, label_column, split_table, target_classes
from tabwright.sources.tables import ORDINAL, read_table
from tabwright.streaming.score_stream import score_stream


def orders(spark, sf):
    df = read_table(spark, f"{sf}/orders.parquet")
    return df.withColumn("dear", (F.col("o_totalprice") > 250000).cast("int")).withColumn(
        "band", F.least(F.floor(F.col("o_totalprice") / 125000), F.lit(3)).cast("int") + 1
    )


def spec_for(df, **changes):
    values = {
        "model_name": "m",
        "target": "dear",
        "task": TWO_CLASS,
        "features": feature_specs(df, ["o_totalprice", "o_orderpriority", "o_orderstatus"], encodings={"o_orderstatus": ORDINAL}),
        "algorithms": [AlgoSpec("decision_tree", {"max_depth": (2, 4)}), AlgoSpec("xgb", {"n_estimators": (2, 3), "max_depth": (1, 2)})],
        "metric": "ROC AUC",
        "n_iter": 2,
        "key": ["o_orderkey"],
    }
    return TrainSpec(**{**values, **changes})


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    df = orders(spark, "/root/testdata/sf0.001")
    folder = str(tmp_path_factory.mktemp("work"))
    registry = Registry(spark, f"{folder}/registry")
    return df, folder, registry, train(df, spec_for(df), folder, registry, "P")


def test_training_leaves_runs_models_and_tables(spark, trained):
    df, folder, registry, result = trained
    board = {r["algorithm"]: r for r in result.leaderboard.collect()}
    assert set(board) == {"decision_tree", "xgb"} and [a for a, r in board.items() if r["is_best"]] == [result.best]
    assert board[result.best]["best_score"] == max(r["best_score"] for r in board.values())
    assert {r["rank_test_score"] for r in result.cv_results.collect()} <= {1, 2}
    assert all(result.test_metrics[a]["test_roc_auc"] > 0.99 for a in board)
    tracker = Tracker(spark, f"{folder}/tracking")
    kinds = {r["kind"]: r["count"] for r in tracker.runs().groupBy("kind").count().collect()}
    assert kinds == {"cv": 4, "final": 2}
    final = tracker.runs().where("kind = 'final'").join(tracker.metrics(), "run_id")
    assert {"test_f1_score", "test_roc_auc_score", "whole_dataset_refit_time"} <= {r["key"] for r in final.collect()}
    assert "max_depth" in {r["key"] for r in tracker.params().collect()}
    assert result.split.train.count() + result.split.test.count() == df.count()
    assert "SAMPLE_WEIGHTS" in result.split.train.columns
    assert result.row_counts["train"] == result.split.train.count() and result.row_counts["dropped"] == 0


def test_reloaded_model_scores_as_in_memory(spark, trained):
    df, _, registry, result = trained
    assert result.registered == "P_m"
    later = score(df, registry, "P_m").collect()
    now = result.best_model.score(df).collect()
    assert sorted(map(tuple, later)) == sorted(map(tuple, now)) and len(later) == df.count()
    assert later[0].__fields__[-3:] == ["PREDICT_PROBA_0", "PREDICT_PROBA_1", "PREDICTION"]
    assert dict(score(df, registry, "P_m").dtypes)["PREDICTION"] == "int"


def test_scoring_is_map_only(spark, trained):
    df, _, registry, _ = trained
    plan = score(df, registry, "P_m")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "SinglePartition" not in plan


def test_scoring_keeps_the_users_weight_column(spark, trained):
    df, _, registry, _ = trained
    scored = score(df.withColumn("SAMPLE_WEIGHTS", F.lit("mine")), registry, "P_m")
    assert {r[0] for r in scored.select("SAMPLE_WEIGHTS").distinct().collect()} == {"mine"}


def test_threshold_is_strict(spark, trained):
    df, _, _, result = trained
    scored = result.best_model.score(df, 0.7).collect()
    assert all(r["PREDICTION"] == int(r["PREDICT_PROBA_1"] > 0.7) for r in scored)


def test_registry_lookups_and_default(spark, trained):
    df, _, registry, result = trained
    row = registry.find("P_m")
    assert row["version"] == result.version and row["tags"][PROJECT_TAG] == "P" and row["classes"] == ["0", "1"]
    assert row["metrics"]["test_roc_auc"] > 0.9 and "o_totalprice" in row["signature"]
    with pytest.raises(LookupError):
        registry.find("P_other")
    with pytest.raises(LookupError):
        registry.find("P_m", "no_such_version")


def test_stream_scores_like_a_table(spark, trained, tmp_path):
    df, _, registry, _ = trained
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a restart finds nothing new to score
        score_stream(stream, registry, "P_m", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, score(df, registry, "P_m").collect()))


def test_second_version_and_cleanup(spark, trained, tmp_path):
    df, _, _, result = trained
    registry = Registry(spark, str(tmp_path / "registry"))
    for version in ("v1", "v2"):
        registry.register(result.best_model, "m", "P", version, "run", "{}", {"auc": 1.0})
    registry.register(result.best_model, "n", "P", "v1", "run", "{}", {})
    registry.register(result.best_model, "n", "OTHER", "v1", "run", "{}", {})
    assert registry.find("P_m")["version"] == "v2"
    assert registry.versions().where("model_name = 'P_m'").select("model_id").distinct().count() == 1
    model_id = registry.find("P_m")["model_id"]
    live = spark.createDataFrame([(model_id, "V1")], "model_id string, version string")
    expected = {("P_m", "v2"), ("P_n", PARENT_MODEL)}
    assert {tuple(r) for r in registry.cleanup(live, "P").collect()} == expected
    assert registry.versions().count() == 4  # listing removes nothing
    assert {tuple(r) for r in registry.cleanup(live, "P", perform_deletion=True).collect()} == expected
    assert registry.cleanup(live, "P", perform_deletion=True).count() == 0
    assert {(r["model_name"], r["version"]) for r in registry.versions().collect()} == {("P_m", "v1"), ("OTHER_n", "v1")}
    with pytest.raises(LookupError):
        registry.find("P_n")
    registry.register(result.best_model, "n", "P", "v9", "run", "{}", {})
    assert registry.find("P_n")["version"] == "v9"


def test_stale_entries_need_both_tags(spark):
    rows = [
        ("A", "v1", {PROJECT_TAG: "P", MODEL_ID_TAG: "a"}),
        ("A", "v2", {PROJECT_TAG: "P", MODEL_ID_TAG: "a"}),
        ("B", "v1", {PROJECT_TAG: "P", MODEL_ID_TAG: "gone"}),
        ("B", "v2", {PROJECT_TAG: "P", MODEL_ID_TAG: "gone"}),
        ("C", "v1", {PROJECT_TAG: "Q", MODEL_ID_TAG: "gone"}),
        ("D", "v1", {PROJECT_TAG: "P"}),
        ("E", "v1", None),
        ("F", "v1", {PROJECT_TAG: "P", MODEL_ID_TAG: "f"}),
    ]
    versions = spark.createDataFrame(rows, "model_name string, version string, tags map<string,string>")
    live = spark.createDataFrame([("a", "V1"), ("f", None)], "model_id string, version string")
    got = {tuple(r) for r in stale_entries(versions, live, "P").collect()}
    assert got == {("A", "v2"), ("B", PARENT_MODEL), ("F", "v1")}


def test_multi_class_with_one_against_rest_boosting(spark, sf, tmp_path):
    df = orders(spark, sf)
    algorithms = [AlgoSpec("gradient_boosting", {"n_estimators": (3, 3), "max_depth": (2, 2)})]
    spec = spec_for(df, target="band", task=MULTI_CLASS, algorithms=algorithms, metric="F1 Score", n_iter=1, folds=2, model_name="bands")
    registry = Registry(spark, str(tmp_path / "registry"))
    result = train(df, spec, None, registry, "P")
    assert len(result.best_model.estimator.models) == 4 and result.best_model.classes == [1, 2, 3, 4]
    scored = score(df, registry, "P_bands")
    names = [f"PREDICT_PROBA_{c}" for c in (1, 2, 3, 4)]
    off = scored.where(F.abs(sum(F.col(n) for n in names) - 1) > 1e-9).count()
    assert off == 0 and scored.where(F.col("PREDICTION") == F.col("band")).count() > 0.95 * df.count()


def test_regression_errors_are_minimised(spark, sf):
    df = orders(spark, sf)
    algorithms = [AlgoSpec("lasso", {"alpha": (1e7, 1e7)}), AlgoSpec("decision_tree", {"max_depth": (4, 4)})]
    features = feature_specs(df, ["band", "o_orderpriority"])
    spec = spec_for(
        df, target="o_totalprice", task=REGRESSION, algorithms=algorithms, features=features, metric="MAE", n_iter=1, folds=2,
        time_column="o_orderdate",
    )
    result = train(df, spec)
    board = {r["algorithm"]: r for r in result.leaderboard.collect()}
    # so heavy a penalty leaves only the mean: the tree must win
    assert result.best == "decision_tree"
    assert board["decision_tree"]["best_score"] > board["lasso"]["best_score"]
    assert board["decision_tree"]["test_metrics"]["test_mae"] < board["lasso"]["test_metrics"]["test_mae"]


def test_positive_class_moves_to_the_end(spark, sf):
    df = orders(spark, sf)
    spec = spec_for(df, positive_class=0)
    assert target_classes(df, spec) == [1, 0]
    labels = df.select("dear", label_column(spec, [1, 0])).distinct().collect()
    assert {(r["dear"], r["label"]) for r in labels} == {(1, 0.0), (0, 1.0)}


def test_rows_without_target_are_no_class(spark, sf):
    df = orders(spark, sf).withColumn("dear", F.when(F.col("o_orderstatus") != "P", F.col("dear")))
    spec = spec_for(df)
    assert target_classes(df, spec) == [0, 1]
    split = split_table(df, spec)
    assert split.train.count() + split.test.count() == df.where("o_orderstatus <> 'P'").count()
    assert split.labelled.agg(F.sum("SAMPLE_WEIGHTS")).first()[0] == pytest.approx(df.where("dear is not null").count())


def test_weights_can_come_from_the_train_rows(spark, sf):
    df = orders(spark, sf)
    split = split_table(df, spec_for(df, weights_from="train"))
    assert split.train.agg(F.sum("SAMPLE_WEIGHTS")).first()[0] == pytest.approx(split.train.count())
    assert split.test.where("SAMPLE_WEIGHTS is null").count() == 0


def test_specifications_are_checked(spark, sf):
    df = orders(spark, sf)
    good = spec_for(df)
    assert spec_for(df, seed=0).seed == 0
    for changes in (
        {"model_name": "has space"},
        {"train_ratio": 1.0},
        {"n_iter": 0},
        {"algorithms": []},
        {"features": []},
        {"metric": "R2"},
        {"weights_from": "test"},
        {"task": "clustering"},
        {"algorithms": [AlgoSpec("lasso")]},
        {"algorithms": [AlgoSpec("decision_tree", {"max_depth": (5, 2)})]},
        {"algorithms": [AlgoSpec("decision_tree", {"depth": (1, 2)})]},
    ):
        with pytest.raises(ValueError):
            spec_for(df, **changes)
    for bad in (
        spec_for(df, target="o_orderstatus"),
        spec_for(df, target="missing"),
        spec_for(df, features=[FeatureSpec("dear", "No rescaling", "Median")]),
        spec_for(df, time_column="o_orderstatus"),
        spec_for(df, target="band"),
    ):
        with pytest.raises(ValueError):
            train(df, bad)
    assert good.weighted and not spec_for(df, class_weights=False).weighted


def test_draws_stay_in_range_and_repeat(spark):
    algorithms = [AlgoSpec("xgb", {"n_estimators": (2, 3)}), AlgoSpec("logistic_regression"), AlgoSpec("random_forest")]
    drawn = draw_candidates(algorithms, TWO_CLASS, 50, 5)
    assert drawn == draw_candidates(algorithms, TWO_CLASS, 50, 5) != draw_candidates(algorithms, TWO_CLASS, 50, 6)
    xgb = [c.params for c in drawn if c.algorithm == "xgb"]
    assert {p["n_estimators"] for p in xgb} == {2, 3}  # the largest value is drawn too
    assert all(1 <= p["min_child_weight"] <= 5 and 0.01 <= p["learning_rate"] <= 0.2 for p in xgb)
    penalties = [c.params["C"] for c in drawn if c.algorithm == "logistic_regression"]
    assert min(penalties) < 0.5 < 5 < max(penalties)  # spread over the orders of magnitude
    assert candidate_table(spark, drawn).count() == 150


def test_equal_scores_share_a_rank(spark):
    rows = [("a", 1, f, 0.5, 1.0) for f in range(3)] + [("a", 2, f, 0.5, 3.0) for f in range(3)] + [("b", 1, 0, 0.4, 1.0), ("a", 3, 0, 0.1, 1.0)]
    results = cv_results(spark.createDataFrame(rows, "algorithm string, candidate int, fold int, score double, fit_seconds double"))
    ranks = {(r["algorithm"], r["candidate"]): r["rank_test_score"] for r in results.collect()}
    assert ranks == {("a", 1): 1, ("a", 2): 1, ("a", 3): 3, ("b", 1): 1}
    best = {r["algorithm"]: r["candidate"] for r in best_candidates(results).collect()}
    assert best == {"a": 1, "b": 1} and best_algorithm(best_candidates(results)).first()["algorithm"] == "a"


def test_parameters_reach_the_learners(spark):
    deep = {"n_estimators": 7, "max_depth": 12, "max_bins": 40, "min_samples_leaf": 3, "min_child_weight": 1.2, "learning_rate": 0.1}
    forest = growth_of("random_forest", deep, MULTI_CLASS, 4, 9, 1)
    assert (forest.max_depth, forest.least_rows, forest.features_per_node, forest.classes, forest.bootstrap) == (12, 3, 3, 4, True)
    level, leaf = (growth_of(a, deep, TWO_CLASS, 2, 9, 1) for a in ("xgb", "lgbm"))
    assert (level.least_hessian, level.l2, level.leaves) == (1.2, 1.0, None) and (leaf.least_hessian, leaf.l2, leaf.leaves, leaf.least_rows) == (1.2, 0.0, 31, 20)
    boosting = build_learner(deep, REGRESSION, True, 1)
    assert boosting.getMinInstancesPerNode() == 3 and boosting.getMaxDepth() == 12 and boosting.getMaxBins() == 40 and boosting.getWeightCol() == "weight"


@pytest.mark.parametrize("kind", ["bigint", "smallint", "float", "double", "decimal(10,2)"])
def test_target_types_come_back_in_predictions(spark, sf, tmp_path, kind):
    df = orders(spark, sf).withColumn("dear", F.col("dear").cast(kind))
    spec = spec_for(df, class_weights=False)
    model = fit_one(df, spec, target_classes(df, spec), "decision_tree", {"max_depth": 2, "min_samples_leaf": 1})
    model.save(spark, str(tmp_path / "model"))
    scored = TrainedModel.load(spark, str(tmp_path / "model")).score(df)
    assert dict(scored.dtypes)["PREDICTION"] == kind
    assert scored.where(F.col("PREDICTION") == F.col("dear")).count() > 0.95 * df.count()


def test_deeper_trees_than_the_learner_has_are_refused(spark, sf):
    with pytest.raises(ValueError, match="at most 30 levels"):
        spec_for(orders(spark, sf), algorithms=[AlgoSpec("decision_tree", {"max_depth": (3, MLLIB_MAX_DEPTH + 1)})])
    drawn = draw_candidates([AlgoSpec("decision_tree", max_bins=99), AlgoSpec("logistic_regression")], TWO_CLASS, 1, 1)
    assert drawn[0].params["max_bins"] == 99 and "max_bins" not in drawn[1].params


@pytest.mark.parametrize("algorithm", ["random_forest", "gradient_boosting", "xgb", "lgbm"])
def test_pieces_of_the_input_do_not_change_a_model(spark, sf, algorithm):
    df = orders(spark, sf)
    spec = spec_for(df, class_weights=False)
    params = {"n_estimators": 4, "max_depth": 5, "min_samples_leaf": 1, "min_child_weight": 1.0, "learning_rate": 0.1}
    sums = set()
    for pieces in (1, 2, 4, 8):
        model = fit_one(df.repartition(pieces), spec, [0, 1], algorithm, params)
        sums.add(round(model.score(df).agg(F.sum("PREDICT_PROBA_1")).first()[0], 6))
    assert len(sums) == 1


def test_many_classes_train(spark):
    df = spark.range(3000).select("id", (F.col("id") % 1500).cast("int").alias("y"), (F.col("id") % 1500).cast("double").alias("x"))
    spec = TrainSpec("many", "y", MULTI_CLASS, feature_specs(df, ["x"]), [AlgoSpec("decision_tree")], "Accuracy", class_weights=False)
    classes = target_classes(df, spec)
    assert len(classes) == 1500
    model = fit_one(df, spec, classes, "decision_tree", {"max_depth": 2, "min_samples_leaf": 1})
    assert model.score(df.limit(5)).count() == 5
    with pytest.raises(ValueError, match="more than 100"):
        target_classes(df, TrainSpec("many", "y", MULTI_CLASS, feature_specs(df, ["x"]), [AlgoSpec("decision_tree")], "Accuracy", max_classes=100))


def test_feature_names_of_training_columns(spark, sf):
    """Features called as the columns that learners read are read from the table."""
    df = orders(spark, sf).select(
        "o_orderkey", "dear", F.rand(3).alias("label"), F.col("o_totalprice").alias("weight"), F.rand(4).alias("features"), F.rand(5).alias("prediction")
    )
    tree = [AlgoSpec("decision_tree", {"max_depth": (3, 3), "min_samples_leaf": (1, 1)})]

    def spec_of(*names):
        return TrainSpec("m", "dear", TWO_CLASS, feature_specs(df, names), tree, "ROC AUC", n_iter=1, key=["o_orderkey"])

    spec = spec_of("label", "weight", "features", "prediction")
    result = train(df, spec)
    assert result.test_metrics["decision_tree"]["test_roc_auc"] > 0.99
    without = train(df, spec_of("label", "features"))
    assert without.test_metrics["decision_tree"]["test_roc_auc"] < 0.75
    assert result.best_model.score(df).columns[: len(df.columns)] == df.columns
    for name in ("split_side", "Split_Fold", "SAMPLE_WEIGHTS", "_tabwright_x"):
        with pytest.raises(ValueError, match="rename"):
            train(df.withColumn(name, F.lit(1)), spec)


def test_weights_change_no_side(spark, sf):
    df = orders(spark, sf)
    sides = []
    for weighted in (True, False):
        split = split_table(df, spec_for(df, key=None, class_weights=weighted))
        sides.append({r["o_orderkey"]: r["split_side"] for r in split.labelled.select("o_orderkey", "split_side").collect()})
    assert sides[0] == sides[1]


@pytest.mark.parametrize("task", [TWO_CLASS, REGRESSION])
def test_rows_with_nan_targets_are_left_out(spark, sf, task):
    target = F.col("dear").cast("double") if task == TWO_CLASS else F.col("o_totalprice")
    df = orders(spark, sf).withColumn("y", F.when(F.col("o_orderkey") % 10 == 0, F.lit(float("nan"))).otherwise(target))
    algorithm = AlgoSpec("decision_tree", {"max_depth": (2, 2)})
    result = train(df, spec_for(df, target="y", task=task, metric="ROC AUC" if task == TWO_CLASS else "R2", algorithms=[algorithm], n_iter=1))
    n = df.where("o_orderkey % 10 = 0").count()
    assert result.row_counts["dropped"] == n and all(v == v for v in result.test_metrics["decision_tree"].values())


def test_versions_are_not_overwritten(spark, trained, tmp_path):
    _, _, _, result = trained
    registry = Registry(spark, str(tmp_path / "registry"))
    registry.register(result.best_model, "m", "P", "v1", "run", "{}", {})
    with pytest.raises(ValueError, match="exists"):
        registry.register(result.best_model, "m", "P", "v1", "run", "{}", {})


def test_two_writers_of_one_version(spark, sf, tmp_path):
    """One wins, the others are refused; no saved model is lost or overwritten, the pointer shows the winner's."""
    from concurrent.futures import ThreadPoolExecutor

    df = orders(spark, sf)
    spec = spec_for(df, class_weights=False)
    model = fit_one(df, spec, [0, 1], "decision_tree", {"max_depth": 2, "min_samples_leaf": 1})
    path = str(tmp_path / "registry")
    Registry(spark, path)

    def register(version: str) -> str:
        try:
            return Registry(spark, path).register(model, "m", "P", version, f"run {version}", "{}", {})
        except ValueError as refused:
            return str(refused)

    with ThreadPoolExecutor(6) as pool:
        outcomes = list(pool.map(register, ["v1", "v1", "v1", "v2", "v2", "v3"]))
    assert outcomes.count("P_m") == 3 and sum("exists" in o for o in outcomes) == 3
    registry = Registry(spark, path)
    versions = {r["version"]: r["path"] for r in registry.versions().collect()}
    assert set(versions) == {"v1", "v2", "v3"} and registry.versions().count() == 3
    assert [e["version"] for e in map(registry._entry, registry._entries())].__len__() == 3 == len(set(registry._entries()))
    for version, where in versions.items():
        assert registry.load("P_m", version)[0].score(df).count() == df.count() and registry._file_system(where)[1].exists(registry._file_system(where)[0])
    assert registry.find("P_m")["version"] in versions and "exists" in register("v1")
