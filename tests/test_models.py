import datetime as dt

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from roadpulse.functions import traffic
from roadpulse.functions.casts import round_dec
from roadpulse.ml import evaluate, features, isoforest, score, train
from roadpulse.plans import training_job
from roadpulse.schema import BOROUGHS
from roadpulse.session import spread
from roadpulse.sources import envelope, sinks, tables
from roadpulse.streaming.processing import TablePaths

AS_OF = dt.datetime(2024, 3, 1)
SMALL = {
    "classifier_params": {"numTrees": 20, "maxDepth": 8},
    "regressor_params": {"maxIter": 20, "maxDepth": 5, "stepSize": 0.2},
    "forest_params": {"trees": 60},
}


def generated(spark, n=6000):
    """Links with a base speed by location, slower at peak hours; one in a hundred is an outlier."""
    ident = F.col("id")
    link = (ident * 17) % 200
    at = F.timestamp_seconds(1707000000 + ident * 200)
    hour, day = F.hour(at), F.dayofweek(at)
    noise = (F.pmod(F.xxhash64(ident), F.lit(100)) - 50) / 25.0
    base = 8 + (link % 50)
    speed = F.greatest(F.lit(0.5), base - F.when(traffic.is_peak_hour(hour, day), 6).otherwise(0) + noise)
    outlier = ident % 100 == 37
    speed = F.when(outlier & (ident % 200 == 37), 0.0).when(outlier, speed * 4).otherwise(speed)
    rows = spark.range(n).select(
        F.format_string("r%06d", ident).alias("record_id"), F.concat(F.lit("LINK "), link.cast("string")).alias("link_name"),
        F.element_at(F.array(*[F.lit(b) for b in BOROUGHS]), (link % 5 + 1).cast("int")).alias("borough"),
        F.when(ident % 20 != 3, 40.5 + (link % 50) / 200.0).alias("latitude"), (-74.2 + (link % 50) / 150.0).alias("longitude"),
        speed.alias("speed"), (600 / F.greatest(base, F.lit(1))).cast("int").alias("travel_time"),
        at.alias("processed_at"), hour.alias("hour_of_day"), day.alias("day_of_week"),
        traffic.is_weekend(day).alias("is_weekend"), traffic.is_peak_hour(hour, day).alias("is_peak_hour"),
        outlier.alias("planted"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("data_as_of"),
    )
    return rows.withColumn("congestion_level", traffic.congestion_level(F.col("speed")))


@pytest.fixture(scope="module")
def table(spark):
    df = generated(spark).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def models(table):
    return train.train(table, AS_OF, **SMALL)


def test_accuracy_on_learnable_data(models):
    facts = models.metadata["congestion_classifier"]
    assert facts["metrics"]["test"]["accuracy"] >= 0.75
    assert (facts["train_size"], facts["val_size"], facts["test_size"]) == (4200, 900, 900)
    speeds = models.metadata["speed_predictor"]["metrics"]["test"]
    assert speeds["mae"] < 5 and len(facts["data_signature"]) == 16
    assert 0.03 < models.metadata["anomaly_detector"]["metrics"]["train"]["anomaly_rate"] <= 0.06


def test_imputer_is_fitted_on_training_rows_only(table, models):
    fitting = features.temporal_split(features.training_rows(table))[0]
    median = fitting.where("latitude IS NOT NULL").select(F.median("latitude")).first()[0]
    assert models.metadata["congestion_classifier"]["imputer"]["latitude"] == pytest.approx(median)


def test_planted_outliers_rank_first(table, models):
    """A speed of 0 lies next to the normal range and is hard to isolate, a fourfold speed is far outside."""
    scored = score.score(table, models).select("planted", "speed", "anomaly_score", "is_anomaly").toPandas()
    normal, planted = scored[~scored.planted], scored[scored.planted]
    wins = planted.anomaly_score.to_numpy()[:, None] < normal.anomaly_score.to_numpy()[None, :]
    assert wins.mean() > 0.75
    high = planted[planted.speed > 80]
    assert high.anomaly_score.mean() < normal.anomaly_score.mean() - 0.05
    assert high.is_anomaly.mean() > 5 * normal.is_anomaly.mean()


def test_saved_models_give_the_same_predictions(spark, table, models, tmp_path):
    path = str(tmp_path / "models")
    train.save(models, spark, path)
    loaded = train.load(spark, path)
    first = score.traffic_predict(table, models, 50, "Bronx").collect()
    assert first == score.traffic_predict(table, loaded, 50, "Bronx").collect()
    assert len(first) == 50 and {r["borough"] for r in first} == {"Bronx"}
    names = [r["feature"] for r in train.importance_table(spark, loaded.metadata["speed_predictor"]["importances"]).collect()]
    assert set(names) == set(features.CAUSAL_FEATURES)
    with pytest.raises(Exception):
        train.load(spark, str(tmp_path / "nothing"))


def test_rows_that_cannot_be_scored_are_unknown(table, models):
    broken = table.limit(1).withColumn("speed", F.lit(float("nan")))
    row = score.score(broken, models).first()
    assert (row["predicted_congestion"], row["congestion_confidence"]) == ("UNKNOWN", 0.0)
    assert row["predicted_speed"] is None and row["is_anomaly"] is None and row["anomaly_score"] is None


def test_rows_without_all_columns_are_scored(spark, models):
    row = score.score(spark.createDataFrame([("Bronx", 20.0)], "borough string, speed double"), models).first()
    assert row["predicted_congestion"] != "UNKNOWN" and row["predicted_speed"] >= 0


def test_minimum_rows(table):
    with pytest.raises(ValueError, match="at least 1000"):
        train.train(table.limit(100), AS_OF, **SMALL)


def test_search_over_expanding_windows(table):
    rows = train.with_inputs(features.with_class_weights(features.training_rows(table.limit(1500))))
    medians = features.fit_imputer(rows, features.CAUSAL_FEATURES)
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="class_prediction", metricName="f1")
    best, mean = train.search(rows, train.classifier, {"numTrees": [3], "maxDepth": [1, 6]}, medians, evaluator, folds=2)
    assert best == {"numTrees": 3, "maxDepth": 6} and 0 < mean <= 1
    assert len(train.grid(train.CLASSIFIER_GRID)) == 12 and len(train.grid(train.REGRESSOR_GRID)) == 8


def test_report_agrees_with_the_library_evaluator(table):
    rows = features.training_rows(table).withColumn("predicted", F.when(F.rand(5) < 0.3, 3).otherwise(F.col("label"))).persist()
    report = evaluate.classification_report(rows, "label", "predicted")
    summary = evaluate.classification_summary(report).first()
    pairs = rows.select(F.col("label").cast("double"), F.col("predicted").cast("double").alias("prediction"))
    for metric, name in (("accuracy", "accuracy"), ("f1", "weighted_f1")):
        found = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(pairs)
        assert summary[name] == pytest.approx(found)
    rows.unpersist()


def test_every_tree_gets_its_own_rows(table):
    for n, trees, size in ((6000, 20, 64), (100, 20, 64), (30, 7, 64)):
        samples, psi = isoforest.tree_samples(table.limit(n), ["speed"], trees, size, 42, "record_id")
        counts = samples.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("_rn").alias("d")).collect()
        assert sorted(r["tree"] for r in counts) == list(range(trees))
        assert {r["n"] for r in counts} == {psi} and {r["d"] for r in counts} == {psi}


def test_forest_is_the_same_on_every_layout(table):
    rows = features.impute(features.training_rows(table), {c: 0.0 for c in features.ANOMALY_FEATURES})
    first = isoforest.fit(rows, features.ANOMALY_FEATURES, trees=10)
    again = isoforest.fit(rows.repartition(5), features.ANOMALY_FEATURES, trees=10)
    assert first.offset == pytest.approx(again.offset)
    key = ["tree", "node"]
    assert first.nodes.sort_values(key).reset_index(drop=True).equals(again.nodes.sort_values(key).reset_index(drop=True))


def test_jobs_and_live_scoring(spark, table, tmp_path):
    from roadpulse.streaming.windows import start_scoring
    from readings import envelope_rows, variant, write_envelope

    paths, model_path = TablePaths(str(tmp_path / "tables")), str(tmp_path / "models")
    sinks.write_processed(table.drop("planted"), paths.processed, 0)
    models = training_job.run_training(spark, paths, model_path, AS_OF, **SMALL)
    report = training_job.run_evaluation(spark, paths, model_path, AS_OF, days=30, unseen_only=False)
    values = {(r["section"], r["metric"]): r["value"] for r in report.collect()}
    assert values[("classifier", "passed")] == 1.0 and values[("regressor", "samples")] == 6000.0

    folder = str(tmp_path / "topic")
    write_envelope(folder, "f", envelope_rows([variant(id=str(i)) for i in range(5)]))
    stream = envelope.stream_files(spark, folder)
    query = start_scoring(stream, models, paths, str(tmp_path / "cp"), once=True)
    assert query.awaitTermination(120)
    rows = tables.read_parts(spark, paths.predictions).collect()
    assert len(rows) == 5 and all(r["is_anomaly"] is not None and r["predicted_speed"] >= 0 for r in rows)

    # a newer version is taken by the next micro-batch, half-written ones are not
    shelf = str(tmp_path / "shelf")
    for k, version in enumerate(("1.9", "1.10")):
        train.save(models, spark, f"{shelf}/{version}")
        (tmp_path / "shelf" / "2.0").mkdir(exist_ok=True)
        write_envelope(f"{folder}2", f"f{k}", envelope_rows([variant(id=f"{version}-{i}") for i in range(3)], start=100 + 10 * k))
        query = start_scoring(envelope.stream_files(spark, f"{folder}2"), shelf, paths, str(tmp_path / "cp2"), once=True)
        assert query.awaitTermination(120)
    found = tables.read_parts(spark, paths.predictions).where("record_id like '1.%'").collect()
    assert len(found) == 6 and all(r["record_id"].split("-")[0] == r["model_version"] for r in found)


def test_rounding_of_predictions(spark):
    df = spark.createDataFrame([(0.123456,)], "v double")
    assert df.select(round_dec(F.col("v"), 4)).first()[0] == 0.1235


def test_registered_queries_train_at_published_settings(spark, table, monkeypatch):
    """The sizes that reach the learners are the defaults: 200 trees of depth 12, 200 rounds of depth 5, 200 isolation trees."""
    from types import SimpleNamespace

    from roadpulse.plans.catalog import streams

    seen = {}

    class Reached(Exception):
        pass

    def fit_all(labelled, tune, classifier_params, regressor_params, forest_params, version):
        seen["classifier"], seen["regressor"] = train.classifier(classifier_params), train.regressor(regressor_params)
        seen["forest"] = forest_params
        raise Reached

    def tree_samples(df, features, trees, *rest):
        seen["trees"] = trees
        raise Reached

    monkeypatch.setattr(train, "_fit_all", fit_all)
    monkeypatch.setattr(isoforest, "tree_samples", tree_samples)
    t = SimpleNamespace(spark=spark, folder="none", traffic=table.drop("planted"))
    for query in (streams.m13, streams.m14, streams.p2, streams.m19):
        seen.clear()
        with pytest.raises(Reached):
            query(t)
        assert (seen["classifier"].getNumTrees(), seen["classifier"].getMaxDepth()) == (200, 12)
        assert (seen["regressor"].getMaxIter(), seen["regressor"].getMaxDepth()) == (200, 5)
        assert not seen["forest"]
    with pytest.raises(Reached):
        streams.m6(t)
    assert seen["trees"] == 200


def test_training_uses_several_tasks_and_does_not_follow_the_layout(table):
    rows = table.select("record_id", "processed_at", "speed")
    one, many = (train.dealt(rows.repartition(n), 30_000).rdd.glom().collect() for n in (1, 7))
    assert len(one) == 3 and one == many and min(len(part) for part in one) > 1000
    assert sum(len(part) for part in one) == rows.count()


def test_forest_keeps_nodes_and_rows_are_cleaned_once(spark, table, monkeypatch):
    """The settings of the trees are unchanged; what training reads many times is narrow and over all cores."""
    assert train.classifier().getCacheNodeIds() and train.classifier(SMALL["classifier_params"]).getCacheNodeIds()
    rows = train.training_input(table.coalesce(1).withColumn("payload", F.lit("x")), AS_OF)
    assert "payload" not in rows.columns and {"label", "processed_at", "data_as_of", "borough"} <= set(rows.columns)
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    seen = []
    monkeypatch.setattr(train, "_fit_all", lambda labelled, *rest: seen.append(labelled._jdf.queryExecution().withCachedData().toString()))
    train.train(table, AS_OF)
    assert seen[0].startswith("InMemoryRelation")


def test_rows_are_arranged_by_their_inputs(spark, models, table):
    """Like rows follow each other; which rows there are and what is predicted does not change."""
    parts = score.arranged(table.coalesce(1)).select("latitude", "longitude").rdd.glom().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and sum(map(len, parts)) == table.count()
    for part in parts:
        keys = [(r.latitude is not None, r.latitude or 0.0, r.longitude) for r in part]
        assert keys == sorted(keys)
    columns = ["record_id", *score.PREDICTION_COLUMNS]
    some = table.limit(500)
    assert sorted(score.score(score.arranged(some), models).select(*columns).collect()) == sorted(score.score(some, models).select(*columns).collect())


def test_scoring_uses_all_cores(spark, table):
    assert spread(table.coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
