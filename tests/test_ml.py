import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tickforge import settings
from tickforge.operators import ml
from tickforge.plans import catalogue

from tests.helpers import as_dicts, at


def predictions(spark, rows):
    return ml.label(spark.createDataFrame(
        [(s, at(i), p, t, up, 1 - up) for i, (s, t, p, up) in enumerate(rows)],
        "symbol string, timestamp_parsed timestamp, prediction int, target int, probability_up double, "
        "probability_down double"))


def test_metrics_by_hand(spark):
    rows = [("A", 1, 1, 0.9)] * 3 + [("A", 0, 1, 0.6)] * 2 + [("B", 1, 0, 0.2)] + [("B", 0, 0, 0.1)] * 4 + [("B", None, 1, 0.7)]
    df = predictions(spark, rows)
    got = ml.metrics(df, "x").first()
    assert (got.rows, got.accuracy, got.precision, got.recall) == (10, 0.7, 0.6, 0.75)
    assert got.f1_score == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert sum(r["count"] for r in ml.confusion_matrix(df).collect()) == 10
    assert [tuple(r) for r in ml.accuracy_by_symbol(df).collect()] == [("B", 4, 5, 0.8), ("A", 3, 5, 0.6)]
    assert ml.accuracy_by_symbol(df.filter("target = 0 or symbol = 'A'")).count() == 1   # B has four left
    stored = spark.createDataFrame([("train", 0.9), ("test", 0.6)], "dataset string, accuracy double")
    live = ml.live_accuracy(df, stored).first()
    assert (live.live_accuracy, round(live.delta_points, 6)) == (0.7, 10.0)
    assert {r["actual_label"] for r in as_dicts(df)} == {"UP", "DOWN", "PENDING"}


def test_class_never_predicted(spark):
    got = ml.metrics(predictions(spark, [("A", 1, 0, 0.1), ("A", 0, 0, 0.1)]), "x").first()
    assert (got.accuracy, got.precision, got.recall, got.f1_score) == (0.5, 0.0, 0.0, 0.0)


def test_confidence_bins(spark):
    df = predictions(spark, [("A", 1, 1, 0.5), ("A", 1, 1, 0.52499), ("A", 1, 1, 0.526), ("A", 1, 1, 1.0), ("A", 0, 0, 0.0)])
    got = {(r.prediction_label, r.bin): r["count"] for r in ml.confidence_histogram(df).collect()}
    assert got == {("UP", 1): 2, ("UP", 2): 1, ("UP", 20): 1, ("DOWN", 20): 1}


@pytest.fixture(scope="module")
def rows(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "t")
    catalogue.feature_rows(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_split_is_stratified_and_repeatable(spark, rows):
    prepared = ml.prepare(rows)
    assert prepared.count() < rows.count()      # first ticks lack a deviation
    fit, held = ml.split(prepared)
    again = ml.split(prepared.repartition(7))[1]
    assert held.count() + fit.count() == prepared.count()
    assert held.exceptAll(again).count() == 0
    sizes = {r.target: r["count"] for r in ml.class_distribution(prepared).collect()}
    for r in ml.class_distribution(held).collect():
        assert abs(r["count"] / sizes[r.target] - 0.2) < 0.02


def test_split_of_many_rows_does_not_depend_on_their_layout(spark):
    df = spark.range(0, 250_000, 1, 8).select(
        F.concat(F.lit("S"), F.col("id") % 90).alias("symbol"),
        F.timestamp_seconds(F.col("id") * 7).alias("timestamp_parsed"), (F.col("id") % 2).cast("int").alias("target"))
    marks = [parted.groupBy("target", "dataset").agg(F.count("*"), F.sum(F.xxhash64("symbol", "timestamp_parsed").cast(
        "decimal(38,0)"))).collect() for parted in (ml.with_split(df), ml.with_split(df.repartition(3)),
                                                    ml.with_split(df.filter("id % 10 >= 0").orderBy("symbol")))]
    assert sorted(marks[0]) == sorted(marks[1]) == sorted(marks[2])
    assert all(abs(r[2] / 125_000 - (0.2 if r.dataset == "test" else 0.8)) < 0.005 for r in marks[0])


def test_metrics_are_stored_beside_the_model(spark, tmp_path):
    measured = ml.metrics(predictions(spark, [("A", 1, 1, 0.9), ("A", 0, 1, 0.6)]), "test")
    ml.save_metrics(measured, str(tmp_path / "m"))
    assert ml.stored_metrics(spark, str(tmp_path / "m")).first().accuracy == 0.5


def answers(scored):
    return sorted(map(tuple, scored.select("symbol", "timestamp_parsed", "prediction", "probability_up").collect()))


def test_train_score_save_load(spark, rows, tmp_path):
    fit, held = ml.split(ml.prepare(rows))
    model = ml.train(fit, trees=3, depth=3)
    scored = ml.predict(model, held)
    assert scored.filter("abs(probability_up + probability_down - 1) > 1e-9").count() == 0
    assert scored.filter("prediction <> cast(probability_up > 0.5 as int)").count() == 0
    ml.save(model, str(tmp_path / "model"))
    loaded = ml.load(str(tmp_path / "model"))
    assert ml.feature_columns(loaded) == settings.FEATURE_COLUMNS
    first = answers(scored)
    assert answers(ml.predict(loaded, held)) == first
    assert answers(ml.predict(ml.train(fit, trees=3, depth=3), held)) == first
    weights = ml.importance(spark, model)
    assert weights.count() == 17 and weights.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    nulls = ml.predict(model, held.withColumn("price_std_10", F.lit(None).cast("double")))
    assert nulls.count() == held.count()
    table = ml.predictions_table(scored)
    assert len(table.columns) == 10 and table.count() == held.count()


def test_quantiles_are_exact_order_statistics(spark):
    r = random.Random(1)
    data = [(float(r.choice([r.random(), 0.5, 7])), None if i % 9 == 0 else float(i % 4)) for i in range(1000)]
    df = spark.createDataFrame(data, "a double, b double")
    for part in (df, df.repartition(7)):
        found = {(x.feature, x["at"]): x.value for x in ml.quantiles(part, ["a", "b"], 8).collect()}
        for k, name in enumerate("ab"):
            column = sorted(d[k] for d in data if d[k] is not None)
            assert [found[name, j] for j in range(1, 8)] == [column[len(column) * j // 8] for j in range(1, 8)]


def test_one_model_for_every_layout(spark, rows):
    fit, held = ml.split(ml.prepare(rows))

    def shape(model):
        trees = model.stages[-1].toDebugString
        return re.sub(r"GBTClassif\S+|(Predict: \S{8})\S*", r"\1", trees)
    few, many = (ml.train(fit.repartition(n), trees=4, depth=4, partitions=n) for n in (2, 64))
    assert shape(few) == shape(many)
    assert [(a[:3], round(a[3], 9)) for a in answers(ml.predict(few, held))] == [
        (a[:3], round(a[3], 9)) for a in answers(ml.predict(many, held))]


def test_partitions_follow_the_rows():
    assert [ml.layout(n, 8) for n in (0, 9_999, 20_000, 10 ** 6, 10 ** 8)] == [1, 1, 2, 8, 100]


FRAMED = "id int, timestamp_parsed timestamp_ntz, frame_from timestamp_ntz, frame_to timestamp_ntz"


def test_time_of_a_place_is_exact_in_any_layout(spark):
    r = random.Random(3)
    times = [r.randrange(-5 * 86_400_000_000, 5 * 86_400_000_000) for _ in range(300)] + [7] * 60 + [-1, 86_400_000_000]
    df = spark.createDataFrame([(t,) for t in times], "t bigint").select(
        F.timestamp_micros("t").cast("timestamp_ntz").alias("timestamp_parsed"))
    df = df.unionByName(df.limit(5).select(F.lit(None).cast("timestamp_ntz").alias("timestamp_parsed")))
    for share in (0.0, 0.3, 0.5, 0.55, 0.999):
        want = sorted(times)[int(share * len(times))]
        assert ml.time_at(df, share) == want == ml.time_at(df.repartition(5), share), share
    assert ml.time_at(df.limit(0), 0.5) is None
    with pytest.raises(ValueError):
        ml.time_at(df, 1.0)


def test_time_split_purges_what_crosses_the_cut(spark):
    # a tick every minute, frames of two ticks; the cut for a share of 0.4 of ten rows lies at the seventh
    rows = [(i, at(60 * i), at(60 * max(0, i - 2)), at(60 * (i + 1))) for i in range(10)]
    df = spark.createDataFrame([*rows, (99, None, None, None)], FRAMED)
    sets = lambda **kw: {x.id: x.dataset for x in ml.with_time_split(df, 0.4, **kw).collect()}
    got = sets(embargo=timedelta(0))
    assert [got[i] for i in range(10)] == ["train"] * 5 + ["purged"] * 3 + ["test"] * 2 and got[99] == "purged"
    got = sets(embargo=timedelta(minutes=3))
    assert [got[i] for i in range(10)] == ["train"] * 5 + ["purged"] * 4 + ["test"]
    assert ml.with_time_split(df.limit(0), 0.4).collect() == []
    # all ticks at one instant: nothing lies before the cut
    one = df.where("id < 10").withColumns(dict.fromkeys(FRAMED_TIMES, F.lit(at(0)).cast("timestamp_ntz")))
    assert {x.dataset for x in ml.with_time_split(one, 0.4, timedelta(0)).collect()} == {"test"}


FRAMED_TIMES = ["timestamp_parsed", "frame_from", "frame_to"]
