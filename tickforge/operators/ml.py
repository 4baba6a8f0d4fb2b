"""Direction classifier on MLlib: data stays distributed from split to predictions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickforge import schemas, settings
from tickforge.functions.clock import micros
from tickforge.operators.ordered import _POSITION, positioned
from tickforge.session import shared_dir, stage

LABEL = "target"
IDENTITY = ("symbol", "timestamp_parsed")
TIMES = ("timestamp_parsed",)


# ----------------------------------------------------------------- training

def prepare(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with every feature and the target present."""
    return features.dropna(subset=(columns or settings.FEATURE_COLUMNS) + [LABEL])


def draw(identity: tuple[str, ...] = IDENTITY, seed: int = 42) -> Column:
    """A number in [0, 2^32) from a row's identity: the leading digits of an md5, which any
    engine can compute."""
    parts = [F.coalesce((micros(c) if c in TIMES else F.col(c)).cast("string"), F.lit("")) for c in identity]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")


def cuts(df: DataFrame, test_share: float, seed: int, identity: tuple[str, ...]) -> list[tuple[int | None, int]]:
    """(class, largest draw of its test set): the exact order statistic at ``test_share``.

    Found in two counts, by the upper and then the lower 16 bits of the draws, so at most
    65,536 counts per class reach the driver however many rows there are, and the layout of
    the rows cannot change them.
    """
    upper, lower = F.shiftright(draw(identity, seed), 16), draw(identity, seed)
    found = []
    rows = df.groupBy(F.col(LABEL).cast("int").alias("c"), upper.alias("u")).count().collect()
    for c in {r.c for r in rows}:
        left = int(sum(r["count"] for r in rows if r.c == c) * test_share + 0.5)
        for r in sorted((r for r in rows if r.c == c), key=lambda r: r.u):
            if left <= r["count"]:
                found.append((c, r.u, left))
                break
            left -= r["count"]
    out = []
    for c, u, left in found:
        part = df.filter(F.col(LABEL).cast("int").eqNullSafe(F.lit(c)) & (upper == u)).groupBy(lower.alias("d")).count()
        cut = -1
        for r in sorted(part.collect(), key=lambda r: r.d):
            if left <= 0:
                break
            cut, left = r.d, left - r["count"]
        out.append((c, cut))
    return out


def with_split(df: DataFrame, test_share: float = 0.2, seed: int = 42,
               identity: tuple[str, ...] = IDENTITY) -> DataFrame:
    """``df`` with the column ``dataset``: train or test, stratified by class.

    Each row draws from a hash of its identity; the ``test_share`` of each class with the
    smallest draws is its test set.  Rows of one identity stay together.
    """
    in_test = F.lit(False)
    for c, cut in cuts(df, test_share, seed, identity):
        in_test = in_test | (F.col(LABEL).cast("int").eqNullSafe(F.lit(c)) & (draw(identity, seed) <= cut))
    return df.withColumn("dataset", F.when(in_test, "test").otherwise("train"))


def split(df: DataFrame, test_share: float = 0.2, seed: int = 42,
          identity: tuple[str, ...] = IDENTITY) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of :func:`with_split`."""
    parted = with_split(df, test_share, seed, identity)
    return tuple(parted.filter(F.col("dataset") == d).drop("dataset") for d in ("train", "test"))


#: Units in which the place of a time is sought: a count by day, by second of one day, by microsecond of one second.
_UNITS = (86_400_000_000, 1_000_000, 1)


def time_at(rows: DataFrame, share: float, ts: str = "timestamp_parsed") -> int | None:
    """The time, in microseconds, of row ``floor(share * n)`` (from 0) in order of time; None without rows.

    Rows without a time don't count.

    An exact order statistic from three counts, each within the unit that the one before found, so the driver sees one
    count per day, then at most 86,400, then at most a million, however many rows there are.
    """
    if not 0.0 <= share < 1.0:
        raise ValueError("a share is at least 0 and below 1")
    within, low, left = rows.where(F.col(ts).isNotNull()).select(micros(ts).alias("_t")), 0, None
    for unit in _UNITS:
        since_low = F.col("_t") - F.lit(low)
        slot = ((since_low - F.pmod(since_low, F.lit(unit))) / F.lit(unit)).cast("bigint")    # floor, before 1970, too
        counts = sorted(within.groupBy(slot.alias("slot")).count().collect())
        if left is None:
            left = int(share * sum(n for _, n in counts))
        if not counts:
            return None
        for at, n in counts:
            if left < n:
                low += at * unit
                within = within.where((F.col("_t") >= low) & (F.col("_t") < low + unit))
                break
            left -= n
    return low


def with_time_split(df: DataFrame, test_share: float = 0.2, embargo: timedelta = timedelta(hours=1),
                    ts: str = "timestamp_parsed", frame: tuple[str, str] = ("frame_from", "frame_to")) -> DataFrame:
    """``df`` with the column ``dataset``: train, test or purged.

    The cut is the exact time after which ``test_share`` of the rows lie.  A training row has seen nothing from the cut
    on: neither its own tick nor the one that decides its target.  A test row has seen nothing before the cut: its
    longest frame begins there or later, and it lies ``embargo`` or more behind it.  Rows whose frame crosses the cut,
    rows under embargo and rows without a time are purged.  Ticks of one instant are on one side.
    """
    if test_share <= 0.0:
        raise ValueError("a test set needs a share of the rows")
    cut = time_at(df, 1.0 - test_share, ts)
    if cut is None:
        return df.withColumn("dataset", F.lit("purged"))
    wait = embargo // timedelta(microseconds=1)
    at, open_ = (F.timestamp_micros(F.lit(t)).cast(df.schema[ts].dataType) for t in (cut, cut + wait))
    train = (F.col(ts) < at) & (F.coalesce(frame[1], ts) < at)
    test = (F.coalesce(frame[0], ts) >= at) & (F.col(ts) >= open_)
    return df.withColumn("dataset", F.when(train, "train").when(test, "test").otherwise("purged"))


#: Bins of a feature, and so split candidates, as many as the trees take.
BINS = 32
#: Rows of a partition that fits trees: fewer only while cores would be idle, never more.
FEW_ROWS, MANY_ROWS = 10_000, 1_000_000


def quantiles(rows: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """feature, at, value: the exact order statistics at 1/bins, 2/bins, ... of every feature.

    All (feature, value) pairs are put in one order; a pair's place is known from the sizes of the range partitions, so
    neither samples nor sketches nor the layout of the rows have a part in it, and no feature is one task's work.
    """
    values = rows.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])).alias("v")).select(
        "v._c", "v.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    placed = positioned(values, "_c", "value", [])     # by number: shorter rows, and faster to compare than names
    span = placed.groupBy("_c").agg(F.min(_POSITION).alias("_first"), F.count("*").alias("_n"))     # a row a feature
    at = F.explode(F.array(*[F.lit(k) for k in range(1, bins)]))
    wanted = span.withColumn("at", at).select(
        F.col("_c").alias("_f"), "at", (F.col("_first") + F.expr(f"(_n * at) div {bins}")).alias("_p"))
    names = F.array(*[F.lit(c) for c in columns])
    return placed.join(F.broadcast(wanted), (F.col(_POSITION) == F.col("_p")) & (F.col("_c") == F.col("_f"))).select(
        names[F.col("_c")].alias("feature"), "at", "value")


def binner(found: DataFrame, columns: list[str]) -> Bucketizer:
    """Bins between the distinct quantiles of each feature; equal ones make one bin."""
    cut = {c: set() for c in columns}
    for r in found.collect():       # fewer than bins a feature
        cut[r.feature].add(r.value)
    inf = float("inf")
    splits = [[-inf, *sorted(cut[c] or {0.0}), inf] for c in columns]
    return Bucketizer(splitsArray=splits, inputCols=columns, outputCols=[f"{c}_bin" for c in columns], handleInvalid="keep")


def layout(n_rows: int, cores: int) -> int:
    """Partitions to fit ``n_rows`` with: one per core if there are rows for them, more where rows are many."""
    return max(1, min(cores, n_rows // FEW_ROWS), -(-n_rows // MANY_ROWS))


def train(rows: DataFrame, columns: list[str] | None = None, trees: int = 100, depth: int = 5,
          rate: float = 0.1, seed: int = 42, partitions: int | None = None, fit_rows: int | None = None) -> PipelineModel:
    """Gradient-boosted trees; every tenth round is checkpointed to the shared folder.

    Features are binned by exact quantiles, which the model holds, so the trees find the same split candidates however
    rows are laid out: one seed gives one model, whatever the number of partitions, which follows the number of rows.
    With ``fit_rows`` at most that many rows, the first by their hash, are used; rows that lack a value are not.
    """
    columns = columns or settings.FEATURE_COLUMNS
    context = rows.sparkSession.sparkContext
    context.setCheckpointDir(shared_dir(rows.sparkSession))
    if fit_rows is not None:
        rows = rows.orderBy(draw(seed=seed + 1), *IDENTITY).limit(fit_rows)
    rows = stage(rows.select(*IDENTITY, *[c for c in columns if c not in IDENTITY], LABEL).dropna(subset=[*columns, LABEL]), "fit")
    n = partitions or layout(rows.count(), context.defaultParallelism)
    bins = binner(quantiles(rows, columns), columns)
    laid = rows.repartition(n, *IDENTITY).sortWithinPartitions(*IDENTITY)
    return Pipeline(stages=[
        bins,
        VectorAssembler(inputCols=bins.getOutputCols(), outputCol="vector", handleInvalid="keep"),
        GBTClassifier(featuresCol="vector", labelCol=LABEL, maxIter=trees, maxDepth=depth,
                      stepSize=rate, seed=seed, maxBins=BINS),
    ]).fit(laid.select(*columns, LABEL))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_metrics(measured: DataFrame, path: str) -> None:
    """Metrics by dataset, beside the model they were measured with."""
    measured.coalesce(1).write.mode("overwrite").parquet(f"{path}/measured")


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/measured")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_columns(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def importance(spark: SparkSession, model: PipelineModel, top: int | None = None) -> DataFrame:
    """One row per feature, most important first; optionally only the ``top`` ones."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(feature_columns(model), weights))
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)


# ------------------------------------------------------------------ scoring

def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Class, probabilities, label, confidence and correctness; NULL features score as 0."""
    scored = model.transform(features.fillna(0, subset=feature_columns(model)))
    chance = vector_to_array("probability")
    return label(scored.withColumns({
        "prediction": F.col("prediction").cast("int"),
        "probability_down": chance[0],
        "probability_up": chance[1],
    }).drop("vector", "rawPrediction", "probability", *model.stages[0].getOutputCols()))


def label(predicted: DataFrame) -> DataFrame:
    """Presentation columns for rows with prediction and class probabilities."""
    return predicted.withColumns({
        "prediction_label": side(F.col("prediction")),
        "actual_label": F.coalesce(side(F.col(LABEL)), F.lit("PENDING")),
        "confidence": F.greatest("probability_down", "probability_up"),
        "correct": F.coalesce(F.col("prediction") == F.col(LABEL), F.lit(False)),
    })


def side(c: Column) -> Column:
    return F.when(c == 1, "UP").when(c == 0, "DOWN")


def predictions_table(predicted: DataFrame) -> DataFrame:
    """Declared predictions contract; the creation time is stamped on write."""
    return schemas.conform(predicted.withColumnRenamed(LABEL, "actual"),
                           schemas.WAREHOUSE_DDL["ml.predictions"], absent=("created_at",)).drop("created_at")


# --------------------------------------------------------------- evaluation

def confusion_matrix(predicted: DataFrame) -> DataFrame:
    return predicted.filter(F.col(LABEL).isNotNull()).groupBy(
        F.col(LABEL).cast("int").alias("actual"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("count"))


def metrics(predicted: DataFrame, dataset: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 in one aggregation (0 where undefined)."""
    actual, guess, n = F.col("actual"), F.col("prediction"), F.col("count")
    cell = {
        "tp": (actual == 1) & (guess == 1), "fp": (actual == 0) & (guess == 1),
        "fn": (actual == 1) & (guess == 0), "tn": (actual == 0) & (guess == 0),
    }
    counts = confusion_matrix(predicted).agg(*[
        F.coalesce(F.sum(F.when(at, n)), F.lit(0)).alias(name) for name, at in cell.items()
    ])
    tp, fp, fn, tn = (F.col(c) for c in cell)

    def rate(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    return counts.select(
        F.lit(dataset).alias("dataset"), (tp + fp + fn + tn).alias("rows"),
        rate(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"),
        rate(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def class_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy(LABEL).agg(F.count("*").alias("count"))


def accuracy_by_symbol(predicted: DataFrame, support: int = settings.MIN_SUPPORT) -> DataFrame:
    """Hit rate of symbols with enough known outcomes, best first."""
    known = predicted.filter(F.col(LABEL).isNotNull())
    return known.groupBy("symbol").agg(
        F.count_if("correct").alias("correct"),
        F.count("*").alias("total"),
        F.avg(F.col("correct").cast("int")).alias("accuracy"),
    ).filter(F.col("total") >= support).orderBy(F.desc("accuracy"), "symbol")


def live_accuracy(predicted: DataFrame, measured: DataFrame) -> DataFrame:
    """Accuracy over known outcomes and its distance, in points, from the test accuracy
    stored with the model."""
    live = predicted.filter(F.col(LABEL).isNotNull()).agg(
        F.avg(F.col("correct").cast("int")).alias("live_accuracy"))
    test = measured.filter("dataset = 'test'").agg(F.first("accuracy").alias("_test"))   # one row
    return live.join(test, F.lit(True)).select(
        "live_accuracy", ((F.col("live_accuracy") - F.col("_test")) * 100).alias("delta_points"))


def prediction_distribution(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("prediction_label").agg(F.count("*").alias("count"))


def confidence_histogram(predicted: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per label and equal-width bin of [0.5, 1]; a confidence of 1 is in the last bin."""
    slot = F.least(F.width_bucket("confidence", F.lit(0.5), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return predicted.groupBy("prediction_label", slot.cast("int").alias("bin")).agg(F.count("*").alias("count"))
