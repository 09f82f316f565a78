"""Breach-risk model (G1-G7) on the monthly scorecard.

Labels come from a quantile of incident cost, the split is by month
position, the model is MLlib's distributed random forest on telemetry only,
and AUC is the exact rank statistic of ``functions.stats.rank_auc``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.functions.stats import exact_percentile, rank_auc
from ledgerspark.operators.deviation import latest_per_area

FEATURES = ("packet_loss", "latency", "mtbf", "uptime")
TARGET = "incident_cost"
LABEL = "high_risk"


def risk_labels(sam: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET,
                q: float = 0.75, approx: bool = False, fit_on: str = "all",
                n_train: int = 9) -> DataFrame:
    """G1: drop rows missing a feature or the target; high_risk = target > q-quantile.

    The quantile is exact (linear interpolation, ``functions.stats.exact_percentile``:
    no single task holds all values) and attached as a scalar subquery; it is
    taken over all remaining rows (``fit_on="all"``, the reference's choice,
    which lets test months shape the label) or over the first `n_train`
    months only (``fit_on="train"``). ``approx=True`` uses a sketch instead.
    """
    df = sam.dropna(subset=list(features) + [target])
    basis = df if fit_on == "all" else time_split(df, n_train).where(F.col("split") == "train")
    thr = (basis.select(F.percentile_approx(target, q, 100000)) if approx
           else exact_percentile(basis, target, q)).scalar()
    return df.select("service_area", "period", *features, target,
                     (F.col(target) > thr).cast("int").alias(LABEL))


def time_split(df: DataFrame, n_train: int = 9, period: str = "period") -> DataFrame:
    """Adds `split`: train before the (n_train+1)-th distinct period, test from it on.

    With fewer distinct periods every row is train (an empty test set). Only
    the distinct periods are ranked.
    """
    months = df.select(period).distinct()
    cut = (months.withColumn("_rn", F.row_number().over(Window.orderBy(period)))
                 .where(F.col("_rn") == n_train + 1).select(period))
    c = cut.scalar()
    split = F.when(c.isNull() | (F.col(period) < c), "train").otherwise("test")
    return df.withColumn("split", split).withColumn("cut", c)


def risk_time_split(labeled: DataFrame, n_train: int = 9) -> DataFrame:
    """Rows and positives per split, with the cut period."""
    s = time_split(labeled, n_train)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(LABEL).cast("long").alias("positives"),
                                  F.max("cut").alias("cut"))


def risk_frame(labeled: DataFrame, n_train: int = 9) -> DataFrame:
    """What G3 scores and is trained on, without the model: (area, period, high_risk, split)."""
    return time_split(labeled, n_train).select("service_area", "period", LABEL, "split")


def watch_months(labeled: DataFrame) -> DataFrame:
    """The months that G6 scores: each area's latest labelled one, with its features."""
    return latest_per_area(labeled)


def fit_risk_model(train: DataFrame, features: Sequence[str] = FEATURES, trees: int = 200,
                   depth: int = 4, seed: int = 0) -> PipelineModel:
    """Random forest on telemetry features only (no incident-count leakage)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="_features")
    rf = RandomForestClassifier(featuresCol="_features", labelCol=LABEL, numTrees=trees,
                                maxDepth=depth, seed=seed, probabilityCol="_prob",
                                rawPredictionCol="_raw", predictionCol="_pred")
    return Pipeline(stages=[asm, rf]).fit(train.withColumn(LABEL, F.col(LABEL).cast("double")))


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Adds the probability of high risk (0 where the training months held no high-risk one)."""
    out = model.transform(df)
    high = F.coalesce(F.get(vector_to_array("_prob"), F.lit(1)), F.lit(0.0))
    return out.withColumn(name, high).drop("_features", "_prob", "_raw", "_pred")


def risk_scores(labeled: DataFrame, n_train: int = 9, features: Sequence[str] = FEATURES,
                seed: int = 0) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train months, score the test months.

    The forest makes several passes over its input; the (aggregated, one row
    per area and month) training rows are persisted for the fit so the label
    quantile and the split month are not recomputed on every pass.
    """
    s = time_split(labeled, n_train)
    train = s.where(F.col("split") == "train").select(*features, LABEL).persist()
    try:
        model = fit_risk_model(train, features, seed=seed)
    finally:
        train.unpersist()
    test = score(model, s.where(F.col("split") == "test"))
    return model, test.select("service_area", "period", LABEL, "score")


def risk_auc(scored: DataFrame, score_col: str = "score") -> DataFrame:
    """Exact ROC-AUC of a score on the rows given (NULL with one class)."""
    return rank_auc(scored, score_col, LABEL)


def risk_feature_importance(spark: SparkSession, model: PipelineModel,
                            features: Sequence[str] = FEATURES) -> DataFrame:
    """The forest's feature importances (one value per feature), descending."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    # One literal row per feature, built in the JVM (no Python worker round trip).
    rows = [F.struct(F.lit(f).alias("feature"), F.lit(float(v)).alias("importance"))
            for f, v in zip(features, imp)]
    df = spark.range(1).select(F.inline(F.array(*rows)))
    return df.orderBy(F.col("importance").desc(), "feature")


def plain_score() -> Column:
    """A fixed risk score of the features: losses and delay count, time between failures speaks against."""
    return (F.col("packet_loss") * 2.0 + F.col("latency") * 0.05 - F.col("mtbf") * 0.0001) + (100.0 - F.col("uptime"))


def _permuted(rows: DataFrame, turns: int, features: Sequence[str], seed: int, blocks: int) -> DataFrame:
    """(feature, turn, label, features): the rows with one feature's values dealt anew, for each feature and turn.

    A block's rows have two hash orders; values of the one go to the rows of the other.
    """
    grid = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(t).alias("turn")) for f in features for t in range(turns)])

    def h(name: str) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("turn").cast("string"), "feature", F.lit(name), "service_area", F.col("period").cast("string")))

    own = F.coalesce(*[F.when(F.col("feature") == f, F.col(f)) for f in features])
    src = rows.select("*", F.explode(grid).alias("_g")).select(*rows.columns, "_g.*")
    src = src.withColumns({"_b": F.pmod(F.conv(F.substring(h("block"), 1, 8), 16, 10).cast("long"), F.lit(blocks)),
                           "_to": h("to"), "_from": h("from"), "_own": own})
    dealt = src.groupBy("feature", "turn", "_b").agg(      # a block's rows: bounded
        F.sort_array(F.collect_list(F.struct("_to", LABEL, *features))).alias("_rows"),
        F.sort_array(F.collect_list(F.struct("_from", F.col("_own").alias("value")))).alias("_values"))
    each = dealt.select("feature", "turn", F.explode(F.arrays_zip("_rows", "_values")).alias("e"))
    value = lambda f: F.when(F.col("feature") == f, F.col("e._values.value")).otherwise(F.col(f"e._rows.{f}"))
    return each.select("feature", "turn", F.col(f"e._rows.{LABEL}").alias(LABEL), *[value(f).alias(f) for f in features])


def permutation_importance(test: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str] = FEATURES, turns: int = 3,
                           seed: int = 11, block_rows: int = 4096) -> DataFrame:
    """G5 for any score: (feature, auc, permuted_auc, importance) on the rows given, the mean over `turns`.

    A feature's importance is what the AUC loses when its values are dealt anew
    among the rows. Rows are dealt within blocks by hashes of (area, month) and the
    seed, so the result depends neither on partitioning nor on one global order.
    `score` adds `score` to a frame of features; the AUC is exact (`rank_auc`), NULL
    with one class of labels. Rows are (area, month): one each.
    """
    rows = test.select("service_area", "period", LABEL, *features)
    blocks = max(1, -(-rows.count() // block_rows))
    permuted = rank_auc(score(_permuted(rows, turns, features, seed, blocks)), "score", LABEL, keys=["feature", "turn"])
    base = rank_auc(score(rows), "score", LABEL).select("auc").scalar()
    means = permuted.groupBy("feature").agg(F.avg("auc").alias("permuted_auc"))
    return means.select("feature", base.alias("auc"), "permuted_auc", (base - F.col("permuted_auc")).alias("importance"))


def risk_watchlist(model: PipelineModel, labeled: DataFrame) -> DataFrame:
    """Each area's latest labelled month scored, highest risk first."""
    s = score(model, watch_months(labeled), "risk_score")
    w = Window.orderBy(F.col("risk_score").desc(), F.col("service_area"))
    return s.select("service_area", "period", "risk_score",
                    F.row_number().over(w).alias("position"))


def risk_separation(labeled: DataFrame, n_train: int = 9, features: Sequence[str] = FEATURES,
                    split: str = "test") -> DataFrame:
    """AUC of each feature alone as a score on the test months."""
    s = time_split(labeled, n_train).where(F.col("split") == split)
    long = s.select(LABEL, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [LABEL], list(features), "feature", "value")
    return rank_auc(long, "value", LABEL, keys=["feature"])
