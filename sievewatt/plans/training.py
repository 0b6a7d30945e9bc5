"""Training, judging and applying the risk model, on MLlib throughout."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime, timezone
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewatt.config import RiskSettings
from sievewatt.functions.columns import risk_category
from sievewatt.operators.checks import DAY
from sievewatt.operators.features import KEYS, feature_columns
from sievewatt.operators.ordered import running_totals
from sievewatt.operators.quantiles import stratified_split
from sievewatt.runtime import durable, scratch_path
from sievewatt.sources import tables

# Fixed value: share of the training rows that decides when boosting stops.
VALIDATION_SHARE = 0.2


def split(df: DataFrame, cfg: RiskSettings = RiskSettings()) -> tuple[DataFrame, DataFrame]:
    """Exact stratified split, reproducible for a seed; written once, as both sides are read several times."""
    marked = durable(stratified_split(df, "target", KEYS, cfg.train_fraction, cfg.seed))
    return (
        marked.filter("is_train = 1").drop("is_train"),
        marked.filter("is_train = 0").drop("is_train"),
    )


def time_parts(df: DataFrame, train_fraction: float = 0.8, horizon_days: int = 1) -> DataFrame:
    """``df`` with ``part``: train, gap or test, by day.

    The first test day is the earliest one before which there are at least ``train_fraction`` of all rows that have
    a day. Rows less than ``horizon_days`` before it are the gap: their labels come from test days. Rows without a
    day are in no part.
    """
    per_day = df.filter(F.col(DAY).isNotNull()).groupBy(DAY).agg(F.count(F.lit(1)).alias("_n"))
    # one row per day
    earlier = Window.orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    days = per_day.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    enough = F.col("_before") >= F.lit(train_fraction) * F.sum("_n").over(Window.partitionBy()) - 1e-9
    edge = days.select(DAY, enough.alias("_enough")).agg(F.min(F.when(F.col("_enough"), F.col(DAY))).alias("_edge"))
    since = F.datediff(DAY, "_edge")
    # no day has that many rows before it: all of them are for training
    part = (
        F.when(F.col(DAY).isNull(), None).when(F.col("_edge").isNull(), "train")
        .when(since >= 0, "test").when(since > -horizon_days, "gap").otherwise("train")
    )
    return df.join(F.broadcast(edge)).withColumn("part", part).drop("_edge")


def split_by_time(df: DataFrame, train_fraction: float = 0.8, horizon_days: int = 1) -> tuple[DataFrame, DataFrame]:
    """Earlier days for training and later ones for testing, with a gap of the horizon between them."""
    marked = time_parts(df, train_fraction, horizon_days)
    return tuple(marked.filter(F.col("part") == p).drop("part") for p in ("train", "test"))


def class_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """(target, rows, weight): positives weigh negatives / positives, negatives one."""
    counts = df.groupBy(F.col(label).alias("target")).agg(F.count(F.lit(1)).alias("rows"))
    # At most one row per class on both sides.
    total = counts.agg(
        F.sum(F.when(F.col("target") == 0, F.col("rows"))).alias("_neg"),
        F.sum(F.when(F.col("target") == 1, F.col("rows"))).alias("_pos"),
    ).withColumn("target", F.explode(F.array(F.lit(0), F.lit(1))))
    weight = F.when((F.col("target") == 1) & (F.col("_pos") > 0), F.coalesce("_neg", F.lit(0)) / F.col("_pos"))
    return counts.join(F.broadcast(total), "target").select("target", "rows", F.coalesce(weight, F.lit(1.0)).alias("weight"))


def train(
    train_rows: DataFrame,
    cfg: RiskSettings = RiskSettings(),
    categories: Sequence[str] = (),
) -> tuple[PipelineModel, list[str]]:
    """Fit the model; returns it with the names of the numeric features it uses.

    Boosting holds back a stratified part of the training rows and stops when it no longer gains.
    """
    numbers = feature_columns(train_rows)
    weights = {r["target"]: r["weight"] for r in class_weights(train_rows).collect()}
    if len(weights) < 2:
        raise ValueError("training needs both classes; the target has only one")
    # Written once: every stage of the pipeline reads these rows anew.
    held = durable(stratified_split(train_rows, "target", KEYS, 1 - VALIDATION_SHARE, cfg.seed + 1))
    ready = (
        held.fillna(0.0, subset=numbers)
        .withColumn("label", F.col("target").cast("double"))
        .withColumn("_weight", F.when(F.col("target") == 1, float(weights[1])).otherwise(float(weights[0])))
        .withColumn("_validation", F.col("is_train") == 0)
        .drop("is_train")
    )
    indexed = [f"{c}_index" for c in categories]
    encoded = [f"{c}_vec" for c in categories]
    stages: list[Any] = []
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*numbers, *encoded], outputCol="features", handleInvalid="keep"))
    stages.append(_classifier(cfg))
    model = Pipeline(stages=stages).fit(ready)
    if cfg.model_type == "logistic_regression":
        # The fitted model holds its training summary and with it the session, which cannot be sent
        # to tasks; a stored copy holds only the coefficients.
        path = scratch_path(train_rows.sparkSession, "model")
        model.write().save(path)
        model = PipelineModel.load(path)
    return model, numbers


def _classifier(cfg: RiskSettings):
    if cfg.model_type == "logistic_regression":
        return LogisticRegression(
            labelCol="label", weightCol="_weight", regParam=cfg.regularisation, elasticNetParam=0.5, maxIter=cfg.max_iter
        )
    if cfg.model_type != "gbt":
        raise ValueError(f"unknown model type {cfg.model_type!r}")
    return GBTClassifier(
        labelCol="label",
        weightCol="_weight",
        validationIndicatorCol="_validation",
        maxIter=cfg.max_iter,
        maxDepth=cfg.max_depth,
        stepSize=cfg.step_size,
        subsamplingRate=cfg.subsampling_rate,
        featureSubsetStrategy=cfg.feature_subset,
        minInstancesPerNode=cfg.min_instances,
        minInfoGain=cfg.min_info_gain,
        seed=cfg.seed,
        cacheNodeIds=False,
    )


def scored(model: PipelineModel, rows: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Rows with ``risk_score``; features the rows lack, or that are null, count as zero."""
    have = set(rows.columns)
    ready = rows.withColumns({c: F.lit(0.0) for c in numbers if c not in have}).fillna(0.0, subset=list(numbers))
    out = model.transform(ready)
    return out.select(*ready.columns, vector_to_array("probability")[1].alias("risk_score"))


# ------------------------------------------------------------------ evaluation


def confusion(df: DataFrame, label: str = "target", score: str = "risk_score", cut: float = 0.5) -> DataFrame:
    """(label, prediction, rows)."""
    return df.groupBy(F.col(label).alias("label"), (F.col(score) >= cut).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def class_report(df: DataFrame, label: str = "target", score: str = "risk_score", cut: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, from four counts."""
    c = confusion(df, label, score, cut)
    n = F.col("rows")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    sides = []
    for k in (0, 1):
        hit, said, is_ = (F.col("label") == k) & (F.col("prediction") == k), F.col("prediction") == k, F.col("label") == k
        sides.append(F.struct(F.lit(k).alias("class"), total(hit).alias("hit"), total(said).alias("said"), total(is_).alias("support")))
    rows = c.agg(F.array(*sides).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    zero = F.lit(0.0)
    rows = rows.withColumns(
        {
            "precision": F.coalesce(F.try_divide("hit", "said"), zero),
            "recall": F.coalesce(F.try_divide("hit", "support"), zero),
        }
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    return rows.select("class", "precision", "recall", f1.alias("f1"), "support")


def calibration(df: DataFrame, label: str = "target", score: str = "risk_score", bins: int = 10) -> DataFrame:
    """Predicted against observed share per bin of the score."""
    b = F.least(F.floor(F.col(score) * bins).cast("int") + 1, F.lit(bins))
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(score).alias("mean_predicted"), F.avg(label).alias("observed_rate")
    )


def ranking(df: DataFrame, label: str = "target", score: str = "risk_score") -> DataFrame:
    """(positives, negatives, auc, average_precision), exact, one row.

    Rows are counted per score and label first; then the scores are gone through from the highest on, with running
    counts carried from one range of scores to the next, so no task sorts them all. Equal scores are one step: a pair
    of them counts half in the AUC, and precision is taken after all of them. With one class only the AUC is 0.5,
    and the average precision 0 without positives; rows without a score or a label do not count.
    """
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    steps = running_totals(counts, [F.desc("_score")], {"_pos": "_pos_above", "_neg": "_neg_above"})
    above, below = F.col("_pos_above") + F.col("_pos"), F.col("_neg_above") + F.col("_neg")
    sums = steps.agg(
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("negatives"),
        F.sum(F.col("_neg") * (2 * F.col("_pos_above") + F.col("_pos"))).alias("_pairs"),
        F.sum(F.col("_pos") * (above / (above + below))).alias("_precision"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives") * 2
    return sums.select(
        "positives",
        "negatives",
        F.coalesce(F.try_divide(F.col("_pairs"), pairs), F.lit(0.5)).alias("auc"),
        F.coalesce(F.try_divide(F.col("_precision"), F.col("positives")), F.lit(0.0)).alias("average_precision"),
    )


def evaluate(df: DataFrame, label: str = "target", score: str = "risk_score") -> dict[str, Any]:
    """AUC (0.5 if there is one class only), average precision, F1 at 0.5 and the report per class."""
    report = {r["class"]: r.asDict() for r in class_report(df, label, score).collect()}
    ranked = ranking(df, label, score).first()
    return {
        "auc": float(ranked["auc"]),
        "average_precision": float(ranked["average_precision"]),
        "f1": float(report[1]["f1"]),
        "report": report,
    }


def importances(model: PipelineModel, numbers: Sequence[str]) -> dict[str, float]:
    """Gain per feature; the columns of a one-hot category are added up under its name."""
    last, assembler = model.stages[-1], model.stages[-2]
    raw = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    gains = [abs(float(x)) for x in raw.toArray()]
    out = dict(zip(numbers, gains))
    encoded = [c for c in assembler.getInputCols() if c not in numbers]
    if encoded:
        sizes, at = model.stages[1].categorySizes, len(numbers)
        for name, size in zip(encoded, sizes):
            width = len(gains) - at if name == encoded[-1] else size
            out[name.removesuffix("_vec")] = sum(gains[at : at + width])
            at += width
    return out


# ---------------------------------------------------------- storage and scoring


def save_model(
    spark: SparkSession,
    model: PipelineModel,
    numbers: Sequence[str],
    metrics: dict[str, Any],
    path: str,
    version: str | None = None,
) -> str:
    """Save the model and add a row to the table of its versions."""
    version = version or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    model.write().save(f"{path}/model_{version}")
    row = (version, datetime.now(timezone.utc), json.dumps(metrics, default=str), list(numbers), importances(model, numbers))
    schema = "model_version string, saved_at timestamp, metrics string, features array<string>, importances map<string,double>"
    tables.write(spark.createDataFrame([row], schema), f"{path}/versions", mode="append", operation="model")
    return version


def model_versions(spark: SparkSession, path: str) -> list[str]:
    if not tables.exists(spark, f"{path}/versions"):
        return []
    return sorted(r["model_version"] for r in tables.read(spark, f"{path}/versions").select("model_version").collect())


def load_model(spark: SparkSession, path: str, version: str | None = None) -> tuple[PipelineModel, dict[str, Any]]:
    """The latest (or a given) model with its metadata row."""
    if not tables.exists(spark, f"{path}/versions"):
        raise tables.TableMissing(f"no model at {path}")
    rows = tables.read(spark, f"{path}/versions")
    if version is not None:
        rows = rows.filter(F.col("model_version") == version)
    row = rows.orderBy(F.col("model_version").desc()).first()
    if row is None:
        raise tables.TableMissing(f"no model {version} at {path}")
    return PipelineModel.load(f"{path}/model_{row['model_version']}"), row.asDict()


def predict(
    model: PipelineModel,
    feature_rows: DataFrame,
    numbers: Sequence[str],
    version: str = "unsaved",
    top: dict[str, float] | None = None,
    on_date: date | str | None = None,
) -> DataFrame:
    """Risk per entity for the day after the features of the given (or latest) day.

    Needs no labels, so the newest day can be scored; entities keep their ids.
    """
    if on_date is None:
        # One row, compared inside the job.
        last = feature_rows.agg(F.max(DAY).alias(DAY))
        rows = feature_rows.join(F.broadcast(last), DAY, "left_semi")
    else:
        rows = feature_rows.filter(F.col(DAY) == F.lit(str(on_date)).cast("date"))
    best = sorted((top if top is not None else importances(model, numbers)).items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    pairs = [part for name, gain in best for part in (F.lit(name), F.lit(float(gain)))]
    return scored(model, rows, numbers).select(
        "entity_id",
        F.date_add(F.col(DAY), 1).alias("prediction_date"),
        "risk_score",
        risk_category(F.col("risk_score")).alias("risk_category"),
        F.lit(version).alias("model_version"),
        F.create_map(*pairs).alias("top_features"),
    )
