"""Model side: correlation and importance filters, walk-forward folds, metrics, profit and loss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import stats as S

from . import windows as W

FEE = 0.0004


@dataclass(frozen=True)
class Setup:
    """Fold sizes in rows, booster settings, decision threshold and importance rule of an interval."""

    test: int
    least: int
    step: int
    trees: int
    rate: float
    depth: int
    threshold: float
    percentile: float
    floor: int = 0


#: Fixed values.
SETUPS = {
    "5m": Setup(9000, 25920, 4032, 1000, 0.05, 6, 0.60, 0.5),
    "15m": Setup(2900, 8640, 1344, 1000, 0.05, 6, 0.65, 0.5),
    "1h": Setup(1200, 2160, 336, 800, 0.07, 6, 0.60, 0.5),
    "4h": Setup(375, 540, 84, 600, 0.08, 5, 0.55, 0.4),
    "1d": Setup(55, 90, 14, 300, 0.1, 4, 0.55, 0.3, 20),
}


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, r for every pair of columns (a before b by name), over rows where both are there; one pass over the data."""
    names = sorted(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    one = df.agg(*[S.corr(S.col(a), S.col(b)).alias(f"_{k}") for k, (a, b) in enumerate(pairs)])
    each = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{k}").alias("r")) for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(each).alias("e")).select("e.a", "e.b", "e.r")


def correlated(df: DataFrame, columns: Sequence[str], most: float = 0.95) -> list[str]:
    """Columns to drop: those that correlate beyond ``most`` with any column before them by name, dropped or not."""
    return sorted({r["b"] for r in correlations(df, columns).where(F.abs("r") > most).collect()})


def folds(rows: int, least: int, test: int, step: int) -> Iterator[tuple[int, int]]:
    """(start of test, end of test) of expanding-window folds: training is all rows before the start.

    A fold whose test rows are under 80 % of ``test`` is left out.
    """
    for start in range(least, rows - test, step):
        end = min(start + test, rows)
        if end - start >= 0.8 * test:
            yield start, end


def fold_table(df: DataFrame, least: int, test: int, step: int) -> DataFrame:
    """fold, train_end, test_start, test_end over the number of rows in ``df``, made by the engine."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    starts = n.where(F.col("n") - test > least).select("n", F.explode(F.sequence(F.lit(least), (F.col("n") - test - 1).cast("int"), F.lit(step))).alias("test_start"))
    out = starts.withColumn("test_end", F.least(F.col("test_start") + test, F.col("n")).cast("long")).where((F.col("test_end") - F.col("test_start")) >= 0.8 * test)
    return out.select(((F.col("test_start") - least) / step).cast("long").alias("fold"), F.col("test_start").cast("long").alias("train_end"), F.col("test_start").cast("long").alias("test_start"), "test_end")


def numbered(df: DataFrame, time: str) -> DataFrame:
    """Adds ``row``, from 0 by time (a number of ms)."""
    return W.places(df, time, "row")


def metrics(predictions: DataFrame, truth: str = "label", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """n, accuracy, precision, recall; a share of nothing is 0."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    hit = F.count_if(t & p)
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        share(F.count_if(t == p), F.count(F.lit(1))).alias("accuracy"),
        share(hit, F.count_if(p)).alias("precision"),
        share(hit, F.count_if(t)).alias("recall"),
    )


def profit(predictions: DataFrame, predicted: str = "predicted", returns: str | None = None, fee: float = FEE, by: Sequence[str] = ()) -> DataFrame:
    """trades, pnl, wins: each signal earns its return (0 if none is given) less the fee."""
    gain = (F.coalesce(F.col(returns), F.lit(0.0)) if returns else F.lit(0.0)) - F.lit(fee)
    signal = F.col(predicted) == 1
    return predictions.groupBy(*by).agg(F.count_if(signal).alias("trades"), S.total(gain, signal).alias("pnl"), F.count_if(signal & (gain > 0)).alias("wins"))


def summary(per_fold: DataFrame, columns: Sequence[str], pnl: str = "pnl") -> DataFrame:
    """Mean, population deviation, least, largest of each metric, total profit and share of profitable folds."""
    return per_fold.agg(
        *[f(S.col(c)).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))],
        F.sum(pnl).alias("total_pnl"),
        F.avg((F.col(pnl) > 0).cast("double")).alias("profitable_share"),
    )


def pick_important(importance: dict[str, float], percentile: float, floor: int = 0) -> list[str]:
    """Features at or above a percentile (linear between ranks) of importance, and at least ``floor`` of them, best first."""
    ranked = sorted(importance.items(), key=lambda x: (-x[1], x[0]))
    values = sorted(importance.values())
    at = percentile * (len(values) - 1)
    low = int(at)
    cut = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)
    keep = [n for n, v in ranked if v >= cut]
    return keep if len(keep) >= floor else [n for n, _ in ranked[:floor]]


def booster(features: Sequence[str], label: str, trees: int = 20, rate: float = 0.1, depth: int = 5, seed: int = 42) -> Pipeline:
    """Imputed features into a gradient-boosted tree classifier."""
    names = [f"_f{i}" for i in range(len(features))]
    return Pipeline(
        stages=[
            Imputer(inputCols=names, outputCols=[f"{n}_i" for n in names]),
            VectorAssembler(inputCols=[f"{n}_i" for n in names], outputCol="features"),
            GBTClassifier(labelCol=label, featuresCol="features", maxIter=trees, stepSize=rate, maxDepth=depth, seed=seed),
        ]
    )


def with_features(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features under plain names (metric names hold dots, which ML columns must not)."""
    return df.select("*", *[S.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)]).withColumn(label, F.col(label).cast("int"))


def predict(model: PipelineModel, df: DataFrame, threshold: float) -> DataFrame:
    """Adds ``probability_up`` and ``predicted``."""
    p = vector_to_array("probability").getItem(1)
    return model.transform(df).withColumn("probability_up", p).withColumn("predicted", (F.col("probability_up") >= threshold).cast("int"))


def importances(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """How much each feature gained in the booster's trees; features that no tree uses have 0."""
    found = model.stages[-1].featureImportances
    return {f: float(found[i]) for i, f in enumerate(features)}


def select_features(train: DataFrame, features: Sequence[str], label: str, setup: Setup, trees: int) -> list[str]:
    """The features left by the correlation filter and then by importance in a first, smaller booster, all on the training rows."""
    drop = set(correlated(train, features))
    kept = [f for f in features if f not in drop]
    first = booster(kept, label, trees, setup.rate, setup.depth).fit(with_features(train, kept, label))
    return sorted(pick_important(importances(first, kept), setup.percentile, setup.floor))


def walk_forward(df: DataFrame, features: Sequence[str], label: str, time: str, setup: Setup, returns: str | None = None, trees: int | None = None) -> DataFrame:
    """fold, n, accuracy, precision, recall, trades, pnl, wins, features.

    In each fold both filters and the booster see the rows before the fold's start only.  What is
    gathered is one row a fold.
    """
    rows = numbered(df, time).persist()
    many, out = trees or setup.trees, []
    try:
        for k, (start, end) in enumerate(folds(rows.count(), setup.least, setup.test, setup.step)):
            train, test = rows.where(F.col("row") < start), rows.where(F.col("row").between(start, end - 1))
            kept = select_features(train, features, label, setup, max(1, many // 4))
            model = booster(kept, label, many, setup.rate, setup.depth).fit(with_features(train, kept, label))
            got = predict(model, with_features(test, kept, label), setup.threshold).withColumn("fold", F.lit(k))
            one = metrics(got, label, "predicted", ["fold"]).join(profit(got, "predicted", returns, by=["fold"]), "fold")
            out.append((*one.first(), kept))
    finally:
        rows.unpersist()
    if not out:
        raise ValueError("too few rows for one fold")
    return df.sparkSession.createDataFrame(out, "fold int, n long, accuracy double, precision double, recall double, trades long, pnl double, wins long, features array<string>")


def refit(df: DataFrame, features: Sequence[str], label: str, setup: Setup, trees: int | None = None) -> tuple[PipelineModel, list[str]]:
    """The final model on all rows, and its features."""
    many = trees or setup.trees
    kept = select_features(df, features, label, setup, max(1, many // 4))
    return booster(kept, label, many, setup.rate, setup.depth).fit(with_features(df, kept, label)), kept


def save(model: PipelineModel, features: Sequence[str], results: DataFrame, folder: str) -> None:
    """Model, feature list, fold results (CSV) and their summary under a folder; what was there is replaced."""
    spark = results.sparkSession
    model.write().overwrite().save(f"{folder}/model")
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "place int, feature string").coalesce(1).write.mode("overwrite").json(f"{folder}/features")
    flat = results.withColumn("features", F.concat_ws(";", "features")) if "features" in results.columns else results
    flat.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/results")
    summary(results, ["accuracy", "precision", "recall"]).coalesce(1).write.mode("overwrite").json(f"{folder}/summary")


def load(spark: SparkSession, folder: str) -> tuple[PipelineModel, list[str]]:
    """What save() wrote: the model and its features in order."""
    names = [r["feature"] for r in spark.read.json(f"{folder}/features").orderBy("place").collect()]
    return PipelineModel.load(f"{folder}/model"), names
