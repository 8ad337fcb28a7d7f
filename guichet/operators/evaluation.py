"""Classification and regression scores as DataFrames.

Class scores are arithmetic on ``(label, prediction, n)`` counts, so the input is
read and shuffled once whatever is asked of it, and a frequent class is combined
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def prediction_counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(actual).alias("y"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))


def _per_class(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """tp, support and predicted rows for every label that occurs as truth or prediction."""
    sides = F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    ))
    hit = F.when((F.col("y") == F.col("p")) & (F.col("s.support") > 0), F.col("n")).otherwise(0)
    return (
        counts.select(*by, "y", "p", "n", sides.alias("s"))
        .groupBy(*by, F.col("s.label").alias("label"))
        .agg(F.sum(hit).alias("tp"), F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"))
    )


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_scores(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator scores 0."""
    t = _per_class(prediction_counts(df, actual, predicted, by), by)
    return t.select(
        *by, "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support", "tp",
    )


def accuracy_f1(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro F1 over the union of true and predicted labels, per ``by`` group."""
    return class_scores(df, actual, predicted, by).groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.sum("support").alias("n"),
    )


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class scores followed by the accuracy, which stands in every score column, and the macro and support-weighted averages."""
    scores = class_scores(df, actual, predicted)
    cols = ["label", "precision", "recall", "f1", "support"]
    macro = scores.agg(*[F.avg(c).alias(c) for c in cols[1:4]], F.sum("support").alias("support"))
    weighted = scores.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in cols[1:4]],
        F.sum("support").alias("support"),
    )
    hits = F.sum("tp") / F.sum("support")
    accuracy = scores.agg(*[hits.alias(c) for c in cols[1:4]], F.sum("support").alias("support"))
    return (
        scores.select(*cols)
        .unionByName(accuracy.select(F.lit("accuracy").alias("label"), *cols[1:]))
        .unionByName(macro.select(F.lit("macro avg").alias("label"), *cols[1:]))
        .unionByName(weighted.select(F.lit("weighted avg").alias("label"), *cols[1:]))
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """One row per true label and one column per predicted label, both in the given order."""
    counts = prediction_counts(df, actual, predicted).filter(F.col("y").isin(list(labels)))
    cells = counts.groupBy("y").agg(*[
        F.sum(F.when(F.col("p") == v, F.col("n")).otherwise(0)).alias(v) for v in labels
    ])
    ordered = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(labels)], "pos int, y string")
    return ordered.join(cells, "y", "left").select("pos", F.col("y").alias("label"), *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in labels])


def confusion_cells(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The same in long form for open label sets, non-zero cells only."""
    return prediction_counts(df, actual, predicted).select(F.col("y").alias("label"), F.col("p").alias("predicted"), "n")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and the spread of the predictions, in one pass per group."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    kept = df.filter(y.isNotNull() & p.isNotNull())
    m = kept.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(p - y)).alias("mae"),
        F.sqrt(F.avg((p - y) * (p - y))).alias("rmse"),
        F.avg((p - y) * (p - y)).alias("__mse"),
        F.var_pop(y).alias("__var"),
        F.min(p).alias("pred_min"), F.max(p).alias("pred_max"),
        F.avg(p).alias("pred_mean"), F.stddev_pop(p).alias("pred_std"),
    )
    return m.withColumn("r2", F.when(F.col("__var") > 0, 1 - F.col("__mse") / F.col("__var"))).drop("__mse", "__var")


def error_buckets(df: DataFrame, abs_error: str = "abs_error", limits: Sequence[float] = (5, 10, 20)) -> DataFrame:
    """Rows under each limit (cumulative) and at or over the last one, with percentages."""
    e = F.col(abs_error)
    tests = [(f"<{v:g}h", e < v) for v in limits] + [(f">={limits[-1]:g}h", e >= limits[-1])]
    counted = df.agg(F.count(e).alias("total"), *[F.count_if(t).alias(name) for name, t in tests])
    return counted.select("total", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(name).alias("bucket"), F.col(f"`{name}`").alias("n")) for i, (name, _) in enumerate(tests)
    ])).alias("b")).select("b.pos", "b.bucket", "b.n", (F.col("b.n") * 100.0 / F.col("total")).alias("pct"))


def mae_by_group(df: DataFrame, group: str = "urgence_pred", abs_error: str = "abs_error") -> DataFrame:
    return df.groupBy(group).agg(F.avg(abs_error).alias("mae"), F.count("*").alias("n"))


def compare_runs(old: DataFrame, new: DataFrame, on: str = "dataset") -> DataFrame:
    """Old and new ``mae``/``r2`` per dataset with the differences."""
    a = old.select(on, F.col("mae").alias("mae_old"), F.col("r2").alias("r2_old"))
    b = new.select(on, F.col("mae").alias("mae_new"), F.col("r2").alias("r2_new"))
    return a.join(b, on).withColumns({
        "mae_diff": F.col("mae_new") - F.col("mae_old"),
        "r2_diff": F.col("r2_new") - F.col("r2_old"),
    })


def overfit_gap(comparison: DataFrame, on: str = "dataset", train: str = "train", test: str = "test") -> DataFrame:
    """Train/test gaps of both runs and how much of the R2 gap the new run removes."""

    def at(name: str, column: str):
        return F.max(F.when(F.col(on) == name, F.col(column)))

    gaps = comparison.agg(
        (at(train, "r2_old") - at(test, "r2_old")).alias("r2_gap_old"),
        (at(train, "r2_new") - at(test, "r2_new")).alias("r2_gap_new"),
        (at(test, "mae_old") - at(train, "mae_old")).alias("mae_gap_old"),
        (at(test, "mae_new") - at(train, "mae_new")).alias("mae_gap_new"),
    )
    return gaps.withColumns({
        "r2_gap_reduction": F.col("r2_gap_old") - F.col("r2_gap_new"),
        "r2_gap_reduction_pct": (F.col("r2_gap_old") - F.col("r2_gap_new")) / F.col("r2_gap_old") * 100,
        "mae_gap_reduction": F.col("mae_gap_old") - F.col("mae_gap_new"),
        "reduced": F.col("r2_gap_new") < F.col("r2_gap_old"),
    })


def pass_rate(df: DataFrame, passed: str = "passed") -> DataFrame:
    """Checks passed, checks made and a verdict: all, at least half, or fewer."""
    t = df.agg(F.count_if(F.col(passed)).alias("n_passed"), F.count("*").alias("n_total"))
    return t.withColumn("verdict", F.when(F.col("n_passed") == F.col("n_total"), "pass")
                        .when(F.col("n_passed") * 2 >= F.col("n_total"), "partial").otherwise("fail"))
