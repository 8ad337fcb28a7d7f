"""Oversampling, stratified splits and stratified folds."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.draws import draw_key, draw_long
from ..schema import N_FOLDS, SEED, SPLIT_LABELS
from ..session import settle
from .ranks import cut_values, label_by_cuts, sorted_rank

# Share of the majority class and of the others after balancing.
MAJORITY = "Basse"
MAJORITY_SHARE = 0.50
MINORITY_SHARES = {"Moyenne": 0.28, "Haute": 0.22}

COPIES_PER_TASK_ROW = 10_000


def oversample_targets(df: DataFrame, class_col: str = "urgence", majority: str = MAJORITY,
                       majority_share: float = MAJORITY_SHARE, shares: Mapping[str, float] = MINORITY_SHARES) -> DataFrame:
    """Current and wanted rows per class; no class ever shrinks."""
    counts = df.groupBy(class_col).agg(F.count("*").alias("n"))
    total = F.floor(counts.filter(F.col(class_col) == majority).agg(F.max("n")).scalar() / F.lit(majority_share))
    target = F.col("n")
    for label, share in shares.items():
        wanted = F.floor(total * F.lit(share)).cast("long")
        target = F.when(F.col(class_col) == label, F.greatest(wanted, F.col("n"))).otherwise(target)
    return counts.select(class_col, "n", target.alias("target"))


def target_counts(targets: DataFrame, class_col: str = "urgence", most: int = 10_000) -> dict[str, int]:
    """The targets on the driver, for reading; a table of more than ``most`` classes stays a table."""
    rows = targets.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{class_col} has more than {most} distinct values")
    return {r[class_col]: r["target"] for r in rows}


def oversample(df: DataFrame, class_col: str, targets: DataFrame | Mapping[str, int], id_col: str = "ID", seed: int = SEED,
               origin_col: str | None = None) -> DataFrame:
    """All rows, plus copies drawn with replacement until each class meets its target.

    ``targets`` is a table (class, target) or a mapping. Copies are named ``<id>_dup_1``, ``<id>_dup_2``... Draw j of a
    class picks the row whose rank is the j-th draw modulo the class size. The draws are counted per rank before
    they meet the rows, so a row drawn a million times is one row in the join; only classes that grow are ranked,
    by a number of the row, not by its ID. Where IDs repeat, all but an ID's first row are numbered too, rows of the
    table before copies. Classes without a target, null among them, stay as they are.
    """
    spark = df.sparkSession
    originals = df.withColumn(id_col, F.col(id_col).cast("string"))
    if origin_col:
        originals = originals.withColumn(origin_col, F.col(id_col))
    if not isinstance(targets, DataFrame):
        targets = spark.createDataFrame([(c, int(n)) for c, n in targets.items()], f"`{class_col}` {df.schema[class_col].dataType.simpleString()}, target long")
    sizes = df.groupBy(class_col).agg(F.count("*").alias("__size"))
    growing = settle(sizes.join(targets.select(class_col, "target"), class_col).select(class_col, "__size", (F.col("target") - F.col("__size")).alias("__extra")).filter("__extra > 0"), "growing")

    # Draws are numbered in blocks, so a class that grows a billionfold is many rows before it is many draws.
    blocks = growing.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__extra") - 1) / COPIES_PER_TASK_ROW)))).repartition(class_col, "__block")
    low = F.col("__block") * COPIES_PER_TASK_ROW + 1
    draws = blocks.withColumn("__j", F.explode(F.sequence(low, F.least(low + (COPIES_PER_TASK_ROW - 1), F.col("__extra")))))
    rank = F.pmod(draw_long(draw_key(seed, F.lit("draw"), F.col(class_col), F.col("__j"))), F.col("__size")) + 1
    copies = draws.select(class_col, rank.alias("__rank")).groupBy(class_col, "__rank").agg(F.count("*").alias("__copies"))

    # The rows that may be copied are stored with a number; ranking reads three narrow columns of them.
    tie = F.xxhash64(*[F.col(c) for c in originals.columns])
    rows = settle(originals.join(growing.select(class_col), class_col, "left_semi").withColumns({
        "__row": F.monotonically_increasing_id(), "__draw": draw_key(seed, F.lit("rank"), F.col(id_col)), "__tie": tie}), "growing-rows")
    ranked = sorted_rank(rows.select("__row", class_col, "__draw", "__tie"), [class_col], ["__draw", "__tie"], "__rank")
    picked = rows.join(ranked.join(copies, [class_col, "__rank"]).select("__row", "__copies"), "__row")

    # A row may be copied any number of times: blocks of copies first, spread over tasks.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / COPIES_PER_TASK_ROW)))
    spread = picked.withColumn("__block", block).repartition("__row", "__block")
    first = F.col("__block") * COPIES_PER_TASK_ROW + 1
    number = F.explode(F.sequence(first, F.least(first + (COPIES_PER_TASK_ROW - 1), F.col("__copies"))))
    dup = spread.withColumn("__k", number)
    if originals.groupBy(id_col).count().filter("count > 1").isEmpty():
        named = dup.withColumn(id_col, F.concat(F.col(id_col), F.lit("_dup_"), F.col("__k").cast("string")))
        return originals.unionByName(named.select(*originals.columns))
    every = originals.withColumns({"__k": F.lit(0).cast("long"), "__tie": tie}).unionByName(dup.select(*originals.columns, "__k", "__tie"))
    return unique_ids(every, id_col, ["__k", "__tie"]).select(*originals.columns)


def unique_ids(df: DataFrame, id_col: str, order_by: Sequence[str], out: str | None = None) -> DataFrame:
    """Suffix repeated IDs: the first keeps its name, later ones get ``_dup_1``, ``_dup_2``...

    One ID may own any share of the table.
    """
    ranked = sorted_rank(df, [id_col], order_by, "__rank")
    name = F.col(id_col).cast("string")
    name = F.when(F.col("__rank") == 1, name).otherwise(F.concat(name, F.lit("_dup_"), (F.col("__rank") - 1).cast("string")))
    return ranked.withColumn(out or id_col, name).drop("__rank")


def _share_out(sizes: DataFrame, take: int, total: int, rows: str, out: str) -> DataFrame:
    """``take`` of ``total`` rows shared over classes by size, whole rows, largest remainder first, ties by label.

    One row per class passes through these windows.
    """
    wide = sizes.withColumn("__x", F.lit(take).cast("decimal(38,0)") * F.col(rows).cast("decimal(19,0)"))
    whole = max(total, 1)
    wide = wide.withColumns({"__base": F.expr(f"CAST(__x div {whole} AS BIGINT)"), "__rem": F.expr(f"CAST(__x % {whole} AS BIGINT)")})
    left = F.lit(take) - F.sum("__base").over(Window.partitionBy())
    extra = F.row_number().over(Window.orderBy(F.desc("__rem"), "__class")) <= left
    return wide.withColumn(out, F.col("__base") + extra.cast("long")).drop("__x", "__base", "__rem")


def split_quotas(sizes: DataFrame, holdout: float = 0.30, test_part: float = 0.50) -> DataFrame:
    """(__class, n) -> (__class, quota: rows for train, validation, test); held-out sizes round up, as does test within them."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_held = math.ceil(round(total * holdout, 9))
    n_test = math.ceil(round(n_held * test_part, 9))
    train = _share_out(sizes, total - n_held, total, "n", "__train").withColumn("__held", F.col("n") - F.col("__train"))
    both = _share_out(train, n_held - n_test, n_held, "__held", "__validation")
    return both.select("__class", F.array("__train", "__validation", F.col("__held") - F.col("__validation")).alias("quota"))


def fold_quotas(sizes: DataFrame, k: int) -> DataFrame:
    """(__class, n) -> (__class, quota per fold) when all rows, sorted by label, are dealt to the folds in turn."""
    if (sizes.agg(F.max("n")).first()[0] or 0) < k:
        raise ValueError(f"no class has {k} rows for {k} folds")
    end = F.sum("n").over(Window.orderBy("__class").rowsBetween(Window.unboundedPreceding, 0))
    turns = lambda x: F.expr("{0} - pmod({0}, {1})".format(x, k)) / k  # noqa: E731  rounds down below zero too
    placed = sizes.withColumns({"__end": end}).withColumn("__start", F.col("__end") - F.col("n"))
    return placed.select("__class", F.array(*[(turns(f"(__end - 1 - {i})") - turns(f"(__start - 1 - {i})")).cast("long") for i in range(k)]).alias("quota"))


def _stratum(class_col: str) -> Column:
    """The class as text that sorts like it; rows without one are a class of their own."""
    return F.when(F.col(class_col).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(class_col).cast("string")))


def _assign(df: DataFrame, key: Column, units: DataFrame, quotas: DataFrame, class_col: str, labels: Sequence, out: str) -> DataFrame:
    until = F.transform(F.slice("quota", 1, len(labels) - 1), lambda q, i: F.aggregate(F.slice("quota", F.lit(1), i + 1), F.lit(0).cast("long"), lambda s, x: s + x))
    wanted = quotas.select("__class", F.posexplode(until).alias("__cut", "__rank"))
    values = cut_values(units, "__class", "__draw", wanted)
    given = df.withColumns({"__draw": key, "__class": _stratum(class_col)})
    return label_by_cuts(given, "__class", "__draw", values, labels, out).select(*df.columns, out)


def _units(df: DataFrame, class_col: str, key_col: str, grouped: bool, key: Column) -> DataFrame:
    if not grouped:
        return df.select(_stratum(class_col).alias("__class"), key.alias("__draw"))
    groups = df.withColumn("__class", _stratum(class_col)).groupBy(key_col).agg(F.min("__class").alias("__class"), F.max("__class").alias("__max"))
    if groups.filter(F.col("__class") != F.col("__max")).limit(1).count():
        raise ValueError(f"a {key_col} group holds more than one {class_col}")
    return groups.select("__class", key.alias("__draw"))


def stratified_split(df: DataFrame, class_col: str = "urgence", id_col: str = "ID", seed: int = SEED, holdout: float = 0.30,
                     test_part: float = 0.50, labels: Sequence[str] = tuple(SPLIT_LABELS), group_col: str | None = None,
                     out: str = "split") -> DataFrame:
    """70/15/15 with exact per-class quotas. With classes few enough to send to the rows, these are labelled where they are.

    With ``group_col`` the quotas count groups and a group's rows stay together, which keeps
    the copies made by :func:`oversample` out of the other splits. Rows without a class are split like one more class;
    rows that share an ID share its label.
    """
    key_col = group_col or id_col
    key = draw_key(f"{seed}|split", F.col(key_col))
    units = _units(df, class_col, key_col, group_col is not None, key)
    sizes = settle(units.groupBy("__class").agg(F.count("*").alias("n")), "sizes")
    return _assign(df, key, units, settle(split_quotas(sizes, holdout, test_part), "quotas"), class_col, labels, out)


def stratified_folds(df: DataFrame, class_col: str, id_col: str = "ID", k: int = N_FOLDS, seed: int = SEED,
                     group_col: str | None = None, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1, class counts equal between folds up to one row; rows without a class are dealt like one more class."""
    key_col = group_col or id_col
    key = draw_key(f"{seed}|fold", F.col(key_col))
    units = _units(df, class_col, key_col, group_col is not None, key)
    sizes = settle(units.groupBy("__class").agg(F.count("*").alias("n")), "sizes")
    return _assign(df, key, units, settle(fold_quotas(sizes, k), "quotas"), class_col, list(range(k)), out)
