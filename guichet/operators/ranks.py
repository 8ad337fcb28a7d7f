"""Exact ranks and quota cuts inside classes of any size.

A plain ``row_number`` over a class sorts the whole class in one task. Here a class
is cut into ordered buckets, each bucket is ranked on its own, and the counts of
the buckets before it are added. The ranks are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.draws import draw_bucket
from ..session import settle

#: Rows that a task ranks on average, at most.
TASK_ROWS = 500_000


def bucketed_rank(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], bucket: Column, out: str = "rank") -> DataFrame:
    """1-based rank of each row within ``keys``; ``df`` is a stored table.

    ``bucket`` must not decrease along ``order_by``. Counting reads only the keys and
    the bucket; the rows themselves are shuffled once, by (keys, bucket), to as many tasks as there are TASK_ROWS: narrow
    rows are small when shuffled and large when sorted, so the planner would put millions into one.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))
    # One struct of keys and bucket, in which a null key is a key: the join finds the rows dealt and sorted as the ranking left them.
    tagged = df.withColumn("__slot", F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], bucket.alias("bucket")))
    before = Window.partitionBy(*[F.col(f"__slot.k{i}") for i in range(len(keys))]).orderBy("__slot.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("__slot").agg(F.count("*").alias("__n"))
        .select(F.col("__slot").alias("__named"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    local = tagged.repartition(tasks, "__slot").withColumn("__local", F.row_number().over(Window.partitionBy("__slot").orderBy(*order_by)))
    joined = local.join(offsets, F.col("__slot") == F.col("__named"))
    return joined.withColumn(out, F.col("__offset") + F.col("__local")).drop("__slot", "__named", "__offset", "__local")


def sorted_rank(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], out: str = "rank") -> DataFrame:
    """1-based rank within ``keys`` for any order columns, ties in no particular order.

    The rows are range-partitioned by keys, order and a random tie-break, so neither a key nor
    a tie is too big for a task, and written down with their piece number. A piece ranks its
    own part of a key; the parts before it are added from the counts.
    """
    pieces = (
        df.withColumn("__tie", F.rand(0))
        .repartitionByRange(*keys, *order_by, "__tie").withColumn("__piece", F.spark_partition_id())
    )
    return bucketed_rank(settle(pieces, "ranges"), keys, [*order_by, "__tie"], F.col("__piece"), out).drop("__tie", "__piece")


def cut_values(df: DataFrame, class_col: str, draw: str, wanted: DataFrame) -> DataFrame:
    """Per class, the draw values of the rows that ``wanted`` (class, __cut, __rank) names, in the order of __cut.

    A rank counts from the smallest draw; rank 0 yields ''. Draws must be unique hex digests, up to ties that may
    stay together. Only the buckets that hold a cut are sorted, so the rows never travel. Joins are left to the
    planner: with few classes it sends the cuts to the rows.
    """
    wanted = wanted.withColumnRenamed(class_col, "__class")
    narrow = df.select(F.col(class_col).alias("__class"), F.col(draw).alias("__draw")).withColumn("__bucket", draw_bucket(F.col("__draw")))
    upto = Window.partitionBy("__class").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    spans = narrow.groupBy("__class", "__bucket").agg(F.count("*").alias("__n")).withColumn("__hi", F.sum("__n").over(upto))
    holding = settle(
        spans.join(wanted, "__class")
        .filter((F.col("__rank") <= F.col("__hi")) & (F.col("__rank") > F.col("__hi") - F.col("__n")))
        .select("__class", "__bucket", "__cut", (F.col("__rank") - F.col("__hi") + F.col("__n")).alias("__k")), "holding")
    inside = narrow.join(holding, ["__class", "__bucket"])
    place = F.row_number().over(Window.partitionBy("__class", "__cut").orderBy("__draw"))
    found = inside.withColumn("__place", place).filter(F.col("__place") == F.col("__k")).select("__class", "__cut", "__draw")
    return (
        wanted.join(found, ["__class", "__cut"], "left")
        .groupBy(F.col("__class").alias(class_col))
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("__cut", F.coalesce("__draw", F.lit("")).alias("d")))), lambda s: s["d"]).alias("__cuts"))
    )


def label_by_cuts(df: DataFrame, class_col: str, draw: str, cuts: DataFrame, labels: Sequence[str], out: str) -> DataFrame:
    """The label of the quota each row falls in: a comparison per row against its class's cut values.

    The cuts are stored first, so their size is known when the join is planned.
    """
    names = F.array(*[F.lit(v) for v in labels])
    joined = df.join(settle(cuts, "cuts"), class_col)
    passed = F.size(F.filter("__cuts", lambda c: F.col(draw) > c))
    return joined.withColumn(out, F.get(names, passed)).drop("__cuts")
