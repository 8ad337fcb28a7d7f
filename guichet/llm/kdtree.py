"""Shards as the leaves of a k-d tree over document metadata, cut at distributed weighted medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle
from .common import running_offset, text_key
from .registry import query, table

#: Bits of a cut's position: the metadata value, and a hash of the group that tells equal values apart.
VALUE_BITS, HASH_BITS = 20, 40
#: Pieces that each pass cuts a bracket into; a cut is settled when its bracket holds less than this share of a leaf.
BINS, CLOSE = 1_024, 1e-4
#: Nodes of a level that are sent to all tasks.
BROADCAST = 10_000
#: Bytes of a leaf where nothing else is asked for.
TARGET_BYTES = 256 << 20
#: Equal texts stay together up to this share of a leaf; a larger group would unbalance the leaves, and is split into parts of at most PART_SHARE of a leaf.
GROUP_SHARE, PART_SHARE = 0.1, 0.005


def text_code(value: Column) -> Column:
    """The first six bytes of a text as a number, so that texts keep their order; null comes first."""
    padded = F.rpad(F.hex(F.substring(F.coalesce(value, F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("long")


def _small(nodes: DataFrame, rows: int) -> DataFrame:
    """One row for each node: sent to all tasks up to BROADCAST rows. More nodes are small parts of the table each, and are joined by shuffle."""
    return F.broadcast(nodes) if rows <= BROADCAST else nodes


def _pick(dim: Column, values: list[Column]) -> Column:
    out = F.lit(None)
    for k, v in enumerate(values):
        out = F.when(dim == k, v).otherwise(out)
    return out


def _open_nodes(points: DataFrame, dims: int) -> DataFrame:
    """For each part with several leaves: the dimension in which it spreads widest, and the weight that goes to its lower half."""
    spread = points.filter("leaves > 1").groupBy("first", "leaves").agg(F.sum("weight").alias("weight"), *[f(f"{c}{k}").alias(f"{n}_{c}{k}") for k in range(dims) for c in ("d", "key") for n, f in (("lo", F.min), ("hi", F.max))])
    widest = F.greatest(*[F.struct((F.col(f"hi_d{k}") - F.col(f"lo_d{k}")).alias("w"), F.lit(-k).alias("dim")) for k in range(dims)]) if dims > 1 else F.struct(F.lit(0).alias("w"), F.lit(0).alias("dim"))
    spread = spread.withColumn("dim", -widest["dim"])
    half = F.expr("leaves div 2")
    return spread.select(F.col("first").alias("node"), half.alias("half"), "dim", _pick(F.col("dim"), [F.col(f"lo_key{k}") for k in range(dims)]).alias("lo"),
                         (_pick(F.col("dim"), [F.col(f"hi_key{k}") for k in range(dims)]) + 1).alias("hi"), F.lit(0).cast("long").alias("before"),
                         (F.col("weight") * half / F.col("leaves")).alias("target"), F.lit(None).cast("long").alias("cut"))


def _cuts(points: DataFrame, nodes: DataFrame, dims: int, n_nodes: int, leaf: float) -> DataFrame:
    """(node, half, dim, cut): each node's weighted quantile, from histograms of ever narrower brackets, all nodes in the same jobs.

    A pass sums the weights of BINS bins of each node's bracket and keeps the bin that holds the target. At most
    BINS rows of a node meet in a window.
    """
    along = _pick(F.col("dim"), [F.col(f"key{k}") for k in range(dims)])
    state, found = settle(nodes, "nodes"), []
    for _ in range(VALUE_BITS + HASH_BITS):
        step = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("hi") - F.col("lo")) / BINS).cast("long"))
        ready = state.withColumn("step", step)
        here = points.join(_small(ready, n_nodes), F.col("first") == F.col("node")).withColumn("at", along).filter("at >= lo AND at < hi")
        bins = here.groupBy("node", F.expr("(at - lo) div step").alias("bin")).agg(F.sum("weight").alias("weight"))
        upto = Window.partitionBy("node").orderBy("bin")
        bins = bins.select(F.col("node").alias("_node"), "bin", "weight", F.sum("weight").over(upto).alias("upto")).join(_small(ready, n_nodes), F.col("_node") == F.col("node"))
        # The first bin that passes the target; without one, by rounding, the cut is the end of the bracket.
        passing = F.min(F.when(F.col("before") + F.col("upto") > F.col("target"), F.struct("bin", "weight", "upto")))
        chosen = bins.groupBy("node", "half", "dim", "lo", "hi", "before", "target", "step").agg(passing.alias("b"))
        start, low = F.col("lo") + F.col("b.bin") * F.col("step"), F.col("before") + F.col("b.upto") - F.col("b.weight")
        stop = F.least(F.col("hi"), start + F.col("step"))
        nearer = F.when(F.col("before") + F.col("b.upto") - F.col("target") < F.col("target") - low, stop).otherwise(start)
        cut = F.when(F.col("b").isNull(), F.col("hi")).when((F.col("b.weight") <= F.lit(CLOSE * leaf)) | (F.col("step") == 1), nearer)
        state = settle(chosen.select("node", "half", "dim", start.alias("lo"), stop.alias("hi"), low.alias("before"), "target", cut.alias("cut")), "nodes")
        found.append(state.filter("cut IS NOT NULL").select("node", "half", "dim", "cut"))
        state = state.filter("cut IS NULL")
        if state.isEmpty():
            break
    cuts = found[0]
    for more in found[1:]:
        cuts = cuts.union(more)
    return cuts


def grow_tree(points: DataFrame, dims: int, leaves: int) -> DataFrame:
    """``points`` with ``first``, the leaf that each row belongs to, of ``leaves`` leaves with nearly equal weight.

    Columns d0, d1, ... are values from 0 to 1 and key0, key1, ... their positions with ties told apart; weight counts.
    All parts of a level are split by the same jobs, each along the dimension in which its values spread widest,
    in proportion to the leaves on each side. The tree stays in tables; the driver only learns when a level is done.
    """
    points = points.withColumn("first", F.lit(0)).withColumn("leaves", F.lit(leaves))
    total = points.agg(F.sum("weight")).first()[0] or 0
    for level in range((leaves - 1).bit_length()):
        cuts = _cuts(points, _open_nodes(points, dims), dims, 1 << level, total / leaves)
        joined = points.join(_small(cuts, 1 << level), F.col("first") == F.col("node"), "left")
        upper = _pick(F.col("dim"), [F.col(f"key{k}") for k in range(dims)]) >= F.col("cut")
        first = F.when(upper, F.col("first") + F.col("half")).otherwise(F.col("first")).cast("int")
        count = F.when(F.col("node").isNull(), F.col("leaves")).when(upper, F.col("leaves") - F.col("half")).otherwise(F.col("half")).cast("int")
        points = settle(joined.withColumns({"first": first, "leaves": count}).drop("node", "half", "dim", "cut"), "points")
    return points


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text",
              numbers: tuple[str, ...] = ("n_chars",), names: tuple[str, ...] = ("lang", "source"), with_text: bool = False) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row: shards of nearly equal bytes that are close in metadata.

    ``with_text`` adds the text; the tree itself is grown without it, and texts meet their places in one join.

    The shards are ``shards`` leaves, or as many as bring a leaf to ``target_bytes`` at most. Metadata are the
    columns ``numbers`` and ``names`` (by their first bytes), each from 0 to 1 over the table; nulls are least.
    The weight is the text's UTF-8 bytes plus 8. Equal texts share the metadata of their smallest id and stay in
    one shard, unless together they exceed GROUP_SHARE of a shard: such groups are split by id, so that copies
    which fill a third of the table still spread evenly. Slots number a shard's rows from 0, without gaps, in an
    order that repeats on every run; rows that repeat id and text follow one another.
    """
    k1, k2 = text_key(F.col(text_col))
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 8
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers] + [text_code(F.col(c)).cast("double") for c in names]
    dims = len(values)
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), size.cast("long").alias("size"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"), *[v.alias(f"m{k}") for k, v in enumerate(values)])
    rows = settle(rows, "metadata")
    ends = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *[f(f"m{k}").alias(f"{n}{k}") for k in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    leaves = int(shards or max(1, -(-(ends.bytes or 0) // (target_bytes or TARGET_BYTES))))
    leaf = (ends.bytes or 0) / leaves
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("together"), F.min(F.struct("id", *[f"m{k}" for k in range(dims)])).alias("first"))
    parts = F.when(F.col("together") > GROUP_SHARE * leaf, F.ceil(F.col("together") / max(1, int(PART_SHARE * leaf)))).otherwise(1)
    groups = groups.select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), parts.alias("parts"), *[F.col(f"first.m{k}").alias(f"f{k}") for k in range(dims)])
    unit = F.when(F.col("parts") > 1, F.pmod(F.xxhash64(F.lit(23), "id"), F.col("parts"))).otherwise(0)
    joined = rows.join(groups, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2"))).withColumn("unit", unit)
    scaled = joined
    for k in range(dims):
        lo, hi = ends[f"lo{k}"] or 0.0, ends[f"hi{k}"] or 0.0
        scaled = scaled.withColumn(f"d{k}", (F.col(f"f{k}") - F.lit(lo)) / F.lit(hi - lo) if hi > lo else F.lit(0.0))
    tie = F.xxhash64(F.lit(29), "k1", "k2", "unit").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    scaled = scaled.withColumn("tie", tie)
    for k in range(dims):
        scaled = scaled.withColumn(f"key{k}", F.shiftleft(F.least(F.floor(F.col(f"d{k}") * (1 << VALUE_BITS)), F.lit((1 << VALUE_BITS) - 1)).cast("long"), HASH_BITS) + F.col("tie"))
    points = settle(scaled.select("id", "k1", "k2", "size", "text_crc32", F.col("size").alias("weight"), *[f"d{k}" for k in range(dims)], *[f"key{k}" for k in range(dims)]), "points")
    placed = grow_tree(points, dims, leaves).select("id", "k1", "k2", "size", "text_crc32", F.col("first").alias("shard")).withColumn("one", F.lit(1).cast("long"))
    slotted = running_offset(placed, ["shard"], ["id", "k1", "k2"], "one", "slot", ends.n)
    if with_text:
        texts = docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).alias("text")).dropDuplicates(["_id", "_k1", "_k2"])
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
        return slotted.join(texts, same).select("id", "text", "size", "text_crc32", "shard", "slot")
    return slotted.select("id", "size", "text_crc32", "shard", "slot")


@query()
def op6_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard of 24 and its place there."""
    found = kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
