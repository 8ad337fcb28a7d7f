"""Mixing sources to target weights: fixed blocks of words, dealt to output shards by index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle
from .common import WORD, running_offset, text_key
from .registry import query, table

#: Words in a block, blocks in an output shard.
BLOCK, SHARD = 64, 4_096
#: Rounds of the index permutation, slots in a cell by which places find their source, and cells that one task lists at a time.
ROUNDS, CELL, STRIDE = 48, 64, 65_536
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0


@dataclass
class Mix:
    """documents (row, id, k1, k2, source, size); sources (source, words, target, blocks, slots); pieces (row, source, block, start, words)
    of documents in blocks; placed (source, epoch, slot, block, shard, place): the block that each slot of each shard holds."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame
    placed: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, words) to (source, words, target). Sources in code-point order, null last, weigh ``weights`` in turn.

    Together they get ``share`` of all words by weight, none more than ``most`` times its own; what a source
    can't take goes to the others by weight. The cut is found by sorting the sources by the share at which each is full.
    One row for each source, not for each document, passes through these windows.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))).withColumn("full", most * F.col("words"))
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    until, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (share * F.sum("words").over(every) - F.coalesce(F.sum("full").over(until), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(until), F.lit(0.0)))
    found = weighed.withColumn("level", level).withColumn("open", F.col("full") > F.col("level") * F.col("weight"))
    # The first source that is not full at the level of its place sets the level for itself and all after it.
    final = F.min(F.when(F.col("open"), F.struct(F.col("full") / F.col("weight"), F.col("level")))).over(every)["level"]
    found = found.withColumn("final", final)
    target = F.when(F.col("final").isNull(), F.col("full")).otherwise(F.least(F.col("full"), F.col("final") * F.col("weight")))
    return found.select("source", "words", target.cast("double").alias("target"))


def permuted(index: Column, n: Column, *key: str) -> Column:
    """A keyed pseudorandom permutation of 0 to ``n`` - 1 at ``index``, computed in the row.

    Each of ROUNDS rounds pairs every x with K - x modulo n for a keyed K, and a keyed bit of the pair swaps it or not
    (swap-or-not shuffle). That is a bijection on any n, so no walk over a larger domain is needed.
    """
    def swap_or_not(x: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(37), *key, k), n) - x, n)
        return F.when(F.pmod(F.xxhash64(F.lit(41), *key, k, F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), swap_or_not)


def draw_slots(sources: DataFrame, shard: int) -> DataFrame:
    """(shard, place, s, slot): the source of every place of the output shards, and which of the source's slots it is.

    ``sources`` has s and slots. All slots together fill shards of ``shard`` places, the last one maybe less. Each place
    draws its source by a keyed uniform number, so a shard's counts are a multinomial draw by the sources' slots. A
    source's slots are numbered through the shards. Where the draws of all shards exceed a source's total, a keyed choice
    of them goes to sources that were drawn too seldom, so totals are exact: about the square root of all slots change.
    """
    spark = sources.sparkSession
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)  # one row a source
    given = settle(sources.filter("slots > 0").select("s", "slots", F.coalesce(F.sum("slots").over(upto), F.lit(0)).alias("lo")), "shares")
    total = given.agg(F.sum("slots")).first()[0] or 0
    number = F.col("id")
    places = spark.range(total).select(F.floor(number / shard).alias("shard"), F.pmod(number, F.lit(shard)).alias("place"))
    places = places.withColumn("u", F.pmod(F.xxhash64(F.lit(19), "shard", "place"), F.lit(max(1, total))))
    # A source's share of the numbers, cut at multiples of CELL, meets the draws by equality. A cell has CELL sources at most.
    cells = given.select("s", "lo", (F.col("lo") + F.col("slots")).alias("hi"))
    ends = [F.floor(F.col("lo") / CELL), F.floor((F.col("hi") - 1) / CELL)]
    cells = cells.select("s", "lo", "hi", ends[1].alias("last"), F.explode(F.sequence(*ends, F.lit(STRIDE).cast("long"))).alias("start")).repartition("s", "start")
    cells = cells.select("s", "lo", "hi", F.explode(F.sequence("start", F.least(F.col("start") + STRIDE - 1, F.col("last")))).alias("_cell"))
    drawn = places.join(cells, F.floor(F.col("u") / CELL) == F.col("_cell")).filter("u >= lo AND u < hi").select("shard", "place", "s")
    drawn = settle(drawn, "draws")
    counts = drawn.groupBy("shard", "s").agg(F.count("*").alias("n"))
    before = running_offset(counts, ["s"], ["shard"], "n", "before", max(1, -(-total // shard))).select(F.col("shard").alias("_shard"), F.col("s").alias("_s"), "before")
    inside = F.row_number().over(Window.partitionBy("shard", "s").orderBy("place")) - 1  # a shard's places at most
    numbered = drawn.withColumn("inside", inside).join(before, (F.col("shard") == F.col("_shard")) & (F.col("s") == F.col("_s")))
    numbered = numbered.select("shard", "place", "s", (F.col("before") + F.col("inside")).alias("slot"))
    taken = counts.groupBy("s").agg(F.sum("n").alias("n")).withColumnRenamed("s", "_s")
    fill = settle(given.join(taken, F.col("s") == F.col("_s"), "left").select("s", "slots", F.coalesce("n", F.lit(0)).alias("n")), "fill")
    numbered = numbered.join(fill.withColumnRenamed("s", "_s"), F.col("s") == F.col("_s")).drop("_s")
    # The surplus of a source is spread over all its draws, so no shard is left with what others did not take.
    spread = F.when(F.col("n") > F.col("slots"), permuted(F.col("slot"), F.col("n"), "s")).otherwise(F.col("slot"))
    numbered = settle(numbered.withColumn("slot", spread).drop("n"), "numbered")
    over = numbered.filter("slot >= slots").select("shard", "place", F.xxhash64(F.lit(43), "shard", "place").alias("mixed"), F.lit(1).cast("long").alias("one"))
    over = running_offset(over, [], ["mixed", "shard", "place"], "one", "e", over.count())
    short = fill.filter("n < slots")
    short = short.select("s", "slots", "n", F.coalesce(F.sum(F.col("slots") - F.col("n")).over(upto), F.lit(0)).alias("first"))
    short = short.select("s", "first", "n", F.explode(F.sequence("n", F.col("slots") - 1)).alias("slot")).select("s", "slot", (F.col("first") + F.col("slot") - F.col("n")).alias("_e"))
    moved = over.join(short, F.col("e") == F.col("_e")).select("shard", "place", "s", "slot")
    return numbered.filter("slot < slots").select("shard", "place", "s", "slot").unionByName(moved)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE, most: float = MOST, block: int = BLOCK, shard: int = SHARD) -> Mix:
    """Lay each source's words end to end, cut them into blocks of ``block`` words, and deal blocks to shards.

    A source's slots are its target in blocks. Every output shard of ``shard`` places draws multinomial counts of the
    sources (see draw_slots). Slot j of a source is in epoch j div blocks and holds the block to which the epoch's
    keyed permutation maps j mod blocks: each epoch uses every block once, the last one is cut short, so no block is used
    more than ``most`` times rounded up. Blocks join their slots by index. All draws come from hashes of indices and
    the layout from ids and texts; reruns agree. A document that spans blocks has a piece in each.

    Texts without words, null texts among them, have no pieces. A null source is a source. Repeated rows count each.
    """
    k1, k2 = text_key(F.col(text_col))
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(source_col).alias("source"), size.alias("size"))
    given = settle(given, "sizes")
    sources = source_targets(given.groupBy("source").agg(F.sum("size").alias("words")), weights, share, most)
    blocks = F.ceil(F.col("words") / block).cast("long")
    sources = sources.withColumn("blocks", blocks).withColumn("slots", F.when(F.col("words") > 0, F.round(F.col("target") * blocks / F.col("words"))).otherwise(0).cast("long"))
    sources = settle(sources.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1), "sources")
    totals = given.agg(F.count("*").alias("n"), F.sum("size").alias("words")).first()
    key = sources.select(F.col("source").alias("_source"), "s")
    coded = given.filter("size > 0").join(key, F.col("source").eqNullSafe(F.col("_source"))).select("row", "id", "k1", "k2", "s", "size")
    laid = running_offset(coded, ["s"], ["id", "k1", "k2", "row"], "size", "at", totals.n, deal=["id", "k1", "k2"])
    end = F.col("at") + F.col("size")
    spans = F.sequence(F.floor(F.col("at") / block), F.floor((end - 1) / block))
    pieces = laid.select("row", "s", "at", end.alias("end"), F.explode(spans).alias("block"))
    first = F.greatest(F.col("at"), F.col("block") * block)
    pieces = settle(pieces.select("row", "s", "block", (first - F.col("at")).alias("start"), (F.least(F.col("end"), (F.col("block") + 1) * block) - first).alias("words")), "pieces")
    drawn = draw_slots(sources, shard)
    counts = sources.select(F.col("s").alias("_s"), "blocks")
    slots = drawn.join(counts, F.col("s") == F.col("_s")).withColumn("epoch", F.expr("slot div blocks"))
    block_at = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), "s", "epoch")
    placed = settle(slots.select("s", "epoch", "slot", block_at.alias("block"), "shard", "place"), "placed")
    return Mix(given, sources, pieces, placed)


def taken_words(m: Mix) -> DataFrame:
    """(id, size, source_size, target, taken, first_shard): how many of each document's words the mix takes, repeats counted."""
    uses = m.placed.groupBy("s", "block").agg(F.count("*").alias("uses"), F.min("shard").alias("shard")).select(F.col("s").alias("_s"), F.col("block").alias("_block"), "uses", "shard")
    used = m.pieces.join(uses, (F.col("s") == F.col("_s")) & (F.col("block") == F.col("_block")))
    taken = used.groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"), F.min("shard").alias("first_shard")).withColumnRenamed("row", "_row")
    named = m.documents.join(m.sources.select(F.col("source").alias("_source"), F.col("words").alias("source_size"), "target"), F.col("source").eqNullSafe(F.col("_source")))
    out = named.join(taken, F.col("row") == F.col("_row"), "left")
    return out.select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` as the mix takes them: a row for each document and epoch that has words of it, with those words in their order.

    White space after a taken word stays with it. A document that is taken whole is as it was but for white space
    at its beginning. Rows that repeat an id and text all get the words that any of them has.
    """
    m = mix(docs, id_col, source_col, text_col, **options)
    slots = m.placed.select(F.col("s").alias("_s"), F.col("block").alias("_block"), "epoch")
    used = m.pieces.join(slots, (F.col("s") == F.col("_s")) & (F.col("block") == F.col("_block"))).select(F.col("row").alias("_row"), "epoch", "start", "words")
    keyed = used.join(m.documents.select("row", "id", "k1", "k2"), F.col("_row") == F.col("row"))
    cuts = keyed.groupBy("id", "k1", "k2", "epoch").agg(F.sort_array(F.collect_set(F.struct("start", "words"))).alias("cuts"))
    cuts = cuts.select(F.col("id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "epoch", "cuts").withColumnRenamed("epoch", "_epoch").withColumnRenamed("cuts", "_cuts")
    k1, k2 = text_key(docs[text_col])
    joined = docs.join(cuts, docs[id_col].eqNullSafe(F.col("_id")) & (k1 == F.col("_k1")) & (k2 == F.col("_k2")))
    units = F.regexp_extract_all(docs[text_col], F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    step = joined.select(*[docs[c] for c in docs.columns], "_cuts", F.inline(F.array(F.struct(units.alias("_units")))))
    text = F.array_join(F.flatten(F.transform("_cuts", lambda c: F.slice(F.col("_units"), (c["start"] + 1).cast("int"), c["words"].cast("int")))), "")
    return step.select(*[text.alias(c) if c == text_col else step[c] for c in docs.columns])


@query()
def op7_block_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words of it that the mix takes."""
    return taken_words(mix(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
