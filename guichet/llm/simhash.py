"""SimHash fingerprints, the generalised pigeonhole search for close ones, and groups of near copies."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, passing, settle
from .common import SPACE, ascii_lower, byte_words, slices
from .components import components
from .registry import query, table

BITS = 64
#: Members of a bucket that one block compares; larger buckets are compared block against block.
BLOCK = 8_192
#: Relative costs of sending one key row through the shuffle and of comparing one pair.
ROW_COST, PAIR_COST = 1.0, 0.005
#: Nodes that follow under a shared shingle with which each is compared first.
NEAR = 4
#: Texts sampled for common shingles, how many of them make a shingle common, and how many such shingles are sent to the tasks.
SAMPLED, COMMON, MOST_COMMON = 20_000, 8, 200_000
MET = ["tok", "a", "b", "n", "place"]
#: Longs of the sketch that rows of texts under a frequent shingle carry.
WORDS = 64


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the rows of hashes (rows x words of 64 bits), packed again."""
    counts = np.zeros(hashes.shape[1] * BITS, np.int64)
    for at in range(0, len(hashes), 32_768):
        part = np.ascontiguousarray(hashes[at:at + 32_768])
        counts += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words, repeats included; fewer words give the whole sequence, none give nothing."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    return [joined[a:b] for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)]


def fingerprint(words: list[bytes], size: int = 3) -> int:
    """Unsigned 64-bit SimHash of a word sequence; zero for no words."""
    found = shingles(words, size)
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    return int(_majority(np.fromiter((digest(s, 42) for s in found), np.uint64, len(found))[:, None])[0])


def shingle_set(words: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, as signed longs."""
    found = shingles(words, size)
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(s) for s in found), np.uint64, len(found)).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp): the SimHash of each row's whole text, as a signed long. Null and empty texts have zero."""
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(byte_words(t.as_py()), size) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, fp long")


def bit_counts(nodes: DataFrame) -> np.ndarray:
    """For each pair of bits, how many of all fingerprints have both set; row and column 64 stand for 'any'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            bits = np.hstack([bits, np.ones((len(fps), 1), np.float32)])
            total += np.rint(bits.T @ bits).astype(np.int64)
        at = np.arange((BITS + 1) ** 2)
        yield pa.RecordBatch.from_arrays([pa.array(at // (BITS + 1)), pa.array(at % (BITS + 1)), pa.array(total.ravel())], ["i", "j", "n"])

    out = np.zeros((BITS + 1, BITS + 1))
    for i, j, n in nodes.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n")).collect():
        out[i, j] = n
    return out


def _groups(both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the bits to partitions, each grown by the bit most correlated with those it has."""
    n = max(both[BITS, BITS], 1.0)
    p = np.diag(both)[:BITS] / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs((both[:BITS, :BITS] / n - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(tied, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        first = max(sorted(left), key=lambda b: tied[b, sorted(left)].max(initial=0.0))
        group = [first]
        left.discard(first)
        while len(group) < BITS // parts + (k < BITS % parts):
            best = max(sorted(left), key=lambda b: tied[b, group].sum())
            group.append(best)
            left.discard(best)
        out.append(group)
    return out


def _agreement(both: np.ndarray, group: list[int]) -> np.ndarray:
    """Probability that two fingerprints differ in 0, 1, 2, ... bits of a group: each bit given its closest earlier bit."""
    n = max(both[BITS, BITS], 1.0)
    p = np.diag(both)[:BITS] / n
    same = p ** 2 + (1 - p) ** 2
    out = np.array([1.0])
    for at, b in enumerate(group):
        given = same[b]
        for a in group[:at]:
            c = both[a, b] / n
            joint = np.array([c, p[a] - c, p[b] - c, 1 - p[a] - p[b] + c])
            given = max(given, min(1.0, float((joint ** 2).sum()) / max(same[a], 1e-9)))
        out = np.convolve(out, [given, 1 - given])
    return out


def _ball(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


def _meeting(width: int, radius: int, apart: int) -> int:
    """Values within ``radius`` of both of two values that differ in ``apart`` bits."""
    return sum(comb(apart, i) * comb(width - apart, j) for i in range(apart + 1) for j in range(width - apart + 1) if i + j <= radius and apart - i + j <= radius)


def plan(both: np.ndarray, radius: int, most_parts: int = 8) -> list[tuple[list[int], int]]:
    """Partitions of the bits with a threshold each, -1 for one that is not probed.

    By the general pigeonhole principle thresholds that sum to radius - parts + 1 miss no pair. For each
    number of parts, dynamic programming spends that sum where the estimated rows and pairs cost least.
    """
    n, best = both[BITS, BITS], None
    for parts in range(1, min(most_parts, radius + 2) + 1):
        groups, budget = _groups(both, parts), radius - parts + 1
        reach = {0: (0.0, [])}  # by the sum of thresholds so far
        for group in groups:
            w, apart = len(group), _agreement(both, group)
            after: dict[int, tuple[float, list[int]]] = {}
            for e in range(-1, radius + 1):
                r = (e + 1) // 2
                if e >= 0 and _ball(w, r) > 5_000:
                    break
                pairs = sum(apart[d] * _meeting(w, r, d) for d in range(min(2 * r, w) + 1)) if e >= 0 else 0
                cost = n * _ball(w, r) * ROW_COST + n * n / 2 * pairs * PAIR_COST if e >= 0 else 0.0
                for spent, (so_far, chosen) in reach.items():
                    if (at := spent + e) not in after or after[at][0] > so_far + cost:
                        after[at] = (so_far + cost, [*chosen, e])
            reach = after
        if budget in reach and (best is None or reach[budget][0] < best[0]):
            best = (reach[budget][0], list(zip(groups, reach[budget][1], strict=True)))
    return best[1]


def _forest(close: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the components of an adjacency matrix."""
    left, out = np.ones(len(close), bool), []
    for start in range(len(close)):
        if not left[start]:
            continue
        left[start], edge = False, [start]
        while edge:
            at = edge.pop()
            near = np.flatnonzero(close[at] & left)
            left[near] = False
            out += [(at, int(x)) for x in near]
            edge += near.tolist()
    return out


def _verified(fp: np.ndarray, radius: int, a, b) -> np.ndarray:
    return np.bitwise_count(fp[a] ^ fp[b]) <= radius


def _bucket_links(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that keep the components of one bucket. A row is compared only with rows not reached yet."""
    if len(fp) <= 512:
        every = np.arange(len(fp))
        return _forest(_verified(fp, radius, every[:, None], every[None, :]))
    left, out = np.arange(len(fp)), []
    while len(left):
        edge, left = [int(left[0])], left[1:]
        while edge and len(left):
            at = edge.pop()
            near = _verified(fp, radius, at, left)
            out += [(at, int(x)) for x in left[near]]
            edge += left[near].tolist()
            left = left[~near]
    return out


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links between nodes whose fingerprints differ in at most ``radius`` bits.

    ``nodes`` has one row per (node long, fp long). Each node sends one row for every value near its own in each
    probed partition; rows that meet under a value are compared inside the task. The result holds enough of the
    links to keep every component, never all pairs of a bucket. A bucket with more than BLOCK members is
    dealt to blocks, and each pair of blocks is a bucket of its own, so no task holds more than two blocks.
    """
    probes = []
    for k, (group, e) in enumerate(plan(bit_counts(nodes), radius)):
        mask = sum(1 << b for b in group)
        for flips in (c for size in range((e + 1) // 2 + 1 if e >= 0 else 0) for c in combinations(group, size)):
            probes.append((k, mask, sum(1 << b for b in flips)))
    long = lambda v: v - (1 << 64) if v >> 63 else v
    values = ", ".join(f"named_struct('part', {k}, 'mask', {_sql(long(m))}, 'flip', {_sql(long(f))})" for k, m, f in probes)
    keyed = nodes.select("*", F.expr(f"inline(array({values}))")).withColumn("key", F.expr("(fp & mask) ^ flip")).drop("mask", "flip")
    large = keyed.groupBy("part", "key").count().filter(F.col("count") > BLOCK).select(F.col("part").alias("_part"), F.col("key").alias("_key"), F.ceil(F.col("count") / (BLOCK // 2)).alias("blocks"))
    keyed = keyed.join(large, (F.col("part") == F.col("_part")) & (F.col("key") == F.col("_key")), "left").drop("_part", "_key")
    own = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks"))
    dealt = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other)))
    keyed = keyed.withColumn("block", F.explode(dealt)).drop("blocks")
    together = keyed.repartition("part", "key", "block").sortWithinPartitions("part", "key", "block", "node")

    def compare(node: np.ndarray, fp: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All buckets that lie whole in the arrays."""
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        a, b = [], []
        few = np.repeat(sizes <= 8, sizes)
        for apart in range(1, 8):
            i = np.flatnonzero(few[:-apart] & (bucket[apart:] == bucket[:-apart])) if len(bucket) > apart else []
            if not len(i):
                break
            i = i[_verified(fp, radius, i, i + apart)]
            a.append(node[i])
            b.append(node[i + apart])
        for s, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist(), strict=True):
            if found := _bucket_links(fp[s:s + size], radius):
                i = np.array(found) + s
                a.append(node[i[:, 0]])
                b.append(node[i[:, 1]])
        if not a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pairs[0], pairs[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = None, 0
        for batch in batches:
            node, fp, key, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "fp", "key", "block"))
            part = batch.column("part").to_numpy(zero_copy_only=False)
            new = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (block[1:] != block[:-1])
            here = (part[0], key[0], block[0]) if len(node) else None
            if here is None:
                continue
            bucket = np.r_[0, np.cumsum(new)]
            if kept is not None:
                bucket = bucket + kept[2][-1] + (here != last)
                node, fp, bucket = (np.concatenate(x) for x in zip(kept, (node, fp.view(np.uint64), bucket), strict=True))
            last, fp = (part[-1], key[-1], block[-1]), fp.view(np.uint64)
            whole = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on in the next batch
            if whole:
                a, b = compare(node[:whole], fp[:whole], bucket[:whole])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            kept = (node[whole:], fp[whole:], bucket[whole:])
        if kept is not None:
            a, b = compare(*kept)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return together.select("part", "key", "block", "node", "fp").mapInArrow(run, "a long, b long").distinct()


def _sql(v: int) -> str:
    return f"{v}L" if v > -(1 << 63) else "(-9223372036854775807L - 1L)"


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``: the smallest id that links of close fingerprints reach.

    Rows with equal texts, repeated rows and rows without words each share a fingerprint and so a component.
    A null id keeps its row but names a component only where no other id does. Other columns play no part;
    an empty table gives no rows.
    """
    found = settle(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = settle(found.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    named = rooted.join(names, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return found.join(named, found.fp == F.col("_fp")).select("id", "fp", "component_id")


def prefix_of(found: np.ndarray, similarity: float, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order that all sets share: sets of this Jaccard similarity share one of them.

    ``common`` are sorted hashes of shingles that come last, by ``rank``; all others are ordered by hash.
    """
    if not len(found):
        return found
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found = found[np.lexsort((found, np.where(common[at] == found, rank[at], 0)))]
    return found[:len(found) - int(np.ceil(similarity * len(found) - 1e-9)) + 1]


def _may_reach(similarity: float, n, m, i, j):
    """Whether sets of n and m shingles whose first common shingle has places i and j can be similar. Columns or arrays."""
    least = similarity / (1 + similarity) * (n + m) - 1e-6
    return (n - i >= least) & (m - j >= least)


def _common_shingles(given: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts of a sample hold, sorted, and their ranks from 1 by count. They only steer the cost."""
    texts = given.select("node").distinct().count()
    part = given.filter(F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(max(1, texts // SAMPLED))) == 0).dropDuplicates(["node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(byte_words(t.as_py()), size))], ["s"])

    often = part.select("text").mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    rows = sorted((r.n, r.s) for r in often.orderBy(F.desc("n"), "s").limit(MOST_COMMON).collect())
    hashes = np.array([s for _, s in rows], np.int64)
    order = np.argsort(hashes)
    return hashes[order], order + 1


def parity_sketch(shingles: np.ndarray) -> tuple[int, bytes]:
    """The size of a set, and a bit for each of at least twice as many slots (a power of two): whether an odd number of its members fall there."""
    bits = 1 << max(8, (2 * len(shingles)).bit_length())
    odd = np.bincount(shingles.astype(np.uint64) & np.uint64(bits - 1), minlength=bits) & 1 if len(shingles) else np.zeros(bits, int)
    return len(shingles), np.packbits(odd.astype(np.uint8)).tobytes()


def fixed_sketch(shingles: np.ndarray) -> list[int]:
    """A parity sketch of WORDS longs, whatever the size of the set."""
    slots = WORDS * 64
    odd = np.bincount(shingles.astype(np.uint64) & np.uint64(slots - 1), minlength=slots) & 1 if len(shingles) else np.zeros(slots, int)
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _may_be_similar(similarity: float, n, m, x, y):
    """Whether sets of n and m shingles with the fixed sketches x and y can be similar: no more bits differ than members may. Columns."""
    apart = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, c: total + c)
    return apart * (1 + similarity) <= (1 - similarity) * (n + m) + 1e-6


def least_apart(a: bytes, b: bytes) -> int:
    """How many members two sets differ in at least. Each changes one bit, so differing bits are no more; the longer sketch is folded to the shorter one."""
    x, y = (np.frombuffer(s, np.uint8) for s in sorted((a, b), key=len))
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def fingerprint_pairs(given: DataFrame, radius: int) -> DataFrame:
    """(a, b): nodes of (node, text) rows that SimHash and the pigeonhole search propose: those of one fingerprint, each with its
    smallest, and the smallest of close fingerprints, as many as keep their components."""
    found = settle(fingerprints(given.dropDuplicates(["node"]), "node"), "fingerprints")
    least = settle(found.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    same = found.join(least, "fp").filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    ends = [least.select(F.col("fp").alias(c), F.col("least").alias(f"least_{c}")) for c in "ab"]
    close = links(least.select(F.col("fp").alias("node"), "fp"), radius).join(ends[0], "a").join(ends[1], "b")
    return same.union(close.select(F.least("least_a", "least_b"), F.greatest("least_a", "least_b")))


def similar_links(given: DataFrame, size: int, similarity: float, radius: int = 2) -> DataFrame:
    """(a, b): links between nodes whose distinct shingles have at least this Jaccard similarity, decided on the sets.

    ``given`` has rows (node long, text binary); rows of one node have equal words. Pairs of close fingerprints
    are proposed by the pigeonhole search of SimHash; as similar texts can have fingerprints further apart than
    ``radius``, nodes also meet under each shingle of their prefixes, so no similar pair is missed. Under a shingle each node is first compared with the NEAR
    that follow by size. Pairs further apart are compared only where those links don't join them already, so a
    large group of near copies costs few pairs, and where their sketches don't tell them apart, so a frequent
    shingle of unlike texts makes none. The result keeps every component of the similar pairs.
    """
    spark = given.sparkSession
    sent = spark.sparkContext.broadcast(_common_shingles(given, size))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = sent.value
        for batch in batches:
            for whole in slices([batch], "text", 1 << 20):
                sets = [shingle_set(byte_words(t.as_py()), size) for t in whole.column("text")]
                first = [prefix_of(s, similarity, common, rank) for s in sets]
                sizes = [len(f) for f in first]
                tok = np.concatenate(first) if first else np.zeros(0, np.int64)
                node = np.repeat(whole.column("node").to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                n = np.repeat(np.array([len(s) for s in sets], np.int32), sizes)
                place = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]) if sizes else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tok, node, n, place)], ["tok", "node", "n", "place"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (null, a, b) of neighbours, and (tok, a) rows of those that have more than NEAR nodes after or before them."""
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
        for batch in batches:
            old = len(kept[0])
            tok, node, n, place = (np.concatenate([k, batch.column(c).to_numpy(zero_copy_only=False)]) for k, c in zip(kept, ("tok", "node", "n", "place"), strict=True))
            new = np.r_[True, (tok[1:] != tok[:-1]) | (node[1:] != node[:-1])][:len(tok)]
            tok, node, n, place = tok[new], node[new], n[new], place[new]
            a, b = [], []
            for apart in range(1, NEAR + 1):
                i = np.flatnonzero((tok[apart:] == tok[:-apart]) & (np.arange(apart, len(tok)) >= old))
                i = i[_may_reach(similarity, n[i], n[i + apart], place[i], place[i + apart])]
                a.append(np.minimum(node[i], node[i + apart]))
                b.append(np.maximum(node[i], node[i + apart]))
            far = np.flatnonzero(tok[NEAR + 1:] == tok[:-NEAR - 1])
            far = np.unique(np.r_[far, far + NEAR + 1])
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(pairs[0]), pa.array(pairs[1]), none.cast(pa.int32()), none.cast(pa.int32())], MET)
            yield pa.RecordBatch.from_arrays([pa.array(tok[far]), pa.array(node[far]), pa.nulls(len(far), pa.int64()), pa.array(n[far]), pa.array(place[far])], MET)
            kept = [x[-NEAR - 1:] for x in (tok, node, n, place)]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in slices([batch], "text", 1 << 20):
                found = [shingle_set(byte_words(t.as_py()), size).tolist() for t in whole.column("text")]
                yield pa.RecordBatch.from_arrays([whole.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "s"])

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in slices([batch], "text", 1 << 20):
                given_sets = [shingle_set(byte_words(t.as_py()), size) for t in whole.column("text")]
                found, fixed = [parity_sketch(s) for s in given_sets], [fixed_sketch(s) for s in given_sets]
                columns = [pa.array([n for n, _ in found], pa.int64()), pa.array([p for _, p in found], pa.binary()), pa.array(fixed, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([whole.column("node"), *columns], ["node", "size", "parity", "fixed"])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, pa_, pb = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "pa", "pb"))
            stay = [least_apart(x, y) * (1 + similarity) <= (1 - similarity) * (m + n) + 1e-6 for x, y, m, n in zip(pa_, pb, na, nb, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, s in zip(c, stay, strict=True) if s], pa.int64()) for c in (a, b)], ["a", "b"])

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are similar. Sketches first drop most of those that surely are not, then the sets decide."""
        out = fresh_path(spark, "similar")
        with passing(spark):
            pairs = settle(pairs, "candidates")
            side = lambda c: sketched.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))
            pairs = settle(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(possible, "a long, b long"), "pairs")
            needed = settle(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "needed")  # stored, so the planner knows its size
            texts = given.join(needed, "node", "left_semi").select("node", "text").dropDuplicates(["node"])
            held = settle(texts.mapInArrow(sets, "node long, s array<long>"), "sets")
            both = pairs.join(held.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(held.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
            shared = F.size(F.array_intersect("sa", "sb"))
            return settle(both.filter(shared * (1 + similarity) >= similarity * (F.size("sa") + F.size("sb")) - 1e-6).select("a", "b"), path=out)

    out = fresh_path(spark, "close")
    with passing(spark):
        sketched = settle(given.mapInArrow(sketches, "node long, size long, parity binary, fixed array<long>").dropDuplicates(["node"]), "sketches")
        proposed_path, near_path, rest_path = fresh_path(spark, "proposed"), fresh_path(spark, "near"), fresh_path(spark, "rest")
        with passing(spark):
            proposed = settle(fingerprint_pairs(given, radius), path=proposed_path)
        with passing(spark):  # the meetings are the largest table: gone before pairs further apart are made
            keyed = given.mapInArrow(prefixes, "tok long, node long, n int, place int")
            met = settle(keyed.repartition("tok").sortWithinPartitions("tok", "n", "node").mapInArrow(meet, "tok long, a long, b long, n int, place int"), "met")
            near = settle(similar(met.filter("tok IS NULL").select("a", "b").union(proposed).distinct()), path=near_path)
            roots = components(near).withColumnRenamed("node", "_n")
            rest = met.filter("tok IS NOT NULL").select("tok", "a", "n", "place").distinct().join(roots, F.col("a") == F.col("_n"), "left").select("tok", "a", "n", "place", F.coalesce("root", "a").alias("root"))
            rest = settle(rest, path=rest_path)
        mixed = rest.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("tok")
        rest = rest.join(mixed, "tok", "left_semi").join(sketched.select(F.col("node").alias("a"), "fixed"), "a")
        x, y = rest.alias("x"), rest.alias("y")
        # sketches drop unlike texts under a frequent shingle before there is a row for their pair
        met = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.root") < F.col("y.root")) & _may_reach(similarity, F.col("x.n"), F.col("y.n"), F.col("x.place"), F.col("y.place"))
        apart = x.join(y, met & _may_be_similar(similarity, F.col("x.n"), F.col("y.n"), F.col("x.fixed"), F.col("y.fixed")))
        return settle(near.union(similar(apart.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")).distinct())), path=out)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest id stays. SimHash and the prefixes propose pairs.

    Two texts are near copies if the Jaccard similarity of their distinct shingles of ``size`` words is at least
    ``similarity``; a group is what such pairs join. Texts of equal words are one node whatever their spacing;
    of rows that repeat an id with such texts one stays. Texts without words are one group, null ids sort last.
    """
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), SPACE, " "))
    whole = docs.withColumn("_node", F.xxhash64(spaced))
    first_id = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id")))
    least = settle(whole.groupBy(F.col("_node").alias("node")).agg(first_id.alias("least")), "least")
    close = components(similar_links(whole.select(F.col("_node").alias("node"), F.col(text_col).cast("binary").alias("text")), size, similarity))
    rooted = least.join(close.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    kept = rooted.groupBy("root").agg(F.min(F.struct("least", "node")).alias("first")).select(F.col("first.least.id").alias("_id"), F.col("first.node").alias("_kept"))
    staying = whole.join(kept, (F.col("_node") == F.col("_kept")) & F.col(id_col).eqNullSafe(F.col("_id")))
    return staying.dropDuplicates(["_node", "_id"]).drop("_node", "_kept", "_id")


@query()
def op8_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
