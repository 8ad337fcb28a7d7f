"""Token ids packed into rows of fixed length by best-fit decreasing."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .registry import query, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's tokenizer cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The id after each document, free in this vocabulary; rows are filled up with it too.
END = 50_256
LENGTH = 2_048
#: Tokens that are packed together in a task.
GROUP = 4_000_000


@cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """Open bins by free space: a segment tree over capacities finds the least one that is large enough."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.any = bytearray(2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, free: int, which: int) -> None:
        self.bins[free].append(which)
        at = free + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, bin) of the fullest bin with room for ``need``, which leaves the tree."""
        at = need + self.size
        while not self.any[at]:
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
            if not self.any[at]:
                continue
            break
        if at < 2:
            return None
        while at < self.size:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        free = at - self.size
        which = self.bins[free].pop()
        if not self.bins[free]:
            self.any[at] = 0
            at >>= 1
            while at:
                self.any[at] = self.any[2 * at] or self.any[2 * at + 1]
                if self.any[at]:
                    break
                at >>= 1
        return free, which


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of indices whose sizes sum to ``length`` at most: largest first, each into the fullest bin with room."""
    tree, bins = Capacities(length), []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = tree.take(sizes[k])
        if found is None:
            bins.append([k])
            free, which = length - sizes[k], len(bins) - 1
        else:
            free, which = found[0] - sizes[k], found[1]
            bins[which].append(k)
        if free:
            tree.put(free, which)
    return bins


def pack_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END, group: int = GROUP) -> DataFrame:
    """Packed rows: n_tokens, ids and positions as little-endian binary vectors of ``length``, cu_seqlens, doc_ids, offsets.

    Each document is its token ids and ``end``; null and empty texts are ``end`` alone. It is split every ``length``
    tokens, nothing is lost: segment k of a row is tokens offsets[k] onwards of document doc_ids[k] and lies
    from cu_seqlens[k] to cu_seqlens[k + 1]. Positions begin at 0 in each segment and in the fill after the last.
    ids are uint16 where all fit, else uint32; positions likewise. Tasks pack what they read in groups of ``group``
    tokens, so nothing is shuffled, memory is bounded by a group and one document, and a lost task is made again
    alike. Repeated rows are packed each.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        id_kind = np.uint16 if max(end, encoding(vocabulary).max_token_value) < 1 << 16 else np.uint32
        place_kind = np.uint16 if length <= 1 << 16 else np.uint32
        count = np.arange(length, dtype=place_kind)
        segments: list[tuple[object, int, np.ndarray]] = []
        waiting, arrow_id = 0, None

        def rows() -> Iterator[pa.RecordBatch]:
            bins = best_fit([len(s[2]) for s in segments], length)
            for at in range(0, len(bins), 1_024):
                out: dict[str, list] = {c: [] for c in ("n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "offsets")}
                for members in bins[at:at + 1_024]:
                    parts = [segments[k] for k in members]
                    ids, places = np.full(length, end, id_kind), np.zeros(length, place_kind)
                    ends = np.cumsum([0, *(len(p[2]) for p in parts)])
                    for (_, _, tokens), a, b in zip(parts, ends[:-1], ends[1:], strict=True):
                        ids[a:b], places[a:b] = tokens, count[:b - a]
                    places[ends[-1]:] = count[:length - ends[-1]]
                    out["n_tokens"].append(int(ends[-1]))
                    out["ids"].append(ids.tobytes())
                    out["positions"].append(places.tobytes())
                    out["cu_seqlens"].append(ends.astype(np.int32))
                    out["doc_ids"].append([p[0] for p in parts])
                    out["offsets"].append([p[1] for p in parts])
                yield pa.RecordBatch.from_pydict(out, pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("positions", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(arrow_id)), ("offsets", pa.list_(pa.int64()))]))

        for batch in slices(batches, "text", 4_000_000):
            arrow_id = batch.column("id").type
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = np.array([*encode(text or ""), end], id_kind)
                for at in range(0, len(tokens), length):
                    segments.append((doc, at, tokens[at:at + length]))
                waiting += len(tokens)
                if waiting >= group:
                    yield from rows()
                    segments, waiting = [], 0
        if segments:
            yield from rows()

    return given.mapInArrow(run, f"n_tokens long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{id_type}>, offsets array<long>")


def matrix(rows: list, column: str, length: int = LENGTH, kind=np.uint16) -> np.ndarray:
    """The vectors of packed rows as one matrix."""
    return np.frombuffer(b"".join(bytes(r[column]) for r in rows), kind).reshape(len(rows), length)


@query()
def op2_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows."""
    return pack_tokens(table(spark, sf_dir, "documents"))
