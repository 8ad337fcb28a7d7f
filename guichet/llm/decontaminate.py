"""Benchmark passages in documents: q-gram counts in diagonal bands, then banded alignment."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import slices
from .registry import query, table

Q = 12
#: Items are searched in long pieces, for passages with many edits, and in short ones, for excerpts; (bytes, step) of each.
PIECE, SHORT = 128, 48
PIECES = ((PIECE, PIECE // 2), (SHORT, 16))
#: Any stretch of an item with this many bytes holds a whole short piece.
EXCERPT = SHORT + 15
#: Edits allowed for each byte of a piece.
EDITS = 0.06
#: Items with fewer bytes than this, white space squeezed, are too common to be evidence.
LEAST = 24
#: Benchmark bytes that one pass over the documents searches for.
PASS_BYTES = 1_000_000
BITMAP_BITS = 23
#: Places within which a q-gram that recurs is taken for one run.
RECUR = 8
#: Text places whose bands are counted together, and band counts made at a time.
STRETCH, COUNTED = 1 << 13, 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
RUN = re.compile(rb"[^\x20\x09-\x0D]+")


def squeezed(text: bytes | None) -> bytes:
    """Lower case A-Z and one space between words."""
    return b" ".join(text.lower().split()) if text else b""


def pieces_of(item: bytes) -> list[tuple[int, bytes]]:
    """Overlapping pieces of both sizes that cover an item, the last ones at its end; a shorter item is a piece."""
    spans = set()
    for size, step in PIECES:
        spans |= {(s, s + size) for s in [*range(0, len(item) - size, step), len(item) - size]} if len(item) > size else {(0, len(item))}
    return [(s, item[s:e]) for s, e in sorted(spans)]


def codes_of(data: bytes) -> np.ndarray:
    """A 64-bit hash of the q-gram at each place, from its first and its last eight bytes."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    first = np.ndarray((n,), "<u8", data, strides=(1,)) * MIX
    first ^= first >> np.uint64(29)
    first += np.ndarray((n,), "<u8", data, Q - 8, strides=(1,))
    first *= MIX
    return first


def _slots(codes: np.ndarray) -> np.ndarray:
    return codes >> np.uint64(64 - BITMAP_BITS)


def budget(size: int) -> int:
    """Edits allowed in a piece: as many as leave the lemma a shared q-gram to ask for."""
    return max(0, min(int(EDITS * size), (size - Q) // Q))


def needed(size: int) -> int:
    """By the q-gram lemma a piece within its budget of a region shares at least so many q-grams with it."""
    return size - Q + 1 - Q * budget(size)


@dataclass
class Index:
    """The distinct pieces of a benchmark block, which items hold them, and where each q-gram occurs in them.

    A q-gram that recurs in a piece within RECUR places is one run of places, so rulers and table lines stay short.
    """

    held: list[list[tuple[int, object, int]]]  # by piece: (number, item, start)
    pieces: list[bytes]
    grams: np.ndarray   # sorted, distinct
    offsets: np.ndarray  # into the next three, by gram
    piece: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def build(rows: list[tuple[object, bytes]]) -> Index:
        holders: dict[bytes, list[tuple[int, object, int]]] = {}
        number = 0
        for item, text in rows:
            data = squeezed(text)
            if len(data) >= LEAST:
                for start, p in pieces_of(data):
                    holders.setdefault(p, []).append((number, item, start))
                    number += 1
        pieces = list(holders)
        codes = [codes_of(p) for p in pieces]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(pieces)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        flat, owner, place = flat[order], owner[order], place[order].astype(np.int64)
        new = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] - place[:-1] > RECUR)][:len(flat)]
        first = np.flatnonzero(new)
        high = place[np.r_[first[1:], len(flat)].astype(np.int64) - 1] if len(flat) else place
        grams, offsets = np.unique(flat[first], return_index=True)
        return Index(list(holders.values()), pieces, grams, np.r_[offsets, len(first)].astype(np.int64), owner[first], place[first], high)

    def bitmap(self) -> np.ndarray:
        out = np.zeros(1 << BITMAP_BITS, bool)
        out[_slots(self.grams)] = True
        return out


class Matcher:
    """An index ready to search; made once for each task."""

    def __init__(self, index: Index):
        self.index, self.bitmap = index, index.bitmap()
        sizes = np.array([len(p) for p in index.pieces], np.int64)
        self.sizes, self.edits = sizes, np.array([budget(int(s)) for s in sizes], np.int64)
        self.needed = np.array([needed(int(s)) for s in sizes], np.int64)
        # A region that holds some piece has this many hits within this many places.
        self.filters = sorted({(int(n), int(s + e - Q)) for n, s, e in zip(self.needed, sizes, self.edits, strict=True)})
        self.filters = [(n, span) for n, span in self.filters if not any(m <= n and wide >= span and (m, wide) != (n, span) for m, wide in self.filters)]
        self.band = int(self.edits.max(initial=0)) + 1

    def bands(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(piece, first diagonal) of the bands with enough shared q-grams, a stretch of the text at a time."""
        codes = codes_of(data)
        hits = np.flatnonzero(self.bitmap[_slots(codes)])
        dense = np.zeros(len(hits) + 1, np.int64)  # regions with enough hits of any piece, by their first and last hits
        for n, span in self.filters:
            if len(hits) >= n:
                start = np.flatnonzero(hits[n - 1:] - hits[:len(hits) - n + 1] <= span)
                np.add.at(dense, start, 1)
                np.add.at(dense, start + n, -1)
        hits = hits[np.cumsum(dense[:-1]) > 0]
        if not len(hits):
            return
        x = self.index
        gram = np.searchsorted(x.grams, codes[hits])
        real = np.minimum(gram, len(x.grams) - 1)
        real = x.grams[real] == codes[hits]
        hits, gram = hits[real], gram[real]
        reach = 2 * self.band + 2 * PIECE  # a band that begins in a stretch ends within so many places behind it
        for begin in sorted({int(v) for h in (hits - 2 * self.band, hits + PIECE) for v in np.unique(h // STRETCH)}):
            lo, hi = begin * STRETCH, (begin + 1) * STRETCH
            near = slice(*np.searchsorted(hits, [lo - PIECE, hi + reach]))
            if near.stop > near.start:
                yield self._bands_of(hits[near], gram[near], -(-lo // self.band), -(-hi // self.band))

    def _bands_of(self, hits: np.ndarray, gram: np.ndarray, from_band: int, to_band: int) -> tuple[np.ndarray, np.ndarray]:
        """The bands of a range, counted from runs: places where the text, and a piece, repeat a q-gram within RECUR.

        Band b holds the 2 * band diagonals from b * band - PIECE; bands overlap by half, so any stretch of diagonals
        within the budget lies in one. A run of the text shares as many q-grams with a run of a piece in a band as
        it has places there. Runs with gaps count too many, never too few; the alignment decides.
        """
        x, width = self.index, self.band
        order = np.lexsort((hits, gram))
        hits, gram = hits[order].astype(np.int64), gram[order].astype(np.int64)
        places = (gram << 40) + hits
        first = np.flatnonzero(np.r_[True, np.diff(places) > RECUR])
        t0, t1, g = hits[first], hits[np.r_[first[1:], len(hits)] - 1], gram[first]
        sizes = x.offsets[g + 1] - x.offsets[g]
        run = np.repeat(np.arange(len(first)), sizes)
        into = np.repeat(x.offsets[g] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        low, high = x.low[into], x.high[into]
        least = np.maximum((t0[run] - high + PIECE) // width - 1, from_band)
        most = np.minimum((t1[run] - low + PIECE) // width, to_band - 1)
        count = np.maximum(most - least + 1, 0)
        keys, totals = np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.cumsum(count)
        cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(COUNTED, ends[-1] if len(ends) else 0, COUNTED)) + 1, len(ends)])
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            c = count[s:e]
            at = np.repeat(np.arange(s, e), c)
            band = least[at] + np.arange(len(at)) - np.repeat(np.cumsum(c) - c, c)
            r = run[at]
            start = np.maximum(t0[r], band * width - PIECE + low[at])
            stop = np.minimum(t1[r], (band + 2) * width - PIECE - 1 + high[at])
            shared = np.searchsorted(places, (g[r] << 40) + stop, "right") - np.searchsorted(places, (g[r] << 40) + start)
            key = x.piece[into[at]] * np.int64(1 << 40) + band + (1 << 20)
            keys, back = np.unique(np.r_[keys, key], return_inverse=True)
            totals = np.bincount(back, np.r_[totals, np.maximum(shared, 0)], len(keys)).astype(np.int64)
        piece = keys >> 40
        good = totals >= self.needed[piece]
        return piece[good], ((keys[good] & ((1 << 40) - 1)) - (1 << 20)) * width - PIECE

    def align(self, texts: list[bytes], owner: np.ndarray, piece: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least edits of each piece against its band of the text, and where that alignment begins and ends in the text."""
        n, slack = len(piece), int(self.edits.max(initial=0))
        width = 2 * self.band + 2 * slack
        lo = first - slack  # column c of row i stands for the text place lo + c + i
        longest = int(self.sizes[piece].max())
        text = np.zeros((n, longest + width), np.int16) - 1
        want = np.zeros((n, longest), np.int16) - 2
        for k in range(n):
            data, start = texts[owner[k]], int(lo[k])
            part = np.frombuffer(data[max(start, 0):max(start + longest + width, 0)], np.uint8)
            text[k, max(-start, 0):max(-start, 0) + len(part)] = part
            p = np.frombuffer(self.index.pieces[piece[k]], np.uint8)
            want[k, :len(p)] = p
        far, columns = 1 << 20, np.arange(width)
        cost = np.zeros((n, width), np.int64)
        begin = np.broadcast_to(columns, (n, width)).copy()
        best = np.full(n, far)
        begins, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(longest):
            change = cost + (text[:, i:i + width] != want[:, i:i + 1])
            skip = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), far)], axis=1)  # a byte of the piece has no partner
            use = skip < change
            now = np.where(use, skip, change)
            from_ = np.where(use, np.concatenate([begin[:, 1:], begin[:, -1:]], axis=1), begin)
            # A byte of the text has no partner: the least of cost + distance over the columns before.
            packed = (now - columns) * width + columns
            low = np.minimum.accumulate(packed, axis=1)
            source = low % width
            cost, begin = low // width + columns, np.take_along_axis(from_, source, axis=1)
            done = np.flatnonzero(self.sizes[piece] == i + 1)
            if len(done):
                c = cost[done].argmin(1)
                best[done] = cost[done, c]
                begins[done], ends[done] = lo[done] + begin[done, c], lo[done] + c + i + 1
        return best, begins, ends

    def search(self, texts: list[bytes]) -> list[tuple[int, object, int, int, int]]:
        """(text, item, begin, end, edits) in squeezed bytes: every occurrence of a benchmark item in a text."""
        out = []
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        aligned: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

        def decide() -> None:
            owner = np.concatenate([np.full(len(p), k) for k, p, _ in waiting])
            piece, first = (np.concatenate([w[i] for w in waiting]) for i in (1, 2))
            waiting.clear()
            for s in range(0, len(owner), 20_000):
                cut = slice(s, s + 20_000)
                self.verify(texts, owner[cut], piece[cut], first[cut], aligned)

        for k, data in enumerate(texts):
            for p, f in self.bands(data):
                if len(p):
                    waiting.append((k, p, f))
                    if sum(len(w[1]) for w in waiting) >= 20_000:
                        decide()
        if waiting:
            decide()
        found: dict[tuple[int, object], list[tuple[int, int, int, int, int, int]]] = {}
        for (text, piece), places in aligned.items():
            for low, high, (edits, begin, end) in self.stretches(places):
                for number, item, start in self.index.held[piece]:
                    found.setdefault((text, item), []).append((low - start, high - start, number, edits, begin, end))
        for (text, item), stretches in found.items():
            out += [(text, item, *o) for o in self.occurrences(stretches)]
        return out

    def verify(self, texts: list[bytes], owner: np.ndarray, piece: np.ndarray, first: np.ndarray, aligned: dict) -> None:
        """Add the (begin, end, edits) of bands that align within the budget. Bands of equal bytes are aligned once."""
        slack = int(self.edits.max(initial=0))
        width = 2 * self.band + 2 * slack
        shown: dict[tuple[int, int, bytes], int] = {}
        same = np.zeros(len(owner), np.int64)
        for k, (o, p, f) in enumerate(zip(owner.tolist(), piece.tolist(), first.tolist(), strict=True)):
            start = f - slack
            window = texts[o][max(start, 0):max(start + int(self.sizes[p]) + width, 0)]
            same[k] = shown.setdefault((p, min(start, 0), window), k)
        once, back = np.unique(same, return_inverse=True)
        best, begin, end = np.zeros(len(once), np.int64), np.zeros(len(once), np.int64), np.zeros(len(once), np.int64)
        for s in range(0, len(once), 2_000):
            cut = once[s:s + 2_000]
            best[s:s + 2_000], b, e = self.align(texts, owner[cut], piece[cut], first[cut])
            begin[s:s + 2_000], end[s:s + 2_000] = b - first[cut], e - first[cut]
        for k in np.flatnonzero(best[back] <= self.edits[piece]).tolist():
            at = back[k]
            aligned.setdefault((int(owner[k]), int(piece[k])), []).append((int(first[k] + begin[at]), int(first[k] + end[at]), int(best[at])))

    def stretches(self, places: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, tuple[int, int, int]]]:
        """(first begin, last begin, best (edits, begin, end)) of alignments of one piece that follow each other within the band."""
        low = high = best = None
        for begin, end, edits in sorted(places):
            if best is not None and begin - high > self.band:
                yield low, high, best
                best = None
            low = begin if best is None else low
            best = (edits, begin, end) if best is None else min(best, (edits, begin, end))
            high = begin
        if best is not None:
            yield low, high, best

    def occurrences(self, stretches: list[tuple[int, int, int, int, int, int]]) -> list[tuple[int, int, int]]:
        """(begin, end, edits) of each occurrence of an item, from (first diagonal, last diagonal, piece, edits, begin, end) of its pieces' stretches.

        Stretches whose diagonals follow each other within the band are one occurrence, with the best of each piece
        in it. An occurrence inside another, as an item that repeats itself makes them, is left out.
        """
        chains: list[dict[int, tuple[int, int, int]]] = []
        last = None
        for low, high, at, edits, begin, end in sorted(stretches):
            if last is None or low - last > self.band:
                chains.append({})
                last = high
            last = max(last, high)
            chains[-1][at] = min(chains[-1].get(at, (edits, begin, end)), (edits, begin, end))
        merged = [(min(v[1] for v in c.values()), max(v[2] for v in c.values()), max(v[0] for v in c.values())) for c in chains]
        out: list[tuple[int, int, int]] = []
        for begin, end, edits in sorted(merged, key=lambda m: (m[0], -m[1], m[2])):
            if not out or end > out[-1][1]:
                out.append((begin, end, edits))
        return out


def original_span(text: bytes, begin: int, end: int) -> tuple[int, int]:
    """Code points of a stretch of the squeezed text, in the text as it was."""
    at, start, stop = 0, None, 0
    for m in RUN.finditer(text):
        size = m.end() - m.start()
        if start is None and begin < at + size:
            start = m.start() + max(begin - at, 0)
        if start is not None:
            stop = m.start() + min(max(end - at, 0), size) if end > at else stop
        if end <= at + size:
            break
        at += size + 1
    start = start or 0
    chars = lambda b: len(text[:b].decode("utf-8", "ignore"))
    return chars(start), chars(max(stop, start))


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """The items in blocks of bounded size, one at a time on the driver."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("text")).filter(F.length("text") >= LEAST)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // pass_bytes))
    for k in range(blocks):
        rows, size = [], 0
        for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).toLocalIterator():
            rows.append((r.item, bytes(r.text)))
            size += len(r.text)
            if size > pass_bytes:
                yield rows
                rows, size = [], 0
        if rows:
            yield rows


_ready: dict[str, Matcher] = {}


def _matcher(sent) -> Matcher:
    """The matcher of a block, made once by a Python worker; only the block's texts travel."""
    key, rows = sent.value
    if key not in _ready:
        _ready.clear()
        _ready[key] = Matcher(Index.build(rows))
    return _ready[key]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(id, item, start, end, edits): for each row of ``docs``, every occurrence of a benchmark item, as a stretch in code points.

    Both sides are compared in lower case with white space squeezed. An item is found where one of its pieces
    aligns with the text within the edit budget, so also by any EXCERPT bytes of it; a stretch reaches from the first such piece of an occurrence to its
    last, and ``edits`` is the most that one of them needs. Repeated rows give repeated results; null, empty and short
    items and texts give none. The documents are read once for each block of the benchmark, without a shuffle; a block
    of ``pass_bytes`` is sent at a time, and taken back before the next.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {given.schema['id'].dataType.simpleString()}, item {kind}, start long, end long, edits long"
    out, part, sent = None, given.sparkSession.createDataFrame([], schema), None
    for rows in benchmark_blocks(benchmark, item_col, item_text_col, pass_bytes):
        if sent is not None:
            part = settle(part, "leaks")
            sent.destroy()
            out = part if out is None else out.union(part)
        sent = given.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent)
            for batch in slices(batches, "text", 1 << 22):
                raw = [t.as_py() or b"" for t in batch.column("text")]
                found = matcher.search([squeezed(t) for t in raw])
                spans = [original_span(raw[k], b, e) for k, _, b, e, _ in found]
                take = pa.array([k for k, *_ in found], pa.int64())
                columns = [batch.column("id").take(take), [f[1] for f in found], [s for s, _ in spans], [e for _, e in spans], [f[4] for f in found]]
                yield pa.RecordBatch.from_arrays([columns[0], pa.array(columns[1], pa.int64() if kind == "bigint" else None), *[pa.array(c, pa.int64()) for c in columns[2:]]], ["id", "item", "start", "end", "edits"])

        part = given.mapInArrow(run, schema)
    return part if out is None else out.union(part)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark item in the sense of ``leaks``.

    Rows with a null or empty text stay. What one block of the benchmark leaves is written before the next block is sent.
    """
    sent = None
    for rows in benchmark_blocks(benchmark, item_col, item_text_col, pass_bytes):
        if sent is not None:
            docs = settle(docs, "clean")
            sent.destroy()
        sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent)
            for batch in slices(batches, text_col, 1 << 22):
                texts = [squeezed(t.as_py().encode() if t.is_valid else b"") for t in batch.column(text_col)]
                clean = np.ones(len(texts), bool)
                clean[[k for k, *_ in matcher.search(texts)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


@query()
def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits")
