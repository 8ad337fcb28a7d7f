"""Periodic runs of words by a dictionary of basic factors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, words_of
from .registry import query, table

#: A run has this many words and this many repetitions of its period at least.
LEAST, TIMES = 6, 4
#: Bytes of text whose words are named together in a task; a longer text comes alone.
BATCH_BYTES = 8_000_000


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) rows of all runs, by start and period, in a sequence of non-negative word numbers.

    ``times`` is 4 or more. A negative number ends a text: no run crosses it.

    Level k names the factors of L = 2^k words; equal names are equal factors, and only repeated ones are named
    further. Occurrences of a factor within 2L words form an arithmetic progression. Let u be a run's first q words,
    q its smallest period and L / 2 < q <= L. A factor of L words in the run occurs again q words on, and not
    earlier, else u would be a power. So every start i of the run with i + 2q + L inside it sees two successors at
    the distance q, and the run's proposals are all its starts up to that one: neighbouring proposals of one
    distance are extended to each other, the run begins with the first and ends 2q + L words after the last.
    Three such occurrences cover a stretch of period q, so no proposal is false, and each run is proposed at the one
    level of its period: as L < 2q, 4q words always hold a proposal; fewer repetitions may not.
    """
    if times < 4:
        raise ValueError("a run must hold four repetitions at least")
    n = len(words)
    names = np.asarray(words, np.int64)
    at = np.flatnonzero(names >= 0)
    found, size = [], 1
    while len(at):
        order = at[np.argsort(names[at], kind="stable")]  # equal factors side by side, in the order of the text
        same = names[order[1:]] == names[order[:-1]]
        after = np.full(n, 0, np.int64)
        after[order[:-1][same]] = order[1:][same] - order[:-1][same]
        near = at[(after[at] <= size) & (after[at] > size // 2)]
        near = near[after[near + after[near]] == after[near]]
        if len(near):
            step = after[near]
            head = np.flatnonzero(np.r_[True, (near[1:] != near[:-1] + 1) | (step[1:] != step[:-1])])
            last = np.r_[head[1:], len(near)] - 1
            period = step[head]
            length = near[last] + 2 * period + size - near[head]
            ok = length >= np.maximum(least, times * period)
            found.append(np.stack([near[head], length, period], 1)[ok])
        again = np.zeros(n, bool)
        again[order[:-1][same]] = True
        again[order[1:][same]] = True
        at = np.flatnonzero(again[:max(n - size, 0)] & again[size:])
        _, named = np.unique(names[at] * (int(names.max()) + 1) + names[at + size], return_inverse=True)
        names = np.full(n, -1, np.int64)
        names[at] = named
        size *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def numbered(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts one after another, -1 after each, and where each text begins. Different texts share no number."""
    numbers: list[int] = []
    starts, first = [0], 0
    for words in texts:
        known: dict[str, int] = {}
        numbers += [known.setdefault(w, first + len(known)) for w in words]
        numbers.append(-1)
        first += len(known)
        starts.append(len(numbers))
    return np.array(numbers, np.int64), np.array(starts, np.int64)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(id, runs, collapsed) for every row: its runs as an array of (start, length, period), and its text without repetitions.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q, ``least``
    words and ``times`` q words at least, that no neighbouring word extends. ``collapsed`` are the words, joined by
    one space, that no run contains after its first period. Null and empty texts have no runs and collapse to the
    empty string; each row is judged by itself, whatever repeats, whole and alone in its task, so nothing is shuffled.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [_split(t) for t in batch.column("text").to_pylist()]
            words, starts = numbered(texts)
            runs = runs_of(words, least, times)
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(gone)[:-1] == 0
            owner = np.searchsorted(starts, runs[:, 0], "right") - 1
            collapsed = []
            for k, text in enumerate(texts):
                stay = kept[starts[k]:starts[k] + len(text)]
                collapsed.append(" ".join(text if stay.all() else [w for w, s in zip(text, stay.tolist(), strict=True) if s]))
            ends = np.searchsorted(owner, np.arange(len(texts) + 1))
            fields = [pa.array(c) for c in (runs[:, 0] - starts[owner], runs[:, 1], runs[:, 2])]
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), found, pa.array(collapsed, pa.string())], ["id", "runs", "collapsed"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _split(text: str | None) -> list[str]:
    """Words as ``byte_words`` splits them: ``str.split`` would also split at other white space."""
    return [w.decode() for w in text.encode().split()] if text else []


def longest(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null without runs."""
    first = lambda a, b: F.when(a["length"] != b["length"], b["length"] - a["length"]).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
    return F.get(F.array_sort(runs, lambda a, b: F.signum(first(a, b)).cast("int")), F.lit(0))


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): one document in ten, by the crc32 of its id, ends in a loop of its own words.

    With h = crc32(id) and g = h // 10, where h ends in 0 the words from place a = g % n on repeat the p words
    there, p = 1 + (n - a) // (3 + g % 8). Other texts, and those without id, are left as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (h % 10 == 0).alias("hit"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("hit"), words_of(F.col("text")))
    given = given.select("id", "text", "g", F.inline(F.array(F.struct(words.alias("w")))))
    n = F.size("w")
    given = given.select("id", "text", "w", "g", n.alias("n"), F.when(n > 0, F.col("g") % n).alias("a"))
    given = given.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    word = lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
    loop = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return given.select("id", F.when(F.col("n") > 0, loop).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its loop included: how many runs, the longest, and digests of all of them and of the collapsed words."""
    found = periodic_runs(looped(table(spark, sf_dir, "documents")), "id")
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    top = longest(F.col("runs"))
    rows = found.select("id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.floor(F.lit(1_000) * F.col("top.length") / F.col("top.period"))
    return rows.select(F.col("id").alias("doc_id"), "n_runs", "top.start", "top.length", "top.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
