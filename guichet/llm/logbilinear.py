"""A log-bilinear language model: counts by Spark, parameters by noise-contrastive estimation inside the tasks, scores for whole texts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import slices, text_key
from .registry import query, table

END = 0
#: Words with a class of their own, and classes that share the remaining words by their last two bytes.
SINGLE, SHARED = 1791, 256
CLASSES = 1 + SINGLE + SHARED
DIM = 32
#: Words whose counts every task holds: so many at most, of so many bytes at most. Other words meet their counts in a join.
LISTED, LISTED_BYTES = 1 << 17, 64
#: Training passes; each takes its own share of the training texts, and all texts are taken once.
ROUNDS = 2
BATCH, NOISE, RATE = 8_192, 64, 0.1


@dataclass
class Vocabulary:
    """Counts of training tokens: totals, listed words by falling count, and what each shared class holds."""

    tokens: int
    types: int
    ends: int
    words: list[bytes]
    counts: np.ndarray
    shared_tokens: np.ndarray
    shared_types: np.ndarray

    def classes(self) -> np.ndarray:
        """Class of each listed word."""
        own = np.arange(1, len(self.words) + 1)
        for k in range(SINGLE, len(self.words)):
            own[k] = shared_class(self.words[k])
        return own.astype(np.int16)

    def class_tokens(self) -> np.ndarray:
        out = np.zeros(CLASSES)
        out[END] = self.ends
        single = self.counts[:SINGLE]
        out[1:1 + len(single)] = single
        out[1 + SINGLE:] = self.shared_tokens
        return out


def shared_class(word: bytes) -> int:
    return 1 + SINGLE + zlib.crc32(word[-2:]) % SHARED


@dataclass
class Parameters:
    """q(h) = c1 * context[w1] + c2 * context[w2]; score(w | h) = q(h) . target[w] + bias[w]."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    c1: np.ndarray
    c2: np.ndarray

    @staticmethod
    def fresh(noise: np.ndarray, seed: int = 11) -> Parameters:
        """Starts as the class frequencies, whatever the context."""
        r = np.random.default_rng(seed)
        return Parameters(r.normal(0, 0.3, (CLASSES, DIM)).astype(np.float32), np.zeros((CLASSES, DIM), np.float32), np.log(noise).astype(np.float32),
                          np.ones(DIM, np.float32), np.full(DIM, 0.5, np.float32))

    def rows(self) -> np.ndarray:
        body = np.hstack([self.context, self.target, self.bias[:, None]])
        return np.vstack([body, np.r_[self.c1, self.c2, 0.0]]).astype(np.float64)

    @staticmethod
    def of(rows: np.ndarray) -> Parameters:
        body, last = rows[:-1].astype(np.float32), rows[-1].astype(np.float32)
        return Parameters(body[:, :DIM].copy(), body[:, DIM:2 * DIM].copy(), body[:, 2 * DIM].copy(), last[:DIM].copy(), last[DIM:2 * DIM].copy())

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (w1, w), scores with bias by (w2, w), and the log of the sum over all w by (w1, w2).

        The sum over the vocabulary of exp(a[w1, w]) * exp(b[w2, w]) is one matrix product for all contexts.
        """
        a = (self.context * self.c1) @ self.target.T
        b = (self.context * self.c2) @ self.target.T + self.bias
        ma, mb = a.max(1, keepdims=True), b.max(1, keepdims=True)
        right = np.exp(b - mb).T
        log_z = np.empty_like(a)
        for at in range(0, CLASSES, 256):
            part = slice(at, at + 256)
            log_z[part] = np.log(np.exp(a[part] - ma[part]) @ right) + ma[part] + mb.T
        return a, b, log_z


def noise_of(vocabulary: Vocabulary) -> np.ndarray:
    """Class frequencies, no class without mass."""
    c = vocabulary.class_tokens() + 0.5
    return c / c.sum()


class Trainer:
    """Adagrad on the noise-contrastive loss; the noise words of a batch are shared by its tokens, so all scores are matrix products."""

    def __init__(self, p: Parameters, noise: np.ndarray, seed: int):
        self.p, self.r = p, np.random.default_rng(seed)
        self.cumulative, self.log_kn = np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
        self.sums = {n: np.full_like(getattr(p, n), 1e-3) for n in ("context", "target", "bias", "c1", "c2")}
        self.tokens = 0

    @staticmethod
    def _gather(rows: np.ndarray, values: np.ndarray, into: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        sorted_rows = rows[order]
        starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
        into[sorted_rows[starts]] += np.add.reduceat(values[order], starts, axis=0)

    def step(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> None:
        p, n = self.p, len(w)
        self.tokens += n
        drawn = np.minimum(np.searchsorted(self.cumulative, self.r.random(NOISE)), CLASSES - 1)
        x1, x2, t = p.context[w1], p.context[w2], p.target[w]
        q = x1 * p.c1 + x2 * p.c2
        good = 1 / (1 + np.exp(np.clip((q * t).sum(1) + p.bias[w] - self.log_kn[w], -30, 30)))  # 1 - sigmoid
        tn = p.target[drawn]
        bad = -1 / (1 + np.exp(-np.clip(q @ tn.T + (p.bias[drawn] - self.log_kn[drawn]), -30, 30)))
        dq = good[:, None] * t + bad @ tn
        grads = {k: np.zeros_like(getattr(p, k)) for k in self.sums}
        self._gather(w, good[:, None] * q, grads["target"])
        np.add.at(grads["target"], drawn, bad.T @ q)
        grads["bias"] += np.bincount(w, good, CLASSES).astype(np.float32)
        np.add.at(grads["bias"], drawn, bad.sum(0))
        self._gather(w1, dq * p.c1, grads["context"])
        self._gather(w2, dq * p.c2, grads["context"])
        grads["c1"], grads["c2"] = (dq * x1).sum(0), (dq * x2).sum(0)
        for k, g in grads.items():
            self.sums[k] += g * g
            getattr(p, k)[...] += RATE * g / np.sqrt(self.sums[k])


class Reader:
    """Texts to token classes; made once in each Python worker."""

    _last: tuple[object, Reader] | None = None

    def __init__(self, v: Vocabulary):
        self.v = v
        self.index = {w: k for k, w in enumerate(v.words)}
        self.own = v.classes()
        self.log_count = np.log10(v.counts + 0.5)
        self.log_shared = np.log10(v.shared_tokens + 0.5 * (v.shared_types + 1))

    @classmethod
    def get(cls, shared) -> Reader:
        if cls._last is None or cls._last[0] != shared.id_key:
            cls._last = (shared.id_key, cls(shared.value))
        return cls._last[1]

    def read(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Place in the list (-1: none) and class of each word, and the words that aren't listed."""
        words = text.lower().split() if text else []
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        missing = np.flatnonzero(at < 0)
        rare = [words[k] for k in missing.tolist()]
        own = self.own[at] if len(self.own) else np.zeros(len(at), np.int16)
        own[missing] = [shared_class(w) for w in rare]
        return at, own, rare


class Shared:
    """A broadcast that names what it holds, so that a worker prepares it once."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(value)
        self.id_key = (spark.sparkContext.applicationId, self.sent._jbroadcast.id())

    def __getstate__(self):
        return {"sent": self.sent, "id_key": self.id_key}

    @property
    def value(self):
        return self.sent.value


def _stream(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts end to end, the two classes before each, and where each text begins. A text starts after two ends."""
    sizes = np.fromiter((len(c) + 1 for c in classes), np.int64, len(classes))
    starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
    end = np.zeros(1, np.int16)
    w = np.concatenate([x for c in classes for x in (c, end)])
    w1, w2 = np.r_[end, w[:-1]], np.r_[end, end, w[:-2]][:len(w)]
    w1[starts] = END
    w2[starts] = END
    after = starts + 1
    w2[after[after < len(w)]] = END
    return w, w1, w2, starts


def with_split(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, text as bytes, held): held out are the ids whose text form has crc32 mod 5 = 1; a null id counts as an empty one."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    k1, k2 = text_key(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).cast("binary").alias("text"), (crc % 5 == 1).alias("held"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all given texts, combined in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                if value := text.as_py():
                    found.update(value.lower().split())
                if len(found) > 300_000:
                    yield out()
                    found.clear()
        yield out()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_vocabulary(split: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of the texts that are not held out, and the counts (word, n) of the words that it doesn't list.

    Listed are the most frequent words down to a count at which they are at most LISTED; a histogram of the counts
    finds it. Only those, and one row for each shared class, come to the driver.
    """
    training = split.filter(~F.col("held"))
    counts = settle(word_counts(training), "counts")
    level = F.floor(F.log2("n") * 16)
    levels = sorted((r for r in counts.filter(F.length("word") <= LISTED_BYTES).groupBy(level.alias("level")).agg(F.count("*").alias("c"), F.min("n").alias("n")).collect()), reverse=True)
    least, total = 1 << 62, 0
    for r in levels:
        total += r.c
        if total > LISTED:
            break
        least = r.n
    is_listed = (F.col("n") >= least) & (F.length("word") <= LISTED_BYTES)
    listed = sorted(((r.n, bytes(r.word)) for r in counts.filter(is_listed).toLocalIterator()), key=lambda r: (-r[0], r[1]))
    shared = F.pmod(F.crc32(F.expr("substring(word, -2)")), F.lit(SHARED)).alias("k")
    rare = counts.filter(~is_listed)
    sums = {r.k: (r.n, r.c) for r in rare.groupBy(shared).agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect()}
    tokens, types = np.zeros(SHARED), np.zeros(SHARED)
    for k, (n, c) in sums.items():
        tokens[k], types[k] = n, c
    for n, w in listed[SINGLE:]:
        k = shared_class(w) - 1 - SINGLE
        tokens[k] += n
        types[k] += 1
    ends = training.count()
    own = np.array([n for n, _ in listed[:SINGLE]])
    n_types = int(types.sum()) + len(own) + (ends > 0)
    return Vocabulary(int(tokens.sum() + own.sum()) + ends, n_types, ends, [w for _, w in listed], np.array([n for n, _ in listed], float), tokens, types), rare


def train(split: DataFrame, vocabulary: Vocabulary, shared: Shared) -> Parameters:
    """Iterative parameter mixing: in each round every task runs the trainer over its share of the texts from the
    last parameters, and the tasks' parameters are averaged, weighed by their tokens. All training texts are read once."""
    spark, noise = split.sparkSession, noise_of(vocabulary)
    p = Parameters.fresh(noise)
    names = [f"v{k}" for k in range(2 * DIM + 1)]
    for turn in range(ROUNDS):
        sent = Shared(spark, (p.rows(), noise))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            rows, noise = sent.value
            reader, trainer, waiting, size = Reader.get(shared), Trainer(Parameters.of(rows), noise, turn), [], 0

            def learn() -> None:
                w, w1, w2, _ = _stream(waiting)
                for at in range(0, len(w), BATCH):
                    trainer.step(w[at:at + BATCH], w1[at:at + BATCH], w2[at:at + BATCH])

            for batch in batches:
                for text in batch.column("text"):
                    waiting.append(reader.read(text.as_py())[1])
                    size += len(waiting[-1])
                    if size > 40 * BATCH:
                        learn()
                        waiting, size = [], 0
            if waiting:
                learn()
            if trainer.tokens:
                out = trainer.p.rows()
                columns = [pa.array(np.arange(len(out))), pa.array(np.full(len(out), trainer.tokens)), *[pa.array(np.ascontiguousarray(out[:, k])) for k in range(out.shape[1])]]
                yield pa.RecordBatch.from_arrays(columns, ["row", "tokens", *names])

        mine = split.filter(~F.col("held") & (F.pmod(F.xxhash64(F.lit(13), "k1"), F.lit(ROUNDS)) == turn)).select("text")
        found = mine.mapInArrow(run, "row long, tokens long, " + ", ".join(f"{n} double" for n in names))
        mixed = found.groupBy("row").agg(F.sum("tokens").alias("tokens"), *[F.sum(F.col(n) * F.col("tokens")).alias(n) for n in names]).collect()
        if mixed:
            p = Parameters.of(np.array([[r[n] / r.tokens for n in names] for r in sorted(mixed, key=lambda r: r.row)]))
    return p


class Scorer:
    """Parameters turned to tables once in each Python worker."""

    _last: tuple[object, tuple] | None = None

    @classmethod
    def get(cls, shared: Shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if cls._last is None or cls._last[0] != shared.id_key:
            cls._last = (shared.id_key, Parameters.of(shared.value).tables())
        return cls._last[1]


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row's whole text.

    ``score`` is the model's log10 probability of the text: each token's class by the log-bilinear model given the
    two classes before it, normalised over all classes, and a word of a shared class by its smoothed share of that
    class, unseen words together as one more. ``base_score`` is the smoothed frequency of each token. A null text
    is an empty one, which has its end. Rows that repeat an id with the same text get equal results; an empty
    table, or one without training rows, scores by the smoothing alone.
    """
    spark, split = docs.sparkSession, with_split(docs, id_col, text_col)
    vocabulary, rare = count_vocabulary(split)
    shared = Shared(spark, vocabulary)
    model = Shared(spark, train(split, vocabulary, shared).rows())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, (by1, by2, log_z) = Reader.get(shared), Scorer.get(model)
        v = reader.v
        ends, base_all = np.log10(v.ends + 0.5), np.log10(v.tokens + 0.5 * (v.types + 1))
        for batch in slices(batches, "text", 2_000_000):
            read = [reader.read(t.as_py()) for t in batch.column("text")]
            w, w1, w2, starts = _stream([own for _, own, _ in read])
            p = (by1[w1, w] + by2[w2, w] - log_z[w1, w2]) / np.log(10)
            at = np.concatenate([x for a, _, _ in read for x in (a, [-2])]).astype(np.int64)
            known = np.where(at >= 0, reader.log_count[at] if len(reader.log_count) else 0.0, np.where(at == -2, ends, 0.0))
            in_shared = w > SINGLE
            inside = np.where(in_shared, np.where(at >= 0, known, 0.0) - reader.log_shared[np.maximum(w - 1 - SINGLE, 0)], 0.0)
            n = np.diff(np.r_[starts, len(w)])
            ids, k1, k2, held = (batch.column(c) for c in ("id", "k1", "k2", "held"))
            zero = np.zeros(len(n), np.int64)
            heads = [ids, k1, k2, held, pa.array(np.ones(len(n), np.int64)), pa.array(n), pa.array(np.add.reduceat(((at >= 0) | ((at == -2) & (v.ends > 0))).astype(np.int64), starts)),
                     pa.array(np.add.reduceat(known, starts) - n * base_all), pa.array(np.add.reduceat(p.astype(np.float64) + inside, starts)),
                     pa.array([b" %d" % k for k in k1.to_pylist()], pa.binary()), pa.array(zero)]
            names = ["id", "k1", "k2", "held", "copies", "n_tokens", "n_known", "base", "score", "word", "n"]
            yield pa.RecordBatch.from_arrays(heads, names)
            owner, words, times = [], [], []
            for k, (_, _, missing) in enumerate(read):
                found = Counter(missing)
                owner += [k] * len(found)
                words += found
                times += found.values()
            if owner:
                take = pa.array(owner)
                blank, none = pa.array(np.zeros(len(owner), np.int64)), pa.array(np.zeros(len(owner)))
                yield pa.RecordBatch.from_arrays([ids.take(take), k1.take(take), k2.take(take), held.take(take), blank, blank, blank, none, none, pa.array(words, pa.binary()), pa.array(times, pa.int64())], names)

    kind = split.schema["id"].dataType.simpleString()
    parts = split.mapInArrow(run, f"id {kind}, k1 long, k2 long, held boolean, copies long, n_tokens long, n_known long, base double, score double, word binary, n long")
    counts = rare.select(F.col("word").alias("_word"), F.col("n").alias("_n"))
    joined = parts.join(counts, F.col("word") == F.col("_word"), "left")
    seen = F.coalesce("_n", F.lit(0))
    gain = F.col("n") * F.log10(seen + 0.5)
    total = joined.groupBy("id", "k1", "k2", "held").agg(
        F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(seen > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + gain).alias("base"), F.sum(F.col("score") + gain).alias("score"))
    each = total.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    whole = lambda c: (F.col(c) / F.col("copies")).cast("long").alias(c)
    return each.select("id", F.col("held").alias("held_out"), whole("n_tokens"), whole("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
                       (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"))


@query()
def op1_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the model and under token frequencies."""
    return score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
