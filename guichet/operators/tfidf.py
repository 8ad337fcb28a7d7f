"""TF-IDF: vocabulary statistics by aggregation, weights inside each row.

Fitting is one shuffle of per-term partial counts. Transforming shuffles nothing:
a document is one row and the vocabulary, bounded by ``max_features``, is part of
the fitted model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSlicer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T
from ..session import fresh_path, passing, settle
from .features import SublinearCounts, TicketTerms


@dataclass(frozen=True)
class TfidfConfig:
    low: int = 1
    high: int = 2
    min_df: int = 1
    max_features: int = 50_000
    sublinear: bool = False
    fold_accents: bool = False


# The settings of the classifiers and of the search index.
MODEL_TFIDF = TfidfConfig(min_df=2, max_features=50_000, sublinear=True, fold_accents=True)
INDEX_TFIDF = TfidfConfig(min_df=1, max_features=1_000)

#: Terms of a pool for each term of a vocabulary, and terms of a pool at most unless the vocabulary itself has more.
POOL, MOST_POOLED = 8, 200_000

#: Words that travel to the tasks at most, where pairs of them are counted by number.
MOST_ENDS = 1_000_000


@dataclass
class TfidfModel:
    """``stages`` turn a text column into an L2-normed vector; ``vocab`` is (term, df, cf, idf, index)."""

    config: TfidfConfig
    stages: list
    vocab: DataFrame
    size: int
    output: str

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.stages).transform(df)


def terms_stage(config: TfidfConfig, text: str = "text_full", out: str = "terms") -> TicketTerms:
    return TicketTerms(inputCol=text, outputCol=out, low=config.low, high=config.high, foldAccents=config.fold_accents)


def term_statistics(df: DataFrame, terms: str = "terms", fold: str | None = None, k: int = 0) -> DataFrame:
    """Documents (``df``) and occurrences (``cf``) per term.

    Each document gives its distinct terms and all its terms, told apart by ``__all``, in one pass over its n-grams;
    no function runs per term but the aggregation, which combines before its one shuffle. With ``fold`` the counts
    inside every fold come out of the same pass, as ``df_i`` and ``cf_i``.
    """
    aggs = _counts()
    for i in range(k):
        here = F.col(fold) == i
        aggs += [F.count_if(F.col("first") & here).alias(f"df_{i}"), F.count_if(~F.col("first") & here).alias(f"cf_{i}")]
    return _occurrences(df, terms, [fold] if fold else []).groupBy("term").agg(*aggs)


def _occurrences(df: DataFrame, terms: str, keep: Sequence[str] = ()) -> DataFrame:
    """(first, term): a row for each distinct term of a document, ``first``, and a row for each of all its terms."""
    both = df.select(*keep, F.posexplode(F.array(F.array_distinct(terms), F.col(terms))).alias("__all", "__terms"))
    return both.select(*keep, (F.col("__all") == 0).alias("first"), F.explode("__terms").alias("term"))


def _counts() -> list[Column]:
    return [F.count_if("first").alias("df"), F.count_if(~F.col("first")).alias("cf")]


def _octave(c: Column) -> Column:
    """A coarse logarithmic scale with under 1,100 steps up to the largest long."""
    return F.floor(F.log2(c) * 16)


def _qualified(stats: DataFrame, config: TfidfConfig, size: int, df: Column | None = None, cf: Column | None = None) -> tuple[DataFrame, Column]:
    """The terms in ``min_df`` documents, and the condition on ``cf`` that any of the ``size`` most frequent of them meets.

    A histogram of counts finds the step of a coarse scale that holds the last of them.
    """
    kept = stats.select(
        "term", (F.col("df") if df is None else df).alias("df"), (F.col("cf") if cf is None else cf).alias("cf")
    ).filter(F.col("df") >= config.min_df)
    hist = kept.groupBy(_octave(F.col("cf")).alias("b")).agg(F.count("*").alias("m"))
    above = F.sum("m").over(Window.orderBy(F.desc("b")))
    cutoff = hist.select("b", (above - F.col("m")).alias("above")).filter(F.col("above") < size).agg(F.min("b")).scalar()
    return kept, _octave(F.col("cf")) >= cutoff


def vocabulary(stats: DataFrame, n_docs: int, config: TfidfConfig, df: Column | None = None, cf: Column | None = None) -> DataFrame:
    """The ``max_features`` most frequent terms among those in ``min_df`` documents, ties by term, with idf.

    A histogram of counts first finds the frequency below which no term can qualify, so the
    final sort sees little more than ``max_features`` rows instead of every term of the corpus.
    """
    kept, frequent = _qualified(stats, config, config.max_features, df, cf)
    top = kept.filter(frequent).orderBy(F.desc("cf"), "term").limit(config.max_features)
    return top.withColumn("idf", F.log(F.lit(1.0 + n_docs) / (F.col("df") + 1)) + 1)


def _documents(lists: pa.Array) -> np.ndarray:
    """The number of the document that each word of a batch belongs to."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())


def _words_counted(words: DataFrame) -> DataFrame:
    """What :func:`term_statistics` counts, for the words in ``words``: a batch is counted by word numbers, so only its distinct words are rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column(0).flatten().dictionary_encode()
            size, code = len(each.dictionary), each.indices.to_numpy().astype(np.int64)
            once = np.unique(_documents(batch.column(0)) * size + code) % max(size, 1)
            yield pa.RecordBatch.from_arrays([each.dictionary.cast(pa.string()), pa.array(np.bincount(once, minlength=size)), pa.array(np.bincount(code, minlength=size))], ["term", "df", "cf"])

    return words.select("words").mapInArrow(run, "term string, df long, cf long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _pairs_counted(words: DataFrame, ends: list[str], least: int) -> DataFrame:
    """What :func:`term_statistics` counts, for the pairs of neighbouring words that are both among ``ends`` and occur ``least`` times.

    A pair is a number made of those of its words; only pairs frequent enough get their names back.
    """
    names, n = pa.array(ends, pa.string()), len(ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            document = _documents(batch.column(0))
            code = pc.fill_null(pc.index_in(batch.column(0).flatten().cast(pa.string()), value_set=names), -1).to_numpy().astype(np.int64)
            at = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0) & (document[:-1] == document[1:]))
            key, place, cf = np.unique(code[at] * n + code[at + 1], return_inverse=True, return_counts=True)
            once = np.unique(document[at] * max(len(key), 1) + place) % max(len(key), 1)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(once, minlength=len(key))), pa.array(cf)], ["pair", "df", "cf"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            term = pc.binary_join_element_wise(names.take(pa.array(pair // n)), names.take(pa.array(pair % n)), " ")
            yield pa.RecordBatch.from_arrays([term, batch.column("df"), batch.column("cf")], ["term", "df", "cf"])

    counted = words.select("words").mapInArrow(run, "pair long, df long, cf long").groupBy("pair").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return counted.filter(F.col("cf") >= least).mapInArrow(named, "term string, df long, cf long")


def candidate_statistics(df: DataFrame, config: TfidfConfig, text: str = "text_full", terms: str | None = None, words: str | None = None) -> DataFrame:
    """What :func:`term_statistics` counts, for the terms that a vocabulary of ``config`` may take; ``terms`` reuses an existing n-gram column, ``words`` one of words.

    An n-gram is no more frequent, and in no more documents, than the shorter ones it begins and ends with. So the shortest
    are counted first, and a longer one only where both its ends may qualify by themselves. Words and pairs of words are counted
    by number inside the batches. Of other n-grams, occurrences are counted by hash, and terms only where their hash is frequent
    enough; a hash is no rarer than its terms, so none is missed and the counts are exact.
    """
    spark, size = df.sparkSession, config.max_features
    out = fresh_path(spark, "candidates")
    with passing(spark):
        if terms is None:
            words = df.select(F.col(words).alias("words")) if words else settle(terms_stage(replace(config, low=1, high=1), text, "words").transform(df.select(text)).select("words"), "words")
            grams = lambda low, high: words.select(T.ngrams("words", low, high).alias("terms"))
        else:
            length = lambda t: F.length(t) - F.length(F.replace(t, F.lit(" "))) + 1
            grams = lambda low, high: df.select(F.filter(terms, lambda t: length(t).between(low, high)).alias("terms"))
        by_number = terms is None and config.low == 1
        first = settle(_words_counted(words), "counted") if by_number else term_statistics(grams(config.low, config.low))
        short, frequent = _qualified(first, config, size)
        ends = settle(short.filter(frequent), "ends")  # little more than ``size`` rows, but for ties
        if config.high == config.low:
            return settle(ends, path=out)
        last = ends.orderBy(F.desc("cf")).limit(size).agg(F.count("*").alias("n"), F.min("cf").alias("cf")).first()
        least = max(config.min_df, last.cf if last.n == size else 1)
        if by_number and config.high == 2 and (names := ends.select("term").limit(MOST_ENDS + 1).collect()) and len(names) <= MOST_ENDS:
            return settle(ends.unionByName(_pairs_counted(words, [r.term for r in names], least)), path=out)
        longer = grams(config.low + 1, config.high)
        each = longer.select(F.explode("terms").alias("term"))
        for sign in (1, -1):
            end = ends.select(F.col("term").alias("__end"))
            each = each.withColumn("__end", F.substring_index("term", " ", sign * config.low)).join(end, "__end", "left_semi").drop("__end")
        hashes = settle(each.groupBy(F.xxhash64("term").alias("__hash")).agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("__hash"), "hashes")
        held = _occurrences(longer, "terms").withColumn("__hash", F.xxhash64("term")).join(hashes, "__hash", "left_semi")
        return settle(ends.unionByName(held.groupBy("term").agg(*_counts())), path=out)


def model_from_vocabulary(vocab: DataFrame, config: TfidfConfig, text: str = "text_full", prefix: str = "", terms: str | None = None) -> TfidfModel:
    """Fitted stages for a vocabulary table, indexed by falling frequency; ``terms`` reuses an existing n-gram column."""
    rows = sorted(vocab.select("term", "df", "cf", "idf").collect(), key=lambda r: (-r.cf, r.term))  # at most max_features rows
    size = len(rows)
    if size == 0:
        raise ValueError("empty vocabulary: no term reaches min_df")
    term_col = terms or f"{prefix}terms"
    counts, logs, weighted, out = (f"{prefix}{s}" for s in ("counts", "log_counts", "weighted", "text_vec"))
    counter = CountVectorizerModel.from_vocabulary([r.term for r in rows], inputCol=term_col, outputCol=counts)
    indexed = vocab.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rows)], "term string, df long, cf long, idf double, index int")
    idf = np.array([r.idf for r in rows])
    stages = [] if terms else [terms_stage(config, text, term_col)]
    stages.append(counter)
    if config.sublinear:
        stages.append(SublinearCounts(inputCol=counts, outputCol=logs))
    stages += [
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=logs if config.sublinear else counts, outputCol=weighted),
        Normalizer(p=2.0, inputCol=weighted, outputCol=out),
    ]
    return TfidfModel(config, stages, indexed, size, out)


def fit_tfidf(df: DataFrame, config: TfidfConfig, text: str = "text_full", prefix: str = "", terms: str | None = None) -> TfidfModel:
    stats = candidate_statistics(df, config, text, terms)
    return model_from_vocabulary(vocabulary(stats, df.count(), config), config, text, prefix, terms)


def fit_fold_vocabularies(df: DataFrame, config: TfidfConfig, fold: str, k: int, text: str = "text_full", terms: str | None = None) -> list[DataFrame]:
    """Vocabulary of "all but fold i" for every i, from one pass over the text, or over its n-grams in ``terms``."""
    ready = df.select(F.col(terms).alias("terms"), fold) if terms else terms_stage(config, text).transform(df.select(text, fold))
    return _fold_vocabularies(term_statistics(ready, fold=fold, k=k), df, config, fold, k)


def _fold_vocabularies(stats: DataFrame, df: DataFrame, config: TfidfConfig, fold: str, k: int) -> list[DataFrame]:
    stats = settle(stats)
    sizes = {r[fold]: r["n"] for r in df.groupBy(fold).agg(F.count("*").alias("n")).collect()}  # k rows
    n = sum(sizes.values())
    return [
        vocabulary(stats, n - sizes.get(i, 0), config, df=F.col("df") - F.col(f"df_{i}"), cf=F.col("cf") - F.col(f"cf_{i}"))
        for i in range(k)
    ]


@dataclass
class TermPool:
    """The most frequent terms of some rows, several times a vocabulary, whose counts stand in a vector beside each row.

    Vocabularies and vectors of parts of these rows come out of the counts, the n-grams are not looked at again. A term
    outside occurs at most ``bound`` times, so a full vocabulary whose every term occurs more often has missed none.
    """

    config: TfidfConfig
    terms: list[str]
    bound: int
    counts: str
    logs: str

    def count(self, df: DataFrame, terms: str | None = None, words: str | None = None) -> DataFrame:
        """``df`` with the counts of its n-grams, given as such or by their ``words``, and what the weights are made of."""
        if words:
            counted = df.withColumn(self.counts, _pool_counter(self.terms)(words))
        else:
            counted = CountVectorizerModel.from_vocabulary(self.terms, inputCol=terms, outputCol=self.counts).transform(df)
        counted = counted.withMetadata(self.counts, {})  # no attribute for every term
        return SublinearCounts(inputCol=self.counts, outputCol=self.logs).transform(counted) if self.config.sublinear else counted

    def stages(self, model: TfidfModel) -> list:
        """Stages that make the same vector as ``model``, whose terms are terms of the pool, from the counts."""
        counter = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
        weigh, norm = model.stages[-2:]
        at = {t: i for i, t in enumerate(self.terms)}
        return [VectorSlicer(inputCol=self.logs, outputCol=weigh.getInputCol(), indices=[at[t] for t in counter.vocabulary]), weigh, norm]

    def fold_vocabularies(self, df: DataFrame, fold: str, k: int) -> list[DataFrame] | None:
        """Vocabulary of "all but fold i" for every i; None if a term outside the pool might belong to one."""
        found = self.fold_terms(df, fold, k)
        if found is None:
            return None
        rows = [[(self.terms[j], int(d), int(c), float(x)) for j, d, c, x in zip(*f, strict=True)] for f in found]
        return [df.sparkSession.createDataFrame(r, "term string, df long, cf long, idf double") for r in rows]

    def fold_terms(self, df: DataFrame, fold: str, k: int) -> list[tuple[np.ndarray, ...]] | None:
        """The vocabularies of :meth:`fold_vocabularies` as (places in the pool, df, cf, idf)."""
        size = len(self.terms)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("indices")
                key = pc.fill_null(batch.column(fold), -1).to_numpy().astype(np.int64)[_documents(lists)] * size + lists.flatten().to_numpy()
                pair, place, d = np.unique(key, return_inverse=True, return_counts=True)
                c = np.bincount(place, batch.column("values").flatten().to_numpy(), len(pair)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((pair // max(size, 1)).astype(np.int32)), pa.array((pair % max(size, 1)).astype(np.int32)), pa.array(d), pa.array(c)], ["fold", "index", "d", "c"])

        v = F.unwrap_udt(self.counts)
        given = df.select(F.col(fold).cast("int").alias(fold), v["indices"].alias("indices"), v["values"].alias("values"))
        part = given.mapInArrow(run, "fold int, index int, d long, c long").groupBy("fold", "index").agg(F.sum("d").alias("d"), F.sum("c").alias("c"))
        df_, cf_ = np.zeros((k + 1, size), np.int64), np.zeros((k + 1, size), np.int64)  # the last row for rows of no fold
        for r in part.collect():  # a row for each term of the pool and fold at most
            df_[r.fold, r["index"]], cf_[r.fold, r["index"]] = r.d, r.c
        sizes = {r[fold]: r["n"] for r in df.groupBy(fold).agg(F.count("*").alias("n")).collect()}  # k rows
        out = []
        for i in range(k):
            d, c, n = df_.sum(0) - df_[i], cf_.sum(0) - cf_[i], sum(sizes.values()) - sizes.get(i, 0)
            kept = sorted((j for j in np.flatnonzero(d >= max(self.config.min_df, 1)).tolist()), key=lambda j: (-c[j], self.terms[j]))[:self.config.max_features]
            if self.bound and (len(kept) < self.config.max_features or c[kept[-1]] <= self.bound):
                return None
            if not kept:
                raise ValueError("empty vocabulary: no term reaches min_df")
            out.append((np.array(kept), d[kept], c[kept], np.log((1.0 + n) / (d[kept] + 1)) + 1))
        return out


def _pool_counter(terms: list[str]):
    """A function from lists of words to sparse vectors of how often each of ``terms``, words and pairs of words, occurs."""
    split = [t.split(" ") for t in terms]
    names = pa.array(sorted({w for t in split for w in t}), pa.string())
    number = {w: i for i, w in enumerate(names.to_pylist())}
    n, single = len(names), np.full(len(names) + 1, -1, np.int64)  # the last one stands for all other words
    for i, t in enumerate(split):
        if len(t) == 1:
            single[number[t[0]]] = i
    pairs = sorted((number[t[0]] * n + number[t[1]], i) for i, t in enumerate(split) if len(t) == 2)
    key, place = np.array([p for p, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64)

    @F.arrow_udf(VectorUDT())
    def counts(words: pa.Array) -> pa.Array:
        document = _documents(words)
        code = pc.fill_null(pc.index_in(words.flatten().cast(pa.string()), value_set=names), n).to_numpy().astype(np.int64)
        found, row = [single[code]], [document]
        if len(key):
            at = np.flatnonzero((code[:-1] < n) & (code[1:] < n) & (document[:-1] == document[1:]))
            pair = code[at] * n + code[at + 1]
            spot = np.minimum(np.searchsorted(key, pair), len(key) - 1)
            found.append(np.where(key[spot] == pair, place[spot], -1))
            row.append(document[at])
        found, row = np.concatenate(found), np.concatenate(row)
        each, c = np.unique((row * len(terms) + found)[found >= 0], return_counts=True)
        offsets = pa.array(np.searchsorted(each, np.arange(len(words) + 1) * len(terms)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((each % max(len(terms), 1)).astype(np.int32), c.astype(np.float64))]
        kind = pa.array(np.zeros(len(words), np.int8))
        return pa.StructArray.from_arrays([kind, pa.array(np.full(len(words), len(terms), np.int32)), *lists], ["type", "size", "indices", "values"])

    return counts


def fit_pooled(df: DataFrame, config: TfidfConfig, terms: str | None = None, prefix: str = "", words: str | None = None) -> tuple[TfidfModel, TermPool]:
    """The model of :func:`fit_tfidf` and a pool of the terms that any large part of the rows may need, from the same counts of n-grams, given as such or by their ``words``."""
    size = max(config.max_features, min(POOL * config.max_features, MOST_POOLED))
    stats, n = candidate_statistics(df, replace(config, max_features=size), terms=None if words else terms, words=words), df.count()
    wide = vocabulary(stats, n, replace(config, max_features=size)).select("term", "cf").collect()  # size rows at most
    least = min((r.cf for r in wide), default=0)
    model = model_from_vocabulary(vocabulary(stats, n, config), config, prefix=prefix, terms=terms)
    return model, TermPool(config, [r.term for r in wide], least if len(wide) == size else 0, f"{prefix}pool_counts", f"{prefix}pool_logs" if config.sublinear else f"{prefix}pool_counts")


def vector_entries(df: DataFrame, ids: Sequence[str], vector: str) -> DataFrame:
    """(ids..., index, weight) of the non-zero entries of a sparse vector column."""
    v = F.unwrap_udt(vector)
    entries = F.explode(F.arrays_zip(v["indices"].alias("index"), v["values"].alias("weight"))).alias("e")
    return df.select(*ids, entries).select(*ids, F.col("e.index").alias("index"), F.col("e.weight").alias("weight"))


def tfidf_weights(model: TfidfModel, df: DataFrame, id_col: str = "ID") -> DataFrame:
    """(id, term, weight), for reading and checking; unknown terms are absent."""
    entries = vector_entries(model.transform(df), [id_col], model.output)
    return entries.join(F.broadcast(model.vocab.select("index", "term")), "index").select(id_col, "term", "weight")  # max_features rows
