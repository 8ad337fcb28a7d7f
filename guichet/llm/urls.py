"""URL filters: listed rules, and gradient-boosted trees on lexical features for what no rule covers."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle
from .common import ascii_lower
from .registry import query, table

# The rules, each a verdict and a host with a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Labelled URLs that the trees are fitted on, those with the smallest hashes; suffix statistics use all of them.
SAMPLE = 50_000
#: Bits of a URL's hash by which the sample is cut before it is sorted.
KEY_BITS = 16
#: Labelled URLs that a suffix's block rate counts besides its own, at the rate of all.
PRIOR = 5.0
TREES, DEPTH = 20, 4
SUFFIXES = ("host", "domain", "top")
LEXICAL = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "host_digits", "hyphens", "entropy", "host_entropy", "parameters", "fragment", "secure", "extension", "first_length")
FEATURES = [*LEXICAL, *[f"{s}_{k}" for s in SUFFIXES for k in ("rate", "seen")]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case and the path; empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as its text, and its verdict; null for none.

    A rule fits its host and the hosts below, where the path begins with the rule's. ``rules`` is a short list in the code.
    """
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character, from how often each distinct character occurs."""
    signs = F.split(text, "")
    n = F.length(text)
    term = lambda c: (lambda p: -p * F.log2(p))((n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(F.transform(F.filter(F.array_distinct(signs), lambda c: c != ""), term), F.lit(0.0), lambda s, x: s + x)).otherwise(0.0)


def lexical(df: DataFrame) -> DataFrame:
    """``df`` (url, host, path) with the LEXICAL features and the suffixes of the host."""
    url = F.coalesce("url", F.lit(""))
    digits = _count(url, "[0-9]")
    labels = F.split("host", r"\.")
    values = {
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/[^/]"), "labels": F.size(labels).cast("double"), "digits": digits,
        "digit_ratio": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0), "host_digits": _count(F.col("host"), "[0-9]"), "hyphens": _count(url, "[-_]"),
        "entropy": entropy(url), "host_entropy": entropy(F.col("host")), "parameters": _count(url, r"[?&][^?&#=]+="), "fragment": url.contains("#").cast("double"),
        "secure": url.startswith("https://").cast("double"), "extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "first_length": F.length(F.regexp_extract("path", "^/([^/]*)", 1)).cast("double"),
    }
    return df.select("*", *[v.alias(k) for k, v in values.items()], F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("top"))


def suffix_counts(labelled: DataFrame) -> dict[str, DataFrame]:
    """For each kind of suffix: (suffix, n, blocked) over all labelled URLs."""
    return {s: labelled.groupBy(F.col(s).alias(f"_{s}")).agg(F.count("*").alias(f"_{s}_n"), F.sum("label").alias(f"_{s}_b")) for s in SUFFIXES}


def with_suffixes(df: DataFrame, counts: dict[str, DataFrame], prior: float, own: bool) -> DataFrame:
    """The block rate and the logarithm of the count of each suffix, without the row's own label if it is one of them."""
    for s in SUFFIXES:
        df = df.join(counts[s], F.col(s) == F.col(f"_{s}"), "left")
        n, b = F.coalesce(f"_{s}_n", F.lit(0)), F.coalesce(f"_{s}_b", F.lit(0.0))
        if own:
            n, b = n - 1, b - F.col("label")
        df = df.withColumn(f"{s}_rate", (b + PRIOR * prior) / (n + PRIOR)).withColumn(f"{s}_seen", F.log2(n + 1.0)).drop(f"_{s}", f"_{s}_n", f"_{s}_b")
    return df


def url_sample(labelled: DataFrame, urls: int) -> DataFrame:
    """At most ``urls`` URLs of ``labelled``, those with the least hashes ``key``: one row each, with n, how often it occurs.

    A histogram of the first KEY_BITS bits of the distinct hashes gives the prefix where ``urls`` are reached, and only the hashes
    of that prefix are sorted. Copies of a URL are combined before the shuffle, however many there are.
    """
    prefix = F.shiftright("key", 64 - KEY_BITS)
    keys = settle(labelled.select("key").distinct(), "url-keys")
    upto = F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))  # 2 ** KEY_BITS rows at most
    past = keys.groupBy(prefix.alias("at")).agg(F.count("*").alias("n")).withColumn("upto", upto).filter(F.col("upto") > urls).orderBy("at").first()
    chosen = labelled
    if past:
        left = urls - (past.upto - past.n)
        edge = keys.filter(prefix == past.at).orderBy("key").offset(left).first().key
        chosen = labelled.filter(F.col("key") < edge)
    others = [c for c in labelled.columns if c != "key"]
    return chosen.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(*others)).alias("_one")).select("key", "n", "_one.*")


def train(labelled: DataFrame, sample: int = SAMPLE) -> tuple[GBTClassificationModel | None, dict[str, DataFrame], float]:
    """Trees on ``labelled`` (LEXICAL, SUFFIXES, key long, label 1.0 for block), the suffix counts and the block rate.

    The trees are fitted on at most ``sample`` distinct URLs, each weighing as often as it occurs; without both labels there are none.
    """
    counts = {s: settle(c, f"suffix-{s}") for s, c in suffix_counts(labelled).items()}
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = blocked / n if n else 0.0
    if not 0 < blocked < n:
        return None, counts, prior
    chosen = settle(with_suffixes(url_sample(labelled, sample), counts, prior, own=True), "sample")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen).select("features", "label", F.col("n").cast("double").alias("weight"))
    return GBTClassifier(weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=5, cacheNodeIds=False).fit(rows), counts, prior


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """(id, url, host, path, rule, verdict, blocked) for every row.

    URLs that a rule covers are the labelled ones: they get its verdict and train the trees, which judge all others;
    ``blocked`` is the trees' prediction for a URL without a rule. Where the rules label nothing, or all alike, others
    get the commoner verdict, allow without any. Null and malformed URLs have an empty host and path and are judged
    by the trees like others; each row is judged by itself, whatever repeats.
    """
    host, path = host_and_path(F.col(url_col))
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = settle(lexical(given.withColumn("rule", rule).withColumn("by_rule", verdict)).withColumn("key", F.xxhash64(F.lit(31), "url")), "urls")
    model, counts, prior = train(ruled.filter("rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("double")), sample)
    if model is None:
        judged = ruled.withColumn("prediction", F.lit(1.0 if prior > 0.5 else 0.0))
    else:
        judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_suffixes(ruled, counts, prior, own=False)))
    by_trees = F.when(F.col("prediction") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("id", "url", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"), F.when(F.col("rule").isNull(), F.col("prediction") > 0.5).alias("blocked"))


@query()
def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the verdict on its URL."""
    return judge(table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")
