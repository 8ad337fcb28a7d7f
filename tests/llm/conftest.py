import duckdb
import pytest

from tests_llm_paths import SF
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties and columns with clashing names."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(60_000))
    near = " ".join(f"tok{i}" for i in range(120))
    rows = [
        (1, "the cat sat on the mat and then it ran far away home", "en", "a", 10), (2, None, "en", None, None), (3, "", None, "a", 0), (None, "a b c", "en", "b", 5),
        (4, " \t\n\x0b\f\r ", "en", "a", 7), (5, long, "en", "a", len(long)), (1, "the cat sat on the mat and then it ran far away home", "en", "a", 10),
        (6, "THE CAT sat on the mat and then it ran far away home", "en", "c", 10), (7, near, "fr", "b", 1), (8, near + " end", "fr", "b", 1), (9, "é ü 漢字 " * 30, None, "c", 1),
        (10, "one\ntwo\none\nthree four five six seven eight nine ten eleven", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'x' AS id", "'y' AS node", "1 AS fp", "2 AS line", "3 AS key", "'z' AS size", "'k' AS shard", "4 AS slot", "5 AS k1", "6 AS h")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
