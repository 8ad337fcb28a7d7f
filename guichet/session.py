"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("guichet")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` names it. Only a local master may go without: there
    the driver's temporary folder is the executors' folder too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="guichet-"))
    return spark.sparkContext.getCheckpointDir()


_written: dict[str, set[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def written(spark: SparkSession) -> set[str]:
    """The paths this application was given so far and has not deleted."""
    return set(_written.get(spark.sparkContext.applicationId, ()))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def forget(spark: SparkSession, paths: set[str] | None = None) -> None:
    """Delete tables made on the way, by default all: for when the results that read them are stored or no longer needed."""
    gone = written(spark) if paths is None else paths
    for path in gone:
        delete_path(spark, path)
    _written.get(spark.sparkContext.applicationId, set()).difference_update(gone)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are deleted at the end, also on failure. Results go to paths asked for before."""
    before = written(spark)
    try:
        yield
    finally:
        forget(spark, written(spark) - before)


def settle(df: DataFrame, name: str = "settled", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files.

    A Parquet table rather than a row checkpoint, because most later steps read two or
    three of its columns. Lost executors cost nothing that came before.
    """
    path = path or fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="guichet-code-"), "guichet.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
