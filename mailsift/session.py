"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "mailsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    AQE (partition coalescing, skew-join splitting), checkpoints removed with the DataFrames that
    read them, and UTC. Anything in ``conf`` is added on top, with ``__`` standing for a dot.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``. Where that is unset, the warehouse in local
    mode, and an error on a cluster, whose machines may not share it."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named or spark.conf.get("spark.sql.warehouse.dir")


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. What is there is removed when the program ends."""
    path = f"{shared_root(spark).rstrip('/')}/mailsift/{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        with contextlib.suppress(Exception):  # the gateway may have ended before
            _remove(spark, path)

    atexit.register(remove)
    return path


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_SHUFFLES_REMOVED)
    spark.conf.set(_SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_REMOVED, before)


def stored(df: DataFrame, name: str = "table", by: str | None = None, **options: str | int) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back, in one folder for each value of ``by``. Its lineage is cut,
    so nothing is computed again after an executor is lost, and each later pass reads the columns it needs."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.options(compression="zstd", **options)
    with shuffles_removed(spark):
        (writer.partitionBy(by) if by else writer).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._kept_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Removes what ``stored`` wrote for these tables, before the program ends. Nothing may read them any more."""
    for table in tables:
        _remove(table.sparkSession, table._kept_at)
