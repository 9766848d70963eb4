"""Written layers between long pipelines.

Each layer (Silver, imputed Silver, Gold panel) is written once as Parquet and read back, which
cuts the plan, keeps column pruning, and survives the loss of an executor. The folder is the
one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_KNOWN: dict[tuple[str, str], str] = {}
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SENT = "spark.sql.execution.arrow.maxRecordsPerBatch"

ROWS_SENT = 512


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a local session without one gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="paypanel-")
    spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def exchanges_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Within, executors delete the exchanged files of a query as soon as it has ended, not when the driver collects garbage.

    A written layer is read from its files, so nothing asks for its exchanges again; while the query runs they
    are kept for retries as ever.
    """
    return _setting(spark, _FREES, "true")


def few_rows_sent(spark: SparkSession) -> AbstractContextManager[None]:
    """Within, tasks send ``ROWS_SENT`` rows at a time to Python; at 10 000, whole splits of texts lie in both processes.

    Holds for queries that run within, not for frames that are only built there.
    """
    return _setting(spark, _SENT, str(ROWS_SENT))


def written(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write the frame under a fresh path of the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with exchanges_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def written_in_buckets(df: DataFrame, by: str, name: str) -> DataFrame:
    """``written`` in as many buckets of ``by`` as there are shuffle partitions, so that grouping by it moves no row again.

    A bucketed layer is read through a table; it leaves the catalog at once, its files stay as those of any layer.
    """
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with exchanges_freed(spark):
        df.write.bucketBy(buckets, by).option("path", f"{shared_dir(spark)}/{own}").saveAsTable(f"`{own}`", format="parquet")
    out = spark.table(f"`{own}`")
    spark.sql(f"DROP TABLE `{own}`")
    return out


def discard(cut: DataFrame) -> None:
    """Delete the files of a frame that ``written`` returned; only when all that reads them has itself been written."""
    spark = cut.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(cut))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def layer(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The named layer, built and written on first use in this application."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _KNOWN:
        path = f"{shared_dir(spark)}/layer-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _KNOWN[key] = path
    return spark.read.parquet(_KNOWN[key])
