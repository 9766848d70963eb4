"""Exact deduplication by a stateful stream.

The documents' digests are read as a stream. Keyed state on disk (RocksDB, checkpointed in the shared
folder, no watermark and so no expiry) keeps one entry per digest: the stable identifier and the content
locator of the row that stays, and the number of rows seen. Digests seen more than once are hits; their
rows' full bytes are compared before any row is called a copy, and digests whose texts differ are
classed by the texts themselves. Rows that arrive later only touch the state of their own digests.

Skew: equal digests are folded into one partial state per task before the shuffle, the state has one
entry per distinct text, and the join back to the rows is an equi-join whose other side is unique, which
adaptive execution may split.

Defined results: a null text counts as empty. Of equal texts the row with the largest id stays; a null id
is smaller than every other, and of rows with the same id and text the one with the largest locator
stays, so exactly one row of a class is kept. An empty table gives an empty result. Other columns of the
input are never read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paypanel.llm.tables import hinted
from paypanel.plans.stages import shared_dir, written

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def file_locator() -> Column:
    """Where a row's content lies: file and position. Any frame read from Parquet files has it."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def digest_state(
    spark: SparkSession, stream_path: str, schema: T.StructType, checkpoint: str, files_per_trigger: int = 4096
) -> DataFrame:
    """Feed every file under ``stream_path`` not seen before into the state at ``checkpoint``; return the state.

    Calling it again with the same checkpoint after more files have landed continues from the kept state.
    """
    session = spark.newSession()  # the settings below stay out of the caller's session
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    # many small stores: no file space reserved in advance
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    seen = (
        session.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(stream_path)
        .groupBy("digest")
        .agg(
            F.max(F.struct("id", "locator")).alias("winner"),
            F.count(F.lit(1)).alias("group_size"),
        )
    )
    query = (
        seen.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    kept, count = state.schema["value"].dataType.names[:2]
    return state.select(
        F.col("key.digest").alias("digest"), F.col(f"value.{kept}").alias("winner"), F.col(f"value.{count}").alias("group_size")
    )


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    locator: Column | None = None,
    files_per_trigger: int = 4096,
) -> DataFrame:
    """One row per input row: id, locator, digest, winner (struct of id and locator), group_size.

    ``docs`` is read from files, or ``locator`` names a stable unique value per row.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    where = file_locator() if locator is None else locator
    rows = written(docs.select(F.col(id_col).alias("id"), where.alias("locator"), digest(text).alias("digest")), "digests")
    base = f"{shared_dir(spark)}/dedup-{uuid.uuid4().hex}"
    path = rows.inputFiles()[0].rsplit("/", 1)[0]
    state = written(digest_state(spark, path, rows.schema, base, files_per_trigger), "digest-state")

    hits = hinted(state.where(F.col("group_size") > 1).select("digest"), 40)
    texts = docs.select(digest(text).alias("digest"), text.alias("content"))
    differing = written(
        texts.join(hits, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("content").alias("low"), F.max("content").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("digest"),
        "digest-clashes",
    )
    if differing.isEmpty():
        return rows.join(state, "digest")

    clashes = hinted(differing, 40)
    clashing = docs.select(
        F.col(id_col).alias("id"), where.alias("locator"), digest(text).alias("digest"), text.alias("content")
    ).join(clashes, "digest", "left_semi")
    classes = clashing.groupBy("digest", "content").agg(
        F.max(F.struct("id", "locator")).alias("winner"), F.count(F.lit(1)).alias("group_size")
    )
    exact = clashing.join(classes, ["digest", "content"]).drop("content")
    return rows.join(clashes, "digest", "left_anti").join(state, "digest").unionByName(exact)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that stay; ``docs`` is read from files."""
    found = dedup(docs, id_col, text_col)
    losers = hinted(
        written(found.where(F.col("locator") != F.col("winner.locator")).select(F.col("locator").alias("_at")), "copies"), 200
    )
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), file_locator().alias("_at"))
    return packed.join(losers, "_at", "left_anti").select("_row.*")


def report(docs: DataFrame) -> DataFrame:
    """The digest columns of every document: which row of its class stays."""
    found = dedup(docs)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("winner.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("locator") == F.col("winner.locator")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
