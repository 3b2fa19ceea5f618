"""Exact duplicates by a stream with keyed state on disk, and a check of the full bytes of all hits."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import run_dir
from .shared import stored

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EXACT_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)"""


def normalised(text: str = "text") -> Column:
    """The text with A-Z in lower case, other letters as they are; null is the empty text."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def located(rows: DataFrame) -> DataFrame:
    """Rows of Parquet files, read as a table or a stream -> doc_id, text, and where the text is: file and row number."""
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _drained(query) -> None:
    query.trigger(availableNow=True).start().awaitTermination()


def fingerprint_stream(spark: SparkSession, path: str, folder: str, bytes_per_batch: int, digest) -> DataFrame:
    """Takes the files of `path` that are new since the last call: doc_id, file, row, the digest of the normalised text and
    a hash of the text as it is, appended to the table that is returned. `path` may be one file."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    glob = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"  # a stream reads one file by a pattern only
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(glob)
    rows = located(source).select("doc_id", "file", "row", digest(normalised()).alias("digest"), F.xxhash64("text").alias("raw"))
    _drained(rows.writeStream.format("parquet").option("compression", "zstd").option("path", f"{folder}/prints").option("checkpointLocation", f"{folder}/prints-log"))
    return spark.read.schema(rows.schema).parquet(f"{folder}/prints")


def state_stream(prints: DataFrame, folder: str, bytes_per_batch: int) -> DataFrame:
    """Feeds the fingerprints that are new since the last call to the state, which no watermark empties: for each digest
    the largest doc_id with file and row of its text, and the number of rows. Tasks combine their rows of a digest before
    they send them, so a digest of many rows costs one a task. State is kept by RocksDB and backed up in `folder`. RocksDB
    would reserve 4 MB of disk for the log of each partition's store, however small; the session is told not to, and the
    setting stays, as the state is read later."""
    spark = prints.sparkSession
    source = spark.readStream.schema(prints.schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(f"{folder}/prints")
    held = source.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    spark.conf.set(name, ROCKS)
    try:
        _drained(held.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{folder}/state"))
        state = spark.read.format("statestore").load(f"{folder}/state").select("key.digest", "value.max.*", F.col("value.count").alias("n"))
    finally:
        spark.conf.set(name, before)
    return state


def _small(df: DataFrame, most: int) -> DataFrame:
    """df, to be sent to all tasks if it has at most `most` rows."""
    return F.broadcast(df) if df.count() <= most else df


def deduplicate(spark: SparkSession, path: str, folder: str | None = None, bytes_per_batch: int | None = None, digest=sha256, max_broadcast: int = 1_000_000) -> DataFrame:
    """Parquet files with doc_id and text -> one row per row: doc_id, keep_id (doc_id of the row that stays of its group of
    equal texts), group_size, kept, text_sha256 (the digest of the normalised text). With a `folder` of the shared file
    system a later call takes in only files that are new since, and returns the whole again; without one the stream
    starts anew. A batch takes `bytes_per_batch` of files: unset, 64 MB for each core.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. The row with the largest doc_id stays,
    rows without doc_id last; of rows equal in both that of the last file and row number, so exactly one row of a group
    is kept. keep_id is null if no row of the group has a doc_id. Other columns are ignored; an empty table gives no rows.

    The state of the stream names the groups by digest; that is checked on every row whose digest came twice: their
    texts are read again and compared in full. Rows of a digest with unlike texts are grouped by the texts instead.
    """
    folder = folder or f"{run_dir(spark)}/exact-{uuid.uuid4().hex}"
    size = bytes_per_batch or spark.sparkContext.defaultParallelism * (64 << 20)
    prints = fingerprint_stream(spark, path, folder, size, digest)
    if prints.limit(1).count() == 0:
        state = spark.createDataFrame([], "digest binary, doc_id long, file string, row long, n long")
    else:
        state = state_stream(prints, folder, size)
    twice = stored(state.where("n > 1").withColumnsRenamed({"doc_id": "keep_id", "file": "keep_file", "row": "keep_row"}), "twice")
    grouped = prints.join(_small(twice, max_broadcast), "digest", "left")
    raw = stored(grouped.where("n is not null").select("raw").distinct(), "raw")
    texts = located(spark.read.parquet(path)).withColumn("raw", F.xxhash64("text")).join(_small(raw, max_broadcast), "raw", "left_semi")
    texts = texts.withColumn("norm", normalised()).withColumn("digest", digest(F.col("norm")))
    variants = texts.groupBy("digest", "norm").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    clash = stored(variants.groupBy("digest").count().where("count > 1").select("digest"), "clash")
    columns = ["doc_id", F.expr("if(n is null, doc_id, keep_id)").alias("keep_id"), F.expr("coalesce(n, 1L)").alias("group_size"),
               F.expr("n is null or (file = keep_file and row = keep_row)").alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    if clash.limit(1).count() == 0:
        return grouped.select(columns)
    own = variants.join(clash, "digest", "left_semi").select("digest", "norm", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.file").alias("keep_file"), F.col("keep.row").alias("keep_row"))
    apart = texts.join(clash, "digest", "left_semi").select("doc_id", "file", "row", "digest", "norm").join(own, ["digest", "norm"])
    return grouped.join(clash, "digest", "left_anti").select(columns).unionByName(apart.select(columns))
