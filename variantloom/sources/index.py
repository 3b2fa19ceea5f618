"""Stored interval indexes: tracks written once, by chromosome and bin, and joined where they lie."""

from __future__ import annotations

import functools
import operator
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import run_dir

#: With more chromosomes (or contigs) among the SNPs than this, the whole index is read.
MOST_CHROMS = 1_000


class Index(NamedTuple):
    """A stored track: the name of its table, the width of its bins, and whether it holds intervals or places."""

    table: str
    width: int
    kind: str


def _bin(place: str, width: int) -> str:
    return f"cast(floor(({place}) / {width}) as bigint)"


def _written(rows: DataFrame, spark: SparkSession, table: str | None, path: str | None, buckets: int) -> str:
    """Rows (chrom, bin, ..) as a table: a folder for each chromosome, in it a file for each bucket of (chrom, bin), sorted."""
    table = table or f"index_{uuid.uuid4().hex}"
    path = path or f"{run_dir(spark)}/{table}"
    rows = rows.withColumn("part", F.col("chrom")).repartition(buckets, "chrom", "bin")  # the hash of the buckets: a bucket comes from one task
    rows.write.option("path", path).option("compression", "zstd").partitionBy("part").bucketBy(buckets, "chrom", "bin").sortBy("chrom", "bin").mode("overwrite").saveAsTable(table)
    return table


def write_intervals(bed: DataFrame, table: str | None = None, path: str | None = None, width: int = 5_000, buckets: int = 32) -> Index:
    """Store intervals (chrom, bstart, bend, ..), each once for every bin that it meets. Unset, the table is one of this
    application, in its folder below the shared one. Rows without chromosome or of no length are left out."""
    rows = bed.where("chrom is not null and bend > bstart")
    rows = rows.withColumn("bin", F.explode(F.expr(f"sequence({_bin('bstart + 1', width)}, {_bin('bend', width)})")))
    return Index(_written(rows, bed.sparkSession, table, path, buckets), width, "intervals")


def write_places(tss: DataFrame, table: str | None = None, path: str | None = None, width: int = 100_000, buckets: int = 32) -> Index:
    """Store places (chrom, tss, ..) for the search of the nearest at less than `width`: for each bin one sorted list of the
    places in it and in the bins on either side, with their columns."""
    own = F.struct("tss", *[c for c in tss.columns if c not in ("chrom", "tss")])
    rows = tss.where("chrom is not null and tss is not null").select("chrom", own.alias("p"), F.explode(F.expr(f"sequence({_bin('tss', width)} - 1, {_bin('tss', width)} + 1)")).alias("bin"))
    rows = rows.groupBy("chrom", "bin").agg(F.sort_array(F.collect_list("p")).alias("places"))
    return Index(_written(rows, tss.sparkSession, table, path, buckets), width, "places")


def drop_index(spark: SparkSession, index: Index) -> None:
    """Forget the table. Its files go with those of the application; those at a path of one's own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {index.table}")


def met(index: Index, snps: DataFrame) -> DataFrame:
    """The part of an index that SNPs (chrom, pos) can meet: the folders of their chromosomes, and the row groups of the
    bins from their first to their last position there. The driver gets one row per chromosome."""
    rows = snps.sparkSession.table(index.table)
    found = snps.where("chrom is not null and pos is not null").groupBy("chrom").agg(F.min("pos").alias("low"), F.max("pos").alias("high")).limit(MOST_CHROMS + 1).collect()
    if len(found) > MOST_CHROMS:
        return rows
    spans = [(F.col("part") == r.chrom) & F.col("bin").between(r.low // index.width, r.high // index.width) for r in found]
    return rows.where(functools.reduce(operator.or_, spans, F.lit(False)))


def _at_bin(snps: DataFrame, width: int) -> Column:
    return F.expr(_bin("pos", width))


def _joined(snps: DataFrame, index: Index, kind: str) -> DataFrame:
    """SNPs with the index rows of their bin. The SNPs are sent to the buckets of the index (or to all tasks, if few);
    the index itself is not moved."""
    if index.kind != kind:
        raise ValueError(f"an index of {index.kind}, not of {kind}")
    held = {c.lower() for c in snps.columns}
    clash = [c for c in snps.sparkSession.table(index.table).columns if c.lower() in held and c != "chrom"]
    if clash:
        raise ValueError(f"columns {clash} are in both tables")
    return snps.withColumn("bin", _at_bin(snps, index.width)).join(met(index, snps).drop("part"), ["chrom", "bin"]).drop("bin")


def overlap(snps: DataFrame, index: Index) -> DataFrame:
    """As intervals.overlap: SNPs (chrom, pos 1-based) with the columns of each stored interval that covers them."""
    return _joined(snps, index, "intervals").where("bstart < pos and pos <= bend")


def nearest(snps: DataFrame, index: Index) -> DataFrame:
    """As intervals.nearest: each SNP with its closest stored place (all on ties) at less than the index's width, and the
    distance. One join: the places of a bin come with their columns."""
    near = _joined(snps, index, "places").withColumn("distance", F.expr("array_min(transform(places, p -> abs(p.tss - pos)))")).where(F.col("distance") < index.width)
    return near.withColumn("p", F.explode(F.expr("filter(places, p -> abs(p.tss - pos) = distance)"))).select(*snps.columns, "distance", "p.*")


def mean_signal(snps: DataFrame, index: Index) -> DataFrame:
    """As intervals.mean_signal, over a stored track (with a column value): NaN is left out."""
    spots = snps.select("rsid", "chrom", F.explode(F.expr("array(pos, pos + 1)")).alias("pos"))
    return overlap(spots, index).where("not isnan(value)").groupBy("rsid").agg(F.avg("value").alias("score"))
