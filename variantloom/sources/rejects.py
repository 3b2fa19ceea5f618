"""Lines that a reader takes and lines that it leaves out, with the reason, from one pass over the source."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.tables import run_dir
from . import readers

def _missing(i: int, kind: str = "double") -> str:
    return f"try_cast(get(f, {i}) AS {kind}) IS NULL"


#: For each format its parser and, in order, what makes it leave a line out: (reason, condition on value and its fields f).
FORMATS = {
    "grasp": (readers.parse_grasp, [("fields", f"size(f) < 71"), ("p value", _missing(10)), ("sample size", _missing(24, "bigint"))]),
    "phewas": (readers.parse_phewas, [("fields", f"size(f) < 10"), ("p value", _missing(4)), ("sample size", _missing(3, "bigint")), ("odds ratio", _missing(5))]),
    "gwas_db": (readers.parse_gwas_db, [("fields", f"size(f) < 7"), ("p value", _missing(3))]),
    "neale_ukb": (readers.parse_neale_ukb, [("fields", f"size(f) <> 10"), ("p value", _missing(3))]),
    "gwas_catalog": (readers.flatten_gwas_catalog, [("JSON", f"try_parse_json(value) IS NULL OR from_json(value, '{readers.CATALOG}', map('mode', 'PERMISSIVE')) IS NULL"),
                                                    ("SNP", f"NOT coalesce(exists(from_json(value, '{readers.CATALOG}').snps, x -> contains(x.rsId, 'rs')), false)")]),
    **{f"bed_{layout}": (lambda lines, layout=layout: readers.parse_bed(lines, layout), [("fields", "size(split(value, '\t')) < 3"), ("start", "try_cast(get(split(value, '\t'), 1) AS bigint) IS NULL"),
                                                                                           ("end", "try_cast(get(split(value, '\t'), 2) AS bigint) IS NULL")]) for layout in readers.LAYOUTS},
}


class Outcome(NamedTuple):
    """accepted: the parser's rows; rejected: source, line, reason; counts: lines read, accepted and rejected."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def reason(kind: str) -> Column:
    """Why a line (`value`, with its fields f) of this format is left out: the first of its reasons, null if it is taken."""
    found = F.when(F.col("value").isNull(), F.lit("no line"))
    for name, test in FORMATS[kind][1]:
        found = found.when(F.expr(test), F.lit(name))
    return found


def split_lines(lines: DataFrame, kind: str, source: str | None = None) -> Outcome:
    """Lines (value, more columns) of a format -> what its parser makes of the lines it takes, the lines it leaves out, and
    the counts of both.

    The source is read once: lines are written to the shared folder under either outcome, and counted on the way. A line
    is accepted as a whole: an accepted document may hold several rows. Lines left out on purpose (other traits) are no
    rejects. Null lines have the reason `no line`. source is the format's name by default.
    """
    spark, seen = lines.sparkSession, Observation()
    judged = readers.fields(lines, "value").select("value", F.explode(F.array(reason(kind))).alias("reason")).withColumn("taken", F.col("reason").isNull())
    path = f"{run_dir(spark)}/lines-{uuid.uuid4().hex}"
    counted = judged.observe(seen, F.count("*").alias("read"), F.count_if("taken").alias("accepted"), F.count_if(~F.col("taken")).alias("rejected"))
    counted.write.option("compression", "zstd").partitionBy("taken").parquet(path)
    table = spark.read.schema("value string, reason string, taken boolean").parquet(path)
    accepted = FORMATS[kind][0](table.where("taken").select("value"))
    rejected = table.where("not taken").select(F.lit(source or kind).alias("source"), F.col("value").alias("line"), "reason")
    return Outcome(accepted, rejected, dict(seen.get))
