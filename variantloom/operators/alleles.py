"""Orientation of risk alleles against the reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_risk_allele(alleles: DataFrame) -> DataFrame:
    """association_id, risk_allele ("rsID-base") -> adds rsid, base, status: base_missing without a dash, integrity if an
    association names several rsIDs, else ok."""
    parts = F.split("risk_allele", "-", 2)
    a = alleles.withColumns({"rsid": F.trim(parts[0]), "base": F.get(parts, F.lit(1))})
    n = a.groupBy("association_id").agg(F.countDistinct("rsid").alias("_n"))
    return a.join(n, "association_id").withColumn("status", F.when(F.col("base").isNull(), "base_missing").when(F.col("_n") > 1, "integrity").otherwise("ok")).drop("_n")


def reference_base(mappings: DataFrame) -> DataFrame:
    """rsid, allele_string (A/B, one row a mapping) -> rsid, base, status: the one first allele, "-" left out; null with
    status ambiguous if there are several, null with status none if there is none."""
    first = F.split("allele_string", "/")[0]
    sets = mappings.groupBy("rsid").agg(F.array_sort(F.collect_set(F.when(first != "-", first))).alias("_s"))
    n = F.size("_s")
    return sets.select("rsid", F.when(n == 1, F.col("_s")[0]).alias("base"), F.when(n == 1, "ok").when(n > 1, "ambiguous").otherwise("none").alias("status"))


def orientation_consensus(split: DataFrame, reference: DataFrame) -> DataFrame:
    """Split alleles and reference bases -> association_id, present (all: true, none: false), status: ok, mixed, or
    not_substitution if no allele has a base ("?"). Alleles whose status is not ok, here or in the reference, are left out."""
    ref = reference.where("status = 'ok'").select("rsid", F.col("base").alias("ref"))
    a = split.where("status = 'ok'").join(ref, "rsid")
    hit = F.when(F.col("base") != "?", F.col("base") == F.col("ref"))
    g = a.groupBy("association_id").agg(F.bool_and(hit).alias("_all"), F.bool_or(hit).alias("_any"))
    return g.select("association_id", F.when(F.col("_all") == F.col("_any"), F.col("_all")).alias("present"),
                    F.when(F.col("_any").isNull(), "not_substitution").when(F.col("_all") != F.col("_any"), "mixed").otherwise("ok").alias("status"))
