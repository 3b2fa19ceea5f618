"""Summary tables of results."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import first_per_group
from .output import WideTable


def _stack(rows: list[tuple]) -> str:
    return f"stack({len(rows)}, {', '.join(str(x) for r in rows for x in r)})"


def id_counts(df: DataFrame | WideTable, fields: list[str]) -> DataFrame:
    if isinstance(df, WideTable):
        return reduce(DataFrame.unionByName, [df.distinct(c).agg(F.count(c).alias("unique_values")).select(F.lit(c).alias("field"), "unique_values") for c in fields])
    one = df.agg(*[F.countDistinct(c).alias(f"_{i}") for i, c in enumerate(fields)])
    return one.select(F.expr(_stack([(f"'{c}'", f"_{i}") for i, c in enumerate(fields)]) + " as (field, unique_values)"))


def top_values(df: DataFrame | WideTable, col: str, n: int = 3) -> DataFrame:
    """The n most frequent values (ties by value): value, row_occurrences."""
    rows, count = (df.counted(col), F.sum("n")) if isinstance(df, WideTable) else (df, F.count("*"))
    return rows.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(count.alias("row_occurrences")).orderBy(F.desc("row_occurrences"), "value").limit(n)


def pair_counts(df: DataFrame | WideTable, pairs: list[tuple[str, str]]) -> DataFrame:
    if isinstance(df, WideTable):
        known = lambda a, b: df.distinct(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
        return reduce(DataFrame.unionByName, [known(a, b).agg(F.count("*").alias("unique_associations")).select(F.lit(f"{a},{b}").alias("field_pair"), "unique_associations") for a, b in pairs])
    one = df.agg(*[F.countDistinct(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.expr(_stack([(f"'{a},{b}'", f"_{i}") for i, (a, b) in enumerate(pairs)]) + " as (field_pair, unique_associations)"))


def degree_distribution(df: DataFrame, a: str, b: str) -> DataFrame:
    """side, degree, n: how many values of a have `degree` distinct values of b, and the other way round."""
    def one(x: str, y: str, side: str) -> DataFrame:
        deg = df.groupBy(x).agg(F.countDistinct(y).alias("degree"))
        return deg.groupBy("degree").agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "degree", "n")

    return one(a, b, "a").unionByName(one(b, a, "b"))


def _bin(col: str, lo, hi, bins: int):
    """Number of the equal-width bin from lo to hi, the last one closed."""
    at = F.floor((F.col(col) - lo) * bins / (hi - lo)).cast("int")
    return F.when(hi > lo, F.least(F.lit(bins - 1), at)).otherwise(F.lit(bins // 2))


def field_histogram(df: DataFrame, col: str, keys: list[str] | None = None, order: list | None = None, bins: int = 100) -> DataFrame:
    """bin, n over the first row of each key (by order), nulls left out; empty bins have no row."""
    one = (first_per_group(df, keys, order or keys) if keys else df).where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    ends = one.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return one.crossJoin(F.broadcast(ends)).groupBy(_bin("x", F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("n"))


def field_histogram_2d(df: DataFrame, fields: list[str], bins: int = 20) -> DataFrame:
    """field_x, field_y, bin_x, bin_y, n for every pair of fields, in one pass over the rows."""
    ends = df.agg(*[f(F.col(c).cast("double")).alias(f"_{k}_{i}") for i, c in enumerate(fields) for k, f in (("lo", F.min), ("hi", F.max))])
    x = df.crossJoin(F.broadcast(ends)).select(*[_bin(c, F.col(f"_lo_{i}"), F.col(f"_hi_{i}"), bins).alias(f"_b{i}") for i, c in enumerate(fields)])
    pairs = [(f"'{fields[i]}'", f"'{fields[j]}'", f"_b{i}", f"_b{j}") for i, j in combinations(range(len(fields)), 2)]
    return x.select(F.expr(_stack(pairs) + " as (field_x, field_y, bin_x, bin_y)")).where("bin_x is not null and bin_y is not null").groupBy("field_x", "field_y", "bin_x", "bin_y").agg(F.count("*").alias("n"))


def evidence_overlap(df: DataFrame, fields: list[str]) -> DataFrame:
    """subset (fields above 0, joined by comma), n."""
    held = F.array_join(F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in fields])), ",")
    return df.groupBy(held.alias("subset")).agg(F.count("*").alias("n"))


def cluster_size_vs_clpp(posterior: DataFrame) -> DataFrame:
    return posterior.groupBy("cluster").agg(F.countDistinct("rsid").alias("n_snps"), F.max("clpp_cluster").alias("max_clpp"))


def fit_inverse_curve(df: DataFrame, x: str, y: str) -> DataFrame:
    """The least-squares a of y = a / x."""
    return df.agg((F.sum(F.col(y) / F.col(x)) / F.sum(1 / (F.col(x) * F.col(x)))).alias("a"))


def gene_posterior(rows: DataFrame, tissues: list[str]) -> DataFrame:
    """gene_id, posterior: the sum over rows of all tissue columns."""
    return rows.groupBy("gene_id").agg(F.sum(reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{t}`"), F.lit(0.0)) for t in tissues])).alias("posterior"))


def heatmap_table(posterior: DataFrame, tissues: list[str]) -> DataFrame:
    """cluster, gene_id and a column per tissue with the cluster's CLPP."""
    return posterior.select("cluster", "gene_id", "tissue", "clpp_cluster").distinct().groupBy("cluster", "gene_id").pivot("tissue", tissues).agg(F.max("clpp_cluster"))


def job_histogram(log: DataFrame, col: str, divisor: float, bins: int = 10) -> DataFrame:
    return field_histogram(log.select((F.col(col) / divisor).alias(col)), col, bins=bins)


def table_shape(df: DataFrame | WideTable) -> DataFrame:
    one = df.counted().agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows")) if isinstance(df, WideTable) else df.agg(F.count("*").alias("n_rows"))
    return one.withColumn("n_columns", F.lit(len(df.columns)))


def top10_genes(posterior: DataFrame, n: int = 10) -> DataFrame:
    """The n largest (gene_id, cluster, tissue) by cluster CLPP; ties by the keys."""
    best = posterior.groupBy("gene_id", "cluster", "tissue").agg(F.max("clpp_cluster").alias("clpp_cluster"))
    return best.orderBy(F.desc("clpp_cluster"), "gene_id", "cluster", "tissue").limit(n)


def top10_snps(posterior: DataFrame, n: int = 10) -> DataFrame:
    return posterior.orderBy(F.desc("clpp_snp"), "rsid", "gene_id", "cluster", "tissue").limit(n)


def best_tissue(posterior: DataFrame) -> DataFrame:
    """The tissue with the largest cluster CLPP of each gene and cluster; ties to the last by name.

    The rows of a cluster, gene and tissue are made one before the largest is sought, which sorts what it is given."""
    one = posterior.groupBy("gene_id", "cluster", "tissue").agg(F.max("clpp_cluster").alias("clpp_cluster"))
    return one.groupBy("gene_id", "cluster").agg(F.max(F.struct("clpp_cluster", "tissue")).alias("x")).select("gene_id", "cluster", "x.tissue", "x.clpp_cluster")


def results_semi_join(posterior: DataFrame, results: DataFrame) -> DataFrame:
    pairs = results.select(F.col("ld_snp_rsID").alias("rsid"), "gene_id")
    return posterior.join(pairs, ["rsid", "gene_id"], "left_semi").select(posterior.columns)


def snp_places(snps: DataFrame, results: DataFrame, stats: DataFrame) -> DataFrame:
    """rsid, pos, gwas_pvalue: the least p value of results (ld_snp_rsID, gwas_pvalue), else of stats (rsid, pvalue)."""
    r = results.groupBy(F.col("ld_snp_rsID").alias("rsid")).agg(F.min("gwas_pvalue").alias("_p1"))
    s = stats.groupBy("rsid").agg(F.min("pvalue").alias("_p2"))
    return snps.select("rsid", "pos").join(r, "rsid", "left").join(s, "rsid", "left").select("rsid", "pos", F.coalesce("_p1", "_p2").alias("gwas_pvalue"))


def with_logs(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"gwas_log": -F.log10("gwas_pvalue"), "eqtl_log": -F.log10("eqtl_pvalue")})


def manhattan_table(posterior: DataFrame, snps: DataFrame, results: DataFrame, stats: DataFrame, eqtl: DataFrame) -> DataFrame:
    """Posterior rows with place, GWAS p (of the results, else of stats), eQTL p, and -log10 of both and of the CLPP."""
    r = results.groupBy(F.col("ld_snp_rsID").alias("rsid")).agg(F.min("gwas_pvalue").alias("_p1"))
    s = stats.groupBy("rsid").agg(F.min("pvalue").alias("_p2"))
    e = eqtl.groupBy("gene_id", "tissue", "rsid").agg(F.min("pvalue").alias("eqtl_pvalue"))
    out = posterior.join(snps.select("rsid", "chrom", "pos"), "rsid", "left").join(r, "rsid", "left").join(s, "rsid", "left").join(e, ["gene_id", "tissue", "rsid"], "left")
    out = out.withColumn("gwas_pvalue", F.coalesce("_p1", "_p2")).drop("_p1", "_p2")
    return with_logs(out)

