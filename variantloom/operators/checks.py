"""Data-quality checks: each gives (check, violations, example)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import MAIN_CHROMS, first_per_group

#: Formats of ids, and the extended region that holds the major histocompatibility complex.
SNP_ID, GENE_ID = r"^rs\d+$", r"^ENSG\d+$"
SOURCES = ["UK Biobank", "GRASP", "Phewas Catalog", "GWAS DB", "GWAS Catalog", "GWAS File"]


def in_range(col: str, lo: float, hi: float, allow_null: bool = False) -> tuple[str, Column]:
    c = F.col(col)
    return f"{col} in [{lo:g}, {hi:g}]", F.coalesce((c < lo) | (c > hi), F.lit(not allow_null))


def not_in_range(col: str, lo: float, hi: float, where: Column | None = None) -> tuple[str, Column]:
    c = F.col(col)
    bad = F.coalesce((c >= lo) & (c <= hi), F.lit(False))
    return f"{col} not in [{lo:g}, {hi:g}]", bad if where is None else bad & where


def matches(col: str, pattern: str) -> tuple[str, Column]:
    return f"{col} matches {pattern}", ~F.coalesce(F.col(col).rlike(pattern), F.lit(False))


def positive(col: str) -> tuple[str, Column]:
    return f"{col} > 0", ~F.coalesce(F.col(col) > 0, F.lit(False))


def in_set(col: str, values: list[str] | None = None) -> tuple[str, Column]:
    return f"{col} known", ~F.coalesce(F.col(col).isin(MAIN_CHROMS if values is None else values), F.lit(False))


def run_checks(df: DataFrame, checks: dict[str, tuple[str, Column]], count: str | None = None) -> DataFrame:
    """All row checks in one pass: check, violations, example (the least offending value as text).

    checks: the column whose value is the example, for each check; count: a column that says how many rows a row stands for."""
    aggs, rows = [], []
    for i, (key, (name, bad)) in enumerate(checks.items()):
        col = key.split("#")[0]
        n = F.count(F.when(bad, 1)) if count is None else F.coalesce(F.sum(F.when(bad, F.col(count))), F.lit(0)).cast("bigint")
        aggs += [n.alias(f"_n{i}"), F.min(F.when(bad, F.col(col).cast("string"))).alias(f"_x{i}")]
        rows.append("'{}', _n{}, _x{}".format(name.replace("\\", "\\\\").replace("'", "\\'"), i, i))
    return df.agg(*aggs).select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) as (check, violations, example)"))


def invalid_values(df: DataFrame, col: str, values: list[str] | None = None, count: str | None = None) -> DataFrame:
    """Frequencies of the values that are not in the set; count: a column that says how many rows a row stands for."""
    n = F.count("*") if count is None else F.sum(count).cast("bigint")
    return df.where(in_set(col, values)[1]).groupBy(F.col(col).alias("value")).agg(n.alias("n"))


def unique_per_group(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """For each column the number of key groups that do not have exactly one distinct non-null value."""
    per = df.groupBy(*keys).agg(*[F.countDistinct(c).alias(f"_{i}") for i, c in enumerate(cols)])
    one = per.agg(*[F.count(F.when(F.col(f"_{i}") != 1, 1)).alias(f"_{i}") for i in range(len(cols))])
    name = ",".join(keys)
    rows = ", ".join(f"'{name} -> {c}', _{i}" for i, c in enumerate(cols))
    return one.select(F.expr(f"stack({len(cols)}, {rows}) as (check, violations)"))


def no_trans(df: DataFrame, keys: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Pairs of chromosome columns that must agree, over the first row of each key."""
    one = first_per_group(df, keys, [F.col(c) for p in pairs for c in p])
    return run_checks(one, {f"{a}#{b}": (f"{a} = {b}", ~F.coalesce(F.col(a) == F.col(b), F.lit(False))) for a, b in pairs})
