"""Domain tables as projections of the given star-schema tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CHROM = "CASE {0} % 5 WHEN 0 THEN '1' WHEN 1 THEN '6' WHEN 2 THEN '17' WHEN 3 THEN 'X' ELSE '2' END"
BASE = "CASE {0} % 5 WHEN 2 THEN 43000000 ELSE 28000000 END"


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR(20))"


def _gene_id(x: str) -> str:
    return f"'ENSG' || lpad({_text(x)}, 11, '0')"


VIEWS = {
    "fx_snp": f"""SELECT 'rs' || {_text('p_partkey')} AS rsid, CAST(p_partkey AS BIGINT) AS k, CAST(floor(p_partkey / 5) AS BIGINT) AS idx,
        {CHROM.format('p_partkey')} AS chrom, CAST({BASE.format('p_partkey')} + CAST(floor(p_partkey / 5) AS BIGINT) * 8000 AS BIGINT) AS pos FROM {{part}}""",
    "fx_sample": "SELECT CAST(s_suppkey AS BIGINT) AS sample_id, CASE s_suppkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'AFR' WHEN 2 THEN 'EAS' WHEN 3 THEN 'SAS' ELSE 'AMR' END AS super_pop FROM {supplier}",
    "fx_geno": """SELECT rsid, chrom, pos, sample_id, CASE WHEN (idx * 31 + sample_id * 17) % 23 = 0 THEN (d + 1) % 3 ELSE d END AS dosage FROM (
        SELECT s.rsid, s.chrom, s.pos, s.idx, c.sample_id, CAST((c.sample_id * 7 + CAST(floor(s.idx / 16) AS BIGINT) * 5 + CAST(floor(c.sample_id / 5) AS BIGINT)) % 3 AS INT) AS d
        FROM {fx_snp} s CROSS JOIN {fx_sample} c) g""",
    "fx_gwas": f"""SELECT 'rs' || {_text('l_partkey')} AS rsid, CAST('1e-' || CAST(CAST(floor(l_quantity / 4) AS INT) AS VARCHAR(5)) AS DOUBLE) AS pvalue,
        l_returnflag || l_linestatus AS efo, CAST(l_suppkey * 100 AS BIGINT) AS sample_size, CAST(l_discount AS DOUBLE) - 0.05 AS beta,
        CAST(l_orderkey AS BIGINT) AS study_id, CAST(l_linenumber AS INT) AS line FROM {{lineitem}}""",
    "fx_gene": f"""SELECT {_gene_id('s_suppkey')} AS gene_id, s_name AS name, {CHROM.format('s_suppkey')} AS chrom,
        CAST({BASE.format('s_suppkey')} + CAST(floor(s_suppkey / 5) AS BIGINT) * 160000 AS BIGINT) AS tss,
        CASE WHEN s_nationkey % 5 = 0 THEN 'lincRNA' ELSE 'protein_coding' END AS biotype FROM {{supplier}}""",
    "fx_bed": f"""SELECT {CHROM.format('o_custkey')} AS chrom, CAST({BASE.format('o_custkey')} + (o_orderkey * 2137) % 3200000 AS BIGINT) AS bstart,
        CAST({BASE.format('o_custkey')} + (o_orderkey * 2137) % 3200000 + 200 + o_custkey % 3000 AS BIGINT) AS bend,
        {_gene_id('o_orderkey % 100')} AS gene_id, CAST(o_totalprice AS DOUBLE) / 10000 AS score, CAST(o_orderkey AS BIGINT) AS feature_id FROM {{orders}}""",
    "fx_eqtl": f"""SELECT {_gene_id('l_suppkey')} AS gene_id, l_returnflag || l_linestatus AS tissue, 'rs' || {_text('l_partkey')} AS rsid,
        CAST(l_orderkey % 1000 + 1 AS DOUBLE) / CAST(1001 AS DOUBLE) AS pvalue, CAST(l_discount AS DOUBLE) - 0.05 AS beta FROM {{lineitem}}""",
    "fx_edges": "SELECT CAST(n_nationkey AS INT) AS child, CAST(floor((n_nationkey - 1) / 2) AS INT) AS parent FROM {nation} WHERE n_nationkey > 0",
    "fx_map": f"SELECT p_type AS trait, 'EFO_' || lpad({_text('min(p_partkey)')}, 7, '0') AS efo FROM {{part}} GROUP BY p_type",
    # raw text lines, as the files of each source hold them
    "fx_grasp_lines": f"""SELECT repeat('x' || chr(9), 4) || {_text('l_partkey')} || chr(9) || repeat('y' || chr(9), 2) || 'PMID' || {_text('l_orderkey')} || chr(9) || repeat('z' || chr(9), 2)
        || CASE WHEN l_linenumber = 7 THEN 'NR' ELSE '1e-' || CAST(CAST(floor(l_quantity / 4) AS INT) AS VARCHAR(5)) END || chr(9) || 'w' || chr(9) || 'trait ' || CASE l_linenumber % 3 WHEN 0 THEN 'AIR' WHEN 1 THEN 'RAIL' ELSE 'SHIP' END || chr(9)
        || repeat('v' || chr(9), 11) || {_text('l_suppkey')} || chr(9) || repeat('u' || chr(9), 45) || 'http://www.ebi.ac.uk/efo/EFO_' || l_returnflag || ',http://www.ebi.ac.uk/efo/EFO_' || l_linestatus AS value
        FROM {{lineitem}}""",
    "fx_phewas_lines": f"""SELECT 'chr1' || chr(9) || 'rs' || {_text('l_partkey')} || chr(9) || 'trait ' || CASE l_linenumber % 3 WHEN 0 THEN 'AIR' WHEN 1 THEN 'RAIL' ELSE 'SHIP' END || chr(9) || {_text('l_suppkey')} || chr(9)
        || CASE WHEN l_linenumber = 7 THEN 'NR' ELSE '1e-' || CAST(CAST(floor(l_quantity / 4) AS INT) AS VARCHAR(5)) END || chr(9) || CAST(CAST(l_quantity AS INT) AS VARCHAR(9)) || chr(9) || 'g' || chr(9) || 'c' || chr(9) || 'a' || chr(9)
        || CASE WHEN l_linenumber = 2 THEN 'N/A' ELSE 'http://www.ebi.ac.uk/efo/EFO_' || l_returnflag || ',http://www.ebi.ac.uk/efo/EFO_' || l_linestatus END AS value FROM {{lineitem}}""",
    "fx_gwasdb_lines": f"""SELECT '1' || chr(9) || '100' || chr(9) || 'rs' || {_text('l_partkey')} || chr(9)
        || CASE WHEN l_linenumber = 7 THEN 'NR' ELSE '1e-' || CAST(CAST(floor(l_quantity / 4) AS INT) AS VARCHAR(5)) END || chr(9) || {_text('l_orderkey')} || chr(9) || 'trait ' || CASE l_linenumber % 3 WHEN 0 THEN 'AIR' WHEN 1 THEN 'RAIL' ELSE 'SHIP' END || chr(9)
        || 'http://www.ebi.ac.uk/efo/EFO_' || l_returnflag || CASE WHEN l_linenumber = 3 THEN '' ELSE chr(9) || 'extra' END AS value FROM {{lineitem}}""",
    "fx_ukb_lines": f"""SELECT 'rs' || {_text('l_partkey')} || chr(9) || 'of ' || l_returnflag || chr(9) || 'trait ' || CASE l_linenumber % 3 WHEN 0 THEN 'AIR' WHEN 1 THEN 'RAIL' ELSE 'SHIP' END || chr(9) || '1e-' || CAST(CAST(floor(l_quantity / 4) AS INT) AS VARCHAR(5)) || chr(9)
        || {_text('l_suppkey')} || chr(9) || 'UKB' || chr(9) || 'S' || chr(9) || '1' || chr(9) || '-2' || CASE WHEN l_linenumber = 7 THEN '' ELSE chr(9) || 'decrease' END AS value FROM {{lineitem}}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or a view of it as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return sql(spark, sf_dir, VIEWS[name])


def sql(spark: SparkSession, sf_dir: str, text: str, **more: DataFrame) -> DataFrame:
    """Run SQL whose {names} are views, tables or the given DataFrames."""
    return spark.sql(text, **{n: more[n] if n in more else view(spark, sf_dir, n) for n in _names(text)})


def oracle(text: str) -> str:
    """The same SQL for DuckDB, with the views that it names as common table expressions."""
    found: dict[str, str] = {}

    def need(body: str) -> None:
        for n in _names(body):
            if n in VIEWS and n not in found:
                need(VIEWS[n])
                found[n] = re.sub(r"\{(\w+)\}", r"\1", VIEWS[n])

    need(text)
    body = re.sub(r"\{(\w+)\}", r"\1", text).strip()
    if not found:
        return body
    head = ", ".join(f"{n} AS ({v})" for n, v in found.items())
    if re.match(r"WITH RECURSIVE\s", body):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    return f"WITH {head}, {body[5:]}" if re.match(r"WITH\s", body) else f"WITH {head} {body}"
