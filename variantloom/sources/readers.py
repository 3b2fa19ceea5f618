"""Readers of association, interval, genotype and annotation sources.

Each `parse_` function takes a DataFrame (of text lines in `value`, or of string columns) so that it can follow any Spark
reader; each `read_` function puts the reader of the file format before it. Rows whose numbers do not parse are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PHEWAS_PUBLICATION = "PMID24270849"


def _number(c: Column, kind: str = "double") -> Column:
    return c.try_cast(kind)


def fields(lines: DataFrame, *kept: str) -> DataFrame:
    """The tab fields of each line (value) as an array f, beside the columns to be kept. A filter on f is not pushed below
    a generator, where it would make the line and split it again for each of its conditions."""
    return lines.select(*kept, F.explode(F.array(F.split(F.rtrim("value"), "\t"))).alias("f"))


def _association(df: DataFrame, source: str, **cols: Column) -> DataFrame:
    kinds = {"snp": "string", "pvalue": "double", "iris": "array<string>", "reported_trait": "string", "publication": "string",
             "sample_size": "bigint", "odds_ratio": "double", "beta_coefficient": "double", "beta_direction": "string"}
    cols = {k: cols.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()}
    return df.select(*cols.values(), F.lit(source).alias("source")).where("pvalue is not null and snp is not null")


def parse_summary_stats(stats: DataFrame, p_max: float | None = None, rsids: DataFrame | None = None) -> DataFrame:
    """String columns variant_id, p-value, beta -> associations with p < p_max, of the wanted rsid column of rsids."""
    out = _association(stats, "GWAS File", snp=F.col("variant_id"), pvalue=_number(F.col("`p-value`")), iris=F.array(F.lit("EFO_Manual")),
                       reported_trait=F.lit("Manual"), publication=F.lit("PMID000"), sample_size=F.lit(1000), beta_coefficient=_number(F.col("beta")))
    out = out.where("beta_coefficient is not null")
    if p_max is not None:
        out = out.where(F.col("pvalue") < p_max)
    return out if rsids is None else out.join(rsids.select(F.col("rsid").alias("snp")), "snp", "left_semi").select(out.columns)


def read_summary_stats(spark: SparkSession, path: str, p_max: float | None = None, rsids: DataFrame | None = None) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=True, ignoreLeadingWhiteSpace=True)
    return parse_summary_stats(raw, p_max, rsids)


def parse_grasp(lines: DataFrame) -> DataFrame:
    """71 tab fields: 5 rsID number, 8 publication, 11 p value, 13 trait, 25 size, 71 comma list of IRIs."""
    f = fields(lines).where("size(f) >= 71")
    return _association(f, "GRASP", snp=F.concat(F.lit("rs"), F.col("f")[4]), pvalue=_number(F.col("f")[10]), iris=F.split(F.col("f")[70], ","),
                        reported_trait=F.col("f")[12], publication=F.col("f")[7], sample_size=_number(F.col("f")[24], "bigint")).where("sample_size is not null")


def parse_phewas(lines: DataFrame) -> DataFrame:
    """10 tab fields: 2 rsID, 3 trait, 4 cases, 5 p value, 6 odds ratio, 10 comma list of IRIs."""
    f = fields(lines).where("size(f) >= 10")
    return _association(f, "Phewas Catalog", snp=F.col("f")[1], pvalue=_number(F.col("f")[4]), iris=F.split(F.col("f")[9], ","), reported_trait=F.col("f")[2],
                        publication=F.lit(PHEWAS_PUBLICATION), sample_size=_number(F.col("f")[3], "bigint"), odds_ratio=_number(F.col("f")[5])).where("sample_size is not null and odds_ratio is not null")


def parse_gwas_db(lines: DataFrame) -> DataFrame:
    """7 tab fields: 3 rsID, 4 p value, 5 publication, 6 trait, 7 comma list of IRIs; the size is unknown."""
    f = fields(lines).where("size(f) >= 7")
    return _association(f, "GWAS DB", snp=F.col("f")[2], pvalue=_number(F.col("f")[3]), iris=F.split(F.col("f")[6], ","), reported_trait=F.col("f")[5], publication=F.col("f")[4])


def parse_neale_ukb(lines: DataFrame, traits: list[str] | None = None) -> DataFrame:
    """Exactly 10 tab fields: rsID, disease, reported trait, p value, size, publication, study, odds ratio, beta, its
    direction. Rows of the given traits; the trait becomes "<reported> <disease>"; there is no IRI."""
    f = fields(lines).where("size(f) = 10")
    if traits is not None:
        f = f.where(F.col("f")[2].isin(traits))
    return _association(f, "UK Biobank", snp=F.col("f")[0], pvalue=_number(F.col("f")[3]), reported_trait=F.concat_ws(" ", F.col("f")[2], F.col("f")[1]), publication=F.col("f")[5],
                        sample_size=_number(F.col("f")[4], "bigint"), beta_coefficient=_number(F.col("f")[8]), beta_direction=F.col("f")[9])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


CATALOG = """struct<association: struct<pvalue: double, pvalueDescription: string, `range`: string, orPerCopyNum: double, betaNum: double, betaUnit: string, betaDirection: string>,
  snps: array<struct<rsId: string>>,
  study: struct<accessionId: string, publicationInfo: struct<pubmedId: string>, diseaseTrait: struct<trait: string>, ancestries: array<struct<numberOfIndividuals: bigint>>>>"""


def flatten_gwas_catalog(docs: DataFrame) -> DataFrame:
    """JSON text in `value`, one association with its SNPs and study -> one row per SNP whose id holds "rs".

    The sample size is the sum of the known ancestry counts; the confidence interval is the first two decimals of range."""
    d = docs.select(F.from_json("value", F.lit(CATALOG)).alias("d")).select("d.*", F.explode("d.snps").alias("snp"))
    ends = F.regexp_extract_all("association.range", F.lit(r"(\d+\.\d+)"), 1)
    return d.select(
        F.expr(r"regexp_replace(snp.rsId, '^[\\s ]+|[\\s ]+$', '')").alias("snp"), F.col("association.pvalue").alias("pvalue"), F.col("association.pvalueDescription").alias("pvalue_description"),
        F.col("association.orPerCopyNum").alias("odds_ratio"), F.get(ends, F.lit(0)).cast("double").alias("ci_start"), F.get(ends, F.lit(1)).cast("double").alias("ci_end"),
        F.col("association.betaNum").alias("beta_coefficient"), F.col("association.betaUnit").alias("beta_unit"), F.col("association.betaDirection").alias("beta_direction"),
        F.col("study.accessionId").alias("study"), F.concat(F.lit("PMID"), F.col("study.publicationInfo.pubmedId")).alias("publication"), F.col("study.diseaseTrait.trait").alias("reported_trait"),
        F.expr("aggregate(study.ancestries, 0L, (a, x) -> a + coalesce(x.numberOfIndividuals, 0L))").alias("sample_size"),
    ).where(F.col("snp").contains("rs"))


LAYOUTS = {
    "symbol": "chrom string, start bigint, end bigint, symbol string, score double",
    "pchic": "chrom string, start bigint, end bigint, score double, gene_id string",
    "regulome": "chrom string, start bigint, end bigint, category string",
    "tss": "chrom string, start bigint, end bigint, gene_id string",
}


def parse_bed(lines: DataFrame, layout: str) -> DataFrame:
    """Tab lines of a layout (symbol, pchic, regulome, tss) -> columns bstart, bend for the 0-based half-open interval."""
    names = [c.strip().rsplit(" ", 1) for c in LAYOUTS[layout].split(", ")]
    f = F.split(F.col("value"), "\t")
    cols = [_number(F.get(f, F.lit(i)), t).alias({"start": "bstart", "end": "bend"}.get(n, n)) for i, (n, t) in enumerate(names)]
    return lines.select(*cols).where("chrom is not null and bstart is not null and bend is not null")


def read_bed(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return parse_bed(spark.read.text(path), layout)


def parse_vcf(lines: DataFrame) -> DataFrame:
    """VCF lines -> rsid, chrom, pos, sample_no, dosage of the first alternative allele.

    Sites without an alternative allele are dropped, and so are calls that are not two alleles out of 0 and 1."""
    f = lines.where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f")).where("size(f) > 9 and f[4] not in ('.', '')")
    gt = f.select(F.col("f")[2].alias("rsid"), F.col("f")[0].alias("chrom"), F.col("f")[1].cast("bigint").alias("pos"), F.posexplode(F.expr("slice(f, 10, size(f) - 9)")).alias("sample_no", "call"))
    # the usual calls are told as they are, by what stands before the first colon; a pattern tells all others
    plain, odd = F.substring_index("call", ":", 1), F.regexp_extract("call", r"^([01][|/][01])(?::|$)", 1)
    dosage = lambda c: F.when(c.isin("0|0", "0/0"), 0).when(c.isin("0|1", "0/1", "1|0", "1/0"), 1).when(c.isin("1|1", "1/1"), 2)
    return gt.select("rsid", "chrom", "pos", "sample_no", F.coalesce(dosage(plain), dosage(odd)).alias("dosage")).where("dosage is not null")


def eqtl_evidence(eqtl: DataFrame) -> DataFrame:
    """gene_id, tissue, rsid, pvalue, beta -> the same with score = 1 - p; only 0 < p <= 1."""
    return eqtl.where("pvalue > 0 and pvalue <= 1").select("gene_id", "tissue", "rsid", "pvalue", "beta", (1 - F.col("pvalue")).alias("score"))


VEP = """struct<input: string, id: string,
  transcript_consequences: array<struct<gene_id: string, impact: string, consequence_terms: array<string>>>,
  colocated_variants: array<struct<id: string, minor_allele: string, frequencies: map<string, map<string, double>>>>,
  regulatory_feature_consequences: array<struct<regulatory_feature_id: string>>>"""
#: Points of each impact, out of 4.
IMPACT = {"HIGH": 4, "MEDIUM": 3, "LOW": 2, "MODIFIER": 1, "MODERATE": 1}


def flatten_vep(docs: DataFrame) -> DataFrame:
    """JSON text in `value` -> one row per transcript consequence: rsid, gene_id, score (0 to 1), terms."""
    d = docs.select(F.from_json("value", F.lit(VEP)).alias("d")).select("d.input", F.explode("d.transcript_consequences").alias("c"))
    score = F.create_map(*[x for k, v in IMPACT.items() for x in (F.lit(k), F.lit(v / 4))])
    return d.select(F.col("input").alias("rsid"), F.col("c.gene_id").alias("gene_id"), F.try_element_at(score, F.col("c.impact")).alias("score"), F.col("c.consequence_terms").alias("terms"))


def flatten_vep_regulatory(docs: DataFrame) -> DataFrame:
    """JSON text in `value` -> rsid, score (1 if any regulatory feature has an id), mafs (by population) for inputs with
    a colocated variant of the hit's own id; mafs are those of its minor allele, if known."""
    d = docs.select(F.from_json("value", F.lit(VEP)).alias("d")).select(
        "d.*", F.expr("get(filter(d.colocated_variants, v -> v.id = d.id), 0)").alias("v")).where("v is not null")
    return d.select(
        F.col("input").alias("rsid"), F.expr("if(exists(coalesce(regulatory_feature_consequences, array()), r -> coalesce(r.regulatory_feature_id, '') != ''), 1, 0)").alias("score"),
        F.expr("if(v.minor_allele is null, null, try_element_at(v.frequencies, v.minor_allele))").alias("mafs"))


def union_sources(sources: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """Rows of the named sources (all by default) in one table, missing columns null, with the source's name."""
    chosen = [df.withColumn("source", F.lit(n)) for n, df in sources.items() if names is None or n in names]
    if not chosen:
        raise ValueError(f"no source among {names}")
    out = chosen[0]
    for df in chosen[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def tsv_lines(df: DataFrame) -> DataFrame:
    """Rows as tab-separated text, nulls as None."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, nullValue="None")


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)
