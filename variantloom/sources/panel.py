"""Genotype panels with the calls of a site as bit masks, made from the line of the site itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = 63


def _words(bits: str) -> Column:
    """A string of 0 and 1, one a sample, as an array of integers: sample i is bit i % 63 of word i / 63."""
    word = f"cast(conv(reverse(substr(b, w * {WORD} + 1, {WORD})), 2, 10) as bigint)"
    # the string is bound to a name in a one-element array, so that it is made once, not once a word
    return F.expr(f"transform(array({bits}), b -> transform(sequence(0, greatest(0, cast(ceil(length(b) / {WORD}) as int) - 1)), w -> {word}))[0]")


def packed_panel(lines: DataFrame) -> DataFrame:
    """VCF lines -> one row a site: rsid, chrom, pos, ref, alt, n0, n1, n2 (samples with so many alternative alleles) and
    m0, m1, m2 (the same samples as bits: sample i is bit i % 63 of word i / 63).

    A row comes from its line alone, without a row per sample and without a shuffle. Headers, sites without an alternative
    allele and lines without samples are dropped; a call that is not two alleles out of 0 and 1 is in no mask.
    """
    f = lines.where(~F.startswith("value", F.lit("#"))).select(F.split("value", "\t", 10).alias("f")).where("size(f) = 10 and get(f, 4) not in ('.', '')")
    at = lambda i: F.get("f", F.lit(i))
    calls = F.when(F.contains(at(9), F.lit(":")), F.regexp_replace(at(9), ":[^\t]*", "")).otherwise(at(9))
    calls = F.concat(F.lit("\t"), F.replace(F.translate(calls, "/", "|"), F.lit("\t"), F.lit("\t\t")), F.lit("\t"))  # each call between tabs of its own
    for call, dosage in (("0|0", "0"), ("0|1", "1"), ("1|0", "1"), ("1|1", "2")):
        calls = F.replace(calls, F.lit(f"\t{call}\t"), F.lit(dosage))
    calls = F.when(F.contains(calls, F.lit("\t")), F.regexp_replace(calls, "\t[^\t]*\t", ".")).otherwise(calls)
    site = f.select(at(2).alias("rsid"), at(0).alias("chrom"), at(1).try_cast("bigint").alias("pos"), at(3).alias("ref"), at(4).alias("alt"), calls.alias("calls")).where("pos is not null")
    counts = [F.expr(f"length(calls) - length(replace(calls, '{d}', ''))").alias(f"n{d}") for d in range(3)]
    masks = [_words(f"translate(calls, '012.', '{''.join('1' if c == str(d) else '0' for c in '012.')}')").alias(f"m{d}") for d in range(3)]
    return site.select("rsid", "chrom", "pos", "ref", "alt", *counts, *masks)


def sample_mask(samples: DataFrame, wanted: Column) -> list[int]:
    """Samples (sample_no from 0) -> the words with the bits of the wanted ones: as many numbers as a 63rd of the samples."""
    bit = F.expr(f"shiftleft(1L, cast(sample_no % {WORD} as int))")
    by_word = samples.groupBy(F.expr(f"cast(floor(sample_no / {WORD}) as int)").alias("w")).agg(F.bit_or(F.when(wanted, bit).otherwise(F.lit(0).cast("bigint"))).alias("m"))
    found = {r.w: r.m for r in by_word.collect()}
    return [found.get(w, 0) for w in range(max(found, default=-1) + 1)]


def of_samples(panel: DataFrame, mask: list[int]) -> DataFrame:
    """The panel with the calls of the masked samples only; bits keep their places."""
    own = f"array({', '.join(f'{m}L' for m in mask)})" if mask else "cast(array() as array<bigint>)"
    cut = panel.withColumns({f"m{d}": F.expr(f"zip_with(m{d}, {own}, (x, y) -> x & coalesce(y, 0L))") for d in range(3)})
    return cut.withColumns({f"n{d}": F.expr(f"aggregate(m{d}, 0, (s, x) -> s + cast(bit_count(x) as int))") for d in range(3)})


def frequency() -> Column:
    """Share of the alternative allele among the calls; null without calls."""
    return F.expr("try_divide(n1 + 2 * n2, 2 * (n0 + n1 + n2))")


def common(panel: DataFrame, maf: float = 0.01) -> DataFrame:
    """The sites at which either allele has a share of maf or more."""
    return panel.where(F.least(frequency(), 1 - frequency()) >= maf)


def write_panel(panel: DataFrame, path: str, in_order: bool = False) -> None:
    """Write the panel so that a range of positions touches few row groups: sorted by chromosome and position. Panels whose
    lines are in that order already (in_order), as in the files of a sorted VCF, are written as they come, without a shuffle."""
    rows = panel if in_order else panel.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    rows.write.option("compression", "zstd").parquet(path)


def read_panel(spark: SparkSession, path: str, chrom: str | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """A written panel, or the sites of it on a chromosome and from `low` to `high`; these bounds reach the scan."""
    panel = spark.read.parquet(path)
    for wanted, test in ((chrom, F.col("chrom") == chrom), (low, F.col("pos") >= low), (high, F.col("pos") <= high)):
        panel = panel if wanted is None else panel.where(test)
    return panel
