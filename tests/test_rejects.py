"""Lines taken and left out: every line is one or the other, and those taken are what the parser takes."""

import json

import pytest
from pyspark.sql import functions as F

from variantloom.sources import readers, rejects

T = "\t".join
PHEWAS = ["chr", "rs1", "trait", "100", "1e-9", "1.5", "g", "c", "a", "http://x/EFO_1"]


def put(fields, **at):
    return T(at.get(f"f{i}", x) for i, x in enumerate(fields))


LINES = {
    "phewas": [(T(PHEWAS), None), (put(PHEWAS, f4="NR"), "p value"), (put(PHEWAS, f3="1.5 k"), "sample size"), (put(PHEWAS, f5=""), "odds ratio"), (put(PHEWAS, f3="x", f4="x"), "p value"),
               (T(PHEWAS[:9]), "fields"), ("", "fields"), (None, "no line"), (T(PHEWAS), None), (T(PHEWAS) + "\textra" * 5000, None)],
    "gwas_db": [(T(["1", "2", "rs1", "1e-5", "3", "t", "i"]), None), (T(["1", "2", "rs1", "", "3", "t", "i"]), "p value"), (T(["1"]), "fields"), (None, "no line")],
    "neale_ukb": [(T(["rs1", "a", "b", "0.1", "5", "p", "s", "1", "2", "up"]), None), (T(["rs1", "a", "b", "0.1", "x", "p", "s", "1", "2", "up"]), None), (T(["rs1"] * 11), "fields"), (T(["rs1", "a", "b", "-", *"123456"]), "p value")],
    "grasp": [(T(["1"] * 71), None), (T(["1"] * 70), "fields"), (T(["1"] * 24 + ["no"] + ["1"] * 46), "sample size"), (T(["1"] * 10 + ["no"] + ["1"] * 60), "p value")],
    "bed_tss": [(T(["1", "5", "9", "g"]), None), (T(["1", "5", "9"]), None), (T(["1", "x", "9"]), "start"), (T(["1", "5", ""]), "end"), (T(["1", "5"]), "fields"), (None, "no line")],
    "gwas_catalog": [(json.dumps({"association": {"pvalue": 1e-9}, "snps": [{"rsId": "rs1"}, {"rsId": "rs2"}]}), None), ('{"snps": [{"rsId": "rs1"', "JSON"), ("{}", "SNP"), (json.dumps({"snps": [{"rsId": "chr1:5"}, {"rsId": None}]}), "SNP"), (None, "no line")],
}


@pytest.mark.parametrize("kind", sorted(LINES))
def test_every_line_has_one_outcome(spark, kind):
    rows = LINES[kind]
    lines = spark.createDataFrame([(v, "clash") for v, _ in rows], "value string, reason string")
    got = rejects.split_lines(lines, kind, "file 1")
    bad = [(v, r) for v, r in rows if r]
    assert sorted(map(repr, got.rejected.select("line", "reason").collect())) == sorted(map(repr, got.rejected.sparkSession.createDataFrame(bad, "line string, reason string").collect()))
    assert got.counts == {"read": len(rows), "accepted": len(rows) - len(bad), "rejected": len(bad)}
    assert {r.source for r in got.rejected.collect()} <= {"file 1"}
    whole = rejects.FORMATS[kind][0](lines)  # the parser alone takes the same
    assert sorted(map(repr, got.accepted.collect())) == sorted(map(repr, whole.collect())) and got.accepted.count() >= len(rows) - len(bad)


def test_no_lines(spark):
    got = rejects.split_lines(spark.range(0).select(F.lit("").alias("value")), "phewas")
    assert got.counts == {"read": 0, "accepted": 0, "rejected": 0} and got.accepted.count() == got.rejected.count() == 0
    assert got.accepted.columns == readers.parse_phewas(spark.range(0).select(F.lit("").alias("value"))).columns
