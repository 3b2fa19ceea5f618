import hashlib
import random
import string
import tempfile
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from variantloom.llm import exact

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ODD = [(1, "Ab c"), (2, "aB C"), (3, "ab c "), (4, None), (5, ""), (None, "ab c"), (None, None), (7, "É"), (8, "é"), (9, "x" * 300_000), (10, "X" * 300_000), (11, "x" * 299_999 + "y"), (5, ""), (5, "")]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, max(known, default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def written(spark, rows, path, files=1):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("keep_id", F.lit("own")).withColumn("row", F.lit(1)).withColumn("digest", F.lit(0.5))
    df.repartition(files).write.mode("append").parquet(path)


def test_groups_by_brute_force_in_several_batches(spark, tmp_path):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abAB ") for _ in range(rng.randrange(4))) for _ in range(400)]
    rows = ODD + [(100 + i, t) for i, t in enumerate(texts)] + [(1000 + i, "same") for i in range(300)]
    written(spark, rows, f"{tmp_path}/docs", 5)
    got = exact.deduplicate(spark, f"{tmp_path}/docs", bytes_per_batch=1)  # a batch a file
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(got) == brute(rows)
    kept = got.where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({r.text_sha256 for r in got.collect()})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_unlike_texts_of_one_digest_are_told_apart(spark, tmp_path):
    rows = ODD + [(100 + i, f"t{i % 37}") for i in range(150)]
    written(spark, rows, f"{tmp_path}/docs", 3)
    weak = lambda norm: F.encode((F.length(norm) % 4).cast("string"), "utf-8")
    for most in (0, 1_000_000):
        got = exact.deduplicate(spark, f"{tmp_path}/docs", bytes_per_batch=1, digest=weak, max_broadcast=most)
        assert sorted([x[:3] for x in rows_of(got)], key=repr) == sorted([x[:3] for x in brute(rows)], key=repr)
        assert got.where("kept").count() == len({(t or "").translate(LOWER) for _, t in rows})


def test_a_later_call_reads_new_files_only(spark, tmp_path):
    first, second = [(i, f"t{i % 5}") for i in range(20)], [(i, f"T{i % 9}") for i in range(20, 50)]
    written(spark, first, f"{tmp_path}/docs")
    folder = f"file://{tmp_path}/state"
    assert rows_of(exact.deduplicate(spark, f"{tmp_path}/docs", folder)) == brute(first)
    written(spark, second, f"{tmp_path}/docs")
    assert rows_of(exact.deduplicate(spark, f"{tmp_path}/docs", folder)) == brute(first + second)
    taken = spark.read.parquet(f"{tmp_path}/state/prints")
    assert taken.count() == 50
    assert rows_of(exact.deduplicate(spark, f"{tmp_path}/docs", folder)) == brute(first + second)  # nothing new


def test_empty_table(spark, tmp_path):
    written(spark, [], f"{tmp_path}/docs")
    assert exact.deduplicate(spark, f"{tmp_path}/docs").collect() == []


def test_a_store_of_few_rows_takes_little_disk(spark, tmp_path):
    logs = lambda: set(Path(spark.conf.get("spark.local.dir", tempfile.gettempdir())).glob("spark-*/StateStoreId*/**/MANIFEST-*"))
    before = logs()
    written(spark, [(i, f"t{i % 5}") for i in range(20)], f"{tmp_path}/docs")
    assert exact.deduplicate(spark, f"{tmp_path}/docs").where("kept").count() == 5
    made = logs() - before
    assert made
    assert max(f.stat().st_blocks * 512 for f in made) < 100_000  # 4 MB were reserved for each
