"""A corpus pipeline over `documents`: language, near duplicates, repeated passages, benchmark leaks, pieces.

Each stage takes (spark, docs, sf_dir) and returns rows with the columns of documents; the last returns piece ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm import decontaminate, language, neardup, pieces, substrings
from variantloom.llm.shared import stored, table

#: Row keys up to this number are sent to all tasks to drop rows by; more are joined by shuffle.
MAX_BROADCAST = 1_000_000


def _key(text_key: str = "xxhash64(text)") -> Column:
    """What tells rows apart: a hash of doc_id and text; doc_ids can be missing or given twice."""
    return F.expr(f"xxhash64(coalesce(cast(doc_id as string), ''), {text_key})")


def _unused(docs: DataFrame, name: str) -> str:
    """name, or a longer one that no column of docs has."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs without the rows of these keys."""
    keys, key = stored(keys.distinct(), "drop"), _unused(docs, "row_key")
    keys = keys.toDF(key)
    small = F.broadcast(keys) if keys.count() <= MAX_BROADCAST else keys
    return docs.withColumn(key, _key()).join(small, key, "left_anti").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts unlike every language learned from the training fold."""
    return language.keep_languages(docs, language.fit_profiles(docs.where(~language.held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near duplicates: that with the least doc_id (rows without one come last), then by a
    hash of the text. Of rows equal in doc_id and text the first by the other columns stays."""
    classes = stored(neardup.near_duplicates(docs).select("doc_id", "text_key", "class_id", "class_key"), "classes")
    repeated = classes.groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.limit(1).count():
        key, row = _unused(docs, "row_key"), _unused(docs, "row")
        again = stored(repeated.select(_key("text_key").alias(key)), "again")
        keyed, own = docs.withColumn(key, _key()), F.struct(*docs.columns)
        held = keyed.join(again, key, "left_semi").groupBy(key).agg(F.min_by(own, F.to_json(own)).alias(row)).select(f"{row}.*")
        docs = keyed.join(again, key, "left_anti").select(docs.columns).unionByName(held)
    return _without(docs, classes.where("not (doc_id <=> class_id and text_key = class_key)").select(_key("text_key")))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated 200-byte strings out of the texts (and what is left of a character); drops texts cut to nothing."""
    rest = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    cut = substrings.remove_repeats(docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(n) for c, n in rest.items())), carry=tuple(rest.values()), as_text=True)
    kept = cut.where("n_removed = 0 or n_removed < n_bytes")
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*(made.get(c, F.col(rest[c]) if c in rest else None).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    keyed = docs.select(_key().alias("doc_id"), "text")
    return _without(docs, decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark")).select("doc_id"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, and whether decoding them gives the text back."""
    return pieces.encode(docs, verify=True).select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]

#: No stage but the joins can be put in SQL; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
