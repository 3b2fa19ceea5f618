"""One query per text operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, decontaminate, exact, language, neardup, pieces, quality, substrings, token_counts, toxicity, warc, whitening
from .shared import spread
from .shared import table as whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(whole(spark, sf_dir, name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = language.held_out(folds=5, fold=0)
    weights, bias = toxicity.fit_toxicity(docs.where(~out), labels.where(~out))
    return toxicity.score_toxicity(docs, weights, bias).select("doc_id", out.alias("held_out"), "score", "predicted")


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "linked_id", "similarity")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = pieces.encode(table(spark, sf_dir, "documents"), verify=True)
    return back.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", "round_trip")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.withColumn("cleaned_sha1", F.sha1(F.encode("cleaned", "utf-8"))).drop("cleaned")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), language.held_out()
    found = language.predict_language(docs, language.fit_profiles(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.preference_pairs(chat.conversations(table(spark, sf_dir, "conversations")))
    spans = [F.expr(chat.spans_text(c)).alias(c) for c in ("chosen_spans", "rejected_spans")]
    return chat.format_preferences(pairs).select("pair_id", "made", "n_shared", "prompt", "chosen", "rejected", *spans)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(spark, f"{sf_dir}/documents.parquet")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    own = [op1_token_counts, op2_toxicity, op3_minhash_neardup, op4_suffix_dedup, op5_sentencepiece, op6_quality_rules, op7_language_id, op8_chat_formatting, op9_decontamination, op10_warc,
           op11_exact_dedup, op12_whitening, op13_centroid_clustering]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op6_quality_rules": quality.QUALITY_SQL, "op8_chat_formatting": chat.CHAT_SQL, "op10_warc": warc.WARC_SQL,
            "op11_exact_dedup": exact.EXACT_SQL, "op13_centroid_clustering": centroids.CLUSTER_SQL}
