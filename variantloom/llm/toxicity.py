"""Toxicity scores by non-negative learning from positive and unlabelled texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, id_number, id_text, stored, text_chunks, tidy, words_of


def features(text: str | None) -> set[str]:
    """Distinct words."""
    return set(words_of(text))


class NonNegativePU:
    """A linear classifier on binary features, fitted to positive rows and unlabelled rows with known class prior.

    The risk is prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-)) with logistic losses. While the bracket is
    negative the step climbs it instead, so that the fit cannot push the unlabelled risk below zero.
    """

    def __init__(self, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-5):
        self.prior, self.steps, self.rate, self.decay = prior, steps, rate, decay

    def fit(self, rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int) -> NonNegativePU:
        """rows, cols: the ones of a sparse matrix. positive: per row True (positive) or False (unlabelled)."""
        n = len(positive)
        n_pos, n_unl = max(positive.sum(), 1), max((~positive).sum(), 1)
        w = np.zeros(n_features + 1)
        w[-1] = np.log(max(self.prior, 1e-6) / max(1 - self.prior, 1e-6))
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, self.steps + 1):
            z = np.bincount(rows, w[cols], n) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            loss_neg = np.logaddexp(0, z)
            bracket = loss_neg[~positive].sum() / n_unl - self.prior * loss_neg[positive].sum() / n_pos
            # derivative by z of the loss as a negative is p, as a positive p - 1
            neg = np.where(positive, -self.prior * p / n_pos, p / n_unl)
            g = np.where(positive, self.prior * (p - 1) / n_pos, 0) + neg if bracket >= 0 else -neg
            grad = np.r_[np.bincount(cols, g[rows], n_features), g.sum()] + self.decay * np.r_[w[:-1], 0]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.bias = w[:-1], w[-1]
        return self


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 30_000, n_features: int = 2_000, min_df: int = 3, min_z: float = 6.0, prior: float | None = None, strength: float = 0.03) -> tuple[dict[str, float], float]:
    """(doc_id, text) and (doc_id, toxic) -> word weights and bias.

    Positives are the rows labelled toxic; unlabelled are all rows of docs, those without any label among them, and no
    label of theirs is looked at. Of either at most about `max_rows` are used, chosen by a hash of doc_id. The class
    prior is `prior`, or the share of toxic ones among all labels. Of the words in at least `min_df` unlabelled or positive
    rows those whose presence among the positives differs from that among the unlabelled by `min_z` standard errors or
    more are used, `n_features` at most. Weights decay by `strength` over the number of positives. The driver receives these counts and the bounded sample's features only. Rows
    without doc_id take no part; rows that share one share its label. Without positive rows every weight is 0.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return {}, -10.0
    docs = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    chosen = lambda total: F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * min(1.0, max_rows / max(total, 1)))
    toxic = known.where((F.col("toxic") == 1) & chosen(n_toxic)).select("doc_id", F.lit(1).alias("toxic"))
    sample = docs.withColumn("free", chosen(docs.count()).cast("int")).join(F.broadcast(toxic), "doc_id", "left").where("free = 1 or toxic = 1").select("text", "free", F.coalesce("toxic", F.lit(0)).alias("toxic"))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_chunks(batches):
            yield pd.DataFrame({"free": b["free"], "toxic": b["toxic"], "words": [sorted(features(t)) for t in b["text"]]})

    found = stored(sample.mapInPandas(tidy(words), "free int, toxic int, words array<string>"), "toxic")
    n_pos, n_free = found.agg(F.sum("toxic"), F.sum("free")).first()
    if not n_pos or not n_free:
        return {}, -10.0
    df = found.select("toxic", "free", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("p"), F.sum("free").alias("u")).where(F.greatest("u", "p") >= min_df)
    a, b = F.col("p") / F.lit(float(n_pos)), F.col("u") / F.lit(float(n_free))
    z = F.abs(a - b) / F.sqrt(b * (1 - b) + F.lit(1e-9)) * F.sqrt(F.lit(float(n_pos)))
    top = df.withColumn("gap", z).where(F.col("gap") >= min_z).orderBy(F.desc("gap"), "word").limit(n_features)
    vocab = sorted(r["word"] for r in top.select("word").collect())
    at = {w: i for i, w in enumerate(vocab)}
    keep = F.array(*[F.lit(w) for w in vocab]) if vocab else F.array().cast("array<string>")
    rows = found.select("toxic", "free", F.sort_array(F.array_intersect("words", keep)).alias("words")).orderBy("words", "toxic", "free").collect()
    r, c, y = [], [], []
    for row in rows:
        hit = [at[w] for w in row["words"]]
        for label in [True] * row["toxic"] + [False] * row["free"]:
            r += [len(y)] * len(hit)
            c += hit
            y.append(label)
    model = NonNegativePU(n_toxic / n_known if prior is None else prior, decay=strength / n_pos).fit(np.array(r, np.int64), np.array(c, np.int64), np.array(y, bool), len(vocab))
    return dict(zip(vocab, model.weights.tolist())), float(model.bias)


def score_toxicity(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """(doc_id, text) -> doc_id, score (0 to 1), predicted (1 if score >= 0.5), one row per input row.

    Null and empty texts get the score of the bias alone; other columns are ignored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = set(weights)
        for b in text_chunks(batches):
            z = np.array([bias + sum(weights[w] for w in sorted(vocab.intersection(words_of(t)))) for t in b["text"]])
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "score": score, "predicted": (score >= 0.5).astype(np.int32)})

    return id_number(bounded_batches(docs).select(id_text(), F.col("text").cast("string")).mapInPandas(
        tidy(run), "doc_id string, score double, predicted int"))
