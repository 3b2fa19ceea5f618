"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded_batches, id_number, id_text, text_chunks, tidy

SPACE = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def ngrams(text: str | None, most: int = 3) -> np.ndarray:
    """Keys of all 1..most-grams of letters of the lower-cased text; a space stands for whatever lies between words.

    Code points take 21 bits each; n-grams with an inner space, or of a space alone, are left out."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter | np.r_[True, letter[:-1]]
    codes = np.where(letter, codes, SPACE)[keep]
    codes = np.r_[[SPACE] if codes[0] != SPACE else [], codes, [SPACE] if codes[-1] != SPACE else []].astype(np.int64)
    space = codes == SPACE
    out = [codes[~space]]
    if most > 1:
        out.append(codes[:-1] << 21 | codes[1:])
    if most > 2:
        out.append((codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[~space[1:-1]])
    return np.concatenate(out)


def ranked(keys: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, most frequent first; equal counts by key."""
    found, n = np.unique(keys, return_counts=True)
    if len(found) > 4 * size:  # the size-th largest count and what ties with it
        keep = n >= np.partition(n, len(n) - size)[len(n) - size]
        found, n = found[keep], n[keep]
    return found[np.lexsort((found, -n))[:size]]


class Profiles:
    def __init__(self, rows: list[tuple[str, list[int]]], size: int):
        self.size, self.langs = size, []
        for lang, keys in sorted(rows):
            keys = np.array(keys, np.int64)
            order = np.argsort(keys)
            self.langs.append((lang, keys[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language whose profile is the least out of place (ties: the first by name), and 1 - distance / largest."""
        doc = ranked(ngrams(text), self.size)
        if not len(doc) or not self.langs:
            return "und", 0.0
        places, best, name = np.arange(len(doc)), None, "und"
        for lang, keys, order in self.langs:
            at = np.minimum(np.searchsorted(keys, doc), len(keys) - 1)
            hit = keys[at] == doc
            off = np.where(hit, np.minimum(np.abs(order[at] - places), self.size), self.size).sum()
            if best is None or off < best:
                best, name = off, lang
        return name, float(1 - best / (self.size * len(doc)))


def fit_profiles(docs: DataFrame, size: int = 400) -> list[tuple[str, list[int]]]:
    """(text, lang) -> the `size` most frequent n-grams of each non-null language over all rows.

    Counts are summed per task before the shuffle. The driver receives `size` keys a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def merge(parts: list) -> list:
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return [(keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64))]

        def rows() -> Iterator[pd.DataFrame]:
            for lang, parts in held.items():
                for keys, n in merge(parts):
                    yield pd.DataFrame({"lang": lang, "key": keys, "n": n})
            held.clear()

        for b in text_chunks(batches, 2_000_000):
            for lang, part in b.groupby("lang", sort=False):
                keys = [k for t in part["text"] if len(k := ngrams(t))]
                if keys:
                    held.setdefault(lang, []).append(np.unique(np.concatenate(keys), return_counts=True))
                    if len(held[lang]) > 8:
                        held[lang] = merge(held[lang])
            if sum(len(k) for parts in held.values() for k, _ in parts) > 3_000_000:
                yield from rows()
        yield from rows()

    counts = (bounded_batches(docs).where("lang is not null and text is not null").select("lang", "text")
              .mapInPandas(tidy(count), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    top = counts.withColumn("place", place).where(F.col("place") <= size)
    rows = top.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "key"))), lambda x: x["key"]).alias("keys")).collect()
    return [(r["lang"], r["keys"]) for r in rows]


def predict_language(docs: DataFrame, profiles: list[tuple[str, list[int]]], size: int = 400) -> DataFrame:
    """(doc_id, text) -> doc_id, lang_pred, score, one row per input row; other columns are ignored.

    A null text or one without a letter is `und` with score 0, and so is every text if there are no profiles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Profiles(profiles, size)
        for b in text_chunks(batches):
            found = [model.predict(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    return id_number(bounded_batches(docs).select(id_text(), F.col("text").cast("string")).mapInPandas(
        tidy(run), "doc_id string, lang_pred string, score double"))


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1):
    """True for the documents that training must not see."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold


def keep_languages(docs: DataFrame, profiles: list[tuple[str, list[int]]], size: int = 400, min_score: float = 0.1) -> DataFrame:
    """The rows, with all their columns, whose text has a language: neither `und` nor less alike than min_score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, size)
        for b in batches:
            found = [model.predict(t.as_py()) for t in b.column(text)]
            yield b.filter(pa.array([lang != "und" and score >= min_score for lang, score in found], pa.bool_()))

    text = docs.columns.index("text")
    return bounded_batches(docs).mapInArrow(tidy(run), docs.schema)
