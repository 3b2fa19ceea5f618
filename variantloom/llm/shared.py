"""Helpers that several text operators use."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import shared_dir, stored
from ..operators.graph import components

__all__ = ["WORD", "WordHash", "bounded_batches", "components", "id_number", "id_text", "mixed", "shared_dir", "shingles", "spread", "stored", "table", "text_chunks", "tidy", "words_of"]

WORD = re.compile(r"\w+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out over all cores where its files come in fewer partitions than that (a small table in one file)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_batches(df: DataFrame, rows: int = 512) -> DataFrame:
    """df, after the session has been told to send at most `rows` rows at a time to Python: texts can be long, and a
    batch is held several times over by the executor and its workers. The setting stays, as plans are made later."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return df


def id_text(name: str = "doc_id") -> Column:
    """An integer id as text: beside a null, pandas would hold integers as floats and lose the last digits of large ones."""
    return F.col(name).cast("long").cast("string").alias(name)


def id_number(df: DataFrame, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function over the batches of a task, which hands freed memory back to the system at its end: workers stay
    for the next task or stage, and what they hold beside the executor's heap adds up."""

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


class WordHash(dict):
    """word -> 64-bit hash; emptied before it outgrows its bound."""

    bound = 200_000

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > self.bound:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores; none of a null text."""
    return WORD.findall(text.lower()) if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of the width-word windows; a shorter non-empty text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, 0x9E3779B97F4A7C15 + width, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - width + 1 + i])
    return out


def text_chunks(batches: Iterator[pd.DataFrame], chars: int = 4_000_000, col: str = "text") -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into pieces of bounded text size (one row at least)."""
    for b in batches:
        if not len(b):
            continue
        size = b[col].str.len().fillna(0).to_numpy(np.int64)
        cut = np.cumsum(size) // chars
        for start, stop in zip(
            np.r_[0, np.flatnonzero(np.diff(cut)) + 1], np.r_[np.flatnonzero(np.diff(cut)) + 1, len(b)], strict=True
        ):
            yield b.iloc[int(start) : int(stop)]
