"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WordHash, bounded_batches, id_number, id_text, mixed, stored, text_chunks, tidy, words_of

#: Six tokens count; those under zeros may differ. Any stretch of 13 tokens or more with 80 % equal has a hit: one of
#: over 25 tokens has a half of that kind, and tests/llm/test_decontaminate.py tries all changes of the shorter ones.
MASKS = ("11010111", "11100010011", "11001001101", "1111101")
#: The masks of items of 5 to 12 tokens, which hit any placement of up to a fifth of changes; shorter items have none to spare.
SHORT = {5: ("1111", "11101", "11011", "10111"), 6: ("1111", "11011"), 7: ("11011",), 8: ("1111",), 9: ("111011",),
         10: ("11101", "1111"), 11: ("11101",), 12: ("111011", "11111")}
HIT = "doc_id string, item_id long, matched int, length int, doc_start int, item_start int"


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each place of the mask along the tokens; tokens under zeros do not matter."""
    n = len(tokens) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.full(n, int(mask, 2) | len(mask) << 32, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ tokens[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return mixed(out)


def masks_for(n: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """The masks of an item of n tokens: those given, or shorter ones if it is shorter than 13 tokens."""
    return masks if n > max(SHORT) else SHORT.get(n, ("1" * n,) if n else ())


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, penalty: float = 2.0, min_tokens: int = 13, min_share: float = 0.8) -> tuple[int, int, int, int]:
    """Best gapless stretch of item against doc[shift:]: equal tokens count 1, others -penalty. If that one is shorter
    than min_tokens (and than the item) or has less than min_share equal, the longest stretch with that share.

    Returns tokens matched, length, start in doc, start in item."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    same = item[lo:hi] == doc[lo + shift : hi + shift]
    gain = np.r_[0.0, np.cumsum(np.where(same, 1.0, -penalty))]
    low = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - low))
    start = int(np.flatnonzero(gain[: end + 1] == low[end])[-1])
    if not _enough(int(same[start:end].sum()), end - start, len(item), min_tokens, min_share):
        over = np.r_[0.0, np.cumsum(same - min_share)]
        later = np.maximum.accumulate(over[::-1])[::-1]
        last = np.searchsorted(-later, 1e-9 - over, "right") - 1  # the last place with as much as each start, within rounding
        start = int(np.argmax(last - np.arange(len(over))))
        end = int(last[start])
    return int(same[start:end].sum()), end - start, lo + start + shift, lo + start


def _enough(matched: int, length: int, n: int, min_tokens: int, min_share: float) -> bool:
    return length >= min(min_tokens, n) and matched >= min_share * length - 1e-9


def _verified(doc_id: int, doc: np.ndarray, pairs: set[tuple[int, int]], items: dict, min_tokens: int, min_share: float) -> list[tuple]:
    best: dict[int, tuple] = {}
    for item_id, shift in pairs:
        item = items[item_id]
        matched, length, at, item_at = overlap(doc, item, shift, min_tokens=min_tokens, min_share=min_share)
        if _enough(matched, length, len(item), min_tokens, min_share):
            found = (matched, -length, -at, -item_at)
            best[item_id] = max(best.get(item_id, found), found)
    return [(doc_id, i, m, -n, -a, -b) for i, (m, n, a, b) in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tokens: int = 13, min_share: float = 0.8,
                 masks: tuple[str, ...] = MASKS, max_broadcast_tokens: int = 1_000_000, max_broadcast_seeds: int = 1_000_000) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> the best overlap of each document and item that it holds, as
    doc_id, item_id, matched, length, doc_start, item_start (tokens); documents without overlap have no row.

    A document holds an item if a gapless stretch of at least min_tokens tokens (or all tokens of a shorter item)
    agrees in min_share of its tokens. Candidates share a masked hash; the default masks miss none of at least 13 tokens
    (or a shorter item) with 80 % equal, while a lower min_tokens or min_share can lose some. Benchmarks of at most max_broadcast_tokens
    tokens are sent to every task as an array; larger ones are joined by hash, with the same results. Null or empty texts
    and items have no overlap. Rows that repeat a doc_id give one row each, rows without doc_id rows without it; of items
    that repeat an item_id one row is used. Of several overlaps of a document and an item that with the most equal tokens
    is taken, then the shortest, then the first in the document. Other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    docs = bounded_batches(docs).select(id_text(), F.col("text").cast("string")).where("text is not null")
    size = items.agg(F.sum(F.length("text")), F.count("*")).first()
    if (size[0] or 0) <= 2 * max_broadcast_tokens:  # a token and what parts it take two characters at least
        return id_number(_by_array(spark, docs, items, min_tokens, min_share, masks))
    return id_number(_by_join(docs, items, min_tokens, min_share, masks, max_broadcast_seeds))


def _by_array(spark, docs: DataFrame, items: DataFrame, min_tokens: int, min_share: float, masks: tuple[str, ...]) -> DataFrame:
    h = WordHash()
    tokens = {r["item_id"]: t for r in items.collect() if len(t := h.of(words_of(r["text"])))}
    used = sorted({m for t in tokens.values() for m in masks_for(len(t), masks)})
    keys, who, where = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for item_id, t in sorted(tokens.items()):
        for mask in masks_for(len(t), masks):
            s = seed_hashes(t, mask)
            keys.append(s)
            who.append(np.full(len(s), item_id))
            where.append(np.arange(len(s)))
    keys, who, where = map(np.concatenate, (keys, who, where))
    order = np.argsort(keys, kind="stable")
    data = spark.sparkContext.broadcast((keys[order], who[order], where[order], tokens, used))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, who, where, tokens, used = data.value
        bits = max(16, int(len(keys)).bit_length() + 5)
        seen = np.zeros(1 << bits, bool)
        seen[keys >> np.uint64(64 - bits)] = True
        h = WordHash()
        for b in text_chunks(batches):
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                doc = h.of(words_of(text))
                pairs = set()
                for mask in used:
                    s = seed_hashes(doc, mask)
                    at = np.flatnonzero(seen[s >> np.uint64(64 - bits)])
                    if len(at):
                        first, last = np.searchsorted(keys, s[at], "left"), np.searchsorted(keys, s[at], "right")
                        for p, x, y in zip(at[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist()):
                            pairs.update((int(who[k]), p - int(where[k])) for k in range(x, y))
                if pairs:
                    rows += _verified(doc_id, doc, pairs, tokens, min_tokens, min_share)
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in HIT.split(", ")])

    return docs.mapInPandas(tidy(run), HIT)


def _by_join(docs: DataFrame, items: DataFrame, min_tokens: int, min_share: float, masks: tuple[str, ...], max_broadcast_seeds: int) -> DataFrame:
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_chunks(batches):
            yield pd.DataFrame({"n": sorted({min(len(words_of(t)), max(SHORT) + 1) for t in b["text"]})})

    lengths = [r["n"] for r in items.mapInPandas(tidy(counted), "n int").distinct().collect()]  # as many as SHORT has, and one
    used = sorted({m for n in lengths for m in masks_for(n, masks)})

    def seeds(key: str, whole: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            h = WordHash()
            for b in text_chunks(batches, 200_000):
                out = []
                for row, i, text in zip(b["row"], b[key], b["text"], strict=True):
                    t = h.of(words_of(text))
                    for mask in masks_for(len(t), masks) if whole else used:
                        s = seed_hashes(t, mask).view(np.int64)
                        out.append(pd.DataFrame({"row": row, key: i, "seed": s, key[:-3] + "_at": np.arange(len(s))}))
                if out:
                    yield pd.concat(out)
        return run

    docs = stored(docs.withColumn("row", F.monotonically_increasing_id()), "docs")
    items = items.withColumn("row", F.lit(0).cast("long"))
    left = docs.mapInPandas(tidy(seeds("doc_id", False)), "row long, doc_id string, seed long, doc_at long")
    right = stored(items.mapInPandas(tidy(seeds("item_id", True)), "row long, item_id long, seed long, item_at long").drop("row"), "seeds")
    if right.count() <= max_broadcast_seeds:  # some 100 bytes each; then no seed of a document is shuffled
        right = F.broadcast(right)
    hits = left.join(right, "seed").select("row", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
    pairs = hits.join(docs, "row").join(items.select("item_id", F.col("text").alias("item")), "item_id")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = WordHash()
        for b in text_chunks(batches):
            rows = []
            for r in b.itertuples():
                doc, item = h.of(words_of(r.text)), h.of(words_of(r.item))
                rows += [(r.row, *x) for x in _verified(r.doc_id, doc, {(r.item_id, r.shift)}, {r.item_id: item}, min_tokens, min_share)]
            yield pd.DataFrame(rows, columns=["row", *(x.split()[0] for x in HIT.split(", "))])

    best = F.max(F.struct("matched", (-F.col("length")).alias("n"), (-F.col("doc_start")).alias("a"), (-F.col("item_start")).alias("b"))).alias("x")
    found = pairs.mapInPandas(tidy(verify), "row long, " + HIT).groupBy("row", "doc_id", "item_id").agg(best)
    neg = lambda c: (-F.col(f"x.{c}")).cast("int")
    return found.select("doc_id", "item_id", "x.matched", neg("n").alias("length"), neg("a").alias("doc_start"), neg("b").alias("item_start"))
