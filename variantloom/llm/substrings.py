"""Removal of repeated byte strings by suffix arrays over anchored shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, mixed, stored, text_chunks, tidy

# --- suffix arrays ---------------------------------------------------------------------------------------------------


def _in_order(keys: np.ndarray) -> np.ndarray:
    """A stable order of non-negative integers."""
    if not len(keys) or keys.max() < 1 << 16:
        return np.argsort(keys.astype(np.uint16), kind="stable")
    bits = len(keys).bit_length()
    packed = np.sort(keys << bits | np.arange(len(keys)))  # sorting values is far faster than sorting places
    return packed & (1 << bits) - 1


def _runs_in_order(text: np.ndarray, at: np.ndarray, stop: np.ndarray, rank: np.ndarray, own: int) -> np.ndarray:
    """The places `at`, all of one type, in the order of their suffixes. From each a run of that type leads to a suffix of
    the other type, at `stop`, whose rank among its like is known. own: 0 for larger, 1 for smaller types, since of two
    suffixes that start alike the larger type comes first.

    All runs are scanned at once, from their far ends: a step sorts by one character the runs that reach so far."""
    far = stop - at
    by = _in_order(far)
    at, stop, ends = at[by], stop[by], np.cumsum(np.bincount(far))
    text = np.r_[text, -1]
    runs, keys = at[:0], at[:0]
    for k in range(len(ends) - 1, 0, -1):
        low, high = ends[k - 1], ends[k]
        fresh = at[low:high][_in_order(rank[stop[low:high]])]
        keys = np.r_[2 * (text[runs + k] + 1) + own, 2 * (text[fresh + k] + 1) + 1 - own]
        runs = np.r_[runs, fresh][_in_order(keys)]
    return runs[_in_order(text[runs])]


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the ordered leftmost-smaller suffixes: all suffixes of the larger type in order, then by these all of the
    smaller type."""
    n = len(text)
    places, rank = np.arange(n), np.zeros(n + 1, np.int64)

    def following(flags: np.ndarray) -> np.ndarray:
        return np.minimum.accumulate(np.where(flags, places, n)[::-1])[::-1]

    rank[lms] = np.arange(1, len(lms) + 1)
    larger = np.flatnonzero(~small)
    larger = _runs_in_order(text, larger, following(small)[larger], rank, 0)
    rank[larger] = np.arange(len(larger))
    smaller = np.flatnonzero(small)
    return larger, _runs_in_order(text, smaller, following(~small)[smaller], rank, 1)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a string of small non-negative integers, in order (a shorter prefix comes first).

    Induced sorting: suffixes are classified as smaller or larger than their successor; the substrings between
    leftmost-smaller places are sorted by one induction and named; the string of names is sorted in the same way, at
    every level, unless all names differ; a second induction from its order gives all suffixes.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    text = text.astype(np.int64)
    differs = np.flatnonzero(text[:-1] != text[1:])
    after = np.searchsorted(differs, np.arange(n))
    ends = np.r_[differs, n - 1]
    stop = ends[np.minimum(after, len(differs))]
    small = np.zeros(n, bool)
    inner = stop < n - 1
    small[inner] = text[stop[inner]] < text[stop[inner] + 1]
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        lms = lms[_lms_order(text, small, lms)]
    larger, smaller = _induce(text, small, lms)
    both = np.r_[larger, smaller]
    return both[_in_order(text[both])]


def _lms_order(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of the leftmost-smaller suffixes, by names of the substrings between them and the order of the names."""
    n = len(text)
    which = np.full(n, -1)
    which[lms] = np.arange(len(lms))
    order = which[_induce(text, small, lms)[1]]
    order = order[order >= 0]
    # equal substrings have equal hashes; each runs to the next leftmost-smaller place, that included
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, 0x9E3779B97F4A7C15 | 1, np.uint64))
        sums = np.r_[np.uint64(0), np.cumsum(mixed(text.astype(np.uint64) + np.uint64(1)) * power)]
        last = np.r_[lms[1:] + 1, n]
        inverse = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
        sums = (sums[last] - sums[lms]) * down[lms]
    length = last - lms
    same = (sums[order[1:]] == sums[order[:-1]]) & (length[order[1:]] == length[order[:-1]])
    same &= (last[order[1:]] != n) & (last[order[:-1]] != n)
    if not same.any():
        return order
    names = np.empty(len(lms), np.int64)
    names[order] = np.cumsum(np.r_[0, ~same])
    return suffix_array(names)


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: at each place the length (up to `most`, counted from the last of starts before it) that
    its suffix shares with the suffix before it in order. Only places whose left neighbours differ, and starts, are
    compared; every other place has one less than the place before."""
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    left = np.r_[-1, text[:-1].astype(np.int64)]
    fresh = (before < 0) | (left != np.where(before > 0, left[before], -2))
    fresh[starts] = True
    fresh[0] = True
    padded = np.zeros(n + 2 * most + 16, np.uint16)
    padded[:n] = text + 1
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n + 2 * most, 8), (2, 1))
    at = np.flatnonzero(fresh)
    size = np.zeros(len(at), np.int64)
    live = np.flatnonzero(before[at] >= 0)
    offset = 0
    while len(live) and offset < most:
        a, b = at[live] + offset, before[at[live]] + offset
        differ = words[a] != words[b]
        stop = differ.any(axis=1)
        size[live] = offset + np.where(stop, differ.argmax(axis=1) // 2, 4)
        live = live[~stop]
        offset += 4
    origin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    out = np.zeros(n, np.int64)
    out[at] = size
    return np.maximum(out[origin] - (np.arange(n) - origin), 0)


def repeated_windows(pieces: list[tuple[bytes, int]], width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For pieces of (bytes, windows): which of its first `windows` windows of `width` bytes occur twice or more among
    all those windows, and a group number for each window (equal windows share one)."""
    size = np.array([len(p) + 1 for p, _ in pieces])
    starts = np.r_[0, np.cumsum(size)[:-1]]
    text = np.zeros(size.sum(), np.uint16)
    for (p, _), s in zip(pieces, starts.tolist(), strict=True):
        text[s : s + len(p)] = np.frombuffer(p, np.uint8).astype(np.uint16) + 1
    order = suffix_array(text)
    shared = common_prefixes(text, order, starts, int(size.max()))
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(shared[order] < width)
    spans = [np.arange(s, s + n) for (_, n), s in zip(pieces, starts.tolist(), strict=True)]
    own = np.concatenate(spans)
    _, inverse, counts = np.unique(group[own], return_inverse=True, return_counts=True)
    flags, cut = counts[inverse] > 1, np.cumsum([n for _, n in pieces])[:-1]
    return np.split(flags, cut), np.split(inverse, cut)


# --- anchors ---------------------------------------------------------------------------------------------------------


def anchors(data: bytes, width: int, gram: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every window of `width` bytes has one anchor: the least of its `gram`-byte hashes, the leftmost if several are.

    Equal windows have equal anchors at equal places. Returns, for each run of windows with one anchor: first window,
    last window + 1, place of the anchor, hash of the anchor."""
    n = len(data) - width + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64)
    h, step = mixed(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)), 1
    while step < gram:
        h = mixed(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
        step *= 2
    bits = np.uint64(len(h).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = h & ~low | np.arange(len(h), dtype=np.uint64)
    span, least, step = width - gram + 1, key, 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: n], least[span - step : span - step + n])
    place = (least & low).astype(np.int64)
    first = np.r_[0, np.flatnonzero(np.diff(place)) + 1]
    return first, np.r_[first[1:], n], place[first], h[place[first]]


ROW = "id long, key long, copies long, anchor long, ctx long, start int, stop int"


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_64_intdigest
        for b in text_chunks(batches, 2_000_000):
            out: list[list] = [[] for _ in range(7)]
            for doc_id, key, copies, text in zip(b["id"], b["key"], b["copies"], b["text"], strict=True):
                data = text.encode()
                first, last, place, h = anchors(data, width)
                if not len(first):
                    continue
                ends, off = (last + (width - 1)).tolist(), (place - first).tolist()
                ctx = np.fromiter((digest(data[s:e], o) for s, e, o in zip(first.tolist(), ends, off)), np.uint64, len(first))
                for x, y in zip(out, (np.full(len(first), doc_id), np.full(len(first), key), np.full(len(first), copies), h.view(np.int64), ctx.view(np.int64), first, last), strict=True):
                    x.append(y)
            if out[0]:
                yield pd.DataFrame({c.split()[0]: np.concatenate(x) for c, x in zip(ROW.split(", "), out, strict=True)})

    return docs.mapInPandas(tidy(run), ROW)


def _windows_hashes(piece: bytes, n: int, width: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(piece[i : i + width]) for i in range(n)), np.uint64, n)


def _ranges(flags: np.ndarray) -> list[int]:
    """Runs of True as a flat list: first, last + 1, ..."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge.tolist()


def remove_repeats(docs: DataFrame, width: int = 200, shard: int = 512, shard_bytes: int = 500_000, max_broadcast: int = 1 << 27,
                   carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept; one row per input row.

    Removed is each UTF-8 byte covered by a `width`-byte string that also starts elsewhere in the table, the same text
    included; spans are the maximal removed runs as (start, end) bytes, kept the remaining bytes. A null text is empty.
    Columns named in `carry` are passed on; all others are dropped. With as_text, kept is a string, without what is
    left of characters that were cut.
    Rows that share a doc_id, or have none, are told apart by their text. Those that agree in both are counted and looked
    at once, and all get the same result.

    Equal strings have equal anchors at equal places, so only texts around anchors that occur twice can repeat. Around
    such an anchor all windows that belong to it are one context. If all its contexts are equal they repeat whole. Else
    one of each kind goes to the anchor's shard, where a suffix array and its common prefixes show the repeated
    windows. An anchor of more than `shard` kinds has several shards; the windows that are new to a shard are then
    compared across its shards by hash, in slices. No group, task or message grows with the copies of a text. The
    tables of contexts and of spans are broadcast up to about `max_broadcast` bytes, else joined by shuffle.
    """
    if clash := {"doc_id", "text", *RESULT_NAMES}.intersection(carry):
        raise ValueError(f"columns to carry have names of results: {sorted(clash)}")
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.struct(*carry).alias("carried") if carry else F.lit(None).cast("int").alias("carried"))
    # a number and a hash of the text tell rows apart; any number will do for rows without doc_id
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(-(1 << 62))), "key": F.xxhash64("text")})

    def sent(df: DataFrame, name: str, entries: Column, entry_bytes: int) -> DataFrame:
        df = stored(df, name)
        n, total = df.agg(F.count("*"), F.coalesce(F.sum(entries), F.lit(0))).first()
        return F.broadcast(df) if 64 * n + entry_bytes * total <= max_broadcast else df

    texts = rows.where(F.octet_length("text") >= width).select("id", "key", "text")
    again = sent(texts.groupBy("id", "key").agg(F.count("*").alias("copies")).where("copies > 1"), "again", F.lit(0), 0)
    alone = texts.withColumn("copies", F.lit(1).cast("long"))
    if again.limit(1).count():
        alone = alone.join(again.drop("copies"), ["id", "key"], "left_anti")
        held = texts.join(again, ["id", "key"]).groupBy("id", "key").agg(F.first("text").alias("text"), F.first("copies").alias("copies"))
        alone = stored(alone.unionByName(held), "texts")
    found = stored(_anchor_rows(alone, width), "anchors")
    # written, so that the joins with them have an exchange on either side and a frequent anchor can be split
    twice = stored(found.groupBy("anchor").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor"), "twice")
    found = stored(found.join(twice, "anchor", "left_semi"), "repeats")
    kinds = stored(found.groupBy("anchor", "ctx").agg(F.sum("copies").alias("n"), F.min(F.struct("id", "key", "start", "stop")).alias("rep")), "kinds")
    per = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")), "per")
    kinds = stored(kinds.join(per, "anchor").withColumn("shards", F.expr(f"cast(ceil(kinds / {shard}) as int)")), "kinds")
    whole = kinds.where("kinds = 1").select("anchor", "ctx", F.expr("array(0, rep.stop - rep.start)").alias("windows"))
    mixed_kinds = kinds.where("kinds > 1").select("anchor", "ctx", "n", "shards", "rep.*")
    per_doc = mixed_kinds.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "ctx", "n", "shards", "start", "stop")).alias("wanted"))
    mine = alone.join(sent(per_doc, "wanted", F.size("wanted"), 48), ["id", "key"]).select("text", "wanted")

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_chunks(batches, 1_000_000):
            out = []
            for text, wanted in zip(b["text"], b["wanted"], strict=True):
                data = text.encode()
                out += [(w["anchor"], w["ctx"] % w["shards"], w["ctx"], w["n"], w["shards"], w["stop"] - w["start"], data[w["start"] : w["stop"] + width - 1]) for w in wanted]
            yield pd.DataFrame(out, columns=["anchor", "part", "ctx", "n", "shards", "windows", "piece"])

    pieces = mine.mapInPandas(tidy(contexts), "anchor long, part int, ctx long, n long, shards int, windows int, piece binary")

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(group: list) -> pd.DataFrame:
            flags, ids = repeated_windows([(r.piece, r.windows) for r in group], width)
            out, seen = [], set()
            slices: dict[tuple[int, int], list] = {}
            for r, flag, own in zip(group, flags, ids, strict=True):
                if r.n > 1:
                    flag[:] = True
                if flag.any():
                    out.append((r.anchor, r.ctx, _ranges(flag), -1, None))
                if r.shards > 1:
                    fresh = np.array([not (i in seen or seen.add(i)) for i in own.tolist()])
                    h = _windows_hashes(r.piece, r.windows, width)
                    for s in range(r.shards):
                        at = np.flatnonzero(fresh & (h % np.uint64(r.shards) == s))
                        if len(at):
                            slices.setdefault((r.anchor, s), []).append(np.stack([h[at], np.full(len(at), r.ctx, np.int64).view(np.uint64), at.astype(np.uint64)], 1))
            out += [(a, 0, None, s, np.concatenate(x).tobytes()) for (a, s), x in slices.items()]
            return pd.DataFrame(out, columns=["anchor", "ctx", "windows", "slice", "hashes"])

        group, size, key = [], 0, None
        for b in batches:
            for r in b.itertuples(index=False):
                if (r.anchor, r.part) != key and size > shard_bytes:
                    yield solve(group)
                    group, size = [], 0
                key = (r.anchor, r.part)
                group.append(r)
                size += len(r.piece)
        if group:
            yield solve(group)

    solved = stored(pieces.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "ctx").mapInPandas(
        tidy(arrays), "anchor long, ctx long, windows array<int>, slice int, hashes binary"), "solved")

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(anchor: int, blobs: list[bytes]) -> pd.DataFrame:
            t = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, 3)
            _, inverse, counts = np.unique(t[:, 0], return_inverse=True, return_counts=True)
            t = t[counts[inverse] > 1]
            return pd.DataFrame([(anchor, int(c), [int(i), int(i) + 1]) for c, i in zip(t[:, 1].view(np.int64) if len(t) else [], t[:, 2])], columns=["anchor", "ctx", "windows"])

        key, blobs = None, []
        for b in batches:
            for r in b.itertuples(index=False):
                if (r.anchor, r.slice) != key:
                    if blobs:
                        yield solve(key[0], blobs)
                    key, blobs = (r.anchor, r.slice), []
                blobs.append(r.hashes)
        if blobs:
            yield solve(key[0], blobs)

    # A window that repeats across shards but not in its own is new to its shard; so is one of those it repeats.
    cross = (solved.where("slice >= 0").select("anchor", "slice", "hashes").repartition("anchor", "slice").sortWithinPartitions("anchor", "slice")
             .mapInPandas(tidy(across), "anchor long, ctx long, windows array<int>"))
    cover = whole.unionByName(solved.where("slice < 0").select("anchor", "ctx", "windows")).unionByName(cross)
    hits = found.join(cover, ["anchor", "ctx"]).select("id", "key", F.transform("windows", lambda w: w + F.col("start")).alias("windows"))
    spans = hits.groupBy("id", "key").agg(F.flatten(F.collect_list("windows")).alias("windows"))
    joined = rows.join(sent(spans, "spans", F.size("windows"), 4), ["id", "key"], "left").select("doc_id", "text", "windows", "carried")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                texts, windows = b.column(1), b.column(2)
                out = [_cut(t.as_py().encode(), w.values.to_numpy() if w.is_valid else None, width) for t, w in zip(texts, windows, strict=True)]
                if as_text:
                    out = [(*x[:-1], x[-1].decode("utf-8", "ignore")) for x in out]
                cols = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols, b.column(3)], ["doc_id", *RESULT_NAMES, "carried"])

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string() if as_text else pa.binary()]
    done = joined.mapInArrow(tidy(cut), f"doc_id long, {RESULT}{'string' if as_text else 'binary'}, carried {dict(joined.dtypes)['carried']}")
    return done.select("doc_id", *RESULT_NAMES, *(F.col(f"carried.`{c}`") for c in carry))


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: int, end: int>>, kept "

RESULT_NAMES = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")


def _cut(data: bytes, windows: np.ndarray | None, width: int) -> tuple:
    """The fields of RESULT for a text and the ranges of its repeated windows."""
    runs: list[int] = []
    if windows is not None:
        w = windows.reshape(-1, 2)
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, w[:, 0], 1)
        np.add.at(edge, w[:, 1] + width - 1, -1)
        runs = _ranges(np.cumsum(edge)[:-1] > 0)
    at = [0, *runs, len(data)]
    kept = b"".join(data[s:e] for s, e in zip(at[::2], at[1::2], strict=True))
    spans = [{"start": s, "end": e} for s, e in zip(runs[::2], runs[1::2], strict=True)]
    return len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept
