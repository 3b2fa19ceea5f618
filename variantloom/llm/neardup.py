"""Near-duplicate classes by BagMinHash signatures, banding and exact multiset overlap."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WordHash, bounded_batches, components, mixed, shingles, stored, text_chunks, tidy, words_of

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def bag_min_hash(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Signatures (len(bags), size) of bags of (element hashes, counts): two agree in a place with the probability of
    their weighted Jaccard similarity. Empty bags give infinities.

    The weights of an element are split at 1, 2, 4, 8, ...; each part has a Poisson process with its width as rate,
    whose points carry a random place of the signature and a random weight level, and count if that level is below the
    element's count. Points come in increasing order, so a process ends once it is beyond the largest value of its
    bag's signature: little more is drawn than the points that matter.
    """
    sig = np.full((len(bags), size), np.inf)
    flat = sig.reshape(-1)
    keys, counts = (np.concatenate([b[i] for b in bags]) if bags else np.zeros(0) for i in (0, 1))
    bag = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    keys, counts = keys.astype(np.uint64), counts.astype(np.int64)
    parts, low, width = [], 0, 1
    while True:
        at = np.flatnonzero(counts > low)
        if not len(at):
            break
        parts.append((bag[at], mixed(keys[at] + np.uint64(low * int(GOLDEN) % 2**64)), counts[at], np.full(len(at), low), np.full(len(at), width)))
        low, width = low + width, max(1, low + width)
    if not parts:
        return sig
    bag, state, counts, low, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    x = np.zeros(len(bag))
    while len(bag):
        state = state + GOLDEN
        r = mixed(state)
        x = x - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
        r = mixed(r ^ GOLDEN)
        place = ((r >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        level = low + ((r & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        ok = level < counts
        np.minimum.at(flat, bag[ok] * size + place[ok], x[ok])
        live, back = np.unique(bag, return_inverse=True)
        go = x < sig[live].max(axis=1)[back]
        bag, state, counts, low, width, x = bag[go], state[go], counts[go], low[go], width[go], x[go]
    return sig


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """(n, bands) keys: equal where all places of the band agree (values are compared as 32-bit floats)."""
    bits = sig.astype(np.float32).view(np.uint32).reshape(len(sig), bands, -1).astype(np.uint64)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (len(sig), 1))
    for i in range(bits.shape[2]):
        out = mixed(out * GOLDEN + bits[:, :, i])
    return out


def sketch(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(id, key, text) -> id, key, h1, h2 (hash of the word sequence), bands (none for a text without words)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = WordHash()
        for b in text_chunks(batches, 2_000_000):
            words = [words_of(t) for t in b["text"]]
            seq = [divmod(xxhash.xxh3_128_intdigest(" ".join(w)), 1 << 64) for w in words]
            bags = [np.unique(shingles(h.of(w), width), return_counts=True) for w in words]
            keys = band_keys(bag_min_hash(bags, bands * rows), bands).view(np.int64)
            yield pd.DataFrame({
                "id": b["id"].to_numpy(), "key": b["key"].to_numpy(), "h1": np.array([s[0] for s in seq], np.uint64).view(np.int64), "h2": np.array([s[1] for s in seq], np.uint64).view(np.int64),
                "bands": [k if len(bag[0]) else k[:0] for k, bag in zip(keys, bags, strict=True)]})

    return docs.select("id", "key", "text").mapInPandas(tidy(run), "id long, key long, h1 long, h2 long, bands array<long>")


def bag_units(hashes: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th copy of a hash becomes a hash of its own."""
    hashes = np.sort(hashes)
    first = np.r_[True, hashes[1:] != hashes[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))
    return np.sort(mixed(hashes + (np.arange(len(hashes)) - start).astype(np.uint64) * GOLDEN))


def overlap_edges(nodes: list, sets: list[np.ndarray], side: np.ndarray, threshold: float) -> list[tuple]:
    """A spanning forest of the pairs with multiset Jaccard >= threshold, as (node, node, similarity); side: 0 and 1, or
    all 0 for pairs within. Overlaps are counted by the posting lists of the hashes, all pairs that share one being covered."""
    n, size = len(sets), np.array([len(s) for s in sets])
    if n < 2:
        return []
    owner = np.repeat(np.arange(n), size)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    owner_by_id, starts = owner[order], np.r_[0, np.cumsum(np.bincount(ids))]
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out, at, cross = [], np.r_[0, np.cumsum(size)], side.any()
    for i in range(n - 1):
        if cross and side[i]:
            continue
        own = ids[at[i] : at[i + 1]]
        own = own[starts[own + 1] - starts[own] > 1]
        if not len(own):
            continue
        shared = np.bincount(np.concatenate([owner_by_id[s:e] for s, e in zip(starts[own].tolist(), starts[own + 1].tolist())]), minlength=n)
        hit = shared >= threshold * (size + size[i] - shared) - 1e-9
        hit[i] = False
        hit &= side == 1 if cross else np.arange(n) > i
        for j in np.flatnonzero(hit).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[a] = b
                out.append((nodes[i], nodes[j], float(shared[j] / (size[i] + size[j] - shared[j]))))
    return out


def _similar(pairs: DataFrame, sets: DataFrame, heap: int) -> DataFrame:
    """Distinct pairs (a, b) of nodes -> a, b, similarity by their sets (node, units). A node that is a in over `heap`
    pairs has its set sent to several parts of about so many pairs each."""
    crowds = pairs.groupBy("a").agg(F.expr(f"cast(ceil(count(*) / {heap}) as int)").alias("parts")).where("parts > 1")
    dealt = pairs.join(crowds, "a", "left").select("a", "b", F.expr("if(parts is null, 0, cast(pmod(xxhash64(b), parts) as int))").alias("part"))
    left = sets.select(F.col("node").alias("a"), F.col("units").alias("ua")).join(crowds, "a", "left")
    left = left.select("a", "ua", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")).alias("part"))
    both = dealt.join(sets.select(F.col("node").alias("b"), F.col("units").alias("ub")), "b").join(left, ["a", "part"])
    shared = F.size(F.array_intersect("ua", "ub"))
    return both.select("a", "b", (shared / (F.size("ua") + F.size("ub") - shared)).alias("similarity"))


def _several(held: DataFrame) -> DataFrame:
    """Rows (band, node, group) of the bands that hold several groups."""
    several = held.groupBy("band").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high").select("band")
    return held.join(several, "band", "left_semi")


def _stars(held: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): in each band a is a text of the largest group there, b each text of another group. A hash that is the
    same for all bands chooses among equal groups and within the group, another one at each turn."""
    chance = F.xxhash64("node", F.lit(turn))
    best = held.groupBy("band", "group").agg(F.count("*").alias("n"), F.min(F.struct(chance.alias("h"), "node")).alias("x"))
    top = best.groupBy("band").agg(F.max(F.struct("n", "x", "group")).alias("top")).select("band", F.col("top.x.node").alias("a"), F.col("top.group").alias("own"))
    return held.join(top, "band").where("group != own").select("a", F.col("node").alias("b")).distinct()


def _merged(held: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (band, node, group) after the groups that edges (a, b) join have become one, under the least group."""
    of = held.select("node", "group").distinct()
    a, b = of.select(F.col("node").alias("a"), F.col("group").alias("ga")), of.select(F.col("node").alias("b"), F.col("group").alias("gb"))
    labels = components(edges.join(a, "a").join(b, "b").select(F.col("ga").alias("a"), F.col("gb").alias("b")), "links")
    return held.join(labels.withColumnRenamed("node", "group"), "group", "left").select("band", "node", F.coalesce("label", "group").alias("group"))


def _blocks(cand: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """Components (node, label) and groups (node, group) -> label, lo, hi, side, node: what a task compares, all pairs
    of side 0 with side 1, or all pairs where lo is hi. Pairs within the largest group of a component are left out, as
    their class is known: its blocks meet those of the others only."""
    x = cand.join(groups, "node")
    count = x.groupBy("label", "group").agg(F.count("*").alias("n"))
    size = count.groupBy("label").agg(F.max(F.struct("n", "group")).alias("top"), F.sum("n").alias("n"))
    size = size.select("label", F.expr("if(top.n > 1, top.group, null)").alias("big"), F.expr(f"cast(ceil(if(top.n > 1, top.n, 0) / {block}) as int)").alias("nb"), F.expr(f"cast(ceil((n - if(top.n > 1, top.n, 0)) / {block}) as int)").alias("na"))
    x = x.join(size, "label").withColumn("known", F.expr("group <=> big"))
    x = x.withColumn("own", F.expr("cast(if(known, na + pmod(xxhash64(node), nb), pmod(xxhash64(node), greatest(na, 1))) as int)"))
    other = F.explode(F.expr("if(known, if(na > 0, sequence(0, na - 1), array()), sequence(0, na + nb - 1))"))
    x = x.select("label", "node", "own", other.alias("other"))
    return x.select("label", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.expr("cast(own > other as int)").alias("side"), "node")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, bands: int = 36, rows: int = 7, block: int = 1024,
                    rounds: int = 2, max_broadcast: int = 500_000) -> DataFrame:
    """(doc_id, text) -> doc_id, class_id (the least doc_id of its class), text_key and class_key (xxhash64 of the text of
    the row, and of the row of class_id), linked_id (the doc_id of the text it was verified with; null if it is the
    first of its class) and similarity to that text; one row per input row.

    Texts are bags of `width`-word shingles of their lower-cased words. Links are pairs of texts with weighted Jaccard
    similarity of at least `threshold`; classes are the connected components. Equal word sequences are one class from
    the start. One row of each sequence goes on, as a set of shingles written once: texts that agree in a band (at 0.8 a
    pair agrees in none of 36 with probability 0.0002) are candidates. While over `block` texts are in bands that hold
    several groups, each of them is compared with one text of the largest group of each of its bands, at most `rounds`
    times: copies of one, however many, are linked by a few comparisons each. Within the components of what is left all
    overlaps between groups are counted exactly: beyond `block` texts each pair of blocks is a task of its own. No link
    between texts of a band is left out.

    Texts without words (null, empty) are classes of their own. Rows are told apart by doc_id and text: those that share
    a doc_id are in the classes of their texts, those without doc_id have the class_id of their class, null if none of
    it has one, and come last in it. Other columns are ignored.
    """
    last = (1 << 63) - 1  # stands for a missing id
    docs = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.select(F.coalesce("doc_id", F.lit(last)).alias("id"), F.xxhash64("text").alias("key"), "text")
    sk = stored(sketch(docs, width, bands, rows), "sketch")
    full = sk.where("size(bands) > 0")
    # h1, a 64-bit hash, is the node of a word sequence; rep is the row that stands for it
    reps = stored(full.groupBy("h1", "h2").agg(F.min(F.struct("id", "key")).alias("rep"), F.first("bands").alias("bands")).withColumn("node", F.col("h1")), "reps")
    keyed = reps.select("node", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    # a band with one text for each of its nodes and the group that each is in so far
    held = stored(keyed.join(buckets, "band").select("band", "node", F.col("node").alias("group")), "held")
    nodes = stored(held.select("node").distinct().join(reps, "node").select("node", "rep.id", "rep.key"), "nodes")
    wanted = docs.join(F.broadcast(nodes) if nodes.count() <= max_broadcast else nodes, ["id", "key"])

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = WordHash()
        for b in text_chunks(batches, 1_000_000):
            yield pd.DataFrame({"node": b["node"], "units": [bag_units(shingles(h.of(words_of(t)), width)).view(np.int64) for t in b["text"]]})

    sets = wanted.select("node", "text").mapInPandas(tidy(bags), "node long, units array<long>")
    sets = stored(sets.groupBy("node").agg(F.first("units").alias("units")), "sets")  # a row may be there twice
    edges = []
    for r in range(rounds):
        if _several(held).select("node").distinct().count() <= block:
            break
        edges.append(stored(_similar(_stars(held, r), sets, block).where(F.col("similarity") >= threshold - 1e-9), "stars"))
        held = stored(_merged(held, edges[-1]), "held")
    rest = stored(_several(held), "rest")
    first = rest.groupBy("band").agg(F.min("node").alias("lead"))
    cand = components(rest.join(first, "band").select(F.col("lead").alias("a"), F.col("node").alias("b")), "cand")
    work = _blocks(cand, rest.select("node", "group").distinct(), block).join(sets, "node")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, nodes, sets, side = None, [], [], []

        def done() -> pd.DataFrame:
            return pd.DataFrame(overlap_edges(nodes, sets, np.array(side), threshold), columns=["a", "b", "similarity"])

        for b in batches:
            for r in b.itertuples(index=False):
                if (r.label, r.lo, r.hi) != part:
                    if len(nodes) > 1:
                        yield done()
                    part, nodes, sets, side = (r.label, r.lo, r.hi), [], [], []
                nodes.append(r.node)
                sets.append(r.units.view(np.uint64))
                side.append(r.side)
        if len(nodes) > 1:
            yield done()

    more = work.repartition("label", "lo", "hi").sortWithinPartitions("label", "lo", "hi", "node").mapInPandas(tidy(verify), "a long, b long, similarity double")
    edges.append(stored(more, "more"))
    labels = _merged(held, edges[-1]).select("node", F.col("group").alias("label")).distinct()
    labels = stored(labels.join(reps.select("node", "rep"), "node"), "labels")
    classes = labels.join(labels.groupBy("label").agg(F.min("rep").alias("first")), "label").select("node", "first")
    edges = functools.reduce(DataFrame.unionByName, edges)
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other"), "similarity").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"), "similarity"))
    ends = ends.join(labels.select(F.col("node").alias("other"), F.col("rep").alias("to")), "other")
    link = ends.groupBy("node").agg(F.max(F.struct("similarity", (-F.col("to.id")).alias("i"))).alias("link"))
    by_text = reps.join(classes, "node", "left").join(link, "node", "left").select("h1", "h2", "rep", F.coalesce("first", "rep").alias("first"), "link", F.lit(1).alias("full"))
    out = sk.select("id", "key", "h1", "h2", F.expr("if(size(bands) > 0, 1, 0)").alias("full")).join(by_text, ["h1", "h2", "full"], "left")
    state = "case when rep is null or (id = first.id and key = first.key) then 0 when id = rep.id and key = rep.key then 1 else 2 end"
    number = lambda c: F.expr(f"nullif({c}, {last}L)")
    return out.withColumn("state", F.expr(state)).select(
        number("id").alias("doc_id"), number("coalesce(first.id, id)").alias("class_id"), F.col("key").alias("text_key"), F.expr("coalesce(first.key, key)").alias("class_key"),
        number("case state when 1 then -link.i when 2 then rep.id end").alias("linked_id"), F.expr("case state when 1 then link.similarity when 2 then 1.0D end").alias("similarity"))
