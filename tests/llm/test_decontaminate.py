"""Verification and seeds of decontamination against enumerations."""

import random
from itertools import combinations

import numpy as np

from variantloom.llm.decontaminate import MASKS, _verified, contaminated, masks_for, overlap, seed_hashes


def changed(n, places):
    t = np.arange(1, n + 1, dtype=np.uint64)
    t[list(places)] = 0
    return t


def held(doc, item, shift):
    """Whether any stretch on the diagonal has at least 13 tokens (or the item) with four fifths equal: all are tried."""
    same = [int(0 <= i + shift < len(doc) and item[i] == doc[i + shift]) for i in range(len(item))]
    inside = [i for i in range(len(item)) if 0 <= i + shift < len(doc)]
    least = min(13, len(item))
    if 5 * sum(same) < 4 * least:
        return False
    return any(5 * sum(same[i : j + 1]) >= 4 * (j + 1 - i) for i in inside for j in inside if j + 1 - i >= least)


def test_every_placement_of_changes_is_verified():
    for n, k in ((13, 2), (15, 3), (19, 3), (10, 2), (5, 1)):
        item = changed(n, ())
        missed = [c for c in combinations(range(n), k) if not _verified(0, changed(n, c), {(1, 0)}, {1: item}, 13, 0.8)]
        assert missed == [], (n, k, len(missed))
    assert not _verified(0, changed(13, (0, 6, 12)), {(1, 0)}, {1: changed(13, ())}, 13, 0.8)


def test_verified_as_by_all_stretches():
    rng, seen = random.Random(3), set()
    for _ in range(1500):
        item = np.arange(1, rng.randint(1, 40) + 1, dtype=np.uint64)
        doc = np.array([t if rng.random() < 0.78 else 0 for t in item], np.uint64)[rng.randint(0, 3) :]
        shift = int(item[len(item) - len(doc) - 1] != 0) * -(len(item) - len(doc)) if len(doc) else 0
        got = _verified(0, doc, {(1, shift)}, {1: item}, 13, 0.8)
        assert bool(got) == held(doc, item, shift)
        seen.add(bool(got))
        if got:
            _, _, matched, length, at, item_at = got[0]
            assert length >= min(13, len(item)) and 5 * matched >= 4 * length and at - item_at == shift
            assert matched == int((doc[at : at + length] == item[item_at : item_at + length]).sum())
    assert seen == {True, False}
    assert overlap(np.zeros(0, np.uint64), np.ones(3, np.uint64), 0)[:2] == (0, 0)


def test_every_placement_of_changes_has_a_seed():
    """All changes of the shortest stretches that allow so many; any longer one of up to 25 tokens holds one of these."""
    for n, k in [(n, n // 5) for n in range(1, 13)] + [(13, 2), (15, 3), (20, 4), (25, 5)]:
        gone = np.array([sum(1 << i for i in c) for c in combinations(range(n), k)], np.int64)
        hit = np.zeros(len(gone), bool)
        for m in masks_for(n, MASKS):
            bits = sum(1 << i for i, b in enumerate(m) if b == "1")
            for at in range(n - len(m) + 1):
                hit |= gone & (bits << at) == 0
        assert hit.all(), (n, k, int((~hit).sum()))
    a, b = changed(13, ()), changed(13, (4, 8))
    assert any((seed_hashes(a, m) == seed_hashes(b, m)).any() for m in MASKS)


def test_changed_copies_are_found(spark):
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in (3, 5, 8, 11, 12, 13, 15, 20, 25)]
    rng, docs = random.Random(5), []
    for n, text in items:
        for _ in range(12):
            t = text.split()
            for i in rng.sample(range(n), n // 5):
                t[i] = "other"
            docs.append((len(docs), "some words before " + " ".join(t) + " and after", n))
    dd, ii = spark.createDataFrame(docs, "doc_id long, text string, n int"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, n) for d, _, n in docs}
    for most in (1_000_000, 0):
        assert {(r.doc_id, r.item_id) for r in contaminated(dd, ii, max_broadcast_tokens=most).collect()} == want


def test_both_ways_agree_on_odd_texts(spark):
    """Combining marks, which parts of a word are tokens in one engine and not in another; null and repeated ids; ties."""
    hindi = ["हिन्दी में एक छोटा वाक्य", "दूसरी पंक्ति भी यहाँ है"]
    accents = "cafe\u0301 re\u0301sume\u0301 nai\u0308ve co\u0308operate e\u0301te\u0301"
    items = [(1, hindi[0]), (2, hindi[1]), (3, accents), (4, "ab"), (5, " ".join(f"t{i}" for i in range(14))), (5, "zzz zzz"), (6, None), (None, "ab")]
    docs = [(1, hindi[0] + " और"), (2, "पहले " + hindi[1]), (3, "x " + accents + " y"), (None, "see ab here"), (None, "see ab here"), (7, "ab"), (7, "ab ab"), (8, ""), (9, None), (10, "clean text of no item at all")]
    dd = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    ii = spark.createDataFrame(items, "item_id long, text string")
    one, joined, shuffled = (sorted(map(str, contaminated(dd, ii, **how).collect())) for how in ({}, {"max_broadcast_tokens": 0}, {"max_broadcast_tokens": 0, "max_broadcast_seeds": 0}))
    assert one == joined == shuffled
    found = sorted((str(r.doc_id), r.item_id) for r in contaminated(dd, ii).collect())
    assert found == [("1", 1), ("2", 2), ("3", 3), ("7", 4), ("7", 4), ("None", 4), ("None", 4)]
    first = [r for r in contaminated(dd, ii).collect() if r.doc_id == 7]
    assert {r.doc_start for r in first} == {0}


def test_a_very_long_text(spark):
    item = " ".join(f"i{k}" for k in range(20))
    long = "word soup " * 60_000 + item.replace("i7", "j7") + " and on " * 60_000
    dd, ii = spark.createDataFrame([(1, long), (2, long[:500_000])], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    for most in (1_000_000, 0):
        got = contaminated(dd, ii, max_broadcast_tokens=most).collect()
        assert [(r.doc_id, r.matched, r.length, r.doc_start) for r in got] == [(1, 19, 20, 120_000)]
