import random
from collections import Counter

import numpy as np
import pytest

from variantloom.llm.neardup import bag_min_hash, bag_units, near_duplicates, overlap_edges
from variantloom.llm.shared import components, shingles, words_of


def similarity(a, b):
    both, all_ = sum((a & b).values()), sum((a | b).values())
    return both / all_ if all_ else 0.0


def bag(text, width=5):
    w = words_of(text)
    n = min(width, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 60), rng.integers(0, 12, 60)
    bags = [(keys, a), (keys[b > 0], b[b > 0]), (keys[:0], b[:0])]
    sig = bag_min_hash(bags, 6000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    assert np.isinf(sig[2]).all()


def test_units_count_copies():
    x = np.array([5, 5, 7], np.uint64)
    y = np.array([5, 7, 7], np.uint64)
    assert len(np.intersect1d(bag_units(x), bag_units(y))) == 2


def labels_by_brute_force(rows, threshold):
    """(doc_id, class_id) of each row: all pairs are compared, classes are named after their least id, nulls coming last."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and similarity(bags[i], bags[j]) >= threshold:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i)) if bags[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [1024, 7])
def test_against_brute_force(spark, block):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "one", "One!", "a b", "...", "one"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += ["la " * 500, "la " * 430, "la " * 300]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, label int").repartition(4)
    got = near_duplicates(df, block=block, max_broadcast=0 if block == 7 else 500_000)
    assert got.columns == ["doc_id", "class_id", "text_key", "class_key", "linked_id", "similarity"]
    found = got.collect()
    assert sorted([(r.doc_id, r.class_id) for r in found], key=str) == labels_by_brute_force(rows, 0.8)
    text = dict(rows)
    for r in found:  # every row but the first of a class has a link of its own, with the right similarity
        assert (r.linked_id is None) == (r.similarity is None) == (r.class_id == r.doc_id)
        if r.linked_id is not None:
            assert r.similarity >= 0.8 and abs(r.similarity - similarity(bag(text[r.doc_id]), bag(text[r.linked_id]))) < 1e-9


def test_rows_without_id_and_empty_table(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (4, "A b c, d e f"), (4, "something else altogether"), (4, "something else altogether"), (2**60 + 1, "q"), (2**60 + 3, "q"),
            (None, "no id has this"), (None, "no, id has this"), (None, None), (5, None), (6, "Something else, altogether")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int")
    got = near_duplicates(df).collect()
    assert sorted([(r.doc_id, r.class_id) for r in got], key=str) == labels_by_brute_force(rows, 0.8)
    assert sum(r.text_key == r.class_key and r.doc_id == r.class_id for r in got) == 7  # one of them twice, as the row is
    assert near_duplicates(df.limit(0)).collect() == []


def test_links_beside_the_least_text_of_a_band(spark):
    """Chains and families whose members are near each other but not the least one."""
    rng = random.Random(11)
    base = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(60):  # neighbours in the chain are at about 0.85, ends far apart
        rows.append((i, " ".join(base)))
        base = base[4:] + [f"n{i}x{k}" for k in range(4)]
    family = [f"f{i}" for i in range(200)]
    for i in range(100, 160):
        t = list(family)
        for _ in range(rng.choice([2, 7])):
            t[rng.randrange(200)] = f"r{rng.random()}"
        rows.append((i, " ".join(t)))
    for block in (1024, 10):
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
        assert sorted([(r.doc_id, r.class_id) for r in got], key=str) == labels_by_brute_force(rows, 0.8)


def test_a_very_long_text(spark):
    rng = random.Random(12)
    words = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:190_000])), (3, " ".join(words[:100_000])), (4, "x")]
    assert len(rows[1][1]) > 1_000_000
    got = {r.doc_id: (r.class_id, r.linked_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, None), 2: (1, 1), 3: (3, None), 4: (4, None)}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (30, 31), (31, 32), (32, 33), (33, 34), (34, 30), (None, 4)]
    got = sorted(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == sorted([(1, 1), (2, 1), (3, 1), *((i, 5) for i in range(5, 10)), *((i, 30) for i in range(30, 35))])


def test_forest_links_what_brute_force_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, 40).astype(np.uint64)
    sets = [np.unique(np.r_[base[rng.random(40) < 0.92], rng.integers(0, 2**62, 2).astype(np.uint64)]) for _ in range(30)]
    edges = overlap_edges(list(range(30)), sets, np.zeros(30, int), 0.8)
    assert len(edges) < 30
    assert shingles(np.arange(3, dtype=np.uint64)).shape == (1,)
