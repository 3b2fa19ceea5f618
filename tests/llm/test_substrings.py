import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from variantloom.llm.substrings import anchors, common_prefixes, remove_repeats, repeated_windows, suffix_array


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 300)), int(rng.integers(1, 6))
    text = rng.integers(0, k, n)
    if seed % 3 == 0:
        text = np.tile(text[: max(1, n // 7)], 7)
    s = text.tolist()
    want = sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_array(text).tolist() == want
    starts = np.array([0, len(s) // 2])
    got = common_prefixes(text.astype(np.uint16), np.array(want), starts, len(s))
    for a, b in zip(want, want[1:]):
        size = 0
        while max(a, b) + size < len(s) and s[a + size] == s[b + size]:
            size += 1
        assert got[b] == size


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                hit[i : i + width] = True
        kept = bytes(b for b, h in zip(d, hit) if not h)
        edges = np.diff(np.r_[False, hit].astype(int))
        out.append((len(d), int(hit.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_anchor_of_equal_windows():
    rng = random.Random(3)
    a = bytes(rng.choice(b"ab") for _ in range(700))
    b = bytes(rng.choice(b"ab") for _ in range(100)) + a[100:400] + b"xyz"
    place = {}
    for d in (a, b):
        for first, last, p, h in zip(*anchors(d, 64, 16)):
            for w in range(first, last):
                assert place.setdefault(d[w : w + 64], (p - w, h)) == (p - w, h)


def test_windows_of_pieces():
    pieces = [(b"abcdefgh", 3), (b"xxabcdefyy", 4), (b"qqqqqqqq", 3)]
    flags, _ = repeated_windows(pieces, 6)
    assert [f.tolist() for f in flags] == [[True, False, False], [False, False, True, False], [True, True, True]]


@pytest.mark.parametrize("shard", [512, 3])
def test_against_brute_force(spark, shard):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    make = lambda n: " ".join(word() for _ in range(n))
    passage = [make(40), make(90), make(15)]
    texts = [None, "", "short", passage[0], "ab" * 300, "x" * 450]
    for i in range(120):
        cut = rng.randint(0, 60)
        parts = [make(rng.randint(0, 25)), rng.choice(passage)[rng.randint(0, 5) :][: -cut or None], make(rng.randint(0, 25))]
        texts.append(" ".join(parts))
    texts += [texts[10]] * 9 + ["y" + texts[10]]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, texts[12], "en"), (11, texts[20], None), (11, texts[20], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, windows string").repartition(5)
    got = remove_repeats(df, 60, shard=shard, shard_bytes=5000).collect()
    want = brute([t for _, t, _ in rows], 60)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((str(r[0]), *w) for r, w in zip(rows, want))
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df).collect() == []


def test_suffix_array_of_a_large_alphabet():
    """Names of over a hundred thousand substrings are sorted by recursion, too."""
    rng = np.random.default_rng(1)
    text = rng.integers(0, 90_000, 60_000)
    text = np.r_[text, text[100:40_000], 7, text[:50]]
    order = suffix_array(text)
    assert sorted(order.tolist()) == list(range(len(text)))
    s = text.tolist()
    assert all(s[a : a + 45_000] < s[b : b + 45_000] for a, b in zip(order[::997].tolist(), order[1::997].tolist()))
    assert suffix_array(np.zeros(900, int)).tolist() == list(range(899, -1, -1))


def test_many_copies_without_an_id(spark):
    """The rows of a text that repeats grow with its length only, and each copy gets the same result."""
    text = " ".join(f"w{i * i}" for i in range(150))
    rows = [(None, text)] * 3000 + [(5, text)] * 10 + [(None, text + " more")] + [(6, "none of this twice " * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, 60).collect())
    want = Counter((i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], 60)))
    assert got == want


def test_long_texts(spark):
    rng = random.Random(9)
    long = " ".join(f"u{rng.randrange(10**7)}" for _ in range(140_000))
    rows = [(1, long), (2, long[500_000:500_900] + " tail"), (3, "z" * 1_200_000), (4, "é" * 700)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(long) > 1_000_000 and got[1].n_removed == got[2].n_removed == 900
    assert got[3].n_removed == 1_200_000 and got[4].n_removed == 1400
