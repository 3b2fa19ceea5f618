import math
import random

import pytest

from variantloom.llm.pieces import MARKED, MODEL, PieceModel, decode, encode
from variantloom.llm.token_counts import VOCAB, UnigramCounter, token_counts

ODD = [None, "", " ", "  a  b\n\n c\t", "▁x ▁▁", "naïve 😀 \u0000 مرحبا", "x" * 3000, "word " * 400, "a\r\nb c", "é" * 700]


def best_score(word, scores, floor):
    """Largest total over all segmentations, and the fewest pieces among the best, by plain recursion on prefixes."""
    table = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(table[s][0] + scores[word[s:end]], -table[s][1] - 1) for s in range(end) if word[s:end] in scores]
        if not options:
            options = [(table[end - 1][0] + floor, -table[end - 1][1] - 1)]
        top = max(options)
        table.append((top[0], -top[1]))
    return table[-1]


@pytest.fixture(scope="module")
def counter():
    with open(VOCAB, "rb") as f:
        return UnigramCounter.from_bytes(f.read())


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return PieceModel.from_bytes(f.read())


def test_trie_counts_equal_brute_force(counter):
    rng = random.Random(1)
    words = [" the", "thing", "things", " thin", "", "ühl", "12345"] + ["".join(rng.choice("abent ") for _ in range(rng.randint(1, 12))) for _ in range(200)]
    got = counter.count_all(words)
    for w in words:
        assert got[w] == best_score(w.encode(), counter.score, counter.floor)[1], w
    long = ["the cat sat " * 40, "the cat sat " * 39 + "the cot", "x" * 3000, "x" * 2990 + "y"]
    assert counter.count_all(long) == {w: best_score(w.encode(), counter.score, counter.floor)[1] for w in long}


def test_small_vocabulary_and_unknown_bytes():
    c = UnigramCounter({b"a": 0, b"b": 1, b"ab": 2})
    assert c.count_all(["ab", "abab", "zz", "azb"]) == {"ab": 1, "abab": 2, "zz": 2, "azb": 3}


def test_token_counts_of_odd_texts(spark, counter):
    import regex

    from variantloom.llm.token_counts import PATTERN

    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(3, ODD[3], 7), (None, "the", None), (2**60 + 1, "the", 7)]
    got = token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), cache=5).collect()
    want = []
    for i, t, _ in rows:
        p = regex.findall(PATTERN, t) if t else []
        want.append((i, len(p), sum(counter.count_all([x])[x] for x in p)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shared_prefix_viterbi_equals_brute_force(model):
    rng = random.Random(2)
    words = [" the", " then", " there", " th", "qqqq", " 😀", "▁", " a▁b"] + [" " + "".join(rng.choice("aeinst▁é") for _ in range(rng.randint(0, 10))) for _ in range(200)]
    got = model.encode_words(words)
    score = {p: s for p, (_, s) in model.pieces.items()}
    by_id = {i: s for i, s in model.pieces.values()}
    for w in words:
        n = len(w)
        table = [0.0] + [-math.inf] * n
        for end in range(1, n + 1):
            table[end] = max([table[s] + score[w[s:end]] for s in range(end) if w[s:end] in score], default=-math.inf)
            if table[end] == -math.inf:
                table[end] = table[end - 1] + model.byte_score * len(w[end - 1].encode())
        assert math.isclose(sum(by_id.get(i, model.byte_score) for i in got[w]), table[n]), w
        assert b"".join(model.surface[i] for i in got[w]).decode() == w


def test_round_trip(spark, model):
    rng = random.Random(3)
    texts = ODD + ["".join(chr(rng.choice([32, 10, 9601, rng.randint(33, 126), rng.randint(160, 0x2FFF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("decoded", __import__("pyspark").sql.functions.lit(1))
    back = decode(encode(df, cache=10)).collect()
    assert len(back) == len(texts)
    for r in back:
        assert r.decoded == r.text == texts[r.doc_id]
        assert (r.piece_ids is None) == (r.text is None)
    assert encode(df.limit(0)).collect() == []


def test_marked_words_cover_the_text():
    assert "".join(MARKED.findall("  a b\n\nc  ")) == "  a b\n\nc  "
