import random

import numpy as np

import corpus_pipeline
from variantloom.llm.language import Profiles, fit_profiles, held_out
from variantloom.llm.pieces import MODEL, PieceModel
from variantloom.llm.shared import words_of

from .test_decontaminate import held
from .test_neardup import bag, similarity
from .test_substrings import brute


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    syllables = {"xx": ["ba", "no", "ti", "lu"], "yy": ["sch", "ung", "ger", "oe"]}
    make = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    items = [(i, make("xx", 30)) for i in range(3)]
    shared = make("xx", 60)
    docs = [(0, None, None), (1, "", "xx"), (2, "123 456", "xx"), (3, "語語語", None)]
    for i in range(4, 60):
        lang = rng.choice(["xx", "yy"])
        t = make(lang, rng.randint(20, 120))
        if i % 7 == 0:
            t += " " + shared
        if i % 9 == 0:
            t = make("xx", 20) + " " + items[i % 3][1] + " " + make("xx", 20)
        docs.append((i, t, lang))
    docs += [(100 + i, docs[10 + i][1], docs[10 + i][2]) for i in range(5)] + [(12, docs[12][1], "xx")]
    docs += [(200, docs[20][1].replace(docs[20][1].split()[3], "zz", 1), "xx")]
    docs += [(21, make("yy", 40), "yy"), (None, make("xx", 50), "xx"), (None, make("xx", 30), "xx"), (None, docs[22][1], "xx"), (None, make("xx", 20) + " " + items[1][1], "xx"), (300, "ba no " * 110_000 + items[2][1], "xx")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _first int"
    spark.createDataFrame([(i, t, g, "s", len(t or ""), None) for i, t, g in docs], schema).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = Profiles(fit_profiles(table.where(~held_out())), 400)
    left = [(i, t) for i, t, _ in docs if (p := model.predict(t))[0] != "und" and p[1] >= 0.1]
    left = firsts(left)
    left = [(i, cut) for (i, t), cut in zip(left, cut_texts([t for _, t in left])) if cut or not t]

    def leaks(t):
        a = np.array(words_of(t), object)
        return any(held(a, np.array(words_of(p), object), shift) for _, p in items for shift in range(-len(words_of(p)) + 1, len(a)) if len(a) < 10_000)

    left = [(i, t) for i, t in left if not leaks(t)]
    assert sorted(r.doc_id or -1 for r in got) == sorted(i or -1 for i, _ in left) and 10 < len(left) < 60
    assert [i for i, _ in left].count(None) == 2 and [i for i, _ in left].count(21) == 2
    with open(MODEL, "rb") as f:
        pieces = PieceModel.from_bytes(f.read())
    assert all(r.round_trip and r.n_pieces == len(r.piece_ids) for r in got)
    assert sorted(((r.doc_id or -1), pieces.decode(r.piece_ids)) for r in got) == sorted((i or -1, t) for i, t in left)


def firsts(rows):
    """Of each class of near duplicates the row that comes first by id (null last), and of rows equal in both one."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for i in range(len(rows)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [r for i, r in enumerate(rows) if find(i) == i]


def cut_texts(texts, width=200):
    from collections import Counter

    import numpy as np

    data = [t.encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                hit[i : i + width] = True
        yield bytes(b for b, x in zip(d, hit) if not x).decode("utf-8", "ignore")


def test_clashing_columns_and_repeated_rows_stay(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key int, own_1 string, kept string, _first int, spans string"
    t = "one line of words that is long enough to be told apart from any other line of words"
    rows = [(1, t, "en", "s", 9, 1, "a", "k", 5, "x"), (1, t, "en", "s", 9, 1, "a", "k", 6, "x"), (2, t, "en", "s", 9, 2, "b", "k", 7, "y"), (1, "quite another text under the same number", "en", "s", 9, 3, "c", "k", 8, "z")]
    docs = spark.createDataFrame(rows, schema)
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted([rows[0], rows[3]])
    cut = corpus_pipeline.substring_dedup(spark, docs, "")
    assert cut.columns == docs.columns and sorted(r._first for r in cut.collect()) == [5, 6, 7, 8]
    clean = corpus_pipeline.decontamination(spark, docs, "/root/testdata/sf0.001")
    assert clean.columns == docs.columns and clean.count() == 4


def test_stages_keep_the_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, "/root/testdata/sf0.001").columns == empty.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []
    assert brute([None], 5)[0][0] == 0
