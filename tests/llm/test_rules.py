import random
import re

import duckdb
import pytest

from variantloom.llm import queries
from variantloom.llm.chat import conversations, format_preferences, preference_pairs
from variantloom.llm.decontaminate import MASKS, contaminated, overlap, seed_hashes
from variantloom.llm.quality import BOILERPLATE, quality
from variantloom.llm.shared import words_of

from .test_decontaminate import held

SF = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    bad = lost = 0
    kept = []
    for x in text.split("\n"):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", x))
        seps, syms = sum(c in "|»›•·>" for c in x), sum(c in "#*$%&|<>" for c in x)
        plain = " " + " ".join(w.lower() for w in re.findall(r"[^\W_]+", x)) + " "
        ended = x.rstrip(WS)[-1:] in set(".!?…:;\"”’»)。！？；：」』）؟۔।")
        if n and (not ended or (seps >= 2 and 4 * seps >= n) or 2 * syms > n or any(f" {p} " in plain for p in BOILERPLATE)):
            bad, lost = bad + 1, lost + n
        else:
            kept.append(x)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(lines), bad, lost, "\n".join(kept), failed, not failed and 100 * lost <= 50 * len(words))


def test_quality_against_plain_python(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "One two.", "a b c d e " * 300, "x. " * 20000, "Home | About | Contact | Us\n" * 3 + "This is a line of some ten words that ends well.", "é ü   line. ends\r\n\x0b\x0c.", "A catalog in print.\nThey design upper floors.\nPlease log  in!\n(Sign-up) now.\nPolítica de privacidad.\nConditions d'utilisation.\n這是一句話。\nwe blog in english.",
             "word soup. " * 120_000]
    for _ in range(150):
        line = lambda: " ".join(rng.choice(["foo", "bar", "baz", "|", "##", "cookie", "End.", "qux!"]) for _ in range(rng.randint(0, 9)))
        texts.append("\n".join(line() for _ in range(rng.randint(1, 8))))
    df = spark.createDataFrame([(i, t, 1) for i, t in [*enumerate(texts), (3, texts[3]), (None, "x"), (None, "x")]], "doc_id long, text string, kept int")
    got = quality(df)
    want = [(i, *plain_quality(t)) for i, t in [*enumerate(texts), (3, texts[3]), (None, "x"), (None, "x")]]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert quality(df.limit(0)).collect() == []
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["op6_quality_rules", "op8_chat_formatting", "op10_warc"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    want = sorted(repr(tuple(r[rel.columns.index(c)] for c in cols)) for r in rel.fetchall())
    assert got == want and got


def rendered(turns):
    esc = lambda x: x.replace("\\", "\\\\").replace("<|", "<\\|").replace("|>", "|\\>")
    return "".join(f"<|{esc(r)}|>\n{esc(t)}<|end|>\n" for r, t in turns)


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "good day"), (1, 2, "user", "bye"), (1, 3, "assistant", "so long"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", "what"), (3, 1, "assistant", None),
             (4, 0, "user", "alone"), (None, 0, "user", "x"), (5000, 0, "assistant", "far"), (9, 0, "user", "hi"), (9, 1, "assistant", "no"),
             (10, 0, "system", "s"), (10, 1, "user", "a <|end|> \\ b"), (10, 2, "assistant", "x<|y|>"), (10, 3, "user", "c"), (10, 4, "assistant", "z"), (11, 0, "assistant", ""), (12, 0, "user", "q " * 600_000), (12, None, "assistant", "r"), (12, 1, "assistant", "r")]
    df = spark.createDataFrame([(*t, "x", 0) for t in turns], "conv_id long, turn long, role string, text string, chosen string, n_shared int")
    pairs = preference_pairs(conversations(df).withColumn("spare", __import__("pyspark").sql.functions.lit(1)))
    raw, rows = {r.pair_id: r for r in pairs.collect()}, {r.pair_id: r for r in format_preferences(pairs).collect()}
    assert set(rows) == {1, 3, 10, 12, 5000}  # 2 says less than 1, 9 repeats it, 4 and 11 have nothing to prefer
    assert {k for k, r in rows.items() if not r.made} == {1}
    r = rows[1]
    assert r.n_shared == 1 and r.prompt == "<|user|>\nhi<|end|>\n" and r.rejected == rendered([("assistant", "no")])
    assert [r.chosen[s.start : s.end] for s in r.chosen_spans] == ["good day", "so long"]
    assert raw[1].rejected == [("user", "hi"), ("assistant", "no")] and raw[3].rejected[-1] == ("assistant", "what") and raw[5000].rejected == [("assistant", "")]
    assert rows[3].chosen_spans[0].start == rows[3].chosen_spans[0].end
    r = rows[10]  # it leaves at its first assistant turn, as 10 is even
    assert r.n_shared == 2 and r.rejected == rendered([("assistant", "z")]) and "a <\\|end|\\> \\\\ b" in r.prompt
    assert rows[12].n_shared == 0 and rows[12].rejected == rendered([("assistant", "")])
    for k, r in rows.items():
        both = [list(map(tuple, x)) for x in (raw[k].chosen, raw[k].rejected)]
        n = next((i for i, (a, b) in enumerate(zip(*both)) if a != b), min(map(len, both)))
        assert (r.n_shared, r.prompt, r.chosen, r.rejected) == (n, *map(rendered, (both[0][:n], both[0][n:], both[1][n:])))
        for text, spans, whole in ((r.chosen, r.chosen_spans, both[0]), (r.rejected, r.rejected_spans, both[1])):
            assert [text[s.start : s.end] for s in spans] == [rendered([("", t)])[5:-8] for x, t in whole[n:] if x == "assistant"]
    assert format_preferences(pairs.limit(0)).collect() == [] and preference_pairs(conversations(df.limit(0))).collect() == []


def test_pairs_of_crowded_openings_do_not_contradict_each_other(spark):
    rng, convs = random.Random(3), {}
    for i in range(600):  # alternatives part at their first, second or third assistant turn
        turns = [("user", f"q{i % 3}")]
        for _ in range(rng.randint(1, 3)):
            turns += [("assistant", "a" * rng.choice((1, 1, 2, 3, 40)) + rng.choice(("", "", str(i)))), ("user", rng.choice(("and", "or")))]
        convs[i] = turns
    df = spark.createDataFrame([(i, k, *t) for i, turns in convs.items() for k, t in enumerate(turns)], "conv_id long, turn int, role string, text string")
    said = lambda turns: sum(len(t) for r, t in turns if r == "assistant")
    plain = lambda turns: [tuple(t) for t in turns]
    distinct = {tuple(t): i for i, t in sorted(convs.items(), reverse=True)}
    levels = {}
    for t in distinct:
        levels.setdefault(t[0], set()).add(said(t))
    for most in (0, 10_000):
        rows = preference_pairs(conversations(df), most).collect()
        assert not any(r.made for r in rows) and all(tuple(plain(r.rejected)) in distinct for r in rows)
        assert sorted(r.pair_id for r in rows) == sorted(i for t, i in distinct.items() if said(t) > min(levels[t[0]]))
        for r in rows:
            c, d = plain(r.chosen), plain(r.rejected)
            assert c == convs[r.pair_id] and c[0] == d[0] and said(d) == max(x for x in levels[c[0]] if x < said(c))
        edges = {(tuple(plain(r.chosen)), tuple(plain(r.rejected))) for r in rows}
        assert not any((b, a) in edges for a, b in edges)
    lengths = {len(r.prompt) for r in format_preferences(preference_pairs(conversations(df))).collect()}
    assert len(lengths) > 3  # pairs share one turn, or more
    same = spark.createDataFrame([(i, k, "user" if k == 0 else "assistant", "hi" if k == 0 else f"answer {i}") for i in range(10, 99) for k in (0, 1)], df.schema)
    assert preference_pairs(conversations(same)).collect() == []  # equal amounts are not compared


def test_masks_ignore_substitutions():
    import numpy as np

    t = np.arange(40, dtype=np.uint64)
    for m in MASKS:
        a = seed_hashes(t, m)
        u = t.copy()
        u[m.index("0")] = 999
        assert seed_hashes(u, m)[0] == a[0] and (seed_hashes(u, m) != a).any()
    assert overlap(np.array([9, 1, 2, 3, 8], np.uint64), np.array([1, 2, 3], np.uint64), 1) == (3, 3, 1, 0)


def test_contamination_by_both_ways_and_brute_force(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(800)]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([30, 45, 15, 6, 3, 60])] + [(7, None), (8, ""), (None, "x y z")]
    docs = [(0, None), (1, ""), (2, "nothing here at all")]
    planted = {}
    for d in range(3, 40):
        t = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if d % 2:
            i = d % 6
            p = items[i][1].split()
            for _ in range(len(p) // 15):
                p[rng.randrange(len(p))] = "changed"
            at = rng.randint(0, len(t))
            t[at:at] = p
            planted[d] = i
        docs.append((d, " ".join(t)))
    dd = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, matched int").repartition(3)
    ii = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, contaminated(dd, ii).collect()))
    two = sorted(map(tuple, contaminated(dd, ii, max_broadcast_tokens=0).collect()))
    assert one == two
    found = {(r[0], r[1]) for r in one}
    want = set()
    import numpy as np

    for d, t in docs:
        for i, p in items:
            if i is None or not words_of(p):
                continue
            vocab = {}
            a, b = (np.array([vocab.setdefault(w, len(vocab)) for w in words_of(x)], np.uint64) for x in (t, p))
            for shift in range(-len(b) + 1, len(a)):
                if len(a) and held(a, b, shift):
                    want.add((d, i))
    assert {(d, i) for d, i in planted.items()} <= found
    assert found == want
    assert contaminated(dd, ii.limit(0)).collect() == [] and contaminated(dd.limit(0), ii).collect() == []
