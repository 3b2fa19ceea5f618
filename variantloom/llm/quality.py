"""Line-first quality rules, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·>"
#: What may end a sentence, and a mark that may follow it.
END_MARKS = ".!?…:;\"”’»)。！？；：」』）؟۔।"
#: Words of notices, menus and placeholders, in the languages at hand.
BOILERPLATE = (
    "cookies", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright", "licensed under", "mit license",
    "gnu general public", "apache license", "permission is hereby granted", "click here", "sign up", "log in", "javascript", "lorem ipsum",
    "alle rechte vorbehalten", "datenschutzerklärung", "impressum", "nutzungsbedingungen", "hier klicken",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "haga clic aquí", "iniciar sesión",
    "tous droits réservés", "politique de confidentialité", "mentions légales", "conditions d utilisation", "cliquez ici")
ENDS = "[" + END_MARKS + "]" + WS + r"*\z"
NOT_WORD = r"[^\p{L}\p{N}]"
PHRASES = f"(?:^|{NOT_WORD})(?:" + "|".join(p.replace(" ", NOT_WORD + "+") for p in BOILERPLATE) + f")(?:$|{NOT_WORD})"


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value, evaluated once a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _count(text: str, chars: str) -> str:
    return f"(length({text}) - length(translate({text}, '{chars}', '')))"


def line_fails(line: str, words: str) -> str:
    """SQL condition: the line of so many words lacks an end mark, is a menu, is mostly symbols or holds boilerplate."""
    seps = _count(line, SEPARATORS)
    return (f"(NOT rlike({line}, {_literal(ENDS)}) OR ({seps} >= 2 AND 4 * {seps} >= {words}) "
            f"OR 2 * {_count(line, SYMBOLS)} > {words} OR rlike(lower({line}), {_literal(PHRASES)}))")


def _repeats() -> str:
    """Words in five-word windows that occur twice: hash each window; only where hashes repeat, sort (hash, place),
    flag neighbours that agree, and add up the places that the flagged windows cover."""
    gram = ", ".join(f"ws[i + {k}]" for k in range(5))
    covered = _let(
        "sort_array(transform(filter(s, (x, k) -> get(s, k - 1).h = x.h OR get(s, k + 1).h = x.h), x -> x.i))", "p",
        "aggregate(transform(p, (v, k) -> coalesce(least(5, get(p, k + 1) - v), 5)), 0, (a, v) -> a + v)")
    covered = _let("sort_array(transform(g, (h, i) -> named_struct('h', h, 'i', i)))", "s", covered)
    body = f"CASE WHEN size(array_distinct(g)) = size(g) THEN 0 ELSE {covered} END"
    return f"CASE WHEN size(ws) < 5 THEN 0 ELSE {_let(f'transform(sequence(0, size(ws) - 5), i -> xxhash64({gram}))', 'g', body)} END"


def quality(docs: DataFrame, max_lost: int = 50) -> DataFrame:
    """(doc_id, text) -> doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines,
    lost_words, cleaned, base_failed, kept; one row per input row, other columns are ignored.

    Lines are judged first (see line_fails) and removed; cleaned is the text of those left, blank lines included. A
    document is kept if it passes the base rules and loses at most max_lost percent of its words. A null text counts as
    an empty one, which fails the base rules. Rows that repeat, or have no doc_id, are judged one by one. No shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = _let(f"filter(split(text, {_literal(WS + '+')}), w -> w <> '')", "ws", f"named_struct('n', size(ws), 'r', {_repeats()})")
    counted = f"transform(split(text, '\\n'), l -> named_struct('l', l, 'n', regexp_count(l, {_literal(NOT_WS + '+')})))"
    judged = f"transform({counted}, x -> named_struct('l', x.l, 'n', x.n, 'bad', x.n > 0 AND {line_fails('x.l', 'x.n')}))"
    summary = _let(
        "transform(filter(ls, x -> x.n > 0), x -> x.l)", "full",
        "named_struct('n', size(full), 'dup', size(full) - size(array_distinct(full)), 'bad', size(filter(ls, x -> x.bad)), "
        "'lost', aggregate(ls, 0L, (a, x) -> a + if(x.bad, x.n, 0)), 'cleaned', array_join(transform(filter(ls, x -> NOT x.bad), x -> x.l), '\\n'))")
    found = rows.select(
        "doc_id", F.expr(words).alias("w"), F.expr(_let(judged, "ls", summary)).alias("l"),
        F.expr("length(translate(text, ' \\t\\n\\u000B\\u000C\\r', ''))").cast("long").alias("word_chars"),
        F.expr(_count("text", SYMBOLS)).cast("long").alias("n_symbols"))
    flat = found.select(
        "doc_id", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.r").cast("long").alias("n_repeat_words"), F.col("l.n").cast("long").alias("n_lines"), F.col("l.bad").cast("long").alias("n_bad_lines"),
        F.col("l.lost").alias("lost_words"), F.col("l.cleaned").alias("cleaned"))
    base = flat.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
    return base.withColumn("kept", F.expr(f"NOT base_failed AND 100 * lost_words <= {max_lost} * n_words"))


def _quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{WS}+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_WS}')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM g),
f AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM f, range(0, 5) AS o(k) GROUP BY doc_id),
x AS (SELECT doc_id, i, l, rtrim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS stem, len(list_filter(regexp_split_to_array(l, '{WS}+'), lambda x: x <> '')) AS n,
        len(list_filter(string_split(l, ''), lambda x: contains('{SEPARATORS}', x))) AS seps, len(list_filter(string_split(l, ''), lambda x: contains('{SYMBOLS}', x))) AS syms,
        ' ' || regexp_replace(lower(l), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ' AS plain
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)),
y AS (SELECT *, n > 0 AND (NOT contains('{END_MARKS.replace("'", "''")}', right(stem, 1)) OR (seps >= 2 AND 4 * seps >= n) OR 2 * syms > n
        OR len(list_filter({_quoted(BOILERPLATE)}, lambda p: contains(plain, ' ' || p || ' '))) > 0) AS bad FROM x),
b AS (SELECT doc_id, count(*) FILTER (WHERE bad) AS n_bad, coalesce(sum(n) FILTER (WHERE bad), 0) AS lost, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT bad), '') AS cleaned
      FROM y GROUP BY doc_id),
a AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(n_bad, 0) AS BIGINT) AS n_bad_lines, CAST(coalesce(lost, 0) AS BIGINT) AS lost_words, sha1(cleaned) AS cleaned_sha1
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN b USING (doc_id))
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_words <= 50 * n_words AS kept FROM a
"""
