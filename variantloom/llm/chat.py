"""Preference formatting of chat conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

START, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
TURN = "struct<role: string, text: string>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, turns: array of (role, text) in the order of turn, then role and text.

    Null roles and texts count as empty; rows without conv_id are dropped, those without turn come first. Rows that
    repeat stay as turns; other columns are ignored."""
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.expr("transform(sort_array(collect_list(struct(turn, role, text))), x -> struct(x.role, x.text))").alias("turns"))


def _escaped(x: str) -> str:
    """SQL: x with a backslash before each backslash and within each mark, so that no text can pass for a mark."""
    slash = "chr(92)"
    return f"replace(replace(replace({x}, {slash}, {slash} || {slash}), '<|', '<' || {slash} || '|'), '|>', '|' || {slash} || '>')"


def _render(turns: str) -> str:
    return f"array_join(transform({turns}, t -> concat('{START}', {_escaped('t.role')}, '{MIDDLE}', {_escaped('t.text')}, '{END}')), '')"


def preference_pairs(convs: DataFrame, max_broadcast: int = 10_000) -> DataFrame:
    """Conversations -> pair_id (that of the chosen one), chosen, rejected, and whether the rejected side is made up.

    Conversations with the same opening (the turns before the first assistant turn) are alternatives, unless there is
    no turn before it. Equal ones count once, under the least id. The more assistant text, the better: each is chosen
    over one of those with the next smaller amount of it, the same one for all (the first by a hash). Equal amounts are
    not compared, and the smallest is chosen over nothing, so no two pairs contradict each other, directly or through
    others. Who is paired with whom depends on the opening alone, however many share it.

    A conversation that is alone with its opening is chosen over a made-up one, which leaves it at one of its assistant
    turns (each in turn by conv_id) and ends with an answer to something else: its own next assistant text, or if all
    are equal the turn before, or nothing. Conversations without an assistant turn, or with a single empty one and
    nothing before it, give no pair.
    """
    first = "array_position(transform(turns, t -> t.role), 'assistant')"
    talk = convs.where("exists(turns, t -> t.role = 'assistant')").select(
        "conv_id", "turns", F.expr(f"md5({_render('turns')})").alias("whole"),
        F.expr(f"md5({_render(f'if({first} = 1, turns, slice(turns, 1, {first} - 1))')})").alias("opening"),
        F.expr("aggregate(turns, 0L, (a, t) -> a + if(t.role = 'assistant', length(t.text), 0))").alias("said"))
    once = stored(talk.groupBy("opening", "whole").agg(F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"), F.first("said").alias("said")), "talk")
    # an opening has as many levels as there are amounts of text, whatever the number of its conversations
    levels = once.groupBy("opening", "said").agg(F.min(F.struct("whole", "turns")).alias("low"), F.count("*").alias("n"))
    w = Window.partitionBy("opening").orderBy("said")
    levels = levels.select("opening", "said", F.lag("low.turns").over(w).alias("other"), (F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) == 1).alias("alone"))
    levels = stored(levels.where("other is not null or alone"), "levels")
    both = once.join(F.broadcast(levels) if levels.count() <= max_broadcast else levels, ["opening", "said"])
    places = "filter(sequence(0, size(turns) - 1), i -> turns[i].role = 'assistant')"
    left = both.withColumn("places", F.expr(places)).withColumn("k", F.expr("cast(pmod(conv_id, size(places)) as int)")).withColumn("at", F.expr("places[k]"))
    texts = ("concat(transform(slice(places, k + 2, size(places)), i -> turns[i].text), transform(slice(places, 1, k), i -> turns[i].text), "
             "if(at > 0, array(turns[at - 1].text), cast(array() as array<string>)), array(''))")
    answer = f"get(filter({texts}, x -> x != turns[at].text), 0)"
    made = f"concat(slice(turns, 1, at), array(cast(struct('assistant', {answer}) as {TURN})))"
    out = left.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), F.expr(f"if(alone, if({answer} is null, null, {made}), other)").alias("rejected"), F.col("alone").alias("made"))
    return out.where("rejected is not null")


def _spans(turns: str) -> str:
    """Character spans (start, end) of assistant texts in the rendered turns: what the loss counts; all else is masked."""
    head = len(START) + len(MIDDLE)
    role, text = f"length({_escaped('t.role')})", f"length({_escaped('t.text')})"
    return (f"aggregate({turns}, struct(0 as at, cast(array() as array<struct<start: int, end: int>>) as spans), (a, t) -> struct("
            f"a.at + {role} + {text} + {head + len(END)} as at, if(t.role = 'assistant', "
            f"array_append(a.spans, struct(a.at + {role} + {head} as start, a.at + {role} + {head} + {text} as end)), a.spans) as spans)).spans")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected: arrays of (role, text)) -> pair_id, n_shared, prompt, chosen, rejected, chosen_spans,
    rejected_spans; and made, where the pairs have it.

    The longest common turn prefix is rendered once, as prompt; the rest of either conversation is its completion,
    with the spans of assistant text that the loss counts. Marks within roles and texts are escaped by backslashes.
    A pair with equal conversations has two empty completions; other columns are ignored.
    """
    n = "coalesce(nullif(array_position(zip_with(chosen, rejected, (a, b) -> a <=> b), false), 0) - 1, size(chosen))"
    more = ["made"] if "made" in pairs.columns else []
    cut = pairs.select("pair_id", "chosen", "rejected", *more, F.expr(n).cast("int").alias("n_shared"))
    parts = cut.select(
        "pair_id", "n_shared", *more, F.expr("slice(chosen, 1, n_shared)").alias("p"),
        F.expr("slice(chosen, n_shared + 1, size(chosen))").alias("c"), F.expr("slice(rejected, n_shared + 1, size(rejected))").alias("r"))
    return parts.select(
        "pair_id", "n_shared", *more, F.expr(_render("p")).alias("prompt"), F.expr(_render("c")).alias("chosen"), F.expr(_render("r")).alias("rejected"),
        F.expr(_spans("c")).alias("chosen_spans"), F.expr(_spans("r")).alias("rejected_spans"))


def spans_text(name: str) -> str:
    """SQL: spans as text, such as 12-40,61-80."""
    return f"array_join(transform({name}, s -> concat(s.start, '-', s.end)), ',')"


def _sql_turns(turns: str) -> str:
    return (f"array_to_string(list_transform({turns}, lambda x: '{START}' || {_escaped('x.role')} || '|>' || chr(10) || {_escaped('x.text')} || '<|end|>' || chr(10)), '')")


def _sql_spans(turns: str) -> str:
    size = f"list_transform({turns}, lambda x: 13 + length({_escaped('x.role')}) + length({_escaped('x.text')}))"
    start = f"coalesce(list_sum(({size})[1:i - 1]), 0) + 5 + length({_escaped(f'({turns})[i].role')})"
    one = f"CASE WHEN ({turns})[i].role = 'assistant' THEN CAST(CAST({start} AS BIGINT) AS VARCHAR) || '-' || CAST(CAST({start} + length({_escaped(f'({turns})[i].text')}) AS BIGINT) AS VARCHAR) END"
    return f"coalesce(array_to_string(list_filter(list_transform(range(1, len({turns}) + 1), lambda i: {one}), lambda s: s IS NOT NULL), ','), '')"


CHAT_SQL = f"""
WITH t AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (SELECT *, list_transform(turns, lambda x: x.role) AS roles FROM t),
a AS (SELECT conv_id, turns, md5({_sql_turns('turns')}) AS whole, md5({_sql_turns("CASE WHEN roles[1] = 'assistant' THEN turns ELSE turns[1:list_position(roles, 'assistant') - 1] END")}) AS opening,
        list_sum(list_transform(turns, lambda x: CASE WHEN x.role = 'assistant' THEN length(x.text) ELSE 0 END)) AS said,
        list_filter(range(1, len(turns) + 1), lambda i: roles[i] = 'assistant') AS places FROM k WHERE list_contains(roles, 'assistant')),
u AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY opening, whole ORDER BY conv_id) = 1),
level AS (SELECT opening, said, arg_min(turns, whole) AS low FROM u GROUP BY opening, said),
below AS (SELECT x.opening, x.said, max(y.said) AS next FROM level x JOIN level y ON y.opening = x.opening AND y.said < x.said GROUP BY x.opening, x.said),
o AS (SELECT *, places[conv_id % len(places) + 1] AS spot, conv_id % len(places) AS k FROM u WHERE opening IN (SELECT opening FROM u GROUP BY opening HAVING count(*) = 1)),
s AS (SELECT *, list_filter(list_transform(places[k + 2:], lambda i: turns[i].text) || list_transform(places[1:k], lambda i: turns[i].text)
        || CASE WHEN spot > 1 THEN [turns[spot - 1].text] ELSE CAST([] AS VARCHAR[]) END || [''], lambda x: x <> turns[spot].text)[1] AS answer FROM o),
p AS (SELECT conv_id AS pair_id, turns AS chosen, turns[1:spot - 1] || [{{'role': 'assistant', 'text': answer}}] AS rejected, true AS made FROM s WHERE answer IS NOT NULL
      UNION ALL SELECT u.conv_id, u.turns, level.low, false FROM u JOIN below USING (opening, said) JOIN level ON level.opening = u.opening AND level.said = below.next),
q AS (SELECT *, coalesce(list_position(list_transform(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[i] = rejected[i]), false) - 1, least(len(chosen), len(rejected))) AS n_shared FROM p),
r AS (SELECT *, chosen[1:n_shared] AS pre, chosen[n_shared + 1:] AS c, rejected[n_shared + 1:] AS d FROM q)
SELECT pair_id, made, CAST(n_shared AS INT) AS n_shared, {_sql_turns('pre')} AS prompt, {_sql_turns('c')} AS chosen, {_sql_turns('d')} AS rejected,
  {_sql_spans('c')} AS chosen_spans, {_sql_spans('d')} AS rejected_spans FROM r
"""
