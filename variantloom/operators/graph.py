"""Connected components, descendants and greedy matching."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tables import stored


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of edges (a, b): rows (node, label), label the least node; only nodes with an edge.

    Every round hooks each node to its least smaller neighbour, jumps pointers until all point to roots, and replaces
    the edges by edges between roots. Groups shrink to one root, whatever their size, by aggregates and joins alone;
    the driver sees counts only. Nulls and self links are dropped.
    """
    cur, assign = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name), None
    while cur.limit(1).count():
        hook = stored(cur.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), name)
        while hook.join(hook.select(F.col("node").alias("root")), "root", "left_semi").limit(1).count():
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            for _ in range(2):
                hook = hook.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            hook = stored(hook, name)
        ha = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        hb = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        roots = cur.join(ha, "a", "left").join(hb, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        cur = stored(roots.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct(), name)
        if assign is None:
            assign = hook
        else:
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = assign.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            assign = stored(moved.unionByName(hook).groupBy("node").agg(F.min("root").alias("root")), name)
    if assign is None:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = assign.select("node", F.col("root").alias("label"))
    return out.unionByName(out.select(F.col("label").alias("node"), "label")).distinct()


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (child, parent) and roots (node) -> rows (root, node) for all descendants at any depth.

    Each round doubles the depth: what is found is joined with jumps of as many levels as are found so far, and a jump
    with itself. A round writes what is new and the next jumps. A round without anything new is the last, as then no
    node is first met beyond the levels found; so cycles end, too, in which a root is its own descendant."""
    jump = stored(edges.select(F.col("parent").alias("node"), F.col("child").alias("to")).where("node is not null and to is not null").distinct(), "jump")
    found = new = stored(roots.select(F.col("node").alias("root"), "node").distinct().join(jump, "node").select("root", F.col("to").alias("node")).distinct(), "desc")
    while new.limit(1).count():
        new = stored(found.join(jump, "node").select("root", F.col("to").alias("node")).distinct().join(found, ["root", "node"], "left_anti"), "desc")
        found = found.unionByName(new)
        jump = stored(jump.join(jump.select(F.col("node").alias("to"), F.col("to").alias("far")), "to").select("node", F.col("far").alias("to")).distinct(), "jump")
    return found


def expand_terms(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct terms (node) and their descendants."""
    return terms.select("node").unionByName(descendants(edges, terms).select("node")).distinct()


def _walk(a: pd.Series, b: pd.Series) -> pd.Series:
    """Lists of ends, in order of place -> whether each pair is taken."""
    out = []
    for x, y in zip(a, b, strict=True):
        used, taken = set(), []
        for u, v in zip(x, y, strict=True):
            free = u not in used and v not in used
            taken.append(free)
            if free:
                used |= {u, v}
        out.append(taken)
    return pd.Series(out)


def greedy_pairs(pairs: DataFrame, most: int = 20_000, rounds: int = 10) -> DataFrame:
    """Pairs (a, b, place) -> the pairs taken when they are visited in the order of place (then a, b) and each node is used
    once. Pairs with a null end are never taken; of repeated rows one is.

    What is taken in one connected component does not bear on another. Components of up to `most` pairs are visited one
    after the other within a task, all in one pass. Larger ones, which no task holds, first lose the pairs that are first
    at both of their ends, and all others at those ends, for some rounds; what is left falls into components again. Only
    one component of more than `most` pairs in which each waits for the one before needs rounds by its length."""
    order = F.struct("place", "a", "b")
    left, taken = stored(pairs.select("a", "b", "place").where("a is not null and b is not null").distinct(), "pairs"), None
    while left.limit(1).count():
        label = components(left, "ties").withColumnRenamed("node", "a")
        labelled = left.join(label, "a", "left").withColumn("label", F.coalesce("label", "a"))
        sizes = stored(labelled.groupBy("label").agg(F.count("*").alias("n")), "sizes")
        large = sizes.where(F.col("n") > most).select("label")
        labelled = stored(labelled, "pairs")
        whole = labelled.join(large, "label", "left_anti").groupBy("label").agg(F.sort_array(F.collect_list(order)).alias("p"))
        visit = F.pandas_udf(_walk, "array<boolean>")
        seen = whole.select("p", visit("p.a", "p.b").alias("t")).select(F.explode(F.arrays_zip("p", "t")).alias("x")).where("x.t")
        now = stored(seen.select("x.p.a", "x.p.b", "x.p.place"), "pairs")
        taken = now if taken is None else taken.unionByName(now)
        left = labelled.join(large, "label", "left_semi").select("a", "b", "place")
        for _ in range(rounds):
            if not large.limit(1).count() or not left.limit(1).count():
                break
            ends = left.select(F.explode(F.array("a", "b")).alias("node"), order.alias("o")).groupBy("node").agg(F.min("o").alias("first"))
            ea, eb = ends.select(F.col("node").alias("a"), F.col("first").alias("fa")), ends.select(F.col("node").alias("b"), F.col("first").alias("fb"))
            now = stored(left.withColumn("o", order).join(ea, "a").join(eb, "b").where("o = fa and o = fb").select("a", "b", "place"), "pairs")
            used = now.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            left = stored(left.join(used.withColumnRenamed("node", "a"), "a", "left_anti").join(used.withColumnRenamed("node", "b"), "b", "left_anti").select("a", "b", "place"), "pairs")
            taken = taken.unionByName(now)
    return left if taken is None else taken
