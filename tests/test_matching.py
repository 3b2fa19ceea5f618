"""Greedy matching against a plain walk over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from variantloom.operators import graph

PAIR = "a string, b string, place int"


def walk(pairs):
    used, out = set(), set()
    for place, a, b in sorted({(p, a, b) for a, b, p in pairs if a and b}):
        if a not in used and b not in used:
            used |= {a, b}
            out.add((a, b, place))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_a_chain_of_a_thousand_ties_in_few_jobs(spark):
    chain = [(f"n{i:04}", f"n{i + 1:04}", i) for i in range(1000)]
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("chain", "matching")
    out = got(graph.greedy_pairs(spark.createDataFrame(chain, PAIR)))
    jobs = len(tracker.getJobIdsForGroup("chain"))
    sc.setJobGroup("rest", "rest")
    assert out == walk(chain) and len(out) == 500 and jobs < 150  # a round of jobs a link would be thousands


@pytest.mark.parametrize("most", [20_000, 3])  # whole components, and rounds first
def test_random_pairs(spark, most):
    rng = random.Random(4)
    nodes = [f"n{i}" for i in range(40)]
    pairs = [(rng.choice(nodes), rng.choice(nodes), rng.randrange(30)) for _ in range(60)]
    pairs += pairs[:10] + [(None, "n1", 0), ("n2", None, 0), (None, None, 1), ("alone", "alone", 5)]
    assert got(graph.greedy_pairs(spark.createDataFrame(pairs, PAIR), most=most, rounds=2)) == walk(pairs)


def test_places_of_several_columns_and_no_pairs(spark):
    df = spark.createDataFrame([("a", "b", 2), ("b", "c", 1), ("c", "d", 2)], PAIR).withColumn("place", F.struct("place", "a", "b"))
    assert {(r.a, r.b) for r in graph.greedy_pairs(df).collect()} == {("b", "c")}
    assert graph.greedy_pairs(df.limit(0)).collect() == []
