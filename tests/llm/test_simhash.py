import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries, simhash

from . import brute

SF = "/root/testdata/sf0.01"


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in queries.op4_simhash_near_dedup(spark, SF).collect())
    assert got == brute.near_duplicates(rows)


@pytest.mark.parametrize("radius, bucket_rows", [(1, 4), (2, 1), (2, 4), (2, 64), (3, 4)])
def test_links_find_every_component(spark, radius, bucket_rows):
    """Dense balls, chains and correlated bits, through pairs and midpoints."""
    rng = random.Random(radius * 100 + bucket_rows)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64) & rng.getrandbits(64)
        for _ in range(30):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(nodes, radius, bucket_rows)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > radius).isEmpty()
    got = {r.u: r.root for r in simhash.components(edges).collect()}
    mask = (1 << 64) - 1
    pairs = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= radius]
    want = brute.components(pairs, signed)
    assert {f: got.get(f, f) for f in signed} == want


def test_thresholds_are_the_cheapest_that_guarantee():
    costs = [[5.0, 50.0, 500.0], [1.0, 2.0, 400.0], [100.0, 200.0, 300.0]]
    assert simhash.thresholds(costs, 2) == (7.0, [0, 1, -1])
    assert simhash.thresholds([[9.0, 9.0, 9.0]], 2) == (9.0, [2])


def test_nulls_empty_repeats_and_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(5, text, "x"), (3, text.upper(), "y"), (3, text.upper(), "y"), (None, None, None), (9, "", "z"),
         (8, " \t\n", "z"), (7, "one two", "q"), (6, "long " * 70_000, "q")], "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
                  .collect()), key=repr)
    by = {i: (f, c) for i, f, c in got}
    assert len(got) == 8
    assert by[5][1] == 3 and by[5][0] == by[3][0] == f"{brute.simhash(text):016x}"
    assert by[9] == by[8] == by[None] == ("0" * 16, 8)
    assert by[7][1] == 7 and by[6][1] == 6
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 8]
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
