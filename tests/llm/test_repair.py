import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import queries, repair

from .brute import cheapest_repair, repair_of

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """(conv_id, turn, role, text) rows after the contract's damage."""
    out = []
    for c, t, r, x in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        r, x, kind = " " if r is None else r, " " if x is None else x, zlib.crc32(name.encode()) % 20
        x = "" if kind == 1 else x.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows):
    held = defaultdict(list)
    for c, *row in damaged(rows):
        held[c].append(row)
    return {c: repair_of(held[c]) for c in {r[0] for r in rows}}


def check(spark, rows, **options):
    got = repair.repair_report(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, SF).collect()
    assert {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in got} == expected(rows)
    assert sum(r.cost > 0 for r in got) > 20


FAULTS = {"": repair.FINE, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.TRUNCATED}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", " "]), st.sampled_from(list(FAULTS))), max_size=9))
def test_integer_weights_give_the_cheapest_and_least_audit(rows):
    weights = repair.Weights(len(rows))
    steps = [(r[:1], FAULTS[f]) for r, f in rows]
    cost, audit = weights.read(repair.least_paths(steps, weights.ends(), weights)[repair.START])
    assert (cost, audit.decode()) == cheapest_repair([(r, "x", f) for r, f in rows])[:2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("uasx"), st.sampled_from(list(FAULTS.values()))), min_size=1, max_size=14), st.integers(1, 5))
def test_fragments_put_together_equal_the_whole(rows, block):
    weights = repair.Weights(len(rows))
    want = weights.read(repair.least_paths(rows, weights.ends(), weights)[repair.START])
    held = repair._Conversation()
    cut = [rows[i:i + block] for i in range(0, len(rows), block)]
    for i in reversed(range(len(cut))):
        held.add({"part": 0, "seq": i, **repair._fragment([(None, a, f, 0) for a, f in cut[i]], False)})
    summary, slices = held.finish(1)
    assert (summary["cost"], summary["audit"].encode()) == want
    assert "".join(s["letters"] for s in slices) == summary["audit"]


@pytest.mark.parametrize("block", [3, 2048])
def test_hot_conversation_nulls_ties_and_repeats(spark, block):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "why", " \t", "", None, "Ok. ", "…?"]
    hot = [(7, t, rng.choice(["user", "assistant"]), f"{rng.choice(texts[:3])} {rng.randrange(40)}{rng.choice('.x')}") for t in range(400)]
    odd = [(c, rng.choice([None, 1, 2, 5, -3]), rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice(texts))
           for c in [None, *range(40)] for _ in range(rng.randrange(1, 9))]
    same = [(99, 4, "user", "same.")] * 60 + [(98, None, "user", "x" * 200_000 + ".")] * 2
    check(spark, [*hot, *odd, *same], block=block)


def test_dropped_conversations_empty_table_and_clashing_columns(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(lost, 0, "user", "gone.")])
    assert repair.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, 1, "user", "Hi.", 5, "x")], f"{SCHEMA}, row long, fault string")
    out = repair.repair(clash.withColumnRenamed("conv_id", "part"), conv_col="part")
    assert [tuple(r) for r in out.turns.orderBy("position").collect()] == [(1, 1, "user", "Hi."), (1, 2, "assistant", "")]
    assert out.summary.first().audit == "KI"
