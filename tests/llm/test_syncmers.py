import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import queries, syncmers

SF = "/root/testdata/sf0.01"


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        cut = len(t) // 4
        out.append(t[:len(t) - cut] + texts[(i + 1) % len(texts)][:cut])
    return out


def test_query_matches_a_sequential_walk(spark):
    rows = sorted((r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect())
    changed = edited([t for _, t in rows])
    got = {r.doc_id: r for r in queries.op8_syncmers(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, ((i, text), after) in enumerate(zip(rows, changed)):
        r, own, new = got[i], syncmers.fingerprint(text), syncmers.fingerprint(after)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(after.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (syncmers.encode(own), syncmers.encode(new))
        assert r.near_edited == syncmers.likeness(own, new)
        assert r.near_next == syncmers.likeness(own, syncmers.fingerprint(rows[(k + 1) % len(rows)][1]))
    near, far = np.array([r.near_edited for r in got.values()]), np.array([r.near_next for r in got.values()])
    assert np.quantile(near, 0.05) > 0.3 and np.quantile(far, 0.95) < 0.1


def closed(text, k, s):
    """Closed syncmers by their definition, with the operator's s-mer hashes."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    inner = syncmers.sequence_hashes(syncmers.mix(points + np.uint64(0x9E37)), s)
    return [i for i in range(len(text) - k + 1) if min(inner[i:i + k - s + 1]) in (inner[i], inner[i + k - s])]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé🙂", min_size=6, max_size=80))
def test_syncmers_by_definition(text):
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    _, at = syncmers.syncmers(points, 6, 3)
    assert at.tolist() == closed(text, 6, 3)


def test_long_texts_in_pieces_and_short_texts(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=5000))
    whole = syncmers.fingerprint(text)
    monkeypatch.setattr(syncmers, "_CHUNK", 700)
    assert syncmers.fingerprint(text) == whole
    assert syncmers.fingerprint("") == b"" and len(syncmers.fingerprint("abc")) == 7 and len(syncmers.fingerprint("short")) == 14
    repeated, after = "word word. " * 400, "word word. " * 300 + text[:1100]
    assert 0.4 < syncmers.likeness(syncmers.fingerprint(repeated), syncmers.fingerprint(after)) < 0.8
    assert syncmers.likeness(b"", b"") == 1.0 and syncmers.likeness(b"", whole) == 0.0 and syncmers.likeness(whole, whole) == 1.0
    moved = syncmers.fingerprint("inserted in front " * 40 + text)
    assert syncmers.likeness(whole, moved) > 0.6


def walk(spark, rows, parts):
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    return {r.doc_id: r for r in syncmers.compare_with_next(docs, parts=parts).collect()}


def test_neighbours_across_ranges(spark):
    rng = random.Random(3)
    ids = rng.sample(range(-500, 10_000), 60)
    rows = [(i, "".join(rng.choices("abc \né", k=rng.randint(0, 60))), "x") for i in ids]
    want = edited([t for _, t, _ in sorted(rows)])
    for parts in (1, 3, 40):
        got = walk(spark, rows, parts)
        assert [got[i].edited_sha256 for i in sorted(ids)] == [hashlib.sha256(t.encode()).hexdigest() for t in want]


def test_any_long_id_and_ranges_by_bytes(spark, monkeypatch):
    top = (1 << 63) - 1
    ids = [-top - 1, -top, -1, 0, 7, 1 << 53, (1 << 53) + 1, top - 2, top - 1, top]
    rows = [(i, f"text of number {n} " * 3, "x") for n, i in enumerate(ids)]
    want = edited([t for _, t, _ in rows])
    for parts in (1, 4, 9):
        got = walk(spark, rows, parts)
        assert [got[i].edited_sha256 for i in ids] == [hashlib.sha256(t.encode()).hexdigest() for t in want]
    docs = spark.createDataFrame([(i, "y" * 1000) for i in range(200)], "id long, text string")
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 4000)
    dealt = syncmers.neighbours(docs)
    held = dealt.where("not tail").groupBy("part").count().collect()
    assert len(held) >= 45 and max(r["count"] for r in held) <= 12
    from pyspark.sql import functions as F
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("part").alias("ranges")).collect()
    assert len(tasks) == len(held) and all(t.ranges == 1 for t in tasks)


def test_nulls_repeats_and_small_tables(spark):
    assert walk(spark, [], 4) == {}
    one = walk(spark, [(7, "only document here", None)], 4)[7]
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"only document only").hexdigest()
    docs = spark.createDataFrame([(None, None), (2, "b" * 40), (2, "b" * 40), (3, "c" * 300_000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_chars, r.near_next) for r in syncmers.compare_with_next(docs, parts=3).collect()), key=repr)
    assert got == sorted([(None, 0, 0.0), (2, 40, 1.0), (2, 40, 0.0), (3, 300_000, 0.0)], key=repr)


def test_long_texts_with_moved_blocks_and_far_positions():
    rng = random.Random(5)
    blocks = ["".join(rng.choices("abcdefghijklmnop ", k=2000)) for _ in range(120)]
    other = ["".join(rng.choices("abcdefghijklmnop ", k=2000)) for _ in range(120)]
    text, far = syncmers.fingerprint("".join(blocks)), syncmers.fingerprint("".join(other))
    mixed = syncmers.fingerprint("".join(rng.sample(blocks, len(blocks))))
    assert syncmers.likeness(text, mixed) > 0.9 and syncmers.likeness(text, far) < 0.01
    # a passage of a few percent of both
    passage = syncmers.fingerprint("".join(other[:60] + blocks[50:56] + other[60:]))
    assert 0.01 < syncmers.likeness(text, passage) < 0.05
    # the start of one text stands beyond 2^24 in the other, or everything moves a little
    head = "".join(blocks)
    at = lambda n: syncmers._read(syncmers.fingerprint("-" * n + head))
    (h0, p0), (h1, p1) = at(0), at((1 << 24) + 100)
    _, i, j = np.intersect1d(h0, h1, return_indices=True)
    assert np.mean((p1[j] - p0[i]) % (1 << 24) == 100) > 0.9
    assert syncmers.likeness(syncmers.fingerprint("x" * 9 + head), text) > 0.9 and syncmers.likeness(text, syncmers.fingerprint("x" * 9 + head)) > 0.9


def test_edits_that_cross_the_limit_of_short_texts(spark):
    rng = random.Random(6)
    draw = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    like = lambda a, b: syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b))
    for n in range(48, 64):
        text = draw(n)
        assert like(text, text[:n - n // 4]) > 0.5 and like(text, draw(n - n // 4)) < 0.2
    text = draw(180)
    assert like(text[:47], text[:49]) > 0.9 and like(text[:47], text[:90]) > 0.3
    got = walk(spark, [(1, text[:56], "x"), (2, "", "x")], 3)[1]
    assert got.near_edited > 0.5
