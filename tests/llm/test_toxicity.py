import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in queries.table(spark, SF, "labels").collect()}
    rows = queries.op5_toxicity(spark, SF).collect()
    assert len(rows) == queries.table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean]) > 0.95
    assert np.mean([s >= 0.5 for s in toxic]) > 0.75 and np.mean([s >= 0.5 for s in clean]) < 0.06


def samples(words, n, bad, rng, codes):
    texts, toxic = [], []
    for i in range(n):
        text = list(rng.choice(words, 30))
        if i % 2:
            text[rng.integers(30)] = bad[i % len(bad)]
        texts.append(" ".join(text).encode())
        toxic.append(i % 2)
    return texts, [toxicity.codes_of([t], codes)[0] for t in texts], np.array(toxic)


def test_learns_words_and_stems_anywhere_in_a_text():
    rng, codes = np.random.default_rng(1), toxicity.WordCodes()
    words = [f"word{i}x" for i in range(3000)]
    _, train, toxic = samples(words, 400, ["badstem1", "badstem2", "vile"], rng, codes)
    net = toxicity.train(train, toxic)
    texts, _, truth = samples(words, 200, ["badstem77", "vile"], rng, codes)
    flat, lengths = toxicity.codes_of(texts, codes)
    got = toxicity._scores(net, flat, lengths)
    assert ((got >= 0.5) == truth).mean() > 0.97
    # one long text, scored in pieces, is as toxic as its worst part
    long = (b"word1x " * 300_000) + texts[1]
    flat, lengths = toxicity.codes_of([long], codes)
    assert toxicity._scores(net, flat, lengths)[0] >= 0.5


def test_pooling_and_gradient_agree_with_plain_loops():
    rng, codes = np.random.default_rng(2), toxicity.WordCodes()
    net = toxicity.Network.start(rng)
    for t in net.tables:
        t[1:] = rng.normal(size=t[1:].shape)
    texts = [b"", b"one", b"one two three four five six", b"a b"]
    flat, lengths = toxicity.codes_of(texts, codes)
    got = net.pooled(flat, lengths)
    for k, text in enumerate(texts):
        own, _ = toxicity.codes_of([text], codes)
        e = net.embed(own)
        want = [max(0, max(sum(e[i + j] @ net.filters[w][j][:, f] for j in range(w)) for i in range(len(e) - w + 1)) + net.bias[w][f])
                for w in toxicity.WIDTHS for f in range(toxicity.FILTERS)]
        assert np.allclose(got[k], want, atol=1e-5)


def test_nulls_repeats_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "some text", "x"), (3, "some text", "x"), (None, "t " * 200_000, "x")],
                                 "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, none)
    assert got.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    assert [(r.score, r.predicted) for r in got.collect()] == [(0.0, 0)] * 5
    some = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (3, None), (None, 1), (77, 0)], "doc_id long, toxic int")
    rows = toxicity.score(docs, some).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id == 3}) == 1
    assert toxicity.score(docs.limit(0), some).count() == 0


def test_long_texts_do_not_end_the_sample(spark):
    # 8 clean labels to a toxic one, every second clean text long, and giant texts in both classes
    rows = [(i, "word " * (150 if i % 2 else 10)) for i in range(160)] + [(1000 + i, "vile " * 10) for i in range(20)]
    giants = [(i, "giant " * 5000) for i in range(2000, 2040)]
    docs = spark.createDataFrame(rows + giants, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000 and i % 2 == 0 or 1000 <= i < 2000)) for i, _ in rows + giants], "doc_id long, toxic int")
    def sizes(words):
        samples, toxic = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", F.lit(True), 200, words)
        return [[len(s) for s, t in zip(samples, toxic) if t == k] for k in (0, 1)]
    clean, bad = sizes(4000)
    assert len(bad) == 20 and sum(clean) <= 2000 and sum(clean) > 1980 and {13, 153} <= set(clean)
    clean, bad = sizes(4)  # nothing fits: one of each class
    assert (clean, bad) == ([13], [13])
    assert [len(x) for x in sizes(10_000_000)] == [180, 40]


def test_learns_from_every_labelled_document(spark):
    # 7000 clean texts: more than a class's old share of the fit; one word is in 12 toxic texts only
    rows = [(i, f"plain words number{i % 50} and more") for i in range(7000)] + [(10_000 + i, f"plain words vile{i % 4}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i >= 10_000)) for i, _ in rows], "doc_id long, toxic int")
    usable = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    counted = []
    old = toxicity.row_counts

    def spied(coded):
        counted.append({r.kept: r["count"] for r in coded.groupBy("kept").count().collect()})
        return old(coded)

    toxicity.row_counts = spied
    try:
        got = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    finally:
        toxicity.row_counts = old
    assert set(counted[0]) == {False} and 0.7 * len(usable) < counted[0][False] < 0.8 * len(usable) and counted[0][False] > 4000
    assert np.mean([got[i] >= 0.5 for i, _ in rows if i >= 10_000]) > 0.9 and np.mean([got[i] >= 0.5 for i, _ in rows if i < 10_000]) < 0.05


def test_counts_over_all_texts_are_plain_counts(spark):
    codes = toxicity.WordCodes()
    texts = [("a b a", 1), ("b c", 0), ("a", 0), ("", 1)] * 3
    flat = [(t, toxicity.codes_of([x.encode()], codes)[0].tolist()) for x, t in texts]
    coded = spark.createDataFrame(flat, "toxic int, codes array<long>").repartition(4)
    held = toxicity.row_counts(coded)
    want = np.zeros_like(held)
    for t, c in flat:
        for i in range(len(toxicity.TABLES)):
            want[i, t, sorted({x >> 16 * i & 0xFFFF for x in c})] += 1
    assert (held == want).all()


def test_shortened_text_has_the_same_maxima():
    rng, codes = np.random.default_rng(4), toxicity.WordCodes()
    net = toxicity.Network.start(rng)
    for t in net.tables:
        t[1:] = rng.normal(size=t[1:].shape)
    flat, lengths = toxicity.codes_of([" ".join(f"w{i}" for i in rng.integers(0, 5000, 150_000)).encode()], codes)
    short = toxicity.shortened(net, flat)
    assert len(short) < 200
    assert (net.pooled(short, np.array([len(short)])) >= net.pooled(flat, lengths) - 1e-4).all()
