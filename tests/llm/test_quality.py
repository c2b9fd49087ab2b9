import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import quality, queries

SF = "/root/testdata/sf0.01"


def plain_weights(rows, good, buckets=quality.BUCKETS):
    """Log weights from n-grams counted one by one."""
    def grams(text):
        ids = [zlib.crc32(w.encode()) for w in quality._TOKENS(text or "")]
        mask, spread = (1 << 64) - 1, 0x9E3779B97F4A7C15
        out = [((i * spread & mask) >> 40) % buckets for i in ids]
        return out + [0 if a == b else ((((a * spread + b + 1) & mask) * spread & mask) >> 40) % buckets for a, b in zip(ids, ids[1:])]

    raw, target, split = np.zeros(buckets), np.zeros(buckets), [(i, grams(t)) for i, t in rows]
    for i, g in split:
        for b in g:
            raw[b] += 1
            target[b] += i in good
    ratios = np.log((target + quality.PRIOR) / (raw * target.sum() / raw.sum() + quality.PRIOR))
    return {i: float(sum(ratios[b] for b in g)) for i, g in split}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    want = plain_weights(docs, {i for i, q in labels.items() if q})
    scored = quality.score(queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"))
    weighed = {r.doc_id: r for r in scored.select("doc_id", "log_weight", "gumbel_weight", "good").collect()}
    assert max(abs(weighed[i].log_weight - w) for i, w in want.items()) < 1e-6
    # the draw, with the query's own weights: as many as reach the best cut, the largest noisy weights
    scored = quality.score(queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"), prior=None, language=F.col("lang"))
    weighed = {r.doc_id: r for r in scored.select("doc_id", "log_weight", "gumbel_weight", "good").collect()}
    marked = sorted((weighed[i].log_weight, q) for i, q in labels.items())
    values = np.array([w for w, _ in marked])
    flags = np.array([q for _, q in marked])
    def balanced(cut):
        return ((values > cut) & (flags == 1)).sum() / (flags == 1).sum() + ((values <= cut) & (flags == 0)).sum() / (flags == 0).sum()
    kept = {r.doc_id for r in queries.op6_quality_resample(spark, SF).collect()}
    ordered = sorted(weighed.values(), key=lambda r: -r.gumbel_weight)
    assert kept == {r.doc_id for r in ordered[:len(kept)]}
    ranked = sorted((r.log_weight for r in weighed.values()), reverse=True)
    cut = ranked[len(kept)] if len(kept) < len(ranked) else -np.inf
    assert balanced(cut) >= max(balanced(v) for v in values) - 0.02
    good = [i for i, q in labels.items() if q]
    poor = [i for i, q in labels.items() if not q]
    assert np.mean([i in kept for i in good]) > 0.97 and np.mean([i in kept for i in poor]) < 0.1


def test_registered_weights_match_brute_force(spark):
    """As the query has them: prior relative to the target, raw text weighted
    to the labels' languages, noise at power 1."""
    docs = {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    own, whole = {}, {}
    for i, r in docs.items():
        whole[r.lang] = whole.get(r.lang, 0) + 1
        own[r.lang] = own.get(r.lang, 0) + (i in labels)
    share = {x: own[x] / whole[x] for x in whole}
    weight = {x: round(share[x] * 2 ** 20 / max(share.values())) for x in share}
    grams = {}
    for i, r in docs.items():
        ids = [zlib.crc32(w.encode()) for w in quality._TOKENS(r.text or "")]
        mask, spread = (1 << 64) - 1, 0x9E3779B97F4A7C15
        two = [0 if a == b else ((((a * spread + b + 1) & mask) * spread & mask) >> 40) % quality.BUCKETS for a, b in zip(ids, ids[1:])]
        grams[i] = [((x * spread & mask) >> 40) % quality.BUCKETS for x in ids] + two
    raw, good = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, g in grams.items():
        np.add.at(raw, g, weight[docs[i].lang])
        if labels.get(i):
            np.add.at(good, g, 1)
    prior = quality.PRIOR_SHARE * good.mean()
    ratios = np.log((good + prior) / (raw * good.sum() / raw.sum() + prior))
    got = queries.op6_quality_resample(spark, SF).collect()
    assert len(got) > 500 and max(abs(r.log_weight - ratios[grams[r.doc_id]].sum()) for r in got) < 1e-6
    noise = [r.gumbel_weight - r.log_weight for r in got]
    assert 0.4 < np.mean(noise) < 0.8 and 1.0 < np.std(noise) < 1.6  # 0.577 and 1.28 for Gumbel's


def test_kth_largest_and_ties(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate((rng.normal(size=500) * 10.0 ** rng.integers(-6, 6, 500), np.full(40, 3.25)))
    scores = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = np.sort(values)[::-1]
    for k in (1, 7, 200, 300, 539):
        assert quality.kth_largest(scores, "x", k) == ordered[k - 1]
    assert quality.kth_largest(scores, "x", 540) == -np.inf and quality.kth_largest(scores, "x", 0) == np.inf


def test_nulls_repeats_labels_and_k(spark):
    rows = [(i, f"good plain words number {i} here", "a") for i in range(30)] + [(100 + i, "### $$$ @@@ " * 5, "b") for i in range(10)]
    rows += [(None, None, None), (200, "", "c"), (0, rows[0][1], "a"), (300, "good words " * 30_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_weight string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(5)] + [(0, 0), (1, None), (None, 1), (999, 1), (300, 1)],
                                   "doc_id long, quality int")
    kept = quality.resample(docs, labels)
    assert kept.columns == ["doc_id", "text", "log_weight", "gumbel_weight", "good"]
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 2 and not [i for i in ids if i and 100 <= i < 110] and 300 in ids
    assert len({r.gumbel_weight for r in kept.where("doc_id = 0").collect()}) == 1
    assert quality.resample(docs, labels, k=3).count() == 3
    assert quality.resample(docs, labels.limit(0)).count() == len(rows)
    assert quality.resample(docs.limit(0), labels).count() == 0


def test_a_table_repeated_many_times_keeps_the_same_documents(spark, monkeypatch):
    read = queries.table
    once = {r.doc_id: r.log_weight for r in queries.op6_quality_resample(spark, SF).collect()}
    monkeypatch.setattr(queries, "table", lambda s, d, name: read(s, d, name).crossJoin(s.range(40).select()) if name == "documents" else read(s, d, name))
    many = [(r.doc_id, r.log_weight) for r in queries.op6_quality_resample(spark, SF).collect()]
    assert len(many) == 40 * len(once) and {i for i, _ in many} == set(once)
    assert max(abs(w - once[i]) for i, w in many) < 1e-6


def test_a_language_with_half_the_labels_keeps_its_good_documents(spark, monkeypatch):
    read, sf = queries.table, "/root/testdata/sf0.1"
    lang = {r.doc_id: r.lang for r in read(spark, sf, "documents").select("doc_id", "lang").collect()}
    labels = read(spark, sf, "labels")
    good = [r.doc_id for r in labels.collect() if r.quality and lang.get(r.doc_id) == "de"]
    poor = [r.doc_id for r in labels.collect() if r.quality == 0]
    fewer = labels.join(read(spark, sf, "documents").where("lang = 'de'").select("doc_id"), "doc_id", "left_anti").unionByName(
        labels.join(read(spark, sf, "documents").where("lang = 'de' AND crc32(cast(doc_id AS string)) % 2 = 0").select("doc_id"), "doc_id", "left_semi"))
    monkeypatch.setattr(queries, "table", lambda s, d, name: fewer if name == "labels" else read(s, d, name))
    kept = {r.doc_id for r in queries.op6_quality_resample(spark, sf).collect()}
    assert np.mean([i in kept for i in good]) > 0.97 and np.mean([i in kept for i in poor]) < 0.1
