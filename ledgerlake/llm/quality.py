"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and runs of other signs, one
and two at a time, in ``buckets`` buckets) are counted over all documents: the
raw text's and the target's, the documents labelled as good.  (A token right
after itself is one and the same two-gram, whatever the token.)  A document's
log importance weight is the sum over its n-grams of log p_target / p_raw,
where the target's counts are drawn to the raw ones by ``prior`` pseudo-counts
a bucket, so that buckets without evidence say nothing.  :func:`resample` takes
as prior ``PRIOR_SHARE`` times the target's mean count a bucket, so the weights
do not depend on how large the table is (:func:`score` has a fixed number
unless told otherwise).

Given a ``language`` column, the raw model has the languages' mix among the
labelled documents (good and poor): a language's raw counts are weighted by the
share of its documents that is labelled, so one with few labels is not taken
for poor.

``k`` documents are
drawn without replacement in proportion to their weights to the power
``sharpness`` by Gumbel top-k: the k largest of sharpness * log weight + Gumbel
noise, the noise a function of (seed, doc_id, text), so the draw can be
repeated.  The power is 1 unless asked: a higher one leaves less to chance for
short documents, whose weights are near 1.

``k`` is the number of documents whose weight reaches the cut that best tells
labelled good documents from labelled poor ones (balanced accuracy over all
labelled rows), or any number the caller gives.

Defined cases: null and empty texts have weight 0; of several labels of a
document the highest counts; null labels and labels of unknown documents are
left out; without both kinds of labels nothing is rejected; a null language is a language
of its own, and n-grams found only in languages without labels say nothing.  Repeated rows get
the same noise and stay or go together, and all rows tied at the last place
stay, so more than k rows can stay.  Other columns pass through, one named
like an added column is replaced.

At scale: counts are added up per task and then by Spark, and the model that
comes to the driver has a fixed size.  The k-th largest value is found by
narrowing a histogram of all scores (no global sort); the scored documents are
written once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, small, texts_of, with_columns_kept, written

BUCKETS = 1 << 15
#: Pseudo-counts a bucket: a document's own n-grams, or those of a language that
#: happens to be rare among the labels, must not outweigh the evidence.
PRIOR = 500.0
#: The prior in units of the target's mean count a bucket (500 at sf0.01).
PRIOR_SHARE = 52.0
SHARPNESS = 1.0
_UNIT = 1 << 20  # weights of languages are whole numbers up to this, so sums are exact
_BINS = 1024


class TokenHashes(dict):
    """token -> 32-bit hash, kept for the tokens met before."""

    LIMIT = 1 << 19

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = zlib.crc32(token.encode())
        return value


_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
#: Texts of a batch are handled together up to this many bytes.
_CHUNK_BYTES = 1 << 21


def ngram_buckets(texts: list[bytes], hashes: TokenHashes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every one- and two-gram."""
    split = [_TOKENS(t.decode()) for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    ids = np.fromiter((hashes[w] for s in split for w in s), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(texts)), counts)
    spread = np.uint64(0x9E3779B97F4A7C15)
    one = (ids * spread) >> np.uint64(40)
    two = ((ids[:-1] * spread + ids[1:] + np.uint64(1)) * spread) >> np.uint64(40)
    two[ids[:-1] == ids[1:]] = 0  # any token twice in a row is one two-gram
    same = owner[:-1] == owner[1:]
    bucket = np.concatenate((one, two[same])) % np.uint64(buckets)
    return bucket.astype(np.int64), np.concatenate((owner, owner[:-1][same]))


def _parts(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > _CHUNK_BYTES:
            yield at, held
            at, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def ngram_counts(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows (text, good, weight), each row's times
    its weight, and over the good ones."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, raw, good = TokenHashes(), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            flags = np.array(batch.column(1).to_pylist(), bool)
            weights = np.array(batch.column(2).to_pylist(), np.float64)
            for at, part in _parts(texts_of(batch.column(0))):
                bucket, owner = ngram_buckets(part, hashes, buckets)
                raw += np.bincount(bucket, weights[at + owner], buckets).astype(np.int64)
                good += np.bincount(bucket[flags[at + owner]], minlength=buckets)
        used = np.flatnonzero(raw + good)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])],
                                         names=["bucket", "raw", "good"])

    found = (rows.select("text", "good", "weight").mapInArrow(count, "bucket long, raw long, good long")
             .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect())
    raw, good = np.zeros(buckets), np.zeros(buckets)
    for r in found:  # at most one row a bucket
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    return raw, good


def language_weights(rows: DataFrame) -> DataFrame:
    """(of, weight): by ``language`` the share of the rows (language, good) that
    are labelled, in units of the largest share."""
    held = written(rows.groupBy("language").agg(F.count(F.lit(1)).alias("all"), F.count("good").alias("own")), "quality-languages")
    share = F.col("own") / F.col("all")
    most = held.agg(F.max(share)).first()[0] or 1.0
    weight = F.when(share > 0, F.greatest(F.lit(1), F.round(share * (_UNIT / most)))).otherwise(0)
    return held.select(F.col("language").alias("of"), weight.cast("long").alias("weight"))


def log_ratios(raw: np.ndarray, good: np.ndarray, prior: float | None = PRIOR) -> np.ndarray:
    """log p_target / p_raw of each bucket; no prior: PRIOR_SHARE of the mean."""
    if not good.sum():
        return np.zeros(len(raw))
    if prior is None:
        prior = PRIOR_SHARE * good.mean()
    expected = raw * (good.sum() / raw.sum())
    return np.log((good + prior) / (expected + prior))


def weight_column(text: Column, ratios: np.ndarray) -> Column:
    """Log importance weight of each text."""
    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        hashes = kept.setdefault("hashes", TokenHashes())
        texts = texts_of(column)
        out = np.zeros(len(texts))
        for at, part in _parts(texts):
            bucket, owner = ngram_buckets(part, hashes, len(ratios))
            out[at:at + len(part)] = np.bincount(owner, weights=ratios[bucket], minlength=len(part))
        return pa.array(out)

    kept: dict[str, TokenHashes] = {}
    return of(text)


def gumbel(seed: int, *of: Column) -> Column:
    """Standard Gumbel noise, a function of the seed and the columns."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def best_cut(labelled: DataFrame) -> float:
    """The weight that best separates the rows (log_weight, good): histograms
    of all of them, narrowed around the best edge."""
    lo, hi, kinds = labelled.agg(F.min("log_weight"), F.max("log_weight"), F.count_distinct("good")).first()
    if kinds != 2 or lo == hi:
        return -np.inf
    start, step = lo, (hi - lo) / _BINS
    while True:
        slot = F.greatest(F.lit(0), F.least(F.lit(_BINS), F.ceil((F.col("log_weight") - start) / step))).cast("int")
        held = np.zeros((2, _BINS + 1))
        for r in labelled.groupBy("good", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect():
            held[int(r.good), r.slot] = r.n
        # a cut at edge i, start + i * step, keeps the slots above i
        score = np.cumsum(held[0]) / held[0].sum() - np.cumsum(held[1]) / held[1].sum()
        best = np.flatnonzero(score >= score.max() - 1e-12)
        cut = start + step * float(best[0] + best[-1]) / 2
        if step < 1e-3:
            return float(cut)
        start, step = cut - 16 * step, step * 32 / _BINS


def kth_largest(scores: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column by narrowing histograms."""
    lo, hi, n = scores.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    above = 0  # values over hi
    for _ in range(12):
        step = (hi - lo) / _BINS
        if step <= 0 or lo + step == lo:
            return float(lo)
        inside = scores.where((F.col(column) >= lo) & (F.col(column) <= hi))
        slot = F.least(F.lit(_BINS - 1), F.floor((F.col(column) - lo) / step)).cast("int").alias("slot")
        held = inside.groupBy(slot).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"),
                                        F.max(column).alias("hi")).orderBy(F.desc("slot")).collect()
        for r in held:  # at most _BINS rows
            if above + r.n >= k:
                lo, hi = r.lo, r.hi
                break
            above += r.n
        if above + 1 == k or lo == hi:
            return float(hi)
    return float(lo)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", buckets: int = BUCKETS, sharpness: float = SHARPNESS, seed: int = 17,
          prior: float | None = PRIOR, language: Column | None = None) -> DataFrame:
    """``docs``, written, with log_weight, gumbel_weight and good (the label,
    null without one).  ``prior`` None is the one relative to the counts."""
    document_batches(docs.sparkSession)
    added = ("log_weight", "gumbel_weight", "good", "_label_of")
    kept = with_columns_kept(docs, *added)
    marks = labels.select(F.col(f"`{id_col}`").alias("_label_of"), F.col(f"`{label_col}`").cast("int").alias("good"))
    marks = written(marks.dropna().groupBy("_label_of").agg((F.max("good") > 0).alias("good")), "quality-labels")
    rows = kept.join(small(marks, 24), F.col(f"`{id_col}`") == F.col("_label_of"), "left").drop("_label_of")
    text = F.col(f"`{text_col}`").cast("string")
    counted = rows.select(text.alias("text"), "good", F.lit(1).alias("weight"))
    if language is not None:
        tagged = rows.select(text.alias("text"), "good", language.alias("language"))
        weights = small(language_weights(tagged), 16 + F.length(F.coalesce(F.col("of").cast("string"), F.lit(""))))
        counted = tagged.join(weights, F.col("language").eqNullSafe(F.col("of"))).select("text", "good", "weight")
    raw, good = ngram_counts(counted.withColumn("good", F.coalesce("good", F.lit(False))), buckets)
    weighed = rows.withColumn("log_weight", weight_column(text, log_ratios(raw, good, prior)))
    noise = gumbel(seed, F.col(f"`{id_col}`"), F.xxhash64(text))
    return written(weighed.withColumn("gumbel_weight", F.lit(sharpness) * F.col("log_weight") + noise)
                   .select(*[F.col(f"`{c}`") for c in kept.columns], "log_weight", "gumbel_weight", "good"), "weighed")


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, prior: float | None = None, **how) -> DataFrame:
    """The rows of :func:`score` that the Gumbel top-k draw keeps."""
    weighed = score(docs, labels, prior=prior, **how)
    scores = weighed.select("log_weight", "gumbel_weight", "good")
    if k is None:
        cut = best_cut(scores.where("good is not null"))
        if cut == -np.inf:
            return weighed
        k = scores.where(F.col("log_weight") > cut).count()
    last = kth_largest(scores, "gumbel_weight", k)
    return weighed.where(F.col("gumbel_weight") >= F.lit(last))
