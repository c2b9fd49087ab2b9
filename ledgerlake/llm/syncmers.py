"""Document fingerprints from closed syncmers.

A k-mer (``k`` code points) is a closed syncmer if the least of its s-mers (by
hash) lies at its start or end - at either, if several are least.  Whether a
k-mer is chosen depends on the k-mer alone, so an edit moves only the anchors
it touches.  Anchors are a multiset: the j-th occurrence of a syncmer has a hash
of its own, so repetitive texts keep their weight.  A fingerprint holds the
``size`` anchors with the least hashes, of longer texts all those of the least
1 / ``RATE`` of the hash range, and the code points where they stand; it is
base64 of 7-byte entries (4 bytes hash, 3 bytes position modulo 2^24), about one
entry for 110 code points of a long text, so a block moved within it still holds
several anchors.

Likeness of two fingerprints, 0 to 1: of the ``size`` least hashes of both
together (as in a bottom-k sketch), or of all those of the least 1 / ``RATE``
if these are more, the share that both hold, at matching
positions: the differences in position (modulo 2^24) that occur among the shared anchors
are grouped to within ``slack`` code points, and anchors of groups that hold
fewer than ``agree`` of them are taken for chance (one is enough for
fingerprints of under eight anchors).

Defined cases: a null text is the empty text; a text of fewer than 4 k code
points is too short to be sampled, so all its runs of four are anchors (the
whole text, if it is shorter still).  Texts from there up to 16 k code points
hold the ``size`` least of both kinds, told apart by the lowest bit of the hash:
two fingerprints are compared by their syncmers if both have any, else by their
runs of four, so an edit across the limit is seen.  The empty text's fingerprint is empty and
its likeness is 1 to another empty one, else 0.  The
neighbour of a document is the next in ascending doc_id, after the last the
first; with one document it is its own neighbour.  Rows with a null doc_id come
first, ties in doc_id are ordered by text.

At scale: neighbours need no global window.  Documents are dealt by ranges of
doc_id (bounds from all ids' quantiles, as many ranges as the texts' bytes ask
for), each range to a task of its own, and sorted within them; the first row
of each range also goes to the range before it, as its last neighbour.  Texts
are shuffled once, and rows stream through a task one batch at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches
from .rlz import mix, sequence_hashes, sliding_min

K, S, SIZE = 12, 6, 48
SLACK, AGREE = 64, 2
SHORT = 4
RATE = 32
_LEAST = (1 << 32) // RATE
_TURN = 1 << 24
_CHUNK = 1 << 20
#: Bytes of text that a range of neighbours is to hold.
RANGE_BYTES = 64 << 20
_MOST_ID = (1 << 63) - 1


def syncmers(points: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the closed syncmers of a code point array; needs
    k <= 2 * s, so that the two edge s-mers cover a k-mer."""
    inner = sequence_hashes(mix(points + np.uint64(0x9E37)), s)
    least = sliding_min(inner, k - s + 1)
    last = inner[k - s:]
    chosen = np.flatnonzero((inner[:len(least)] == least) | (last == least))
    return mix(inner[chosen] * np.uint64(0x9E3779B97F4A7C15) + last[chosen]), chosen


def _runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    hashes = sequence_hashes(mix(points.astype(np.uint64) + np.uint64(0x9E37)), min(SHORT, len(text)))
    return hashes, np.arange(len(hashes))


def _anchors(text: str, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    found = [(h, p + at) for at in range(0, len(points) - k + 1, _CHUNK)  # long texts in overlapping pieces
             for h, p in [syncmers(points[at:at + _CHUNK + k - 1].astype(np.uint64), k, s)]]
    return np.concatenate([h for h, _ in found]), np.concatenate([p for _, p in found])


def fingerprint(text: str, k: int = K, s: int = S, size: int = SIZE) -> bytes:
    """Entries of one text, sorted by hash (see the module docstring)."""
    if not text:
        return b""
    few = _entries(*_runs(text), size, 1) if len(text) < 16 * k else []
    many = _entries(*_anchors(text, k, s), size, 0) if len(text) >= 4 * k else []
    entry = np.concatenate([e for e in (few, many) if len(e)])
    return entry[np.lexsort(entry.T[3::-1])].tobytes()


def _entries(hashes: np.ndarray, at: np.ndarray, size: int, kind: int) -> np.ndarray:
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
    nth = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    marked = mix(ranked + mix(nth.astype(np.uint64))) >> np.uint64(32)
    marked = marked & ~np.uint64(1) | np.uint64(kind)
    if len(marked) > 4 * size:
        few = np.flatnonzero(marked <= max(np.partition(marked, 4 * size)[4 * size], np.uint64(_LEAST)))
        marked, order = marked[few], order[few]
    least, index = np.unique(marked, return_index=True)
    kept = max(size, np.searchsorted(least, np.uint64(_LEAST)))
    least, where = least[:kept], at[order[index[:kept]]]
    entry = np.zeros((len(least), 7), np.uint8)
    entry[:, :4] = least.astype(">u4").view(np.uint8).reshape(-1, 4)
    entry[:, 4:] = (where % _TURN).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]
    return entry


def encode(entries: bytes) -> str:
    return base64.b64encode(entries).decode()


def _read(entries: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(entries, np.uint8).reshape(-1, 7).astype(np.int64)
    return (raw[:, 0] << 24 | raw[:, 1] << 16 | raw[:, 2] << 8 | raw[:, 3],
            raw[:, 4] << 16 | raw[:, 5] << 8 | raw[:, 6])


def likeness(a: bytes, b: bytes, size: int = SIZE, slack: int = SLACK, agree: int = AGREE) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (ha, pa_), (hb, pb) = _read(a), _read(b)
    kind = int((ha & 1).all() or (hb & 1).all())  # of a text without syncmers, the runs of four
    (ha, pa_), (hb, pb) = ((h[h & 1 == kind], p[h & 1 == kind]) for h, p in ((ha, pa_), (hb, pb)))
    if not len(ha) or not len(hb):
        return 0.0
    # a sketch that is not full is the whole set; a full one is known up to its largest hash, at least to _LEAST
    union = np.union1d(ha, hb)
    union = union[:max(size, np.searchsorted(union, _LEAST))]
    shared, ia, ib = np.intersect1d(ha, hb, return_indices=True)
    known = shared <= union[-1]
    moved = np.sort((pa_[ia[known]] - pb[ib[known]]) % _TURN)
    if not len(moved):
        return 0.0
    group = np.cumsum(np.diff(moved, prepend=moved[0]) > slack)
    if moved[0] + _TURN - moved[-1] <= slack:  # small moves to either side
        group[group == group[-1]] = 0
    held = np.bincount(group)
    least = min(agree, max(1, min(len(ha), len(hb)) // 4))
    return float(held[held >= least].sum() / len(union))


# --- neighbours -------------------------------------------------------------------

def _ranges(docs: DataFrame, parts: int) -> list:
    """Upper bounds (exclusive) of ``parts`` ranges of doc_id."""
    share = [i / parts for i in range(1, parts)]
    bounds = docs.select(F.col("id").cast("double").alias("x")).approxQuantile("x", share, 0.2 / parts) if share else []
    return sorted(set(min(int(b) + 1, _MOST_ID) for b in bounds))  # any bounds are right, even ones are quick


def _range_number(bounds: list[int]) -> Column:
    """Number of bounds at or below id, found in two steps of at most a few
    dozen comparisons each."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[step - 1::step]] or [F.lit(None).cast("long")])
    skip = F.size(F.filter(coarse, lambda b: b <= F.col("id"))) * step
    return skip + F.size(F.filter(F.slice(edges, skip + 1, step), lambda b: b <= F.col("id")))


def neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, id, text, tail): rows dealt by ranges of id, sorted; a ``tail``
    row is the first row of the following range (of the first one, after the
    last) and is there only as a neighbour.  ``docs`` has id (an integer) and text."""
    if not parts:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        parts = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    part = F.when(F.col("id").isNull(), 0).otherwise(_range_number(_ranges(docs.select("id"), parts)))
    dealt = docs.select(part.cast("int").alias("part"), "id", "text")
    order = F.struct(F.col("id").isNotNull().alias("known"), "id", F.xxhash64("text").alias("digest"))
    heads = sorted(dealt.groupBy("part").agg(F.min(order).alias("head")).collect())  # one row a range
    if not heads:
        return dealt.select("part", "id", "text", F.lit(False).alias("tail"))
    last = {h.part: i for i, h in enumerate(heads)}
    slots = [last.get(p) for p in range(max(last) + 1)]  # of every range number
    before = F.array(*[F.lit(None if i is None else heads[i - 1].part).cast("int") for i in slots])
    firsts = F.array(*[F.struct(F.lit(None if i is None else heads[i].head.id).cast("long").alias("id"),
                                F.lit(0 if i is None else heads[i].head.digest).cast("long").alias("digest"))
                       for i in slots])
    own = F.struct(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("digest"))
    at = F.col("part") + 1
    copies = F.when(F.element_at(firsts, at) == own, F.array(
        F.struct("part", F.lit(False).alias("tail")), F.struct(F.element_at(before, at).alias("part"), F.lit(True).alias("tail"))))
    spread = dealt.select("id", "text", F.explode(F.coalesce(copies, F.array(
        F.struct("part", F.lit(False).alias("tail"))))).alias("x"))
    return (spread.select("x.part", "id", "text", "x.tail").repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", "tail", F.col("id").asc_nulls_first(), F.xxhash64("text")))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S,
                      size: int = SIZE, parts: int | None = None) -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.  The edited text has its
    last floor(n_chars / 4) code points replaced by the neighbour's first as
    many (or all)."""
    document_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document that waits for its neighbour: part, id, text, fingerprint
        for batch in batches:
            part, ids, texts, tail = (c.to_pylist() for c in batch.columns)
            done: list[tuple] = []
            last_tail = None
            for p, i, text, is_tail in zip(part, ids, texts, tail):
                if is_tail and last_tail == p:
                    continue  # equal rows at the head of a range: one is enough
                own = fingerprint(text, k, s, size)
                if held is not None:
                    done.append(pair(held, text, own))
                held = None if is_tail else (i, text, own)
                last_tail = p if is_tail else None
            columns = list(zip(*done)) if done else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema=schema)

    def pair(held: tuple, text: str, own: bytes) -> tuple:
        i, mine, fp = held
        cut = len(mine) // 4
        edited = mine[:len(mine) - cut] + text[:cut]
        changed = fingerprint(edited, k, s, size)
        return (i, len(mine), hashlib.sha256(edited.encode()).hexdigest(), encode(fp), encode(changed),
                likeness(fp, changed, size), likeness(fp, own, size))

    types = [pa.int64() if kind == "bigint" else pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(),
             pa.float64(), pa.float64()]
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = pa.schema(list(zip(names, types)))
    out = neighbours(rows, parts).mapInArrow(
        walk, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)


def fingerprint_column(text: Column, k: int = K, s: int = S, size: int = SIZE) -> Column:
    """Fingerprints of a text column."""
    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([encode(fingerprint(t or "", k, s, size)) for t in column.to_pylist()], pa.string())

    return of(text.cast("string"))
