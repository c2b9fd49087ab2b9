"""Substring dedup by minimizer chunks and window counts over the whole corpus,
in place of a relative Lempel-Ziv parse: no reference block is chosen and no
document is factored greedily.

A window is ``window`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of
one document.  A word is removed if a window that covers it occurs, as a word
sequence, at any other place, in the same document or another; windows are
judged on the input.  Texts that are null, empty or shorter than a window have
none and lose nothing; fully repeated rows are places of their own, so they
remove each other's words, as any two copies do.

How it is done at scale.  Each document is cut at *anchors*: of the
``gram``-word runs in a window the one with the least hash (the rightmost of
equals) anchors it, so equal windows have equal anchors at equal offsets.  The
windows that follow each other with the same anchor form a *phrase*, 35 to 62
words long.  Then

1. an anchor that occurs once in the corpus ends the matter: its phrase shares
   no window with anything;
2. a phrase that occurs twice as a whole is copied (adjacent copied phrases
   join into longer ones);
3. where an anchor recurs inside differing
   phrases, the windows of each distinct phrase are compared one by one.

Word sequences are compared by two independent 64-bit hashes.  Counting is
pre-aggregated before every shuffle, one row stands for each distinct phrase
where windows are compared, and no group of equal phrases is ever gathered, so
a passage that many documents share costs no more than its rows.  Documents
are told apart by (id, hash of the text), so null and repeated ids are safe.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_batches, run_starts, texts_of, written

_K = np.uint64(0x9E3779B97F4A7C15)
_K_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_POSITION_BITS = 28
#: Words hashed at once; a longer text is a chunk of its own.
CHUNK_WORDS = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """word -> 64-bit hash, kept for the words met before."""

    LIMIT = 1 << 19

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 11)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        get = self.__getitem__
        return np.fromiter(map(get, words), np.uint64, len(words))


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on that has as many."""
    out, done, power, size = None, 0, words, 1
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    while True:
        if length & size:
            part = power[done:done + n]
            out = part.copy() if out is None else mix(out * _K + part)
            done += size
        if done == length:
            return mix(out + np.uint64(length))
        power = mix(power[:-size] * _K + power[size:]) if len(power) > size else power[:0]
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def phrases(words: np.ndarray, counts: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Phrases of documents whose word hashes lie one after the other:
    document, anchor, phrase (hashes), first (window start in the document)
    and n (windows)."""
    empty = {k: np.zeros(0, t) for k, t in
             (("doc", np.int64), ("anchor", np.int64), ("phrase", np.int64), ("first", np.int32), ("n", np.int32))}
    starts = run_starts(counts)
    if len(words) < window:
        return empty
    grams = mix(sequence_hashes(words, gram))
    at = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    least = sliding_min((grams & ~low) | (low - at), window - gram + 1)
    anchor_at = (low - (least & low)).astype(np.int64)  # of each window start
    owner = np.repeat(np.arange(len(counts)), counts)[:len(anchor_at)]
    inside = np.arange(len(anchor_at)) + window <= (starts + counts)[owner]
    where = np.flatnonzero(inside)
    if not len(where):
        return empty
    anchors, docs = anchor_at[where], owner[where]
    new = np.ones(len(where), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (docs[1:] != docs[:-1])
    heads = np.flatnonzero(new)
    first, anchor, doc = where[heads], anchors[heads], docs[heads]
    n = np.diff(np.append(heads, len(where)))
    # range hashes from prefix sums: the words from first on, n + window - 1 of them
    powers = np.cumprod(np.full(len(words), _K, np.uint64))
    inverses = np.cumprod(np.full(len(words), _K_INVERSE, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words ^ _SEEDS[0]) * powers, dtype=np.uint64)))
    whole = (sums[first + n + window - 1] - sums[first]) * inverses[first]
    shape = ((anchor - first) * 4096 + n).astype(np.uint64)
    return {"doc": doc, "anchor": grams[anchor].view(np.int64), "phrase": mix(whole ^ mix(shape)).view(np.int64),
            "first": (first - starts[doc]).astype(np.int32), "n": n.astype(np.int32)}


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(index of the first text, words of texts) in chunks of bounded size."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        words = text.split()  # bytes: ASCII white space
        if held and size + len(words) > CHUNK_WORDS:
            yield start, held
            start, held, size = i, [], 0
        held.append(words)
        size += len(words)
    if held:
        yield start, held


def phrase_table(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """The indexed reference: every phrase of every row (id, digest, text)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for start, held in _chunks(texts_of(batch.column(2))):
                counts = np.array([len(w) for w in held], np.int64)
                found = phrases(hashes.of([x for w in held for x in w]), counts, window, gram)
                rows_at = pa.array(found["doc"] + start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows_at), batch.column(1).take(rows_at)]
                    + [pa.array(found[k]) for k in ("anchor", "phrase", "first", "n")],
                    names=["id", "digest", "anchor", "phrase", "first", "n"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, digest long, anchor long, phrase long, first int, n int")


def window_table(rows: DataFrame, window: int) -> DataFrame:
    """Windows of the phrases listed with each row (id, digest, text, listed)."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, listed = texts_of(batch.column(0)), batch.column(1)
            for text, phrases_of in zip(texts, listed):
                words = hashes.of(text.split())
                one = sequence_hashes(words, window)
                two = sequence_hashes(mix(words ^ _SEEDS[1]), window)
                parts = phrases_of.values.flatten()  # first, n, anchor, phrase
                first, n, anchor, phrase = (np.asarray(p) for p in parts)
                offset = np.arange(n.sum()) - np.repeat(run_starts(n), n)
                at = np.repeat(first, n) + offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (one[at].view(np.int64), two[at].view(np.int64), np.repeat(anchor, n),
                                           np.repeat(phrase, n), offset.astype(np.int32))],
                    names=["w1", "w2", "anchor", "phrase", "offset"])

    return rows.select("text", "listed").mapInArrow(compare, "w1 long, w2 long, anchor long, phrase long, offset int")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   gram: int = 8) -> tuple[DataFrame, DataFrame]:
    """(rows, factors): the input's (id, digest, text), and per (id, digest)
    with repeated windows ``factors``, an array of (first, offsets) where
    ``offsets`` lists the repeated window starts counted from ``first``."""
    document_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    table = written(phrase_table(rows, window, gram), "rlz-phrases")
    # counts are written before they are joined back: AQE splits a hot key of a
    # join only if both sides come straight from a shuffle
    again = table.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    shared = written(table.join(written(again, "rlz-again"), "anchor"), "rlz-shared")

    place = F.struct("id", "digest", "first")
    distinct = written(shared.groupBy("anchor", "phrase", "n").agg(F.count(F.lit(1)).alias("copies"),
                                                                   F.min(place).alias("at")), "rlz-distinct")
    varied = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor")
    listed = (distinct.join(written(varied, "rlz-varied"), "anchor")
              .groupBy("at.id", "at.digest")
              .agg(F.collect_list(F.struct("at.first", "n", "anchor", "phrase")).alias("listed")))
    joined = rows.alias("r").join(listed.alias("l"), F.col("r.id").eqNullSafe(F.col("l.id"))
                                  & (F.col("r.digest") == F.col("l.digest"))).select("r.text", "l.listed")
    windows = written(window_table(joined, window), "rlz-windows")
    spot = F.struct("anchor", "phrase", "offset")
    twice = (windows.groupBy("w1", "w2").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).where("x <> y")
             .select("w1", "w2"))
    edges = (windows.join(written(twice, "rlz-twice"), ["w1", "w2"]).groupBy("anchor", "phrase")
             .agg(F.collect_set("offset").alias("offsets")))  # at most window - gram + 1 of them
    verdict = (distinct.alias("d").join(edges.alias("e"), ["anchor", "phrase"], "left")
               .select("anchor", "phrase",
                       F.when(F.col("copies") > 1, F.expr("sequence(0, n - 1)")).otherwise(F.col("offsets")).alias("offsets"))
               .where("offsets is not null"))
    factors = (shared.join(written(verdict, "rlz-verdict"), ["anchor", "phrase"])
               .groupBy("id", "digest").agg(F.collect_set(F.struct("first", "offsets")).alias("factors")))
    return rows, factors


def covered(n_words: int, factors, window: int) -> np.ndarray:
    """Which words the repeated windows cover."""
    change = np.zeros(n_words + 1, np.int32)
    first, offsets = factors.flatten()
    lengths = np.asarray(offsets.value_lengths())
    at = np.repeat(np.asarray(first), lengths) + np.asarray(offsets.flatten())
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = 8,
                   digest_only: bool = False) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_removed, spans (word
    ranges removed, end exclusive) and kept, the other words joined by one
    space - or with ``digest_only`` kept_sha256 in its place."""
    rows, factors = repeated_spans(docs, id_col, text_col, window, gram)

    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        total, removed, spans, kept = [], [], [], []
        for text, of in zip(texts_of(texts), found):
            words = text.split()
            gone = covered(len(words), of.values, window) if of.is_valid else np.zeros(len(words), bool)
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            total.append(len(words))
            removed.append(int(gone.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
            left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if removed[-1] else words)
            kept.append(hashlib.sha256(left).hexdigest() if digest_only else left.decode())
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(kept, pa.string())], names=["n_words", "n_removed", "spans", "kept"])

    cut_column = F.arrow_udf(cut, "n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string")
    joined = rows.alias("r").join(factors.alias("f"), F.col("r.id").eqNullSafe(F.col("f.id"))
                                  & (F.col("r.digest") == F.col("f.digest")), "left")
    out = joined.select(F.col("r.id").alias(id_col), cut_column(F.col("r.text"), F.col("f.factors")).alias("x"))
    return out.select(id_col, "x.n_words", "x.n_removed", "x.spans",
                      F.col("x.kept").alias("kept_sha256" if digest_only else "kept"))
