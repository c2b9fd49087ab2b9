"""Language identification by string kernels.

**Method.**  A text is the set of its letter n-grams, n from 1 to 3 (the
blended spectrum; presence, not counts; lower case, anything that is no letter
a word edge, which is part of the n-grams of two and three).  The kernel of two
texts is the size of the sets' intersection over the root of the product of
their sizes.  ``landmarks`` training texts, as many of each language, span the
feature space (Nystroem): the features of a text are its kernel values with them,
whitened by the kernel matrix among them.  On the features one ridge regression
for each language against the rest is solved; the language with the largest
value is predicted.  Texts are scored in batches: presence matrix (texts x
n-grams) times the landmarks' n-grams times the regression weights.  The product
of the last two is the same for all batches and is formed once.

The fit learns from at most ``train_texts`` different texts, as many of each of
at most ``languages`` languages (the commonest), in the order of a hash of the
text, and from at most ``train_ngrams`` n-grams in all; a text that does not fit
into its language's share is passed over.  Nothing else samples: every text is
read whole, in pieces, and scored.

Defined cases: a text that is null, empty or without a letter is ``und`` with
score 0; it teaches nothing, nor does a row without language or id.  A score is
(1 + value) / 2 within 0 and 1, where 1 is the regression's target for the
language and -1 for the rest.  Of languages tied for a text the first by name
is taken.  Without anything to learn from every row is ``und``.  Repeated rows get
the same result and copies of a text are learned once.  Other columns pass
through, one named like an added column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_batches, texts_of, with_columns_kept, written

TRAIN_TEXTS, LANDMARKS, TRAIN_NGRAMS, LANGUAGES = 1600, 256, 8_000_000, 200
RIDGE = 0.1
UNKNOWN = "und"
_EDGE = 32
_PIECE = 1 << 18
_BATCH = 64


class Letters:
    """Which code points are letters; filled in when first asked."""

    def __init__(self) -> None:
        self.table: np.ndarray | None = None

    def of(self, points: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        return self.table[points]


def ngrams(text: str, letters: Letters) -> np.ndarray:
    """Sorted distinct n-grams of a whole text, 21 bits a code point."""
    text = text.lower() + " "
    found, tail = [], np.array([_EDGE], np.int64)
    for at in range(0, len(text), _PIECE):
        points = np.frombuffer(text[at:at + _PIECE].encode("utf-32-le"), "<u4").astype(np.int64)
        c = np.concatenate((tail, np.where(letters.of(points), points, _EDGE)))
        keep = c != _EDGE
        keep[1:] |= keep[:-1].copy()
        keep[0] = True
        c = c[keep]
        two = c[:-1] | c[1:] << 21
        found.append(np.unique(np.concatenate((c[c != _EDGE], two, two[:-1] | c[2:] << 42))))
        tail = c[-2:]
    out = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
    return out if (out < 1 << 21).any() else out[:0]


@dataclass
class Model:
    languages: list[str]
    #: sorted n-grams of the landmarks and, per n-gram and language, their weight
    ngrams: np.ndarray
    weights: np.ndarray

    def values(self, texts: list[np.ndarray]) -> np.ndarray:
        """Regression values (texts, languages) of texts given as n-grams."""
        sizes = np.sqrt(np.maximum([len(t) for t in texts], 1))
        return presence(texts, self.ngrams) @ self.weights / sizes[:, None]


def presence(texts: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """1 where a text (row) has a known n-gram (column)."""
    out = np.zeros((len(texts), len(known)), np.float32)
    for row, t in zip(out, texts):
        at = np.minimum(np.searchsorted(known, t), len(known) - 1)
        row[at[known[at] == t]] = 1
    return out


def train(texts: list[np.ndarray], spoken: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Fit on texts given as n-grams with their languages, in order of choice."""
    languages = sorted(set(spoken))
    if not languages:
        return None
    number = np.array([languages.index(s) for s in spoken])
    each = max(landmarks // len(languages), 1)
    chosen = np.concatenate([np.flatnonzero(number == i)[:each] for i in range(len(languages))])
    marks = [texts[i] for i in chosen]
    known = np.unique(np.concatenate(marks))
    spanned = presence(marks, known) / np.sqrt([len(t) for t in marks])[:, None].astype(np.float32)

    def kernel(some: list[np.ndarray]) -> np.ndarray:
        parts = [presence(some[i:i + _BATCH], known) @ spanned.T / np.sqrt([len(t) for t in some[i:i + _BATCH]])[:, None]
                 for i in range(0, len(some), _BATCH)]
        return np.concatenate(parts)

    values, vectors = np.linalg.eigh(kernel(marks))
    kept = values > 1e-6 * values[-1]
    whitening = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel(texts) @ whitening
    share = np.bincount(number) * len(languages) / len(number)
    weight = 1 / share[number]  # every language counts alike
    target = np.where(number[:, None] == np.arange(len(languages)), 1.0, -1.0)
    left = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(left, features.T @ (target * weight[:, None]))
    return Model(languages, known, (spanned.T @ (whitening @ solved)).astype(np.float32))


# --- on tables ----------------------------------------------------------------------

def _readable(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_sample(rows: DataFrame, train_texts: int, train_ngrams: int, languages: int) -> tuple[list[np.ndarray], list[str]]:
    """n-grams and languages of the chosen texts of ``rows`` (text, lang)."""
    keys = rows.select("lang", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b")).distinct()
    keys = written(keys, "language-keys")
    common = [r.lang for r in keys.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(languages).collect()]
    if not common:
        return [], []
    each = max(train_texts // len(common), 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("a", "b"))
    chosen = keys.where(F.col("lang").isin(common)).withColumn("rank", rank).where(F.col("rank") <= each)
    letters = Letters()

    @F.arrow_udf("array<long>")
    def grams(column: pa.Array) -> pa.Array:
        return pa.array([ngrams(t.decode(), letters) for t in texts_of(column)], pa.list_(pa.int64()))

    # at most train_texts + languages keys
    found = rows.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(7), "text")}).join(F.broadcast(chosen), ["lang", "a", "b"])
    found = found.groupBy("lang", "rank").agg(F.first("text").alias("text"))
    found = written(found.select("lang", "rank", grams(F.col("text")).alias("grams")), "language-sample")
    room, taken = train_ngrams / len(common), []
    left = dict.fromkeys(common, room)
    for r in found.select("lang", "rank", F.size("grams").alias("n")).orderBy("rank", "lang").collect():
        if r.n <= left[r.lang]:
            left[r.lang] -= r.n
            taken.append((r.lang, r.rank))
    if not taken:
        return [], []
    fits = rows.sparkSession.createDataFrame(taken, "lang string, rank int")  # at most train_texts + languages rows
    sample = found.join(F.broadcast(fits), ["lang", "rank"], "left_semi").orderBy("rank", "lang").select("lang", "grams").toArrow()
    return [np.asarray(v.values) for v in sample.column("grams").combine_chunks()], sample.column("lang").to_pylist()


def prediction(text: Column, model: Model | None) -> Column:
    """struct(lang_pred, score) of each whole text."""
    letters = Letters()

    @F.arrow_udf("lang_pred string, score double")
    def of(column: pa.Array) -> pa.Array:
        texts = texts_of(column)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for at, part in _batches(texts):
            grams = [ngrams(t.decode(), letters) for t in part]
            some = [i for i, g in enumerate(grams) if len(g)]
            if model is None or not some:
                continue
            values = model.values([grams[i] for i in some])
            for i, best, value in zip(some, values.argmax(1), values.max(1)):
                names[at + i], scores[at + i] = model.languages[best], min(max((1 + float(value)) / 2, 0.0), 1.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return of(text)


def _batches(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    for at in range(0, len(texts), _BATCH):
        yield at, texts[at:at + _BATCH]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_texts: int = TRAIN_TEXTS, landmarks: int = LANDMARKS, train_ngrams: int = TRAIN_NGRAMS,
             languages: int = LANGUAGES) -> DataFrame:
    """``docs`` with held_out (crc32 of the id's text mod 4 is 2: its language
    was not learned), lang_pred and score."""
    document_batches(docs.sparkSession)
    held_out = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.where(~held_out).select(text.alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    sample = training_sample(rows.where(F.col("lang").isNotNull() & _readable(F.col("text"))), train_texts, train_ngrams, languages)
    model = train(*sample, landmarks=landmarks)
    kept = with_columns_kept(docs, "held_out", "lang_pred", "score")
    fresh = "_prediction" + "_" * max((len(c) for c in kept.columns), default=0)  # longer than any name there is
    out = kept.withColumn(fresh, prediction(F.col(f"`{text_col}`").cast("string"), model))
    return out.select(*[F.col(f"`{c}`") for c in kept.columns], F.coalesce(held_out, F.lit(False)).alias("held_out"),
                      F.col(f"{fresh}.lang_pred").alias("lang_pred"), F.col(f"{fresh}.score").alias("score"))
