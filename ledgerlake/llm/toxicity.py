"""Toxicity by a small convolutional network over hashed word embeddings.

A word (``\\w+``, lower-cased) is embedded by three hashes into three tables: of
the word and of its first five and four letters, so inflected and unseen forms
of a stem are alike and others are told apart unless several hashes meet.
Filters of widths 1, 2 and 3 run over a text's words; each filter's largest
value over the whole text goes, with a bias, into a logistic output.  The network is trained on
every labelled document that may be learned from:

1. embeddings start at the words' log-odds, counted over all of them;
2. in each of ``EPOCHS`` rounds every task trains a copy of the network on its
   documents, in batches, and what the copies changed is averaged by Spark, block
   by block of the parameters, over the copies that changed it;
3. a quarter of the documents (by a hash of the id) is kept from training and
   gives the thresholds, by language, from counts of its logits in bins of
   1 / ``BINS``; a language with fewer than 20 kept texts of either class takes the
   threshold of all languages.

Only the network, the counts by embedding row and the bins come to the driver:
their size does not grow with the documents.  The language is read off the text
by its function words, so no label, language tag, source or id enters a score.
A score is sigmoid(logit - threshold of the text's language): 0.5 is the
threshold.  :func:`train` and :func:`training_sample` are the plain fit of a
few documents in one process; no query uses them.

Defined cases: null and empty texts are scored like any text, from the bias
alone; texts are scored whole at any length; repeated rows get equal scores; of
several labels of a document the highest counts, null labels are left out;
without labels of both classes every score is the share of toxic labels (0
without any).  Other columns pass through, one named like an added column is
replaced.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, run_starts, small, texts_of, with_columns_kept, written

EPOCHS, BATCH, RATE, SEED = 4, 32, 0.05, 3
#: Parameters averaged in one group, bins of a logit's unit and the bounds of binned logits.
BLOCK, BINS, FARTHEST = 4096, 64, 64
ROWS, DIM, FILTERS, WIDTHS = 1 << 16, 4, 8, (1, 2, 3)
#: Letters of a word that are hashed for each table; None: all.
TABLES = (None, 5, 4)
_ROW = 0xFFFF
PAD = 3  # padding words after each text, so every filter fits
CHUNK_WORDS = 1 << 16

#: Frequent words by which the language of a text is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as this be",
    "fr": "le la les de des et du un une que qui dans pour sur avec est",
    "de": "der die das und den von zu mit sich auf ist im nicht ein eine",
    "es": "el la los las de del que y en un una por para con su se",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
_WORDS = re.compile(r"\w+").findall


class WordCodes(dict):
    """word -> its embedding rows (16 bits a table) and, above them, the
    languages it is frequent in; kept for the words met before."""

    LIMIT = 1 << 19
    _frequent = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = sum(1 << i for i, f in enumerate(self._frequent.values()) if word in f) << 16 * len(TABLES)
        for i, letters in enumerate(TABLES):
            value |= (zlib.crc32(word[:letters].encode(), i) % (ROWS - 1) + 1) << 16 * i
        self[word] = value
        return value


def codes_of(texts: list[bytes], codes: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all texts' words with PAD zeros after each, lengths)."""
    split = [_WORDS(t.decode().lower()) for t in texts]
    lengths = np.array([len(s) + PAD for s in split], np.int64)
    flat = np.zeros(int(lengths.sum()), np.int64)
    keep = np.ones(len(flat), bool)
    ends = np.cumsum(lengths)
    for j in range(1, PAD + 1):
        keep[ends - j] = False
    flat[keep] = np.fromiter((codes[w] for s in split for w in s), np.int64, len(flat) - PAD * len(texts))
    return flat, lengths


def language(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number in LANGUAGES of the language with most function words."""
    starts, masks = run_starts(lengths), flat >> 16 * len(TABLES)
    held = np.stack([np.add.reduceat(masks >> i & 1, starts) for i in range(len(FUNCTION_WORDS))], 1)
    return np.where(held.max(1) > 0, held.argmax(1), len(FUNCTION_WORDS))


@dataclass
class Network:
    tables: list[np.ndarray]  # (ROWS, DIM) each
    filters: dict[int, np.ndarray]  # width -> (width, len(TABLES) * DIM, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    shift: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    constant: float | None = None

    @classmethod
    def start(cls, rng: np.random.Generator) -> Network:
        wide = len(TABLES) * DIM
        return cls([np.zeros((ROWS, DIM), np.float32) for _ in TABLES],
                   {w: rng.normal(0, 0.3 / w, (w, wide, FILTERS)).astype(np.float32) for w in WIDTHS},
                   {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
                   rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32))

    def embed(self, flat: np.ndarray) -> np.ndarray:
        return np.concatenate([t[flat >> 16 * i & _ROW] for i, t in enumerate(self.tables)], 1)

    def _convolve(self, embedded: np.ndarray, w: int) -> np.ndarray:
        n = len(embedded) - w + 1
        total = embedded[:n] @ self.filters[w][0]
        for j in range(1, w):
            total += embedded[j:n + j] @ self.filters[w][j]
        return total

    def pooled(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Largest value of every filter over each text, (texts, filters)."""
        embedded, starts = self.embed(flat), run_starts(lengths)
        parts = []
        for w in WIDTHS:
            total = self._convolve(embedded, w)
            edges = np.stack((starts, np.minimum(starts + lengths - w + 1, len(total))), 1).ravel()
            edges = edges[:-1] if edges[-1] >= len(total) else edges
            parts.append(np.maximum.reduceat(total, edges)[::2] + self.bias[w])
        return np.maximum(np.concatenate(parts, 1), 0)

    def logits(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.pooled(flat, lengths) @ self.out + self.shift

    # --- training ---------------------------------------------------------------

    def _parts(self) -> list[np.ndarray]:
        return [*self.tables, *self.filters.values(), *self.bias.values(), self.out]

    def parameters(self) -> np.ndarray:
        return np.concatenate([*[p.ravel() for p in self._parts()], [self.shift]]).astype(np.float32)

    def moved(self, change: np.ndarray) -> Network:
        """The network with ``change`` added to its :meth:`parameters`."""
        out, at = copy.deepcopy(self), 0
        for p in out._parts():
            p += change[at:at + p.size].reshape(p.shape)
            at += p.size
        out.shift += float(change[at])
        return out

    def at_odds(self, odds: list[np.ndarray], rng: np.random.Generator) -> None:
        """Embeddings start on the log-odds of their rows, and some filters on
        the embeddings' log-odds."""
        for table, values in zip(self.tables, odds):
            table[:] = rng.normal(0, 0.05, table.shape)
            table[:, 0] = values
            table[0] = 0
        for w in WIDTHS:
            self.filters[w][:, ::DIM, :2] = 1.0 / w

    def step(self, flat: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rate: float,
             seen: dict[str, np.ndarray]) -> None:
        """One Adagrad step; gradients reach only the words at the maxima."""
        embedded, starts = self.embed(flat), run_starts(lengths)
        where, peaks = {}, []
        for w in WIDTHS:
            total = self._convolve(embedded, w)
            at = np.stack([s + total[s:s + m - w + 1].argmax(0) for s, m in zip(starts, lengths)])
            where[w] = at
            peaks.append(total[at, np.arange(FILTERS)] + self.bias[w])
        peak = np.concatenate(peaks, 1)
        hidden = np.maximum(peak, 0)
        chance = 1 / (1 + np.exp(-(hidden @ self.out + self.shift)))
        error = ((chance - toxic) * weight / len(toxic)).astype(np.float32)
        back = error[:, None] * self.out[None, :] * (peak > 0)

        def move(name: str, value: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
            seen.setdefault(name, np.full(value.shape, 1e-6, np.float32))[at] += gradient * gradient
            value[at] -= rate * gradient / np.sqrt(seen[name][at])

        word_gradient = np.zeros_like(embedded)
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            change = np.zeros_like(self.filters[w])
            for j in range(w):
                at = where[w] + j  # (texts, filters)
                change[j] = np.einsum("tfd,tf->df", embedded[at], g)
                np.add.at(word_gradient, at.ravel(), (g[:, :, None] * self.filters[w][j].T[None]).reshape(-1, embedded.shape[1]))
            move(f"filter{w}", self.filters[w], change)
            move(f"bias{w}", self.bias[w], g.sum(0))
        move("out", self.out, hidden.T @ error)
        shift = np.array([self.shift], np.float32)
        move("shift", shift, np.array([error.sum()], np.float32))
        self.shift = float(shift[0])
        for i, values in enumerate(self.tables):
            rows, part = flat >> 16 * i & _ROW, word_gradient[:, i * DIM:(i + 1) * DIM]
            used = np.flatnonzero(part.any(1) & (rows > 0))
            ids, inverse = np.unique(rows[used], return_inverse=True)
            gradient = np.zeros((len(ids), DIM), np.float32)
            np.add.at(gradient, inverse, part[used])
            move(f"table{i}", values, gradient, ids)


def _log_odds(samples: list[np.ndarray], toxic: np.ndarray, table: int) -> np.ndarray:
    """Per embedding row: how much likelier it is in toxic texts."""
    held = np.zeros((2, ROWS))
    for codes, t in zip(samples, toxic):
        held[int(t), np.unique(codes >> 16 * table & _ROW)] += 1
    return _odds(held, np.array([(toxic == 0).sum(), toxic.sum()]))


def _odds(held: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log-odds of each row from the texts of either class that hold it."""
    share = (held + 1) / (texts[:, None] + 2)
    return np.log(share[1] / share[0])


def train(samples: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE,
          seed: int = SEED) -> Network:
    """Fit on texts given as padded codes, and calibrate the thresholds on
    every fourth of them."""
    rng = np.random.default_rng(seed)
    net = Network.start(rng)
    toxic = np.asarray(toxic, np.float32)
    if not 0 < toxic.sum() < len(toxic):
        net.constant = float(toxic.mean()) if len(toxic) else 0.0
        return net
    held = np.arange(len(samples)) % 4 == 3
    fit = np.flatnonzero(~held)
    if not 0 < toxic[fit].sum() < len(fit):
        fit = np.arange(len(samples))
    net.at_odds([_log_odds([samples[j] for j in fit], toxic[fit], i) for i in range(len(TABLES))], rng)
    share = toxic[fit].mean()
    weights = np.where(toxic > 0, 0.5 / share, 0.5 / (1 - share))
    seen: dict[str, np.ndarray] = {}
    for epoch in range(epochs):
        order = rng.permutation(fit)
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            lengths = np.array([len(samples[i]) for i in some])
            net.step(np.concatenate([samples[i] for i in some]), lengths, toxic[some], weights[some].astype(np.float32),
                     rate / (1 + epoch), seen)
    check = np.flatnonzero(held) if 0 < toxic[held].sum() < held.sum() else np.arange(len(samples))
    logits = np.array([net.logits(samples[i], np.array([len(samples[i])]))[0] for i in check])
    langs = np.array([language(samples[i], np.array([len(samples[i])]))[0] for i in check])
    overall = best_threshold(logits, toxic[check])
    for k in range(len(LANGUAGES)):
        own = langs == k
        enough = min(toxic[check][own].sum(), (1 - toxic[check][own]).sum()) >= 20
        net.thresholds[k] = best_threshold(logits[own], toxic[check][own]) if enough else overall
    return net


def best_threshold(logits: np.ndarray, toxic: np.ndarray, texts: np.ndarray | None = None) -> float:
    """The middle of the widest gap that gives the best balanced accuracy;
    with ``texts``, how many texts each logit stands for."""
    order = np.argsort(logits, kind="stable")
    n = np.ones(len(logits)) if texts is None else texts[order]
    x, t, clean = logits[order], toxic[order] * n, (1 - toxic[order]) * n
    below_toxic = np.concatenate(([0], np.cumsum(t))) / max(t.sum(), 1)
    below_clean = np.concatenate(([0], np.cumsum(clean))) / max(clean.sum(), 1)
    edges = np.concatenate(([x[0] - 2], x, [x[-1] + 2]))
    gap = np.diff(edges)
    score = np.where(gap > 1e-9, below_clean - below_toxic, -2)
    best = np.flatnonzero(score >= score.max() - 1e-9)
    i = best[gap[best].argmax()]
    return float((edges[i] + edges[i + 1]) / 2)


# --- on tables ----------------------------------------------------------------------

def _marks(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(_id, toxic): of several labels of a document the highest, nulls left out."""
    marks = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).dropna()
    return marks.groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def _coded(text: Column) -> Column:
    codes = WordCodes()

    @F.arrow_udf("array<long>")
    def coded(column: pa.Array) -> pa.Array:
        flat, lengths = codes_of(texts_of(column), codes)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(flat))

    return coded(text)


def _texts_in(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    return [np.asarray(v.values) for v in batch.column("codes")], batch.column("toxic").to_numpy().astype(np.float32)


def row_counts(coded: DataFrame) -> np.ndarray:
    """(tables, 2, ROWS): texts of either class that hold an embedding row."""
    shape = (len(TABLES), 2, ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shape, np.int64)
        for batch in batches:
            for codes, t in zip(*_texts_in(batch)):
                for i in range(len(TABLES)):
                    held[i, int(t), np.unique(codes >> 16 * i & _ROW)] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held.ravel()[at])], ["at", "n"])

    found = coded.select("toxic", "codes").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(shape)
    held.ravel()[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return held


def shortened(net: Network, codes: np.ndarray) -> np.ndarray:
    """A very long text by the words at which the filters have their maxima, each
    followed by padding: a step changes the network at no other words."""
    best = {w: (np.full(FILTERS, -np.inf), np.zeros(FILTERS, np.int64)) for w in WIDTHS}
    for i in range(0, len(codes) - PAD + 1, CHUNK_WORDS):
        embedded = net.embed(codes[i:i + CHUNK_WORDS + PAD])
        for w, (tops, at) in best.items():
            total = net._convolve(embedded, w)
            where, peak = total.argmax(0), total.max(0)
            at[peak > tops] = i + where[peak > tops]
            np.maximum(tops, peak, out=tops)
    pad = np.zeros(PAD, np.int64)
    return np.concatenate([x for w, (_, at) in best.items() for a in np.unique(at) for x in (codes[a:a + w], pad)])


def portions(sizes: np.ndarray, order: np.ndarray, texts: int, words: int) -> Iterator[list[int]]:
    """``order`` in runs of at most ``texts`` texts and, from two texts on, ``words`` words."""
    some, size = [], 0
    for j in order:
        if some and (len(some) == texts or size + sizes[j] > words):
            yield some
            some, size = [], 0
        some.append(j)
        size += sizes[j]
    if some:
        yield some


def trained_round(coded: DataFrame, net: Network, weights: np.ndarray, rate: float, seed: int) -> Network:
    """One round over all texts: each task trains a copy of ``net``, the changes
    are averaged over the copies that have them."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, own, seen = np.random.default_rng((seed, part)), copy.deepcopy(net), {}
        for batch in batches:
            texts, toxic = _texts_in(batch)
            long = 4 * CHUNK_WORDS
            texts = [shortened(own, t) if len(t) > long else t for t in texts]
            for some in portions(np.array([len(t) for t in texts]), rng.permutation(len(texts)), BATCH, long):
                own.step(np.concatenate([texts[j] for j in some]), np.array([len(texts[j]) for j in some]), toxic[some],
                         weights[toxic[some].astype(int)], rate, seen)
        change = own.parameters() - net.parameters()
        blocks = [b for b in range(0, len(change), BLOCK) if change[b:b + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int32()),
                                          pa.array([change[b:b + BLOCK].tobytes() for b in blocks], pa.binary())], ["block", "part", "change"])

    def averaged(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        changes = [np.frombuffer(c, np.float32) for c in table.column("change").to_pylist()]
        total, copies = np.zeros(len(changes[0])), np.zeros(len(changes[0]))
        for c in changes:
            total += c
            copies += c != 0
        mean = (total / np.maximum(copies, 1)).astype(np.float32)
        return pa.table({"block": table.column("block").slice(0, 1), "change": pa.array([mean.tobytes()], pa.binary())})

    moved = coded.select("toxic", "codes").mapInArrow(learn, "block long, part int, change binary")
    means = moved.groupBy("block").applyInArrow(averaged, "block long, change binary").toArrow()  # the size of a network
    change = np.zeros(len(net.parameters()), np.float32)
    for b, c in zip(means.column("block").to_pylist(), means.column("change").to_pylist()):
        change[b:b + BLOCK] = np.frombuffer(c, np.float32)
    return net.moved(change)


def calibrated(coded: DataFrame, net: Network) -> Network:
    """``net`` with the thresholds of all texts of ``coded``."""
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = _texts_in(batch)
            logits, langs = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for some in portions(np.array([len(t) for t in texts]), np.arange(len(texts)), len(texts), 4 * CHUNK_WORDS):
                flat, lengths = np.concatenate([texts[j] for j in some]), np.array([len(texts[j]) for j in some])
                logits[some], langs[some] = _logits(net, flat, lengths), language(flat, lengths)
            bins = np.round(np.clip(logits, -FARTHEST, FARTHEST) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(bins), pa.array(toxic.astype(np.int64))], ["lang", "bin", "toxic"])

    found = (coded.select("toxic", "codes").mapInArrow(binned, "lang long, bin long, toxic long")
             .groupBy("lang", "bin", "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow())  # as many rows as bins at most
    langs, bins, toxic, n = (found.column(c).to_numpy() for c in ("lang", "bin", "toxic", "n"))
    overall = best_threshold(bins / BINS, toxic, n)
    for k in range(len(LANGUAGES)):
        own = langs == k
        enough = min((toxic[own] * n[own]).sum(), ((1 - toxic[own]) * n[own]).sum()) >= 20
        net.thresholds[k] = best_threshold(bins[own] / BINS, toxic[own], n[own]) if enough else overall
    return net


def train_on_all(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column) -> Network:
    """The network of all labelled documents whose ``usable`` (of ``_id``) holds."""
    marks = _marks(labels, id_col, label_col).where(usable)
    docs = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = docs.join(small(marks, 16), F.col("_doc") == F.col("_id"))
    coded = written(found.select("toxic", (F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(4)) == 3).alias("kept"),
                                 _coded(F.col("text")).alias("codes")), "toxicity-coded")
    texts = {(r.kept, r.toxic): r.n for r in coded.groupBy("kept", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_class = {k: np.array([texts.get((k, 0), 0), texts.get((k, 1), 0)]) for k in (False, True)}
    total = by_class[False] + by_class[True]
    rng = np.random.default_rng(SEED)
    net = Network.start(rng)
    if not total.all():
        net.constant = float(total[1] / total.sum()) if total.any() else 0.0
        return net
    fit, n_fit = (coded.where(~F.col("kept")), by_class[False]) if by_class[False].all() else (coded, total)
    net.at_odds([_odds(held, n_fit) for held in row_counts(fit)], rng)
    weights = (0.5 * n_fit.sum() / n_fit).astype(np.float32)
    for epoch in range(EPOCHS):
        net = trained_round(fit, net, weights, RATE / (1 + epoch), SEED + epoch)
    return calibrated(coded.where("kept") if by_class[True].all() else coded, net)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    usable: Column, most: int, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Codes and labels of at most ``most`` labelled documents a class whose
    ``usable`` holds, and of at most half of ``words`` words a class, in the
    order of a hash of the id.  A text that does not fit is passed over; a class
    in which none fits is its shortest text."""
    marks = _marks(labels, id_col, label_col).withColumn("turn", F.xxhash64(F.lit(5), "_id")).where(usable)
    chosen = [marks.where(F.col("toxic") == t).orderBy("turn", "_id").limit(most) for t in (0, 1)]
    chosen = written(chosen[0].unionByName(chosen[1]), "toxicity-sample")  # 2 * most rows
    docs = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = docs.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    found = written(found.select("turn", "_id", "toxic", F.xxhash64("text").alias("digest"), _coded(F.col("text")).alias("codes"))
                    .withColumn("n", F.size("codes")).withColumn("row", F.monotonically_increasing_id()), "toxicity-coded")
    order, rows = ("turn", "_id", "digest", "row"), []
    for t in (0, 1):
        own, total, fit = found.where(F.col("toxic") == t), 0, []
        for r in own.select("n", "row", *order[:-1]).orderBy(*order).limit(most).collect():
            if total + r.n <= words / 2:
                total += r.n
                fit.append(r.row)
        rows += fit or [r.row for r in own.select("n", "row", *order[:-1]).orderBy("n", *order).limit(1).collect()]
    if not rows:
        return [], np.zeros(0)
    chosen = docs.sparkSession.createDataFrame([(r,) for r in rows], "row long")  # at most 2 * most rows
    taken = found.join(F.broadcast(chosen), "row", "left_semi").orderBy(*order).select("toxic", "codes").toArrow()
    values = taken.column("codes").combine_chunks()
    return [np.asarray(v.values) for v in values], taken.column("toxic").to_numpy()


def score_column(text: Column, net: Network) -> Column:
    """Score of each whole text, 0 to 1."""
    codes = WordCodes()

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        texts = texts_of(column)
        out, at = np.full(len(texts), net.constant or 0.0), 0
        while net.constant is None and at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= 6 * CHUNK_WORDS:
                size += len(texts[end])
                end += 1
            flat, lengths = codes_of(texts[at:end], codes)
            out[at:end] = _scores(net, flat, lengths)
            at = end
        return pa.array(out)

    return of(text)


def _logits(net: Network, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if len(flat) > 4 * CHUNK_WORDS and len(lengths) == 1:  # one long text: maxima of overlapping pieces
        tops = [net.pooled(flat[i:i + CHUNK_WORDS + PAD], np.array([len(flat[i:i + CHUNK_WORDS + PAD])]))
                for i in range(0, len(flat) - PAD + 1, CHUNK_WORDS)]
        return np.max(tops, 0) @ net.out + net.shift
    return net.logits(flat, lengths)


def _scores(net: Network, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_logits(net, flat, lengths) - net.thresholds[language(flat, lengths)], -30, 30)))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """``docs`` with held_out (crc32 of the id's text mod 5 is 0: its label was
    not learned), score and predicted (1 from 0.5 on)."""
    document_batches(docs.sparkSession)
    fold = lambda c: F.crc32(c.cast("string").cast("binary")) % 5
    net = train_on_all(docs, labels, id_col, text_col, label_col, fold(F.col("_id")) != 0)
    kept = with_columns_kept(docs, "held_out", "score", "predicted")
    out = kept.withColumn("score", score_column(F.col(f"`{text_col}`").cast("string"), net))
    return out.select(*[F.col(f"`{c}`") for c in kept.columns],
                      F.coalesce(fold(F.col(f"`{id_col}`")) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
