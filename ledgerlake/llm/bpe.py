"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The vocabulary is a ``tokenizers`` JSON file whose path is a parameter; the
driver reads it once and its tables (fixed size) travel with the tasks.
Encoding follows that library with ``add_special_tokens=False``: occurrences
of added tokens are cut out first, the rest is split by the byte-level
pattern, and each word's bytes are merged lowest rank first.  All words of a
batch that were not met before lie in one flat symbol array; a round looks up
the rank of every adjacent pair by binary search over the sorted pair keys,
finds each word's lowest rank, and merges that pair wherever it stands in the
word (a merged symbol only takes part in later-ranked pairs, so this is what
merging one at a time gives).  Decoding gathers the tokens' bytes from one
flat array.

Null and empty texts have no tokens and decode to the empty text.  Rows are
independent of each other: repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, run_starts, texts_of, with_columns_kept

#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are tokenised together up to this many bytes; a longer one alone.
CHUNK_BYTES = 1 << 21
#: Words whose tokens are remembered between batches.
CACHE_WORDS = 1 << 18
_NONE = np.iinfo(np.int64).max


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from
    U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Tables of a vocabulary, and encoding and decoding with them."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in symbols.items():
            self.byte_ids[byte] = vocab[char]
        size = max([*vocab.values(), *self.specials.values()]) + 1
        pieces = [b""] * size
        for token, at in vocab.items():
            pieces[at] = bytes(symbols[c] for c in token)
        for token, at in self.specials.items():
            pieces[at] = token.encode()
        self.piece_len = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = run_starts(self.piece_len)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.pattern = pattern
        self._ready = False

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "cut", "slots", "store", "at", "len")} | {"_ready": False}

    def _prepare(self) -> None:
        self.find = regex.compile(self.pattern).findall
        names = sorted(self.specials, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self._forget()
        self._ready = True

    def _forget(self) -> None:
        """Start the remembered words anew, with the special tokens first."""
        ids = np.array(list(self.specials.values()), np.int64)
        self.slots = {("special", s): i for i, s in enumerate(self.specials)}
        self.store, self.at, self.len = ids, np.arange(len(ids)), np.ones(len(ids), np.int64)

    # --- encoding ---------------------------------------------------------------

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words one after the other, tokens per word)."""
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_words = [], []
        while len(ids):
            keys = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            ranks = np.full(len(ids), _NONE)  # of the pair that starts here
            known = (self.pair_keys[at] == keys) & (word[:-1] == word[1:])
            ranks[:-1][known] = self.pair_ranks[at[known]]
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(np.append(heads, len(ids)))
            least = np.repeat(np.minimum.reduceat(ranks, heads), sizes)
            over = least == _NONE
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                go = ~over
                ids, word, ranks, least = ids[go], word[go], ranks[go], least[go]
                if not len(ids):
                    break
            chosen = ranks == least
            # of pairs that overlap (one symbol repeated) every second one counts, from the left
            run = np.flatnonzero(chosen)
            fresh = np.flatnonzero(np.diff(run, prepend=-2) != 1)
            nth = np.arange(len(run)) - np.repeat(fresh, np.diff(np.append(fresh, len(run))))
            run = run[nth % 2 == 0]
            ids[run] = self.merged[ranks[run]]
            stay = np.ones(len(ids), bool)
            stay[run + 1] = False
            ids, word = ids[stay], word[stay]
        if not done_ids:
            return ids, np.zeros(len(words), np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _words(self, text: str) -> list:
        if self.cut is None or not any(s in text for s in self.specials):
            return self.find(text)
        out: list = []
        for i, part in enumerate(self.cut(text)):
            out += [("special", part)] if i % 2 else self.find(part)
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all texts one after the other, tokens per text)."""
        if not self._ready:
            self._prepare()
        if len(self.slots) > CACHE_WORDS:
            self._forget()
        split = [self._words(t.decode()) for t in texts]
        words = [w for s in split for w in s]
        slots, new = self.slots, []
        for w in dict.fromkeys(words):
            if w not in slots:
                slots[w] = len(slots)
                new.append(w.encode())
        if new:
            ids, counts = self.merge_words(new)
            self.at = np.concatenate((self.at, len(self.store) + run_starts(counts)))
            self.len = np.concatenate((self.len, counts))
            self.store = np.concatenate((self.store, ids))
        which = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
        flat, counts = gather(self.store, self.at[which], self.len[which])
        per_text = np.array([len(s) for s in split], np.int64)
        ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(per_text)))]
        return flat, np.diff(ends)

    # --- decoding ---------------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 texts of runs of token ids; bytes that are no UTF-8 become
        U+FFFD, as in the library."""
        flat, lengths = gather(self.piece_bytes, self.piece_at[ids], self.piece_len[ids])
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        data = flat.tobytes()
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:])]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[start : start + length]`` one after the other."""
    shift = np.repeat(starts - run_starts(lengths), lengths)
    return values[shift + np.arange(len(shift))], lengths


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def encode_column(text: Column, codec: Codec) -> Column:
    """Token ids of a text column as array<int>."""
    @F.arrow_udf("array<int>")
    def of(column: pa.Array) -> pa.Array:
        done = [codec.encode(part) for part in _parts(texts_of(column))]
        counts = np.concatenate([c for _, c in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([i for i, _ in done]) if done else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))

    return of(text.cast("string"))


def decode_column(ids: Column, codec: Codec) -> Column:
    """Text of an array<int> column of token ids; null gives the empty text."""
    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array([t.decode() for t in codec.decode(flat, counts)], pa.string())

    return of(ids)


def encode(docs: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """``docs`` with ``ids``, the token ids of each whole text."""
    document_batches(docs.sparkSession)
    out = with_columns_kept(docs, "ids")
    return out.select("*", encode_column(F.col(f"`{text_col}`"), Codec(path, pattern)).alias("ids"))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN,
               ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 (UTF-8 of the text decoded from the ids); with
    ``ids`` the token ids too.  Decoded texts stay in the task."""
    document_batches(docs.sparkSession)
    codec = Codec(path, pattern)
    names = ("n_tokens", "ids_sha256", "decoded_sha256") + (("ids",) if ids else ())

    def digests(column: pa.Array) -> pa.Array:
        out: tuple[list, ...] = ([], [], [])
        found = [np.zeros(0, np.int32)]
        for part in _parts(texts_of(column)):
            flat, counts = codec.encode(part)
            data, ends = flat.astype("<u4").tobytes(), (4 * np.concatenate(([0], np.cumsum(counts)))).tolist()
            out[0].extend(counts.tolist())
            out[1].extend(hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends, ends[1:]))
            out[2].extend(hashlib.sha256(t).hexdigest() for t in codec.decode(flat, counts))
            if ids:
                found.append(flat.astype(np.int32))
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
        if ids:
            offsets = np.concatenate(([0], np.cumsum(out[0]))).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found))))
        return pa.StructArray.from_arrays(columns, names=list(names))

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    of = F.arrow_udf(digests, kind)
    kept = with_columns_kept(docs, *names, "_codec")
    return kept.withColumn("_codec", of(docs[f"`{text_col}`"].cast("string"))).select(
        *[F.col(f"`{c}`") for c in kept.columns], *[F.col(f"_codec.{n}") for n in names])
