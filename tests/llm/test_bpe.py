import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, queries

SF = "/root/testdata/sf0.01"
PATH = queries.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
CODEC = bpe.Codec(PATH)


def library(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def encode(texts):
    ids, counts = CODEC.encode([t.encode() for t in texts])
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_query_matches_the_library(spark):
    rows = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in queries.op9_bpe(spark, SF).collect()}
    assert set(got) == set(rows)
    for (i, text), ids in zip(rows.items(), library(list(rows.values()))):
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=["Cn"]),
                                           st.sampled_from(" \n\t'sтll aabbé日本🙂<|>"))), min_size=1, max_size=6))
def test_any_text(texts):
    texts.append("<|endoftext|>".join(texts))
    want = library(texts)
    assert encode(texts) == want
    ids, counts = CODEC.encode([t.encode() for t in texts])
    assert [t.decode() for t in CODEC.decode(ids, counts)] == texts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50_256), max_size=12), min_size=1, max_size=4))
def test_any_ids_decode_as_in_the_library(runs):
    flat = np.array([i for r in runs for i in r], np.int64)
    got = CODEC.decode(flat, np.array([len(r) for r in runs]))
    assert [t.decode() for t in got] == [LIBRARY.decode(r, skip_special_tokens=False) for r in runs]


def test_long_words_and_overlapping_pairs():
    texts = ["a" * 5000, "aaa" * 7 + "b", "ab" * 3000, "", " ", "\n" * 41, "x" * 3 + " " * 9 + "y"]
    assert encode(texts) == library(texts)


def test_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "hi hi<|endoftext|>", 7)],
                                 "doc_id long, text string, n_tokens long")
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    assert [got[i].n_tokens for i in (1, 2, None)] == [0, 0, 3]
    assert got[1].ids_sha256 == got[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert set(bpe.round_trip(docs, PATH).columns) == {"doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"}
    ids = bpe.encode(docs, PATH)
    back = ids.select("doc_id", bpe.decode_column(ids.ids, CODEC).alias("t")).collect()
    assert {r.doc_id: r.t for r in back} == {1: "", 2: "", None: "hi hi<|endoftext|>"}
    assert bpe.encode(docs.limit(0), PATH).count() == 0
