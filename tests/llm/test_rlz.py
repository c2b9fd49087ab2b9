import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.llm import queries, rlz

from . import brute

SF = "/root/testdata/sf0.01"


def kept(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rlz.remove_repeats(docs, **how).collect()),
                  key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    want = sorted((i, n, gone, brute.sha(left)) for i, n, gone, left in brute.without_repeats(rows))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                 for r in queries.op10_substring_dedup(spark, SF).collect())
    assert got == want
    assert sum(r[2] for r in got) > 0


def passages(rng, alphabet):
    return [" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(4)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), window=st.integers(3, 9), letters=st.integers(1, 12))
def test_shared_passages_of_few_letters(spark, seed, window, letters):
    """Small alphabets make windows recur at every offset and inside factors."""
    rng = random.Random(seed)
    alphabet = [chr(97 + i) for i in range(letters)]
    shared = passages(rng, alphabet)
    rows = [(i, " ".join(rng.choice([*shared, rng.choice(alphabet)]) for _ in range(rng.randint(0, 6))))
            for i in range(12)]
    assert kept(spark, rows, window=window, gram=2) == sorted(brute.without_repeats(rows, window), key=repr)


def test_edges(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"a {passage} b"), (2, f"c d  {passage}"), (3, None), (4, ""), (5, passage[:-4]),
            (None, "z " * 35), (None, "y " * 34), (6, "same text " * 30), (7, "u " + "v " * 100_000)]
    rows += [(8, "repeated row " + " ".join(f"r{i}" for i in range(50)))] * 2
    assert kept(spark, rows) == sorted(brute.without_repeats(rows), key=repr)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans]
             for r in rlz.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[1] == [(1, 41)] and spans[2] == [(1, 41)]
    assert kept(spark, rows[:0]) == []


def test_other_columns_do_not_matter(spark):
    rows = [(1, "a b c d e f", "x"), (2, "c d e f g", "y")]
    docs = spark.createDataFrame(rows, "id long, body string, digest string")
    got = sorted(tuple(r) for r in rlz.remove_repeats(docs, "id", "body", window=3, gram=2).drop("spans").collect())
    assert got == [(1, 6, 4, "a b"), (2, 5, 4, "g")]


def longest(text, at, blocks, own):
    """Longest match of the words from ``at`` on in one reference block, not at the place itself."""
    best = 0
    for name, words in blocks:
        for p, w in enumerate(words):
            if w == text[at] and (name, p) != (own, at):
                n = 0
                while at + n < len(text) and p + n < len(words) and text[at + n] == words[p + n]:
                    n += 1
                best = max(best, n)
    return best


def greedy_parse(rows, window, block_rows):
    """The relative Lempel-Ziv form, document by document and block by block:
    greedy factors against the block, long ones are duplicate, and behind each
    factor's start the matches that run over its end are looked up as well."""
    texts = [(k, brute.words_of(t)) for k, (_, t) in enumerate(rows)]
    gone = {k: set() for k, _ in texts}
    for first in range(0, len(texts), block_rows):
        block = texts[first:first + block_rows]
        for k, words in texts:
            at = 0
            while at < len(words):
                n = max(longest(words, at, block, k), 1)
                for j in range(at, min(at + n, len(words))):
                    m = longest(words, j, block, k) if j > at else n
                    if m >= window:
                        gone[k] |= set(range(j, j + m))
                at += n
    return sorted(((i, len(w), len(gone[k]), " ".join(x for p, x in enumerate(w) if p not in gone[k]))
                   for (k, w), (i, _) in zip(texts, rows)), key=repr)


def test_the_same_words_go_as_by_greedy_factors_against_every_block(spark):
    rng = random.Random(9)
    shared = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (6, 9, 14)]
    rows = [(i, " ".join(rng.choice([*shared, rng.choice("abcdefgh")]) for _ in range(rng.randint(0, 8)))) for i in range(24)]
    for window, block_rows in ((4, 5), (6, 24)):
        assert kept(spark, rows, window=window, gram=2) == greedy_parse(rows, window, block_rows)
