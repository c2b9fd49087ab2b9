import zlib

import numpy as np

from ledgerlake.llm import queries, string_kernel
from ledgerlake.llm.string_kernel import Letters, ngrams, train

SF = "/root/testdata/sf0.01"


def plain_ngrams(text):
    marked = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(marked.split())} " if marked.split() else ""
    return {padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)} - {" "}


def code(gram):
    return sum(ord(c) << 21 * i for i, c in enumerate(gram))


def test_ngrams_by_definition(monkeypatch):
    letters = Letters()
    texts = ["", "  12 .", "a", "Été à l'île!", "word  word\tWORD", "漢字 kana 🙂 x²", "ΑΣ Σ", "é" * 30 + "--b"]
    for text in texts:
        assert ngrams(text, letters).tolist() == sorted(map(code, plain_ngrams(text)))
    monkeypatch.setattr(string_kernel, "_PIECE", 3)
    for text in texts:
        assert ngrams(text, letters).tolist() == sorted(map(code, plain_ngrams(text)))


def test_values_are_those_of_the_kernel_machine():
    """Against kernel values of sets and an unfolded Nystroem ridge regression."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list(alphabet), 40)) for alphabet in ("abc de", "cdx yz", "abz q") for _ in range(12)]
    spoken = [x for x in "pqr" for _ in range(12)]
    spoken[-1] = "p"  # languages of unequal size
    letters = Letters()
    grams = [ngrams(t, letters) for t in texts]
    model = train(grams, spoken, landmarks=9)

    def kernel(a, b):
        return len(plain_ngrams(a) & plain_ngrams(b)) / (len(plain_ngrams(a)) * len(plain_ngrams(b))) ** 0.5

    marks = [texts[i] for x in "pqr" for i in [j for j, s in enumerate(spoken) if s == x][:3]]
    inner = np.array([[kernel(a, b) for b in marks] for a in marks])
    cross = np.array([[kernel(a, b) for b in marks] for a in texts])
    weight = np.array([len(texts) / (3 * spoken.count(s)) for s in spoken])
    target = np.array([[1.0 if s == x else -1.0 for x in "pqr"] for s in spoken])
    # ridge in the landmarks' span: min sum w (K a - y)^2 + ridge * a' K_mm a
    dual = np.linalg.solve(cross.T @ (cross * weight[:, None]) + string_kernel.RIDGE * inner, cross.T @ (target * weight[:, None]))
    assert np.abs(model.values(grams) - cross @ dual).max() < 1e-4
    assert model.languages == ["p", "q", "r"]


def test_held_out_accuracy_and_whole_result(spark):
    rows = {r.doc_id: r for r in queries.table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in queries.op12_language_id(spark, SF).collect()}
    assert set(got) == set(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 100 and np.mean([got[i].lang_pred == rows[i].lang for i in held]) > 0.99


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = queries.table(spark, SF, "documents").limit(300)
    rows = [(r.doc_id, r.text, "xx" if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.lang) for r in docs.collect()]
    got = string_kernel.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert "xx" not in {r.lang_pred for r in got}


def test_defined_cases(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[0], None, "en", "p", 1), (ids[1], "", "en", "p", 1), (ids[2], "12 +", "en", "p", 1), (None, "the house", "zz", "p", 1),
            (ids[3], "the house and the garden " * 40_000, "en", "p", 1), (ids[4], "das Haus und der Garten", "de", "p", 1),
            (ids[5], "das Haus und der Garten", "de", "p", 1), (ids[5], "das Haus und der Garten", "de", "p", 1), (ids[6], "le jardin", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, rank int")
    got = string_kernel.identify(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "lang", "rank", "held_out", "lang_pred", "score"}
    assert [r.lang_pred for r in got if not (r.text or "").strip("12 +")] == ["und"] * 3
    assert {r.lang_pred for r in got if r.lang == "de"} == {"de"} and {r.lang_pred for r in got if r.doc_id == ids[3]} == {"en"}
    assert {r.lang_pred for r in got} == {"und", "en", "de"}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert string_kernel.identify(docs.limit(0)).count() == 0
    alone = string_kernel.identify(docs.where("lang is null")).collect()
    assert [r.lang_pred for r in alone] == ["und"]
    few = string_kernel.identify(docs, train_ngrams=40)  # the long text and the copies still fit or are passed over
    assert few.count() == len(rows)
