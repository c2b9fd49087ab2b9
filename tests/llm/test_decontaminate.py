import random
import re

from ledgerlake.llm import decontaminate, queries

from . import brute

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\W_]+")


def shingles(words, k=5):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def leaks(docs, items, similarity=0.8, k=5, every=False):
    """(doc, item) of every item-sized window, at any place, that is alike;
    pairs that share no shingle are looked at only with ``every``."""
    out = set()
    split = [(i, WORD.findall((t or "").lower())) for i, t in items]
    for d, text in docs:
        words = WORD.findall((text or "").lower())
        whole = set(shingles(words, k))
        for i, item in split:
            own = shingles(item, k)
            if len(item) < k or not (every or whole & set(own)):
                continue
            n = min(len(item), len(words))
            if any(brute.multiset_similarity(shingles(words[s:s + n], k), own) >= similarity
                   for s in range(len(words) - n + 1)):
                out.add((d, i))
    return out


def found(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b, **how).collect()}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    got = queries.op3_decontaminate(spark, SF).collect()
    want = leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    assert all(r.similarity >= 0.8 and r.distance <= 20 for r in got)


def test_altered_cut_and_shouted_passages(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(30, 120)))) for i in range(12)]
    items += [(50, "too few words"), (51, None), (52, ""), (53, items[0][1])]
    docs = []
    for i, text in items[:12]:
        words = text.split()
        around = rng.choices(vocabulary, k=40)
        changed = list(words)
        changed[len(words) // 2] = "other"
        longer = words[:9] + ["extra"] + words[9:]
        docs += [(len(docs) + j, " ".join(around[:20] + w + around[20:])) for j, w in enumerate((words, changed, longer))]
        docs.append((len(docs), "".join(c if c != " " else ",\n" for c in text.upper())))
        docs.append((len(docs), " ".join(words[: len(words) * 9 // 10])))
        docs.append((len(docs), " ".join(words[: len(words) // 2] + around)))
        docs.append((len(docs), " ".join(around)))
    docs += [(900, None), (901, ""), (902, items[1][1] + " " + "filler " * 50_000), (None, items[2][1]), (903, items[3][1]), (903, items[3][1])]
    want = leaks(docs, items)
    assert {(0, 0), (0, 53), (902, 1), (None, 2), (903, 3)} <= want
    assert found(spark, docs, items) == want
    short = [(d, t) for d, t in docs if d != 902]
    assert leaks(short, items, every=True) == {(d, i) for d, i in want if d != 902}


def test_passes_over_a_large_benchmark_agree(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abcdefghijklmnop", k=20))) for i in range(9)]
    docs = [(i, "x y z " + t + " q r s") for i, t in items[:6]]
    whole = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "PASS_SHINGLES", 40)
    assert found(spark, docs, items) == whole == leaks(docs, items)


def test_stage_keeps_the_clean_rows_as_they_are(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three four five six seven", 3), (2, "one two three", 4), (2, "one two three", 4),
                                  (None, None, 5)], "doc_id long, text string, item_id long")
    kept = decontaminate.without_contaminated(docs, items)
    assert sorted((r.doc_id or 0, r.item_id) for r in kept.select(*docs.columns).collect()) == [(0, 5), (2, 4), (2, 4)]
    assert decontaminate.without_contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == 4


def test_repeated_rows_and_items_each_have_their_results(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text)] * 3 + [(None, text)] * 2 + [(4, "else")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)] * 2 + [(8, text)], "item_id long, text string")
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == sorted([(0, 7)] * 4 + [(0, 8)] * 2 + [(1, 7)] * 6 + [(1, 8)] * 3)
    assert {(r.start, r.n_words, r.distance, r.similarity) for r in got} == {(0, 7, 0, 1.0)}


def test_windows_at_every_position_are_looked_at(spark):
    # the halves of the item change places amid other words: the window that holds
    # both is the item's place by neither of them
    half = [" ".join(f"{c}{i}" for i in range(45)) for c in "ab"]
    around = " ".join(f"f{i}" for i in range(60))
    docs = [(1, f"{around} {half[1]} {half[0]} {around}"), (2, f"{around} {half[0]} {around} {half[1]}")]
    items = [(7, f"{half[0]} {half[1]}")]
    assert found(spark, docs, items) == leaks(docs, items, every=True) == {(1, 7)}


def test_every_alike_window_is_found_once(spark):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choices([f"w{j}" for j in range(200)], k=30))) for i in range(3)]
    docs = [(1, "x " * 9 + items[0][1] + " y" * 9), (2, items[1][1] + " z"), (3, " ".join(items[2][1].split()[:28]))]
    want = []
    for d, text in docs:
        words = text.split()
        for i, item in items:
            n = min(30, len(words))
            want += [(d, i, s, n) for s in range(len(words) - n + 1)
                     if brute.multiset_similarity(shingles(words[s:s + n]), shingles(item.split())) >= 0.8]
    rows = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.n_words) for r in rows) == sorted(want) and len(want) > 5
