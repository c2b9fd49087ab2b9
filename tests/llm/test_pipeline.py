import corpus_pipeline
from ledgerlake.llm import queries

from . import brute
from .test_bpe import library
from .test_decontaminate import leaks

SF = "/root/testdata/sf0.01"


def boilerplate_free(rows):
    """(id, text, source) rows without boilerplate lines, page by page."""
    pages, held = {}, {}
    for _, text, source in rows:
        pages.setdefault(source, set()).add(text)
    for source, texts in pages.items():
        for t in texts:
            for line in set(t.split("\n")):
                held[source, line] = held.get((source, line), 0) + 1
    bad = {k for k, n in held.items() if k[1].strip(" ") and n >= queries.BOILERPLATE_PAGES
           and n > queries.BOILERPLATE_RATIO * len(pages[k[0]])}
    return [(i, "\n".join(x for x in t.split("\n") if (s, x) not in bad), s) for i, t, s in rows]


def test_run_matches_a_plain_version(spark):
    docs = queries.table(spark, SF, "documents")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)  # held against brute force in test_quality
    assert kept.columns == docs.columns
    rows = boilerplate_free([(r.doc_id, r.text, r.source) for r in kept.collect()])
    firsts = {c for _, _, c in brute.near_duplicates([(i, t) for i, t, _ in rows], queries.SIMHASH_SHINGLE, queries.SIMHASH_RADIUS)}
    rows = [(i, t) for i, t, _ in rows if i in firsts]
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _ in leaks(rows, items)}
    assert leaked and len(firsts) < docs.count()
    want = [(i, t) for i, t in rows if i not in leaked]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in out) == sorted(zip([i for i, _ in want], library([t for _, t in want])))
    texts = dict(want)
    assert all(r.decoded_sha256 == brute.sha(texts[r.doc_id]) for r in out)


def test_stages_keep_columns_and_take_nulls_and_empty_tables(spark):
    docs = queries.table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    for table, rows in ((odd, 2), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF)
            assert table.columns == docs.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert last.count() <= rows and (last.count() > 0) == (rows > 0)
