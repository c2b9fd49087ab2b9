import random
import re

from ledgerlake.llm import queries, secret_scan
from ledgerlake.llm.secret_scan import RULES, Rule, trigram_query, trigrams

from .oracle import compare

SF = "/root/testdata/sf0.01"


def plain(text, rules=RULES):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", (re.I | re.A) if r.any_case else 0):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), k, f"{r.kind}:{m.start()}:{m.end()}", r.base))
    out.sort()
    return ",".join(s for _, _, s, b in out if b), ",".join(s for _, _, s, _ in out)


def test_query_matches_sql(spark):
    got = compare(queries.op7_secrets(spark, SF), queries.oracle_sql()["op7_secrets"], {"documents": f"{SF}/documents.parquet"})
    assert sum(r[-1] != "" for r in got)


def scan(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumnRenamed("doc_id", "spans_id")
    docs = docs.selectExpr("spans_id", "text", "'clash' as spans", "'clash' as n_hex")
    out = secret_scan.scan(docs, **how)
    return [(r.base_spans, r.spans) for r in sorted(out.collect(), key=lambda r: r.spans_id)]


def test_edges_match_a_plain_scan(spark):
    texts = [None, "", "password=abcdefghijkl", "PassWord : 'short' token='0123456789ab'", "token=secret=abcdefghijklmnop",
             "password: secret: abcdefghijklmnopq", "é🙂 api_key = \"ABCDEFGHIJKLMNOP\" apikey:aaaaaaaaaaaa", "AKIA" + "A" * 13, "xAKIA" + "B" * 14,
             "AKIAAKIA" + "C" * 12, "0123456789abcdef", "0123456789abcde", "g" + "a" * 40 + "g" + "b" * 16, "ghp_" + "a" * 36,
             "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.abc", "-----BEGIN RSA PRIVATE KEY-----", "x postgres://bob:pw@host/db",
             "token=" + "z" * 200_000, " secret: " + "k" * 11 + " secret: " + "k" * 12, "xoxb-1234567890-abc AIza" + "q" * 35]
    assert scan(spark, texts) == [plain(t) for t in texts]
    assert scan(spark, ["same token=abcdefghijklmnop"] * 3) == [plain("same token=abcdefghijklmnop")] * 3
    assert scan(spark, []) == []


def test_random_texts_of_rule_pieces(spark):
    rng = random.Random(1)
    pieces = ["password", "Token", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "\n", "zz", "secret"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(150)]
    assert scan(spark, texts) == [plain(t) for t in texts]


def test_a_query_holds_for_every_match():
    """Whatever a rule matches satisfies its Boolean query."""
    samples = {"assign": "API_KEY: 'abc", "access": "AKIAZ", "hex": "0" * 16, "github": "ghs_" + "a" * 36, "slack": "xoxr-" + "1" * 12,
               "google": "AIza" + "1" * 35, "jwt": "eyJ" + "a" * 10 + "." + "b" * 10 + ".", "private_key": "-----BEGIN PRIVATE KEY-----",
               "url_password": "ab://b:c@"}
    for rule in RULES:
        text = samples[rule.kind]
        assert re.search(rule.pattern, text, re.I if rule.any_case else 0)
        assert all(any(a <= trigrams(text.lower()) for a in clause) for clause in trigram_query(rule.pattern))
    assert trigram_query(next(r for r in RULES if r.kind == "hex").pattern) == []


def test_rules_without_an_index(spark):
    only = (Rule("digits", r"[0-9]{4,}", base=True),)
    docs = spark.createDataFrame([(1, "a 12345 b 123 c 0000")], "doc_id long, text string")
    assert secret_scan.scan(docs, rules=only).first().spans == "digits:2:7,digits:16:20"


def test_running_sums(spark):
    from pyspark.sql import functions as F
    rows = [(list(range(n)),) for n in (0, 1, 2, 3, 4, 5, 31, 32, 33, 1000)]
    df = spark.createDataFrame(rows, "a array<int>")
    for r in df.select("a", secret_scan.running_sums(F.col("a")).alias("s")).collect():
        assert r.s == [sum(r.a[:i + 1]) for i in range(len(r.a))]


def test_many_spans_in_one_text_take_no_quadratic_time(spark):
    import time
    def seconds(n):
        text = " ".join(f"{i:016x}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        row = secret_scan.scan(docs).first()
        assert row.n_hex == n and row.spans.endswith(f",hex:{17 * (n - 1)}:{17 * n - 1}")
        return time.perf_counter() - start
    seconds(1000)
    few, many = seconds(20_000), seconds(200_000)
    assert many < 40 * few + 5
