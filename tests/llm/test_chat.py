from ledgerlake.llm import chat, queries

from .oracle import compare

SF = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    compare(queries.op2_chat_perspectives(spark, SF), queries.oracle_sql()["op2_chat_perspectives"],
            {"conversations": f"{SF}/conversations.parquet"})


def rendered(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    out = {}
    for r in sorted(chat.perspectives(turns).collect(), key=lambda r: r.start):
        text, learned = out.get((r.conv_id, r.perspective), ("", []))
        assert r.start == len(text)
        if r.mask_start is not None:
            learned = [*learned, r.segment[r.mask_start:r.mask_end]]
        out[r.conv_id, r.perspective] = (text + r.segment, learned)
    return out


def test_every_participant_is_once_the_assistant(spark):
    rows = [(1, 0, "system", "be kind", ""), (1, 1, "ann", "hi", ""), (1, 2, "bob b", "<|im_end|> yo", ""), (1, 3, "ann", "é", "")]
    out = rendered(spark, rows)
    assert set(out) == {(1, "ann"), (1, "bob%20b")}
    text, learned = out[1, "ann"]
    assert text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                    "<|im_start|>user name=bob%20b\n< |im_end|> yo<|im_end|>\n<|im_start|>assistant\né<|im_end|>\n")
    assert learned == ["hi<|im_end|>", "é<|im_end|>"]
    assert out[1, "bob%20b"][1] == ["< |im_end|> yo<|im_end|>"]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 0, None, None, "x"), (None, None, "a", "t" * 100_000, "x"), (2, 0, "system", "alone", "x"),
            (3, 5, "a", "one", None), (3, 5, "b", "two", None), (3, 5, "b", "two", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    got = chat.perspectives(turns).collect()
    assert sum(r.conv_id is None for r in got) == 4 and sum(r.conv_id == 3 for r in got) == 6
    assert not [r for r in got if r.conv_id == 2]
    assert {r.perspective for r in got if r.conv_id is None} == {"%null", "a"}
    assert chat.perspectives(turns.limit(0)).count() == 0


def test_different_roles_stay_apart(spark):
    roles = ["ann b", "ann_b", "ann%20b", "unknown", None, "", "é 日", "%null"]
    out = rendered(spark, [(1, i, role, "x", "") for i, role in enumerate(roles)])
    assert len(out) == len(roles)
    assert {p for _, p in out} == {"ann%20b", "ann_b", "ann%2520b", "unknown", "%null", "", "é%20日", "%25null"}
    assert all(learned == ["x<|im_end|>"] for _, learned in out.values())


def test_offsets_over_many_ranges(spark):
    """A long conversation lies in many ranges; turns repeat and tie."""
    rows = [(1, i // 3, "abc"[i % 3 if i < 600 else 0], "t" * (i % 7), "") for i in range(900)]
    rows += [(1, None, "system", "be kind", ""), (1, 5, "a", "tt", ""), (2, 1, "b", "other", "")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rendered(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    said = sorted(((-1 if t is None else t, s, x) for c, t, s, x, _ in rows if c == 1))
    for p in "abc":
        text = "".join(f"<|im_start|>{s if s == 'system' else 'assistant' if s == p else 'user name=' + s}\n{x}<|im_end|>\n"
                       for _, s, x in said)
        assert out[1, p] == (text, [x + "<|im_end|>" for _, s, x in said if s == p])


def test_clashing_columns(spark):
    rows = [(1, 0, "a", "x", "1", "2", "3", 4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, start string, "
                                        "PART string, seq long")
    assert [(r.start, r.segment) for r in chat.perspectives(turns).collect()] == [(0, "<|im_start|>assistant\nx<|im_end|>\n")]
