"""Conversation structure repair: the cheapest edits that give each dialogue the
turn order ``(system? (user assistant)+)?``.

A row is *blank* (nothing but blanks), *duplicate* (same role and text as an
earlier row of the conversation) or *truncated* (its last sign that is no blank
is none of ``.!?``); the first of these counts.  Edits, with their audit letter
and cost: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user
or assistant turn anywhere 3.  Blank and duplicate rows must be deleted, a
truncated row that stays costs 3 more.  Of the cheapest edits those with the
ASCII-least audit string are taken; the audit decides the repaired dialogue.

**Method.**  The edits are the edges of a DAG whose nodes are (row, state of
the turn order), and a path's weight is one big integer: its high digits are
the cost, its low digits (base 256, ``3 * rows + 2`` of them) the audit letters
from the top digit down, zeros behind the last letter.  Less cost, then the
ASCII-least audit is the same as the lesser integer, so ``min`` of integers
decides everything.  Weights run from the end to the start; a letter put before
a path moves the path's letters down by one digit.

**At scale.**  No conversation is gathered, whatever its length.  Rows without
their texts are sorted into ranges of (conversation, turn, ...), the row's
number last, so even equal rows can lie in several ranges.  Each range is cut
into fragments of one conversation and at most ``block`` rows, and a fragment
has the least weight for every pair of states before and behind it.  (Of two
paths of a fragment with the same cost and ends neither's letters start the
other's: they would differ in insertions, so in cost.  So the best of a pair
stays the best whatever follows.)  Fragments of a conversation are put together
from last to first, one at a time, and its audit is dealt back to them.  What
one task holds is a conversation's audit - the result asks for it in one string -
and its fragments' bounds.  Texts meet their edits in a join on the row number.

Defined cases: nulls in role and text are one space (so the row is blank or
``" "`` has no place in the turn order); a null conversation is a conversation
of its own; turns that are null or no numbers come first.  Rows with equal
turns follow role, text (its first 64 code points, then its hash).  A role is
told by its first letter; a row with an empty role may stay and has no part in
the turn order.  Texts of any length are only looked at, never cut.  Equal rows
but the first are duplicates.  An empty table gives empty tables.  Other
columns are not needed and do not clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, written

#: Rows of a fragment.
BLOCK = 2048

# States of the turn order: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn that may come next.
_NEXT = {"u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "s": (SYSTEM, None, None, None)}
_AFTER_INSERT = (USER, USER, ASSISTANT, USER)
_NEVER = 1 << 48  # a cost no path reaches

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT = b"KRDI"

_BLANKS = r"\x20\x09-\x0D"


def blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_BLANKS}]")


def truncated(text: Column) -> Column:
    return ~text.rlike(rf"[.!?][{_BLANKS}]*\z")


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of ``conversations`` with faults put in by
    crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes its role user.  Nulls are one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *filled).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).when(fault == 0, 0).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("col")


# --- weights ------------------------------------------------------------------------

class Weights:
    """Path weights with room for the letters of ``rows`` rows."""

    def __init__(self, rows: int) -> None:
        self.digits = 3 * rows + 2
        self.width = 8 * self.digits
        self.never = _NEVER << self.width
        self._low = (1 << self.width) - 1

    def before(self, path: int, cost: int, letter: int) -> int:
        """The path with an edit put before it."""
        low = path & self._low
        return path - low + (cost << self.width) + (letter << self.width - 8) + (low >> 8)

    def read(self, path: int) -> tuple[int, bytes] | None:
        cost = path >> self.width
        return None if cost >= _NEVER else (cost, (path & self._low).to_bytes(self.digits, "big").rstrip(b"\0"))

    def ends(self) -> list[int]:
        """The least weight from each state to an allowed end, by insertions."""
        one = self.before(0, 3, INSERT)
        return [0, self.before(one, 3, INSERT), one, 0]


def least_paths(rows: list[tuple[str, int]], ends: list[int], weights: Weights) -> list[int]:
    """Least weight from each state before the (role initial, fault) rows to
    the states behind them, whose weights are given."""
    best, before = ends, weights.before
    for initial, fault in reversed(rows):
        after = [before(w, 4, DELETE) for w in best]
        if fault not in (BLANK, DUPLICATE):
            more = 3 if fault == TRUNCATED else 0
            for state in range(4):
                for role in "ua":
                    to = _NEXT[role][state]
                    if to is not None:
                        after[state] = min(after[state], before(best[to], 3 + more, REROLE))
                to = state if initial == "" else _NEXT.get(initial, (None,) * 4)[state]
                if to is not None:
                    after[state] = min(after[state], before(best[to], more, KEEP))
        user = min(after[USER], before(after[ASSISTANT], 3, INSERT))
        assistant = min(after[ASSISTANT], before(after[USER], 3, INSERT))
        best = [min(after[START], before(user, 3, INSERT)), min(after[SYSTEM], before(user, 3, INSERT)), user, assistant]
    return best


# --- fragments ----------------------------------------------------------------------

_FRAGMENT = """part int, seq long, n long, blank long, duplicate long, truncated long, illegal long, first string,
    last string, least long, most long, turns long, whole boolean, paths array<struct<come:int,go:int,cost:long,letters:binary>>"""
_WHOLE = -1  # "go" of a path to the end of its conversation


def _fragment(rows: list[tuple], whole: bool) -> dict:
    """A fragment's counts and least paths; rows are (turn, initial, fault, row)."""
    steps = [(r[1], r[2]) for r in rows]
    weights, paths = Weights(len(rows)), []
    goals = [(_WHOLE, weights.ends())] if whole else [
        (go, [0 if s == go else weights.never for s in range(4)]) for go in range(4)]
    for go, ends in goals:
        found = least_paths(steps, ends, weights)
        for come in (START,) if whole else range(4):
            read = weights.read(found[come])
            if read:
                paths.append({"come": come, "go": go, "cost": read[0], "letters": read[1]})
    turns = [r[0] for r in rows if r[0] is not None]
    faults = [r[2] for r in rows]
    return {"n": len(rows), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED), "first": rows[0][1], "last": rows[-1][1],
            "illegal": sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "least": turns[0] if turns else None, "most": turns[-1] if turns else None,
            "turns": len(set(turns)), "whole": whole, "paths": paths,
            "initials": [r[1] for r in rows], "rows": [r[3] for r in rows]}


def _fragments(slim: DataFrame, block: int) -> DataFrame:
    """Fragments of the sorted ranges of ``slim``, in a written table."""
    order = ["conv", "turn", "role", "head", "a", "b", "row"]
    sorted_rows = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "initial", "fault", "row")
    conv_type = slim.schema["conv"].dataType.simpleString()
    schema = f"conv {conv_type}, {_FRAGMENT}, initials array<string>, rows array<long>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out, size = TaskContext.get().partitionId(), 0, [], 0
        held: list[tuple] = []
        conv, inner = None, False  # inner: the held rows start their conversation, surely

        def flush(ended: bool) -> None:
            nonlocal seq, size, held
            out.append({"conv": conv, "part": part, "seq": seq, **_fragment(held, inner and ended)})
            seq, size, held = seq + 1, size + len(held), []

        types: pa.Schema | None = None
        for batch in batches:
            if types is None:
                types = pa.schema([pa.field("conv", batch.schema.field("conv").type), *_ARROW])
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "fault", "row")]
            for c, *row in zip(*columns):
                if held and c != conv:
                    flush(True)
                    inner = True
                elif len(held) >= block:
                    flush(False)
                    inner = False
                conv = c
                held.append(tuple(row))
                if size >= 8192:
                    yield pa.RecordBatch.from_pylist(out, types)
                    out, size = [], 0
        if held:
            flush(False)
        if out:
            yield pa.RecordBatch.from_pylist(out, types)

    return written(sorted_rows.mapInArrow(cut, schema), "repair-fragments")


_ARROW = [pa.field("part", pa.int32()), *(pa.field(c, pa.int64()) for c in ("seq", "n", "blank", "duplicate", "truncated", "illegal")),
          pa.field("first", pa.string()), pa.field("last", pa.string()),
          *(pa.field(c, pa.int64()) for c in ("least", "most", "turns")), pa.field("whole", pa.bool_()),
          pa.field("paths", pa.list_(pa.struct([("come", pa.int32()), ("go", pa.int32()), ("cost", pa.int64()), ("letters", pa.binary())]))),
          pa.field("initials", pa.list_(pa.string())), pa.field("rows", pa.list_(pa.int64()))]


# --- putting fragments together -----------------------------------------------------

class _Conversation:
    """Fragments of one conversation, added from its last to its first."""

    def __init__(self) -> None:
        self.best: list[tuple[int, bytes] | None] = [(0, b""), (6, b"II"), (3, b"I"), (0, b"")]
        self.steps: list[tuple] = []  # (part, seq, n, state behind it by state before it)
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.least = self.most = self.first = None

    def add(self, f: dict) -> None:
        for c in self.counts:
            self.counts[c] += f[c]
        if self.first is not None:
            self.counts["illegal"] += f["last"] + self.first not in ("su", "ua", "au")
            self.counts["turns"] -= f["most"] is not None and f["most"] == self.least
        self.first = f["first"]
        self.most = f["most"] if self.most is None else self.most
        self.least = f["least"] if f["least"] is not None else self.least
        if f["whole"]:
            path = f["paths"][0]
            self.best = [(path["cost"], path["letters"]), None, None, None]
            self.steps.append((f["part"], f["seq"], f["n"], None))
            return
        best: list = [None] * 4
        go: list = [None] * 4
        for p in f["paths"]:
            behind = self.best[p["go"]]
            if behind is None:
                continue
            joined = (p["cost"] + behind[0], p["letters"] + behind[1])
            if best[p["come"]] is None or joined < best[p["come"]]:
                best[p["come"]], go[p["come"]] = joined, p["go"]
        self.best = best
        self.steps.append((f["part"], f["seq"], f["n"], go))

    def finish(self, conv) -> tuple[dict, Iterator[dict]]:
        cost, letters = self.best[START]
        gaps = self.most - self.least + 1 - self.counts["turns"] if self.most is not None else 0
        summary = {"conv": conv, "gaps": gaps, **{c: self.counts[c] for c in ("blank", "duplicate", "truncated", "illegal")},
                   "cost": cost, "audit": letters.decode()}
        return summary, self._slices(conv, letters)

    def _slices(self, conv, letters: bytes) -> Iterator[dict]:
        at, position, state = 0, 0, START
        for i, (part, seq, n, go) in enumerate(reversed(self.steps)):
            end, taken = at, 0
            while taken < n:
                taken += letters[end] != INSERT
                end += 1
            if i == len(self.steps) - 1:
                end = len(letters)
            piece = letters[at:end]
            yield {"conv": conv, "part": part, "seq": seq, "come": state, "position": position, "letters": piece.decode()}
            position += len(piece) - piece.count(DELETE)
            at, state = end, go[state] if go else START


def _solved(fragments: DataFrame) -> DataFrame:
    """Per conversation a summary row (part is null) and one row a fragment
    with its slice of the audit, in a written table."""
    conv_type = fragments.schema["conv"].dataType.simpleString()
    ordered = (fragments.drop("initials", "rows").repartition("conv")
               .sortWithinPartitions("conv", F.col("part").desc(), F.col("seq").desc()))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = (f"conv {conv_type}, " + ", ".join(f"{c} long" for c in counts)
              + ", audit string, part int, seq long, come int, position long, letters string")
    fields = [*(pa.field(c, pa.int64()) for c in counts), pa.field("audit", pa.string()), pa.field("part", pa.int32()),
              pa.field("seq", pa.int64()), pa.field("come", pa.int32()), pa.field("position", pa.int64()),
              pa.field("letters", pa.string())]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, types = None, None, None

        def results(last: _Conversation, key) -> Iterator[pa.RecordBatch]:
            summary, slices = last.finish(key)
            out = [summary]
            for s in slices:
                out.append(s)
            yield pa.RecordBatch.from_pylist([dict.fromkeys(types.names) | o for o in out], types)

        pending: list[pa.RecordBatch] = []
        for batch in batches:
            types = types or pa.schema([pa.field("conv", batch.schema.field("conv").type), *fields])
            for f in batch.to_pylist():
                if held is None or f["conv"] != conv:
                    if held is not None:
                        pending += results(held, conv)
                    held, conv = _Conversation(), f["conv"]
                held.add(f)
            if pending:
                yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
                pending = []
        if held is not None:
            yield from results(held, conv)

    return written(ordered.mapInArrow(solve, schema), "repair-solved")


def _edits(fragments: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, position, row, role): one row per turn of the repaired dialogues;
    row is null for an inserted turn, role for one that keeps its own."""
    conv_type = fragments.schema["conv"].dataType.simpleString()
    slices = solved.where("part is not null").select("conv", "part", "seq", "come", "position", "letters")
    given = fragments.select("part", "seq", "initials", "rows").join(slices, ["part", "seq"])
    given = given.select("conv", "come", "position", "letters", "initials", "rows")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = pa.schema([pa.field("conv", batch.schema.field("conv").type), pa.field("position", pa.int64()),
                               pa.field("row", pa.int64()), pa.field("role", pa.string())])
            out = []
            for f in batch.to_pylist():
                state, position, at = f["come"], f["position"], 0
                for letter in f["letters"]:
                    if letter == "D":
                        at += 1
                        continue
                    position += 1
                    role, row = None, None
                    if letter == "K":
                        row, initial = f["rows"][at], f["initials"][at]
                        state = state if initial == "" else _NEXT[initial][state]
                    else:
                        state = _AFTER_INSERT[state]
                        role = "user" if state == USER else "assistant"
                        row = f["rows"][at] if letter == "R" else None
                    at += letter != "I"
                    out.append({"conv": f["conv"], "position": position, "row": row, "role": role})
            yield pa.RecordBatch.from_pylist(out, types)

    return given.mapInArrow(deal, f"conv {conv_type}, position long, row long, role string")


@dataclass
class Repaired:
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation
    summary: DataFrame
    #: conv_id, position (from 1), role, text: the repaired dialogues
    turns: DataFrame


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block: int = BLOCK) -> Repaired:
    """Faults, cheapest edits and repaired dialogues of all conversations, see
    the module docstring."""
    document_batches(turns.sparkSession)
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col)}
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").try_cast("long").alias("turn"),
                        filled[role_col].alias("role"), filled[text_col].alias("text"))
    rows = rows.withColumns({
        "row": F.monotonically_increasing_id(), "initial": F.substring("role", 1, 1), "head": F.substring("text", 1, 64),
        "a": F.xxhash64("text"), "b": F.xxhash64(F.lit(7), "text"),
        "fault": F.when(blank(F.col("text")), BLANK).when(truncated(F.col("text")), TRUNCATED).otherwise(FINE)})
    rows = written(rows, "repair-rows")
    slim = rows.drop("text")

    said = ["conv", "role", "a", "b"]
    first = (slim.groupBy(*said).agg(F.min(F.struct("turn", "row")).getField("row").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in said]
    repeated = F.col("first").isNotNull() & (F.col("first") != F.col("row")) & (F.col("fault") != BLANK)
    marked = slim.alias("s").join(first.alias("f"), same, "left").select(
        *[f"s.{c}" for c in ("conv", "turn", "role", "head", "a", "b", "row", "initial")],
        F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"))

    fragments = _fragments(marked, block)
    solved = _solved(fragments)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    summary = solved.where("part is null").select(F.col("conv").alias("conv_id"), *counts)
    edits = written(_edits(fragments, solved), "repair-edits")
    own = edits.where("row is not null").alias("e").join(rows.select("row", F.col("role").alias("old"), "text").alias("r"), "row")
    out = own.select("conv", "position", F.coalesce("e.role", "old").alias("role"), "text").unionByName(
        edits.where("row is null").select("conv", "position", "role", F.lit("").alias("text")))
    return Repaired(summary, out.withColumnRenamed("conv", "conv_id"))


def dialogue_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of each dialogue's ``role:text``
    lines joined by newlines.  The hash is fed row by row from sorted rows, so
    a long dialogue is never held as a whole."""
    conv_type = turns.schema["conv_id"].dataType.simpleString()
    lines = turns.select("conv_id", "position", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "line")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, keys, values, types = None, None, [], [], None
        for batch in batches:
            types = types or pa.schema([batch.schema.field("conv_id"), pa.field("repaired_sha256", pa.string())])
            for c, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if state is None or c != conv:
                    if state is not None:
                        keys.append(conv)
                        values.append(state.hexdigest())
                    state, conv = hashlib.sha256(line.encode()), c
                else:
                    state.update(b"\n" + line.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, types[0].type), pa.array(values)], schema=types)
                keys, values = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], types[0].type), pa.array([state.hexdigest()])], schema=types)

    return ordered.mapInArrow(digest, f"conv_id {conv_type}, repaired_sha256 string")


def repair_report(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conversation of ``turns`` with what repairing its damaged rows
    takes; conversations that lost all rows have zeros and an empty audit."""
    found = repair(damage(turns), block=block)
    everyone = turns.select("conv_id").distinct()
    known = F.col("c.conv_id").eqNullSafe(F.col("s.conv_id"))
    hashed = F.col("c.conv_id").eqNullSafe(F.col("d.conv_id"))
    out = (everyone.alias("c").join(found.summary.alias("s"), known, "left")
           .join(dialogue_digests(found.turns).alias("d"), hashed, "left"))
    zeros = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("c.conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
