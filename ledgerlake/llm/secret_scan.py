"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query: every string it
can match must contain, for each clause, all trigrams of one of the clause's
alternatives.  One pass over the texts builds the inverted index of the
trigrams the rules ask for, (trigram, text); the rules intersect the postings
per text, and only the texts that are left are scanned with the expression.  A
rule without a mandatory trigram scans every text.  The index holds
lower-cased trigrams and serves rules of either case.

Matches are leftmost and do not overlap within a kind; spans are in code
points, end exclusive.  Spans of different kinds may overlap.  Null and empty
texts have no spans; texts of any length are scanned whole; repeated rows
(equal texts share their postings) give repeated results.  Other columns pass
through, one named like an added column is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, text_key, with_columns_kept, written

#: More strings than this are not told apart when a query is derived.
MOST_STRINGS = 24
_WORD = 62  # trigrams per mask column


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; one counts if its ``group`` has at least
    ``least`` code points.  ``base`` rules are reported apart."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    base: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


#: The three base kinds, in the order they are listed.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, any_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
)

#: Well-known token formats beside them.
MORE_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^/\s:@]+:[^/\s:@]+@"),
)
RULES = BASE_RULES + MORE_RULES


# --- Boolean trigram queries ------------------------------------------------------

def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses (all must hold) of alternatives (one must hold) of lower-cased
    trigrams (all present), necessary for any match of ``pattern``."""
    clauses: list[list[frozenset[str]]] = []

    def close(strings: list[str] | None) -> None:
        sets = {trigrams(s) for s in strings or [""]}
        if all(sets):  # an alternative that asks for more than another adds nothing
            clauses.append(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))

    def strings_of(op: str, arg) -> list[str] | None:
        """All strings an element can be, lower-cased; None: too many."""
        if op == "LITERAL":
            return [chr(arg).lower()]
        if op == "IN":
            if any(str(k) != "LITERAL" for k, _ in arg) or len(arg) > 8:
                return None
            return sorted({chr(c).lower() for _, c in arg})
        if op == "SUBPATTERN":
            return sequence(arg[-1])
        if op == "BRANCH":
            parts = [sequence(b) for b in arg[1]]
            return None if None in parts else [s for p in parts for s in p]
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            inner = sequence(body) if int(high) <= 2 else None
            if inner is None:
                return None
            out = {""} if low == 0 else set()
            for n in range(max(low, 1), int(high) + 1):
                out |= set(reduce(lambda a, b: [x + y for x in a for y in b], [inner] * n))
            return sorted(out)
        return None

    def sequence(parsed) -> list[str] | None:
        out = [""]
        for op, arg in parsed:
            found = strings_of(str(op), arg)
            if found is None or len(out) * len(found) > MOST_STRINGS:
                return None
            out = [a + b for a in out for b in found]
        return out

    def walk(parsed) -> None:
        run: list[str] = [""]
        for op, arg in parsed:
            found = strings_of(str(op), arg)
            if found is not None and len(run) * len(found) <= MOST_STRINGS:
                run = [a + b for a in run for b in found]
                continue
            close(run)
            run = found or [""]
            if found is None and str(op) == "SUBPATTERN":
                walk(arg[-1])
            elif found is None and str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
                walk(arg[2])
        close(run)

    walk(re._parser.parse(pattern))
    return clauses


# --- index and candidates -----------------------------------------------------------

def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for alt in clause for t in alt})


def build_index(texts: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index (trigram, text_id) of a frame with a column text,
    for the given trigrams; ``trigram`` is the number in ``grams``.

    A text is lower-cased once, in a projection of its own, and its trigrams
    are gathered as bits by generated code.  The bits are written before they
    become postings: a filter on them, or a lambda over them, would search the
    text again.
    """
    low = texts.select(text_key(F.col("text")).alias("text_id"), F.lower("text").alias("low"))

    def bits(of: range) -> Column:
        held = [F.when(F.contains("low", F.lit(grams[i])), F.lit(1 << i - of.start)).otherwise(F.lit(0)).cast("long") for i in of]
        return reduce(lambda x, y: x.bitwiseOR(y), held)

    words = [range(at, min(at + _WORD, len(grams))) for at in range(0, len(grams), _WORD)]
    masks = written(low.select("text_id", *[bits(of).alias(f"m{w}") for w, of in enumerate(words)]), "trigram-bits")
    masks = masks.where(reduce(or_, [F.col(f"m{w}") != 0 for w in range(len(words))]))

    def numbers(mask: Column, of: range) -> Column:
        return F.filter(F.array(*[F.lit(i) for i in of]), lambda i: F.getbit(mask, i - of.start) == 1)

    present = F.concat(*[numbers(F.col(f"m{w}"), of) for w, of in enumerate(words)])
    postings = masks.select("text_id", F.explode(present).alias("trigram"))
    return written(postings.select("trigram", "text_id").sortWithinPartitions("trigram"), "trigram-index")


def candidates(index: DataFrame, grams: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """(text_id, one flag per indexed rule) of the texts that satisfy at least
    one rule's query: the postings of each text are joined into bit masks."""
    number = {g: i for i, g in enumerate(grams)}
    words = range((len(grams) + _WORD - 1) // _WORD)
    masks = index.groupBy("text_id").agg(*[
        F.bit_or(F.when(F.floor(F.col("trigram") / _WORD) == w,
                        F.expr(f"shiftleft(1L, trigram % {_WORD})")).otherwise(F.lit(0).cast("long"))).alias(f"m{w}")
        for w in words])

    def holds(alternative: frozenset[str]) -> Column:
        tests = []
        for w in words:
            need = sum(1 << number[g] % _WORD for g in alternative if number[g] // _WORD == w)
            if need:
                tests.append(F.col(f"m{w}").bitwiseAND(F.lit(need)) == F.lit(need))
        return reduce(and_, tests)

    flags = {r.kind: reduce(and_, [reduce(or_, [holds(a) for a in clause]) for clause in trigram_query(r.pattern)])
             for r in rules}
    found = masks.select("text_id", *[f.alias(k) for k, f in flags.items()])
    return written(found.where(reduce(or_, [F.col(k) for k in flags])), "trigram-candidates")


# --- verification -------------------------------------------------------------------

def _matches(rule: Rule, text: Column, scan: Column | None) -> Column:
    found = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))
    return found if scan is None else F.when(scan, found)


def running_sums(numbers: Column) -> Column:
    """Sums of an array up to and with each entry, by doubling: in round j each
    entry adds the one 2^j places before it.  (A fold that appends its results
    would copy them all at every step.)"""
    rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.size(numbers).cast("double"))).cast("int"), F.lit(0)))
    return F.aggregate(rounds, numbers, lambda sums, j: F.transform(
        sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), j)), F.lit(0))))


def _spans(rule: Rule, order: int, text: Column, matches: Column) -> Column:
    """Array of (start, order, span text) from the matches and the text
    between them."""
    none = F.expr("cast(array() as array<struct<start:int,order:int,span:string>>)")
    gaps = F.slice(F.split(text, rule.java, -1), 1, F.size(matches))
    groups = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group))
    ends = running_sums(F.zip_with(gaps, matches, lambda gap, hit: F.length(gap) + F.length(hit)))
    found = F.filter(F.arrays_zip(ends.alias("end"), matches.alias("hit"), groups.alias("part")), lambda x: F.length(x["part"]) >= rule.least)

    def span(x: Column) -> Column:
        start = x["end"] - F.length(x["hit"])
        return F.struct(start.alias("start"), F.lit(order).alias("order"), F.concat_ws(":", F.lit(rule.kind), start, x["end"]).alias("span"))

    return F.when(F.size(F.coalesce(matches, F.array())) > 0, F.transform(found, span)).otherwise(none)


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with n_<kind> for each base rule, base_spans and spans, both
    ``kind:start:end`` joined by commas in the order of start, then rule."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    base = [r for r in rules if r.base]
    added = [f"n_{r.kind}" for r in base] + ["base_spans", "spans"]
    kept = with_columns_kept(docs, *added, "_text", "_id", "_found")
    rows = kept.select("*", text.alias("_text"))
    if indexed:
        grams = vocabulary(indexed)
        found = candidates(build_index(docs.select(text.alias("text")), grams), grams, indexed)
        found = small(found, 64).select(F.col("text_id").alias("_id"), F.struct(*[r.kind for r in indexed]).alias("_found"))
        rows = rows.join(found, text_key(F.col("_text")) == F.col("_id"), "left")
    for i, rule in enumerate(rules):
        flag = F.col(f"_found.`{rule.kind}`") if rule in indexed else None
        rows = rows.withColumn(f"_m{i}", _matches(rule, F.col("_text"), flag))
    rows = rows.select("*", *[_spans(r, i, F.col("_text"), F.col(f"_m{i}")).alias(f"_s{i}") for i, r in enumerate(rules)])

    def joined(of: list[int]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.concat(*[F.col(f"_s{i}") for i in of])), lambda x: x["span"]), ",")

    at = {r.kind: i for i, r in enumerate(rules)}
    return rows.select(*[F.col(f"`{c}`") for c in kept.columns],
                       *[F.size(f"_s{at[r.kind]}").cast("long").alias(f"n_{r.kind}") for r in base],
                       joined([at[r.kind] for r in base]).alias("base_spans"),
                       joined(list(range(len(rules)))).alias("spans"))


def _oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same spans in SQL: the text between matches gives their places."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hits = " UNION ALL ".join(
        f"SELECT rid, {i} AS ord, {quote(r.kind)} AS kind, {r.least} AS least, {r.base} AS base, "
        f"regexp_extract_all(text, {quote(r.java)}, 0) AS m, regexp_extract_all(text, {quote(r.java)}, {r.group}) AS g, "
        f"regexp_split_to_array(text, {quote(r.java)}) AS gaps FROM doc" for i, r in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {quote(r.kind)}) AS n_{r.kind}" for r in rules if r.base)
    span = "kind || ':' || s || ':' || e, ',' ORDER BY s, ord"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
hit AS ({hits}),
one AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM hit WHERE len(m) > 0),
span AS (
  SELECT rid, ord, kind, base, s, s + length(m[i]) AS e FROM (
    SELECT *, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM one)
  WHERE length(g[i]) >= least),
found AS (SELECT rid, {counts}, string_agg({span}) FILTER (WHERE base) AS base_spans, string_agg({span}) AS spans
          FROM span GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules if r.base)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN found USING (rid)
"""


ORACLE_SQL = _oracle_sql()
