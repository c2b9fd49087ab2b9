"""Line classification and the queues built from it.

Classification is a ``when`` chain over the matched line: built-in
expressions only, evaluated inside whole-stage codegen.  Numbers, texts and
reasons are columns of projections of their own, which keeps each generated
method under the 8,000 bytes beyond which the JVM does not compile it
(``tests/test_layers.py``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import format_money
from . import ledger as L

# --- fixed values: reason texts -------------------------------------------------
# A8 (browser workflow); {placeholders} are filled from the line.
A8_TEXT = {
    "R6": 'Category "{category}" is not in the approved ledger.',
    "R5": 'No ledger sub-item matches "{description}" under {ledger_category}.',
    "R4": "Line total {line_total} exceeds high-value threshold {threshold}.",
    "R1": "Exact match on category, item and unit price {expected}.",
    "R2": "Unit price {unit_price} within ±{tolerance} of expected {expected}.",
    "R3": "Unit price {unit_price} differs from expected {expected} by {diff} (tolerance {tolerance}).",
}
# A7 (AUD processing); our wording, referencing AUD values.
A7_TEXT = {
    "R5": 'No ledger item matches "{description}" or vendor "{vendor}".',
    "R4": "Line total {line_total} exceeds high-value threshold {threshold}.",
    "R1": "Exact match on item and unit price {expected}.",
    "R2": "Unit price {unit_price} within ±{tolerance} of expected {expected}.",
    "R3": "Unit price {unit_price} differs from expected {expected} by {diff} (tolerance {tolerance}).",
}


def _fill(template: str, values: dict[str, Column]) -> Column:
    """The template with its ``{name}``s filled in."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), values[name]]
    return F.concat(*parts, F.lit(rest))


def _with_texts(df: DataFrame, values: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Compute every text value once in a lower projection; reasons refer to
    the columns (keeps the generated code of the CASE small).  Missing values
    print as 'null'.  Names with one and the same value share a column."""
    first = {id(v): k for k, v in reversed(values.items())}
    out = df.select("*", *[F.coalesce(values[k].cast("string"), F.lit("null")).alias(f"_txt_{k}") for k in dict.fromkeys(first[id(v)] for v in values.values())])
    return out, {k: F.col(f"_txt_{first[id(v)]}") for k, v in values.items()}


def _money(x, currency=None) -> Column:
    return format_money(x, currency)


def _with_amounts(df: DataFrame, cur: Column | None, rules: RuleSet, unit: Column, total: Column, expected: Column,
                  diff: Column, tolerance: Column) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the amounts that the reason of its rule names, and their
    texts.  R4 names two amounts, R1 one, R2 three and R3 four, so four columns
    hold them all and no row formats another."""
    rule = F.col("_rule")
    of = {"_a1": (F.when(rule == "R4", total).when(rule.isin("R1", "R2", "R3"), expected), ("R4", "R1", "R2", "R3")),
          "_a2": (F.when(rule == "R4", rules.high_value).when(rule.isin("R2", "R3"), unit), ("R4", "R2", "R3")),
          "_a3": (F.when(rule.isin("R2", "R3"), tolerance), ("R2", "R3")),
          "_a4": (F.when(rule == "R3", diff), ("R3",))}
    out = df.withColumns({name: amount for name, (amount, _) in of.items()})
    a1, a2, a3, a4 = (F.when(rule.isin(*named), _money(F.col(name), cur)) for name, (_, named) in of.items())
    return out, {"line_total": a1, "expected": a1, "threshold": a2, "unit_price": a2, "tolerance": a3, "diff": a4}


@dataclass(frozen=True)
class Thresholds:
    """The numbers of the rules R2 and R4; the defaults are the shipped file's."""

    tolerance_percent: float = K.RULE_TOLERANCE_PERCENT
    tolerance_absolute: float = K.RULE_TOLERANCE_ABSOLUTE
    high_value: float = K.RULE_HIGH_VALUE_THRESHOLD


def thresholds(rules: DataFrame) -> Thresholds:
    """The thresholds of a rules table (one row per rule, so one small
    aggregate); a missing rule or number keeps its default."""
    r = rules.agg(*[F.max(F.when(F.col("id") == rule, F.col(c))).alias(c) for rule, c in
                    (("R2", "tolerancePercent"), ("R2", "toleranceAbsolute"), ("R4", "thresholdAmount"))]).first()
    given = {"tolerance_percent": r[0], "tolerance_absolute": r[1], "high_value": r[2]}
    return Thresholds(**{k: v for k, v in given.items() if v is not None})


@dataclass(frozen=True)
class RuleSet:
    """The rules as values of the query itself: limits, outcomes and who has
    to look, from a rules table or the defaults.  The order in which rules are
    tried is fixed (R6, R5, R4, R1, R2, R3)."""

    tolerance_percent: Column
    tolerance_absolute: Column
    high_value: Column  # null: no such rule
    outcome: Column  # map rule -> status
    human: Column  # map rule -> whether a person has to look

    def status(self, rule: Column) -> Column:
        return F.coalesce(F.try_element_at(self.outcome, rule), _case(rule, DEFAULT_OUTCOME))

    def human_in_loop(self, rule: Column) -> Column:
        return F.coalesce(F.try_element_at(self.human, rule), _case(rule, DEFAULT_HUMAN))


DEFAULT_OUTCOME = {"R6": "exception", "R5": "exception", "R4": "review", "R1": "matched", "R2": "matched", "R3": "review"}
DEFAULT_HUMAN = {"R6": False, "R5": False, "R4": True, "R1": False, "R2": False, "R3": True}


def _case(key: Column, values: dict) -> Column:
    out = F
    for k, v in values.items():
        out = out.when(key == k, F.lit(v))
    return out


def fixed_rules(t: Thresholds) -> RuleSet:
    none = F.create_map()
    return RuleSet(F.lit(t.tolerance_percent), F.lit(t.tolerance_absolute), F.lit(t.high_value),
                   none.cast("map<string,string>"), none.cast("map<string,boolean>"))


def rules_of(rules: DataFrame) -> RuleSet:
    """S8 as data: a rules table (id, outcome, humanInLoop, tolerancePercent,
    toleranceAbsolute, thresholdAmount), one row a rule, read by the query
    itself as one scalar subquery: nothing is collected, and a changed table
    changes the outcome.  A limit that a rule does not give is 0; without R4
    no line is of high value; a rule without an outcome keeps its default, one
    that does not say that a person has to look needs none.  Of rows with one
    id the last by its fields counts."""
    def limit(rule: str, column: str) -> Column:
        return F.max(F.when(F.col("id") == rule, F.coalesce(F.col(column).cast("double"), F.lit(0.0))))

    one = rules.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.struct(
        "outcome", "humanInLoop", "tolerancePercent", "toleranceAbsolute", "thresholdAmount")).alias("r")).select("id", "r.*")
    said = F.col("outcome").isNotNull()
    read = one.agg(F.struct(
        F.coalesce(limit("R2", "tolerancePercent"), F.lit(0.0)).alias("percent"),
        F.coalesce(limit("R2", "toleranceAbsolute"), F.lit(0.0)).alias("absolute"), limit("R4", "thresholdAmount").alias("high"),
        F.map_from_entries(F.collect_list(F.when(said, F.struct("id", "outcome")))).alias("outcome"),
        F.map_from_entries(F.collect_list(F.struct("id", F.coalesce("humanInLoop", F.lit(False))))).alias("human"))).scalar()
    return RuleSet(read["percent"], read["absolute"], read["high"], read["outcome"], read["human"])


def _with_price_columns(df: DataFrame, unit: Column, line_total: Column, expected: Column, rules: RuleSet):
    """``df`` with the price's difference and tolerance, and these as (diff,
    tolerance, high, exact, within)."""
    out = df.withColumns({
        "_diff": F.abs(unit - expected),
        "_tolerance": F.greatest(expected * (rules.tolerance_percent / F.lit(100.0)), rules.tolerance_absolute)})
    diff, tolerance = F.col("_diff"), F.col("_tolerance")
    return out, (diff, tolerance, line_total > rules.high_value, diff < F.lit(K.RULE_EXACT_PRICE_DELTA), diff <= tolerance)


def classify_aud(matched: DataFrame, t: Thresholds | RuleSet = Thresholds()) -> DataFrame:
    """Classify lines matched by J8 (``ledger_item``) on AUD values.

    R5 no item -> exception; R4 convertedLineTotal > 5000 -> review;
    R1 |convertedUnitPrice - expected| < 0.01 -> matched; R2 within
    max(10 %, 50) -> matched; else R3 -> review.  Output is the match record.
    """
    rules = t if isinstance(t, RuleSet) else fixed_rules(t)
    item = F.col("ledger_item")
    unit, total, expected = F.col("convertedUnitPrice"), F.col("convertedLineTotal"), item["expectedUnitPrice"]
    matched, (diff, tol, high, exact, within) = _with_price_columns(matched, unit, total, expected, rules)
    cur = F.lit(K.LEDGER_CURRENCY)
    rule = (F.when(item.isNull(), "R5").when(high, "R4").when(exact, "R1").when(within, "R2").otherwise("R3"))
    matched = matched.withColumn("_rule", rule)
    rule = F.col("_rule")
    matched, amounts = _with_amounts(matched, cur, rules, unit, total, expected, diff, tol)
    matched, vals = _with_texts(matched, {"description": F.col("description"), "vendor": F.col("vendorName"), **amounts})
    reason = F.when(rule == "R5", _fill(A7_TEXT["R5"], vals))
    for r in ("R4", "R1", "R2", "R3"):
        reason = reason.when(rule == r, _fill(A7_TEXT[r], vals))
    return matched.select(
        "invoiceId", "lineNo",
        F.col("description").alias("lineItemDescription"),
        F.col("vendorName").alias("businessName"),
        "quantity", "unitPrice", "lineTotal", "convertedUnitPrice", "convertedLineTotal",
        F.lit(K.LEDGER_CURRENCY).alias("convertedCurrency"),
        rules.status(rule).alias("status"),
        F.when(item.isNotNull(), item["itemName"]).alias("matchedLedgerItem"),
        F.when(item.isNotNull(), item["ledgerCode"]).alias("ledgerCode"),
        rule.alias("ruleApplied"),
        reason.alias("reason"),
        rules.human_in_loop(rule).alias("humanInLoop"))


def classify_category(matched: DataFrame, t: Thresholds | RuleSet = Thresholds()) -> DataFrame:
    """The browser workflow's classification of lines matched by J7.

    Same order as A7 but on native values, plus R6 when the category is not
    in the ledger.  Money text uses the default currency (USD) like the page.
    """
    rules = t if isinstance(t, RuleSet) else fixed_rules(t)
    item = F.col("ledger_item")
    unit, total, expected = F.col("unitPrice"), F.col("lineTotal"), item["expectedUnitPrice"]
    matched, (diff, tol, high, exact, within) = _with_price_columns(matched, unit, total, expected, rules)
    rule = (F.when(F.col("ledger_category").isNull(), "R6").when(item.isNull(), "R5")
            .when(high, "R4").when(exact, "R1").when(within, "R2").otherwise("R3"))
    matched = matched.withColumn("_rule", rule)
    rule = F.col("_rule")
    matched, amounts = _with_amounts(matched, None, rules, unit, total, expected, diff, tol)
    matched, vals = _with_texts(matched, {"category": F.col("categoryName"), "description": F.col("description"),
                                          "ledger_category": F.col("ledger_category"), **amounts})
    reason = F.when(rule == "R6", _fill(A8_TEXT["R6"], vals))
    for r in ("R5", "R4", "R1", "R2", "R3"):
        reason = reason.when(rule == r, _fill(A8_TEXT[r], vals))
    return matched.select(
        "invoiceId", "vendorName", "categoryName",
        F.col("lineNo").alias("lineItemId"),
        "description", "quantity", "unitPrice", "lineTotal",
        F.col("ledger_category").alias("matchedLedgerCategory"),
        F.when(item.isNotNull(), item["itemName"]).alias("matchedLedgerItem"),
        rules.status(rule).alias("status"),
        rule.alias("ruleApplied"),
        reason.alias("reason"),
        rules.human_in_loop(rule).alias("humanInLoop"))


def process_lines_aud(lines: DataFrame, items: DataFrame) -> DataFrame:
    """J8 + A7 over invoice lines."""
    return classify_aud(L.match_global(lines, items))


def process_lines_category(lines: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """J7 + A8 over invoice lines."""
    return classify_category(L.match_in_category(lines, items, categories))


def split_matched(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """LedgerMatched (matched + review) and LedgerException (exception)."""
    return (records.filter(F.col("status").isin("matched", "review")),
            records.filter(F.col("status") == "exception"))


def outcome_summary(results: DataFrame) -> DataFrame:
    """Per invoice -- matched, review, exception and total lines."""
    s = F.col("status")
    return (results.groupBy("invoiceId")
            .agg(F.count_if(s == "matched").alias("matched"),
                 F.count_if(s == "review").alias("review"),
                 F.count_if(s == "exception").alias("exception"),
                 F.count(F.lit(1)).alias("totalProcessed")))


def processing_notes(results: DataFrame) -> DataFrame:
    """The processing notes of each invoice, one row per note line.

    section 0/1 = the two summary sentences, 2/3 = review title and items,
    4/5 = exception title and items (items keep their lineItemId).  Joining
    ``note`` ordered by (section, lineItemId) gives the page's text; rows
    are kept long so a huge invoice is never gathered into one value.
    ``results`` is read twice, for the per-invoice lines and for the item
    lines: pass the saved records, not the matching itself.
    """
    s = F.col("status")
    summary = (results.groupBy("invoiceId")
               .agg(F.count_if(s == "matched").alias("matched"),
                    F.count_if(s == "review").alias("review"),
                    F.count_if(s == "exception").alias("exception"),
                    F.count(F.lit(1)).alias("totalProcessed"),
                    F.min("vendorName").alias("vendorName")))

    def note(section: int, text, when=None):
        st = F.struct(F.lit(section).alias("section"), text.alias("note"))
        return st if when is None else F.when(when, st)

    first = F.concat(F.lit("Processed "), F.col("totalProcessed").cast("string"),
                     F.lit(" line item(s) for invoice "), F.col("invoiceId"), F.lit(" ("),
                     F.coalesce(F.col("vendorName"), F.lit("null")), F.lit(")."))
    second = F.concat(F.col("matched").cast("string"), F.lit(" matched, "), F.col("review").cast("string"),
                      F.lit(" need review, "), F.col("exception").cast("string"), F.lit(" exception(s)."))
    heads = F.array(note(0, first), note(1, second),
                    note(2, F.lit("Human-in-the-loop required for:"), F.col("review") > 0),
                    note(4, F.lit("Sent to exception queue:"), F.col("exception") > 0))
    head = (summary.select("invoiceId", F.explode(F.filter(heads, lambda x: x.isNotNull())).alias("n"))
            .select("invoiceId", F.col("n.section").alias("section"),
                    F.lit(None).cast("string").alias("lineItemId"), F.col("n.note").alias("note")))
    items = results.filter(s.isin("review", "exception")).select(
        "invoiceId",
        F.when(s == "review", 3).otherwise(5).alias("section"),
        "lineItemId",
        F.concat(F.lit("  • "), F.coalesce(F.col("description"), F.lit("null")), F.lit(" — "),
                 F.coalesce(F.col("reason"), F.lit("null"))).alias("note"))
    return head.unionByName(items)


def exception_queue(records: DataFrame, invoices: DataFrame) -> DataFrame:
    """U2 + J11 + F8: exceptions and review items with their kind.

    Vendor = businessName, else vendorName, of the invoice's last document,
    else the record's businessName; empty names count as none.
    """
    business = L.last_document(invoices, L.filled("businessName", "vendorName"), "_biz")
    review = F.lower(F.coalesce(F.col("status"), F.lit(""))) == "review"
    kind = F.when(F.col("status") == "exception", "exception").when(review, "review")
    return (records.withColumn("kind", kind).filter(F.col("kind").isNotNull())
            .join(business, "invoiceId", "left")
            .select("invoiceId", "lineNo",
                    F.coalesce("_biz", "businessName").alias("vendorName"),
                    F.lit(None).cast("string").alias("categoryName"),
                    F.col("lineItemDescription").alias("description"),
                    "lineTotal", "ruleApplied", "kind", "reason"))


def posted_lines(records: DataFrame) -> DataFrame:
    """LedgerMatched and LedgerException records together (the ledger
    page's posted set).  The union of the two status filters is one filter
    on the same rows, so the records are scanned once."""
    return records.filter(F.col("status").isin("matched", "review", "exception"))


def posted_entries(records: DataFrame) -> DataFrame:
    """One ledger entry per LedgerMatched record."""
    matched, _ = split_matched(records)
    cur = F.coalesce(F.col("convertedCurrency"), F.lit(K.LEDGER_CURRENCY))
    return matched.select(
        F.concat(F.coalesce("invoiceId", F.lit("")), F.lit("-"), F.coalesce("lineNo", F.lit(""))).alias("entry"),
        "invoiceId",
        F.col("businessName").alias("vendor"),
        F.coalesce("ledgerCode", F.lit("")).alias("ledgerCode"),
        F.coalesce("matchedLedgerItem", "lineItemDescription").alias("item"),
        F.col("convertedLineTotal").alias("amount"),
        _money(F.col("convertedLineTotal"), cur).alias("amount_text"),
        F.coalesce("status", F.lit("")).alias("status"))
