"""DuckDB oracle SQL for the business-rule queries.

Matching is written the obvious way here (``contains`` in the join
condition): the oracle only has to be right at the check's scale, while
the Spark plan joins windows of the texts to the terms.
"""

from __future__ import annotations

from .. import constants as K
from ..operators.rules import A7_TEXT, A8_TEXT
from .oracle import RUN_OF_EVENT, _r, converted


def _money(expr: str, currency_sql: str = f"'{K.DEFAULT_MONEY_CURRENCY}'") -> str:
    return (f"CASE WHEN ({expr}) IS NULL OR isnan(CAST({_r(expr)} AS DOUBLE)) THEN '{K.MISSING_MONEY_TEXT}' "
            f"ELSE {currency_sql} || ' ' || printf('%.2f', {_r(expr)}) END")


def _fill(template: str, values: dict[str, str]) -> str:
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append("'" + head.replace("'", "''") + "'")
        parts.append(f"coalesce(CAST(({values[name]}) AS VARCHAR), 'null')")
    if rest:
        parts.append("'" + rest.replace("'", "''") + "'")
    return " || ".join(parts)


_EXACT = f"CAST({K.RULE_EXACT_PRICE_DELTA} AS DOUBLE)"


def _reason_case(texts: dict[str, str], values: dict[str, str], order) -> str:
    return "CASE ruleApplied " + " ".join(f"WHEN '{r}' THEN {_fill(texts[r], values)}" for r in order) + " END"


def _limits(rules) -> tuple[str, str]:
    """(tolerance, high-value limit) in SQL; a limit not given is 0, a high-value rule not given NULL."""
    by_id = {r[0]: dict(zip(K.RULE_FIELDS, r)) for r in rules}
    r2, r4 = by_id.get("R2", {}), by_id.get("R4")
    tolerance = (f"greatest(m_expected * CAST({(r2.get('tolerancePercent') or 0) / 100.0} AS DOUBLE), "
                 f"CAST({r2.get('toleranceAbsolute') or 0} AS DOUBLE))")
    return tolerance, f"CAST({r4['thresholdAmount'] or 0} AS DOUBLE)" if r4 else "CAST(NULL AS DOUBLE)"


def _outcomes(rules) -> tuple[str, str]:
    """(status, humanInLoop) by ruleApplied in SQL: the file's, else what the rule does by itself."""
    status = {"R1": "matched", "R2": "matched", "R3": "review", "R4": "review", "R5": "exception", "R6": "exception"}
    status |= {r[0]: r[1] for r in rules if r[1]}
    human = {"R3": True, "R4": True} | {r[0]: bool(r[2]) for r in rules}
    return ("CASE ruleApplied " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in status.items()) + " END",
            "ruleApplied IN ('none'" + "".join(f", '{k}'" for k, v in human.items() if v) + ")")


def _a7_sql(name: str, rules) -> str:
    tolerance, high = _limits(rules)
    status, human = _outcomes(rules)
    values = {"description": "description", "vendor": "vendorName",
              "line_total": _money("convertedLineTotal", "'AUD'"), "threshold": _money(high, "'AUD'"),
              "expected": _money("m_expected", "'AUD'"), "unit_price": _money("convertedUnitPrice", "'AUD'"),
              "tolerance": _money("tol", "'AUD'"), "diff": _money("diff", "'AUD'")}
    return f"""{name}_base AS (
  SELECT *, abs(convertedUnitPrice - m_expected) AS diff, {tolerance} AS tol FROM j8),
{name}_rule AS (
  SELECT *, CASE WHEN NOT has_item THEN 'R5' WHEN convertedLineTotal > {high} THEN 'R4'
                 WHEN diff < {_EXACT} THEN 'R1' WHEN diff <= tol THEN 'R2' ELSE 'R3' END AS ruleApplied
  FROM {name}_base),
{name} AS (
  SELECT invoiceId, lineNo, description AS lineItemDescription, vendorName AS businessName,
         quantity, unitPrice, lineTotal, convertedUnitPrice, convertedLineTotal, 'AUD' AS convertedCurrency,
         {status} AS status,
         CASE WHEN has_item THEN m_item END AS matchedLedgerItem,
         CASE WHEN has_item THEN m_code END AS ledgerCode,
         ruleApplied,
         {_reason_case(A7_TEXT, values, ("R5", "R4", "R1", "R2", "R3"))} AS reason,
         {human} AS humanInLoop
  FROM {name}_rule)"""


def _a8_sql(name: str, rules) -> str:
    tolerance, high = _limits(rules)
    status, human = _outcomes(rules)
    values = {"category": "categoryName", "description": "description", "ledger_category": "ledger_category",
              "line_total": _money("lineTotal"), "threshold": _money(high),
              "expected": _money("m_expected"), "unit_price": _money("unitPrice"),
              "tolerance": _money("tol"), "diff": _money("diff")}
    return f"""{name}_base AS (
  SELECT *, abs(unitPrice - m_expected) AS diff, {tolerance} AS tol FROM j7),
{name}_rule AS (
  SELECT *, CASE WHEN ledger_category IS NULL THEN 'R6' WHEN NOT has_item THEN 'R5'
                 WHEN lineTotal > {high} THEN 'R4' WHEN diff < {_EXACT} THEN 'R1'
                 WHEN diff <= tol THEN 'R2' ELSE 'R3' END AS ruleApplied
  FROM {name}_base),
{name} AS (
  SELECT invoiceId, vendorName, categoryName, lineNo AS lineItemId, description, quantity, unitPrice, lineTotal,
         ledger_category AS matchedLedgerCategory,
         CASE WHEN has_item THEN m_item END AS matchedLedgerItem,
         {status} AS status,
         ruleApplied,
         {_reason_case(A8_TEXT, values, ("R6", "R5", "R4", "R1", "R2", "R3"))} AS reason,
         {human} AS humanInLoop
  FROM {name}_rule)"""


def _best(cands: str, rank_contains: int, src: str, out: str) -> str:
    return f"""
{cands} AS (
  SELECT d.t, x.ledgerCode, x.itemName, x.expectedUnitPrice, x.item_position,
         CASE WHEN d.t = x.term_l THEN 0 ELSE {rank_contains} END AS match_rank,
         CASE WHEN contains(d.t, x.term_l) THEN length(x.term_l) ELSE length(d.t) END AS overlap
  FROM {src} d JOIN ledger_terms x
    ON length(d.t) > 0 AND (contains(d.t, x.term_l) OR contains(x.term_l, d.t))),
{out} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY match_rank, overlap DESC, item_position) AS rn
    FROM {cands}) WHERE rn = 1)"""


def _found_rate(date: str) -> str:
    """The rate of the covering period that starts last; without a date that
    of the period that starts last of all."""
    d = f"TRY_CAST({date} AS DATE)"
    return (f"(SELECT fx.rate FROM fx WHERE upper(fx.\"from\") = upper(s.currency) AND ({d} IS NULL OR "
            f"(fx.fd <= {d} AND (fx.td IS NULL OR {d} <= fx.td))) ORDER BY fx.fd DESC LIMIT 1)")


RULE_CTES = f"""
ledger_items AS (
  SELECT p_type AS categoryName, CAST(min(p_partkey) - CAST(min(p_partkey) % {K.SHARED_CODE[0]} = {K.SHARED_CODE[1]} AS INTEGER) AS VARCHAR) AS ledgerCode, upper(p_name) AS itemName,
         min(p_retailprice) AS expectedUnitPrice,
         list_concat([arg_min(p_brand, p_partkey)],
                     CASE WHEN min(p_partkey) % {K.VENDOR_ALIAS[0]} = {K.VENDOR_ALIAS[1]}
                          THEN ['Customer#' || lpad(CAST(min(p_partkey) AS VARCHAR), CAST(greatest(9, length(CAST(min(p_partkey) AS VARCHAR))) AS INTEGER), '0')]
                          ELSE [] END) AS aliases,
         min(p_partkey) AS item_position
  FROM part GROUP BY p_type, p_name),
ledger_categories AS (
  SELECT p_type AS categoryName, {_r("sum(p_retailprice) * 50")} AS approvedBudget,
         {_r("sum(p_retailprice) * 20")} AS ytdBalance
  FROM part GROUP BY p_type),
ledger_terms AS (
  SELECT DISTINCT categoryName, ledgerCode, itemName, expectedUnitPrice, item_position, lower(term) AS term_l
  FROM (SELECT *, unnest(list_distinct(list_concat([itemName], aliases))) AS term FROM ledger_items)
  WHERE length(term) > 0),
j7_best AS (
  SELECT d.cat_l, d.desc_l,
         arg_min(t.ledgerCode, t.item_position) AS ledgerCode,
         arg_min(t.itemName, t.item_position) AS itemName,
         arg_min(t.expectedUnitPrice, t.item_position) AS expectedUnitPrice
  FROM (SELECT DISTINCT lower(categoryName) AS cat_l, lower(coalesce(description, '')) AS desc_l FROM silver_lines) d
  JOIN ledger_terms t ON lower(t.categoryName) = d.cat_l AND contains(d.desc_l, t.term_l)
  GROUP BY d.cat_l, d.desc_l),
j7 AS (
  SELECT l.*, c.categoryName AS ledger_category, b.desc_l IS NOT NULL AS has_item,
         b.ledgerCode AS m_code, b.itemName AS m_item, b.expectedUnitPrice AS m_expected
  FROM silver_lines l
  LEFT JOIN (SELECT lower(categoryName) AS cat_l, min(categoryName) AS categoryName
             FROM ledger_categories GROUP BY 1) c ON c.cat_l = lower(l.categoryName)
  LEFT JOIN j7_best b ON b.cat_l = lower(l.categoryName) AND b.desc_l = lower(coalesce(l.description, ''))),
j8_descs AS (SELECT DISTINCT lower(coalesce(description, '')) AS t FROM silver_lines),
j8_vends AS (SELECT DISTINCT lower(coalesce(vendorName, '')) AS t FROM silver_lines),
{_best("j8_dc", 1, "j8_descs", "j8_db").strip()},
{_best("j8_vc", 2, "j8_vends", "j8_vb").strip()},
j8 AS (
  SELECT l.*, (db.t IS NOT NULL OR vb.t IS NOT NULL) AS has_item,
         CASE WHEN db.t IS NOT NULL THEN db.ledgerCode ELSE vb.ledgerCode END AS m_code,
         CASE WHEN db.t IS NOT NULL THEN db.itemName ELSE vb.itemName END AS m_item,
         CASE WHEN db.t IS NOT NULL THEN db.expectedUnitPrice ELSE vb.expectedUnitPrice END AS m_expected,
         CASE WHEN db.t IS NOT NULL THEN db.match_rank WHEN vb.t IS NOT NULL THEN 2 END AS m_rank
  FROM silver_lines l
  LEFT JOIN j8_db db ON db.t = lower(coalesce(l.description, ''))
  LEFT JOIN j8_vb vb ON vb.t = lower(coalesce(l.vendorName, ''))),
{_a7_sql('a7', K.SHIPPED_RULES)},
{_a8_sql('a8', K.SHIPPED_RULES)},
{_a7_sql('a7_changed', K.CHANGED_RULES)},
{_a8_sql('a8_changed', K.CHANGED_RULES)},
g13 AS (
  SELECT invoiceId,
         count(*) FILTER (WHERE status = 'matched') AS matched,
         count(*) FILTER (WHERE status = 'review') AS review,
         count(*) FILTER (WHERE status = 'exception') AS exception,
         count(*) AS totalProcessed,
         min(vendorName) AS vendorName
  FROM a8 GROUP BY invoiceId),
u3 AS (
  SELECT * FROM a7 WHERE status IN ('matched', 'review')
  UNION ALL
  SELECT * FROM a7 WHERE status = 'exception'),
last_document AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY invoiceId ORDER BY run_id DESC, source_path DESC, fileName DESC) AS rn
                 FROM bronze_header) WHERE rn = 1),
inv_ccy AS (
  SELECT invoiceId, coalesce(nullif(invoiceCurrency, ''), nullif(currency, '')) AS invoice_currency FROM last_document),
fx_lookup AS (
  SELECT s.invoiceId, s.currency, s.invoiceDate, s.totalAmount,
         {_found_rate("s.invoiceDate")} AS found_rate, {_found_rate("s.dueDate")} AS due_rate, s.dueDate
  FROM silver_invoice s)
"""

_AUD = "upper(currency) = 'AUD'"

RULE_SELECTS: dict[str, str] = {
    "classify_lines_shipped_rules": "SELECT * FROM a8",
    "classify_lines_changed_rules": "SELECT * FROM a8_changed",
    "classify_aud_changed_rules": "SELECT * FROM a7_changed",
    "fx_rate_lookup": "SELECT invoiceId, currency, invoiceDate, CAST(found_rate AS DOUBLE) AS rate FROM fx_lookup",
    "fx_convert": (
        f"SELECT invoiceId, currency, invoiceDate, totalAmount, "
        f"CAST(CASE WHEN {_AUD} THEN CAST(1 AS DECIMAL(18,6)) ELSE found_rate END AS DOUBLE) AS rate, "
        f"{converted('totalAmount', 'currency', 'found_rate')} AS aud_amount FROM fx_lookup"),
    "fx_convert_unit_price": (
        "WITH p AS (SELECT *, " + _r("totalAmount / 7", 4) + " AS price FROM fx_lookup) "
        f"SELECT invoiceId, currency, price, {converted('price', 'currency', 'due_rate')} AS aud_price FROM p"),
    "fx_convert_first_rate": (
        "WITH fr AS (SELECT upper(\"from\") AS ccy, arg_min(CAST(rate AS DOUBLE), position) AS first_rate "
        "FROM fx WHERE upper(\"to\") = 'AUD' GROUP BY 1) "
        "SELECT s.invoiceId, s.currency, s.totalAmount, "
        "CASE WHEN s.currency IS NULL THEN NULL WHEN upper(s.currency) = 'AUD' THEN s.totalAmount "
        "ELSE floor(s.totalAmount * fr.first_rate * 100 + 0.5) / 100 END AS aud_amount "
        "FROM silver_invoice s LEFT JOIN fr ON fr.ccy = upper(s.currency)"),
    "ledger_aliases": "SELECT categoryName, ledgerCode, itemName, unnest(aliases) AS alias FROM ledger_items",
    "ledger_match_category": (
        "SELECT invoiceId, lineNo, categoryName, description, ledger_category, m_code AS ledgerCode, "
        "m_item AS itemName FROM j7"),
    "ledger_match_global": (
        "SELECT invoiceId, lineNo, description, vendorName, m_code AS ledgerCode, m_item AS itemName, "
        "m_rank AS match_rank FROM j8"),
    "classify_lines_aud": "SELECT * FROM a7",
    "classify_lines_category": "SELECT * FROM a8",
    "match_outcome_summary": "SELECT invoiceId, matched, review, exception, totalProcessed FROM g13",
    "processing_notes": (
        "SELECT invoiceId, 0 AS section, CAST(NULL AS VARCHAR) AS lineItemId, "
        "'Processed ' || CAST(totalProcessed AS VARCHAR) || ' line item(s) for invoice ' || invoiceId "
        "|| ' (' || coalesce(vendorName, 'null') || ').' AS note FROM g13 "
        "UNION ALL SELECT invoiceId, 1, NULL, CAST(matched AS VARCHAR) || ' matched, ' || CAST(review AS VARCHAR) "
        "|| ' need review, ' || CAST(exception AS VARCHAR) || ' exception(s).' FROM g13 "
        "UNION ALL SELECT invoiceId, 2, NULL, 'Human-in-the-loop required for:' FROM g13 WHERE review > 0 "
        "UNION ALL SELECT invoiceId, 4, NULL, 'Sent to exception queue:' FROM g13 WHERE exception > 0 "
        "UNION ALL SELECT invoiceId, CASE WHEN status = 'review' THEN 3 ELSE 5 END, lineItemId, "
        "'  • ' || coalesce(description, 'null') || ' — ' || coalesce(reason, 'null') "
        "FROM a8 WHERE status IN ('review', 'exception')"),
    "exception_queue": (
        "SELECT a.invoiceId, a.lineNo, coalesce(b.biz, a.businessName) AS vendorName, "
        "CAST(NULL AS VARCHAR) AS categoryName, a.lineItemDescription AS description, a.lineTotal, "
        "a.ruleApplied, a.kind, a.reason FROM (SELECT *, CASE WHEN status = 'exception' THEN 'exception' "
        "WHEN lower(coalesce(status, '')) = 'review' THEN 'review' END AS kind FROM a7) a "
        "LEFT JOIN (SELECT invoiceId, coalesce(nullif(businessName, ''), nullif(vendorName, '')) AS biz FROM last_document) b "
        "ON a.invoiceId = b.invoiceId WHERE a.kind IS NOT NULL"),
    "posted_lines": "SELECT * FROM u3",
    "posted_entries": (
        "SELECT coalesce(invoiceId, '') || '-' || coalesce(lineNo, '') AS entry, invoiceId, "
        "businessName AS vendor, coalesce(ledgerCode, '') AS ledgerCode, "
        "coalesce(matchedLedgerItem, lineItemDescription) AS item, convertedLineTotal AS amount, "
        f"{_money('convertedLineTotal', "coalesce(convertedCurrency, 'AUD')")} AS amount_text, "
        "coalesce(status, '') AS status FROM a7 WHERE status IN ('matched', 'review')"),
    "ledger_posting_view": (
        "WITH pl AS (SELECT trim(CAST(u.ledgerCode AS VARCHAR)) AS code, u.invoiceId, u.lineNo, "
        "u.lineItemDescription AS description, u.unitPrice, u.lineTotal, "
        "coalesce(c.invoice_currency, 'AUD') AS currency FROM u3 u LEFT JOIN inv_ccy c ON c.invoiceId = u.invoiceId "
        "WHERE u.ledgerCode IS NOT NULL) "
        "SELECT i.categoryName, i.ledgerCode, i.itemName, i.expectedUnitPrice, "
        "array_to_string(coalesce(i.aliases, []), ', ') AS aliases_text, pl.invoiceId, pl.lineNo, "
        "pl.description, pl.unitPrice, pl.lineTotal, pl.currency "
        "FROM ledger_items i LEFT JOIN pl ON pl.code = trim(CAST(i.ledgerCode AS VARCHAR))"),
    "expected_price_lookup": (
        "SELECT a.invoiceId, a.lineNo, a.ledgerCode, a.convertedUnitPrice, p.price AS ledgerExpectedUnitPrice "
        "FROM a7 a LEFT JOIN (SELECT CAST(ledgerCode AS VARCHAR) AS code, arg_max(expectedUnitPrice, item_position) AS price "
        "FROM ledger_items GROUP BY 1) p ON p.code = CAST(a.ledgerCode AS VARCHAR)"),
    "budget_position": (
        f"SELECT c.categoryName, c.approvedBudget, c.ytdBalance, {_r('c.approvedBudget - c.ytdBalance')} AS remaining, "
        "coalesce(n.items, 0) AS items FROM ledger_categories c LEFT JOIN "
        "(SELECT categoryName, count(*) AS items FROM ledger_items GROUP BY 1) n ON n.categoryName = c.categoryName"),
    "agent_json_extract": (
        "WITH x AS (SELECT event_type, NULLIF(regexp_extract(props, '(?s)\\{.*\\}', 0), '') AS j FROM events) "
        "SELECT event_type, count(*) AS events, "
        "count(CASE WHEN json_valid(j) THEN TRY_CAST(json_extract(j, '$.k') AS BIGINT) END) AS parsed, "
        "sum(CASE WHEN json_valid(j) THEN TRY_CAST(json_extract(j, '$.k') AS BIGINT) END) AS sum_k "
        "FROM x GROUP BY event_type"),
    "event_overlay": (
        f"WITH d AS (SELECT {RUN_OF_EVENT} AS run_id, ts, event_id, props FROM events e WHERE json_valid(props)), "
        "n AS (SELECT run_id, ts, event_id, unnest(json_keys(props)) AS node, props FROM d), "
        "v AS (SELECT run_id, node, CAST(json_extract(props, '$.\"' || node || '\"') AS VARCHAR) AS value, "
        "row_number() OVER (PARTITION BY run_id, node ORDER BY ts DESC, event_id DESC) AS rn FROM n) "
        "SELECT run_id, node, value FROM v WHERE rn = 1"),
}
