"""Ledger reference data and line-to-ledger matching.

Matching asks "does text A contain text B" for every line description
against every ledger item name and alias.  Written naively that is a
nested-loop (cross) join.  Here it is an exact equi-join instead, over
*distinct* texts only:

* equal terms are collapsed first (for a term the winner is always the item
  first in ledger order, whatever the text), so each term is matched once;
* every text is cut into its windows of each length that a term has, which
  travel as hashes with a text id, not with the text;
* windows meet the terms whose hash they have, so the candidates are the
  pairs themselves; they get their texts back by id and are verified with
  ``contains``.

A text contains a term only if one of its windows is the term, so no pair is
missed and none is invented.  A prefix that all terms share keys nothing.  A
text of n characters has at most n windows for each length of a term: terms
have few lengths, however many they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas


# --- reference data -----------------------------------------------------------

def read_ledger_json(spark, path: str, multiline: bool = True) -> DataFrame:
    """The nested ledger, one row per document: a file, or with
    ``multiline`` off each line of it."""
    return spark.read.schema(schemas.LEDGER_FILE).option("multiLine", str(multiline).lower()).json(path)


def read_rules_json(spark, path: str) -> DataFrame:
    """The rules file, one row per rule."""
    raw = spark.read.schema(schemas.RULES_FILE).option("multiLine", "true").json(path)
    return raw.select(F.inline("rules"))


def flatten_ledger(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested ledger -> (items, categories).

    Items carry ``item_position`` = (category index, item index), the ledger
    order the browser's first-match rule walks.
    """
    cats = ledger.select("currency", F.posexplode("categories").alias("cat_idx", "cat"))
    categories = cats.select(
        F.col("cat.categoryName").alias("categoryName"),
        F.col("cat.approvedBudget").alias("approvedBudget"),
        F.col("cat.ytdBalance").alias("ytdBalance"),
        "cat_idx")
    items = (cats.select("cat_idx", F.col("cat.categoryName").alias("categoryName"),
                         F.posexplode("cat.items").alias("item_idx", "item"))
             .select("categoryName",
                     F.col("item.ledgerCode").alias("ledgerCode"),
                     F.col("item.itemName").alias("itemName"),
                     F.col("item.expectedUnitPrice").alias("expectedUnitPrice"),
                     F.col("item.aliases").alias("aliases"),
                     F.struct("cat_idx", "item_idx").alias("item_position")))
    return items, categories


def ledger_aliases(items: DataFrame) -> DataFrame:
    """One row per (item, alias); items without aliases keep a null row."""
    return items.select("categoryName", "ledgerCode", "itemName",
                        F.explode_outer("aliases").alias("alias"))


ITEM_FIELDS = ("ledgerCode", "itemName", "expectedUnitPrice", "categoryName", "item_position")


def ledger_terms(items: DataFrame, by_category: bool = False) -> DataFrame:
    """Item names and aliases as lower-case match terms, one row per distinct
    term (per category, if asked) with ``item``: the first item, in ledger
    order, that has it."""
    names = F.array(F.col("itemName"))
    aliases = F.coalesce(F.col("aliases"), F.array().cast("array<string>"))
    terms = (items.select(F.lower("categoryName").alias("_cat_l"), F.struct(*ITEM_FIELDS).alias("item"),
                          F.explode(F.concat(names, aliases)).alias("term"))
             .withColumn("term_l", F.lower("term")).filter(F.length("term_l") > 0))
    keys = ["_cat_l", "term_l"] if by_category else ["term_l"]
    return terms.groupBy(*keys).agg(F.min_by("item", "item.item_position").alias("item"))


# --- exact substring containment as an equi-join --------------------------------

def _inside(hay: F.Column, needle: F.Column, word_boundary: bool) -> F.Column:
    if not word_boundary:
        return F.contains(hay, needle)
    edge = r"[\p{L}\p{N}]"
    quoted = F.concat(F.lit(rf"(?<!{edge})\Q"), F.replace(needle, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(rf"\E(?!{edge})"))
    return F.rlike(hay, quoted)


def contains_pairs(hay: DataFrame, hay_col: str, needles: DataFrame, needle_col: str,
                   keys: tuple[str, ...] = (), word_boundary: bool = False) -> DataFrame:
    """Distinct pairs (keys, hay_col, needle_col) where the hay text contains
    the needle text.

    Both text columns must already be normalised (e.g. lower-cased); null
    and empty texts match nothing.  Extra equality ``keys`` (non-null, on
    both sides) narrow the match, e.g. the category.  ``word_boundary``
    asks that the needle begins and ends at the edge of a word.
    """
    candidates, hays = candidate_pairs(hay, hay_col, needles, needle_col, keys)
    return (candidates.join(hays, [*keys, "_id"])
            .filter(_inside(F.col(hay_col), F.col(needle_col), word_boundary)).select(*keys, hay_col, needle_col))


def candidate_pairs(hay: DataFrame, hay_col: str, needles: DataFrame, needle_col: str,
                    keys: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(pairs of text id and needle where a window of the text has the
    needle's length and hash, the distinct texts with their ids)."""
    ks, text = list(keys), F.col(hay_col)
    text_id = F.struct(F.xxhash64(hay_col).alias("a"), F.xxhash64(F.lit(7), hay_col).alias("b"))
    hays = hay.select(*ks, hay_col).filter(F.length(hay_col) > 0).distinct().withColumn("_id", text_id)
    wanted = needles.select(*ks, needle_col).filter(F.length(needle_col) > 0).distinct()
    lengths = wanted.agg(F.collect_set(F.length(needle_col))).scalar()
    fitting = hays.select(*ks, "_id", hay_col, F.explode_outer(lengths).alias("_n")).filter(F.length(text) >= F.col("_n"))
    hashes = F.transform(F.sequence(F.lit(1), F.length(text) - F.col("_n") + 1), lambda i: F.xxhash64(F.substring(text, i, F.col("_n"))))
    windows = fitting.select(*ks, "_id", "_n", F.explode_outer(F.array_distinct(hashes)).alias("_window"))
    hashed = wanted.select(*ks, needle_col, F.length(needle_col).alias("_n"), F.xxhash64(needle_col).alias("_window"))
    return windows.join(hashed, [*ks, "_n", "_window"]).select(*ks, "_id", needle_col), hays


# --- J7: category-scoped first match (browser workflow) ---------------------------

def _texts(lines: DataFrame, category_col: str, description_col: str, vendor_col: str) -> DataFrame:
    return lines.select("*", *[F.lower(F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in
                               ((category_col, "_cat_l"), (description_col, "_desc_l"), (vendor_col, "_vend_l")) if c])


def category_lookup(lines: DataFrame, items: DataFrame, categories: DataFrame,
                    category_col: str = "categoryName", description_col: str = "description") -> DataFrame:
    """J7 per distinct (category, description): (_cat_l, _desc_l,
    ledger_category, ledger_item)."""
    texts = _texts(lines, category_col, description_col, "").select("_cat_l", "_desc_l").distinct()
    terms = ledger_terms(items, by_category=True)
    pairs = contains_pairs(texts, "_desc_l", terms, "term_l", keys=("_cat_l",))
    best = (pairs.join(terms, ["_cat_l", "term_l"]).groupBy("_cat_l", "_desc_l")
            .agg(F.min_by("item", "item.item_position").alias("ledger_item")))
    cats = (categories.groupBy(F.lower("categoryName").alias("_cat_l"))
            .agg(F.min("categoryName").alias("ledger_category")))
    return texts.join(cats, "_cat_l", "left").join(best, ["_cat_l", "_desc_l"], "left")


def match_in_category(lines: DataFrame, items: DataFrame, categories: DataFrame,
                      category_col: str = "categoryName", description_col: str = "description",
                      lookup: DataFrame | None = None) -> DataFrame:
    """Per line, the ledger category (ignoring case) and the first item
    of that category -- in ledger order -- whose name or an alias equals or
    is contained in the description (ignoring case).

    Adds ``ledger_category`` (null when the category is unknown) and
    ``ledger_item`` (struct of ITEM_FIELDS, null when nothing matches).
    ``lookup`` is :func:`category_lookup` as a written table, whose size the
    planner then knows.
    """
    if lookup is None:
        lookup = category_lookup(lines, items, categories, category_col, description_col)
    keyed = _texts(lines, category_col, description_col, "")
    return keyed.join(lookup, ["_cat_l", "_desc_l"], "left").drop("_cat_l", "_desc_l")


# --- J8: global ranked match on description, then vendor -------------------------

def _best_by_text(texts: DataFrame, text_col: str, terms: DataFrame, rank_contains: int, word_boundary: bool) -> DataFrame:
    """Best item per distinct text: equality (rank 0), containment either
    way (rank ``rank_contains``), longer matched text first, then ledger order."""
    forth = contains_pairs(texts, text_col, terms, "term_l", word_boundary=word_boundary)
    back = contains_pairs(terms, "term_l", texts, text_col, word_boundary=word_boundary)
    pairs = (forth.select(text_col, "term_l", F.length("term_l").alias("_overlap"))
             .unionByName(back.select(text_col, "term_l", F.length(text_col).alias("_overlap")))
             .join(terms, "term_l"))
    rank = F.when(F.col(text_col) == F.col("term_l"), F.lit(0)).otherwise(F.lit(rank_contains))
    key = F.struct(rank.alias("rank"), (-F.col("_overlap")).alias("neg_overlap"), F.col("item.item_position").alias("at"))
    item = F.struct(*[F.col(f"item.{f}").alias(f) for f in ITEM_FIELDS], rank.alias("match_rank"))
    return pairs.groupBy(text_col).agg(F.min_by(item, key).alias("_best"))


def description_lookup(lines: DataFrame, items: DataFrame, description_col: str = "description",
                       word_boundary: bool = False) -> DataFrame:
    """J8 on descriptions: (_desc_l, _by_desc) per distinct description, the
    item null when nothing matched."""
    texts = _texts(lines, "", description_col, "").select("_desc_l").distinct()
    best = _best_by_text(texts, "_desc_l", ledger_terms(items), 1, word_boundary)
    return texts.join(best, "_desc_l", "left").withColumnRenamed("_best", "_by_desc")


def vendor_lookup(lines: DataFrame, items: DataFrame, by_desc: DataFrame, description_col: str = "description",
                  vendor_col: str = "vendorName", word_boundary: bool = False) -> DataFrame:
    """J8 on the vendors of lines whose description matched nothing:
    (_vend_l, _by_vend), matched vendors only."""
    unmatched = by_desc.filter(F.col("_by_desc").isNull()).select("_desc_l")
    texts = (_texts(lines, "", description_col, vendor_col).join(unmatched, "_desc_l", "left_semi")
             .select("_vend_l").distinct())
    best = _best_by_text(texts, "_vend_l", ledger_terms(items), 2, word_boundary)
    return best.select("_vend_l", F.col("_best").withField("match_rank", F.lit(2)).alias("_by_vend"))


def match_global(lines: DataFrame, items: DataFrame, description_col: str = "description",
                 vendor_col: str = "vendorName", word_boundary: bool = False,
                 by_desc: DataFrame | None = None, by_vend: DataFrame | None = None) -> DataFrame:
    """Best ledger item over *all* items, category not used.

    Description first: equal to a name/alias (rank 0), else contains or is
    contained in one (rank 1, longest matched text wins).  When the
    description matches nothing, the vendor name is tried the same way
    (rank 2).  Ties go to ledger order.  ``word_boundary`` lets a text match
    only at the edges of words ("PORT" is not in "Support").  Adds
    ``ledger_item`` (struct of ITEM_FIELDS + match_rank) -- null when nothing
    matches.

    ``by_desc`` and ``by_vend`` are the two lookups as written tables: the
    planner then knows their sizes and need not shuffle the lines for them.
    """
    if by_desc is None:
        by_desc = description_lookup(lines, items, description_col, word_boundary)
    if by_vend is None:
        by_vend = vendor_lookup(lines, items, by_desc, description_col, vendor_col, word_boundary)
    return (_texts(lines, "", description_col, vendor_col)
            .join(by_desc, "_desc_l", "left")
            .join(by_vend, "_vend_l", "left")
            .withColumn("ledger_item", F.coalesce("_by_desc", "_by_vend"))
            .drop("_desc_l", "_vend_l", "_by_desc", "_by_vend"))


# --- J9, J10, G16 --------------------------------------------------------------

def posting_view(items: DataFrame, posted: DataFrame, invoice_currency: DataFrame,
                 ledger_currency: str = "AUD") -> DataFrame:
    """J9 + J12: ledger items with the lines posted to them.

    Items without lines keep one row with null line fields; lines without a
    ledger code (or with a code the ledger does not have) are dropped.
    Codes compare after trimming.  The line's currency is the invoice's
    currency (J12), else the ledger currency.

    Plan: "items left join lines" would keep the item table as the preserved
    side and shuffle the lines by code -- one hot code in one task, which
    AQE cannot split on that side.  Instead the lines meet the items in an
    inner join, and items with no line come from an anti join against the
    distinct posted codes.  Pass saved match records as ``posted``: the
    second look at them then reads one column.
    """
    it = items.select("categoryName", "ledgerCode", "itemName", "expectedUnitPrice",
                      F.array_join(F.coalesce("aliases", F.array().cast("array<string>")), ", ").alias("aliases_text"),
                      F.trim(F.col("ledgerCode").cast("string")).alias("_code"))
    coded = posted.filter(F.col("ledgerCode").isNotNull()).withColumn("_code", F.trim(F.col("ledgerCode").cast("string")))
    lines = (coded.select("_code", "invoiceId", "lineNo", F.col("lineItemDescription").alias("description"),
                          "unitPrice", "lineTotal")
             .join(invoice_currency, "invoiceId", "left")
             .withColumn("currency", F.coalesce(F.col("invoice_currency"), F.lit(ledger_currency)))
             .drop("invoice_currency"))
    with_lines = lines.join(it, "_code")
    without = (it.join(coded.select("_code").distinct(), "_code", "left_anti")
               .select(*it.columns, *[F.lit(None).cast(t).alias(c) for c, t in
                                      (("invoiceId", "string"), ("lineNo", "string"), ("description", "string"),
                                       ("unitPrice", "double"), ("lineTotal", "double"), ("currency", "string"))]))
    cols = ["categoryName", "ledgerCode", "itemName", "expectedUnitPrice", "aliases_text",
            "invoiceId", "lineNo", "description", "unitPrice", "lineTotal", "currency"]
    return with_lines.select(*cols).unionByName(without.select(*cols))


#: Documents of one invoice follow each other in this order; the last one counts.
DOCUMENT_ORDER = ("run_id", "source_path", "fileName")


def last_document(invoices: DataFrame, value: F.Column, name: str) -> DataFrame:
    """(invoiceId, ``name``): the value of each invoice's last document."""
    order = [c for c in DOCUMENT_ORDER if c in invoices.columns]
    at = F.struct(*order) if order else F.lit(0)
    return invoices.groupBy("invoiceId").agg(F.max_by(value, at).alias(name))


def filled(*names: str) -> F.Column:
    """The first of the columns that is neither null nor empty text."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names])


def invoice_currency(invoices: DataFrame) -> DataFrame:
    """J12 lookup table: invoiceId -> the first of invoiceCurrency,
    originalInvoiceCurrency and currency that is filled, from the invoice's
    last document."""
    named = [c for c in ("invoiceCurrency", "originalInvoiceCurrency", "currency") if c in invoices.columns]
    return last_document(invoices, filled(*named), "invoice_currency")


def expected_price_lookup(records: DataFrame, items: DataFrame) -> DataFrame:
    """Add the ledger's expected unit price by code (left join); of items
    with one code the last in ledger order counts."""
    prices = (items.groupBy(F.col("ledgerCode").cast("string").alias("_code"))
              .agg(F.max_by("expectedUnitPrice", "item_position").alias("ledgerExpectedUnitPrice")))
    return (records.join(prices, F.col("ledgerCode").cast("string") == F.col("_code"), "left").drop("_code"))


def budget_position(categories: DataFrame, items: DataFrame) -> DataFrame:
    """Per category -- budget, YTD, remaining and number of items."""
    counts = items.groupBy("categoryName").agg(F.count(F.lit(1)).alias("items"))
    return (categories.join(counts, "categoryName", "left")
            .select("categoryName", "approvedBudget", "ytdBalance",
                    F.round(F.col("approvedBudget") - F.col("ytdBalance"), 2).alias("remaining"),
                    F.coalesce("items", F.lit(0)).alias("items")))
