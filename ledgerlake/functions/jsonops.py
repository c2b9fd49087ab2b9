"""JSON handling of agent output (P12-P16), all with built-in functions.

Agent replies are free text that should contain one JSON object.  The
object is cut out with a regular expression and parsed with ``from_json``
against an explicit schema; anything that does not parse gives null,
never a failed task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# Greedy: from the first '{' to the last '}', across newlines.
JSON_OBJECT_PATTERN = r"(?s)\{.*\}"
_PERMISSIVE = {"mode": "PERMISSIVE"}
# An object payload is either ``{"invoices": [...]}`` or one invoice.
_INVOICE_OR_FILE = T.StructType(schemas.INVOICE.fields + schemas.INVOICE_FILE.fields)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_json_text(text) -> Column:
    """The JSON object inside agent text, or null when there is none."""
    return F.nullif(F.regexp_extract(_c(text), JSON_OBJECT_PATTERN, 0), F.lit(""))


def parse_json(text, schema: T.DataType) -> Column:
    """Parse (already extracted) JSON text; invalid -> null fields."""
    return F.from_json(_c(text), schema, _PERMISSIVE)


def parse_agent_json(text, schema: T.DataType) -> Column:
    """Extract then parse."""
    return parse_json(extract_json_text(text), schema)


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def without_null_fields(json: Column) -> Column:
    """Compact JSON text without the fields whose value is null, at any depth.

    Both patterns match strings whole where nothing is to go (and put them
    back), so what stands inside a string is never taken for a field.  The
    quantifiers are possessive: a string of any length needs no recursion.
    """
    no_nulls = F.regexp_replace(json, rf"(,?){_STRING}:null(?=[,}}])|({_STRING})", "$2")
    return F.regexp_replace(no_nulls, rf"(\{{),|({_STRING})", "$1$2")


def explode_rows(df: DataFrame, array_col: str, out_col: str) -> DataFrame:
    """Inner ``explode`` of ``array_col`` without the inferred pre-filter.

    For an inner explode the optimizer infers ``size(array) > 0`` and pushes
    it below the projections, where it inlines -- and so evaluates twice --
    whatever built the array (a JSON parse, a serialisation).  An outer
    explode with its position kept, filtered on the position, gives the same
    rows (empty and null arrays yield none) and the filter stays above it.
    """
    return (df.select("*", F.posexplode_outer(array_col).alias("_pos", out_col))
            .filter(F.col("_pos").isNotNull()).drop("_pos", array_col))


def with_invoice_array(df: DataFrame, text_col: str, out_col: str = "invoices") -> DataFrame:
    """Payload text -> array of invoices.

    A JSON array is the invoice list; an object with ``invoices`` gives that
    list; an object with ``invoiceId`` is one invoice; anything else is [].
    Each payload is parsed once: arrays against the invoice-list schema,
    objects against one schema holding both the invoice fields and
    ``invoices``.  The parses land in their own projection, which the
    optimizer keeps separate because the parsed object is read twice; a
    single column expression would parse it again in each ``coalesce``
    branch."""
    t = F.col(text_col)
    first = F.substring(F.ltrim(t), 1, 1)
    parsed = df.select("*", F.when(first == "[", parse_json(t, T.ArrayType(schemas.INVOICE))).alias("_arr"),
                       F.when(first == "{", parse_json(t, _INVOICE_OR_FILE)).alias("_obj"))
    single = F.filter(F.array(F.col("_obj").dropFields("invoices")), lambda x: x["invoiceId"].isNotNull())
    empty = F.array().cast(T.ArrayType(schemas.INVOICE))
    return (parsed.withColumn(out_col, F.coalesce(F.col("_arr"), F.col("_obj.invoices"), single, empty))
            .drop("_arr", "_obj"))


def unwrap_email(text) -> Column:
    """The ``email`` member when present, else the whole object as an email."""
    t = _c(text)
    wrapped = parse_json(t, schemas.INGESTION_FILE)
    return F.coalesce(wrapped["email"], parse_json(t, schemas.EMAIL))


def merge_attachment_urls(emails: DataFrame, uploads: DataFrame, key_col: str = "run_id",
                          attachments_col: str = "attachments", order_col: str = "position") -> DataFrame:
    """Set each attachment's blobUrl from the run's uploads.

    ``uploads`` holds (key, name, blobUrl, order); of a name uploaded twice the
    last URL counts (without an order the greatest).  A known name takes the upload's URL; an unknown one keeps
    its own (null if it had none), and so does an empty one.

    Uploads are reduced to the last of each name, then to the names that the
    run's attachments have, and only those become a name -> URL map: a run's
    uploads are never gathered, however many there are.  The emails meet the
    map on the run and each attachment array is changed where it stands, so no
    row id is needed and a retried task cannot mix up emails.
    """
    asked = (emails.select(key_col, F.explode_outer(F.transform(attachments_col, lambda a: a["name"])).alias("name"))
             .filter(F.length("name") > 0).distinct())
    order = order_col if order_col in uploads.columns else "blobUrl"
    last = uploads.groupBy(key_col, "name").agg(F.max_by("blobUrl", order).alias("blobUrl"))
    urls = (last.join(asked, [key_col, "name"], "left_semi").groupBy(key_col)
            .agg(F.map_from_entries(F.collect_list(F.struct("name", "blobUrl"))).alias("_urls")))
    known = F.coalesce("_urls", F.create_map().cast("map<string,string>"))
    merged = F.transform(attachments_col, lambda a: a.withField(
        "blobUrl", F.coalesce(F.try_element_at(known, a["name"]), a["blobUrl"])))
    return emails.join(urls, key_col, "left").withColumn(attachments_col, merged).drop("_urls")


def overlay_nodes(docs: DataFrame, key_col: str, order_cols: list[str], json_col: str) -> DataFrame:
    """Per key, later top-level JSON nodes replace earlier ones.

    ``docs`` has one JSON object per row; ``order_cols`` give the write
    order (e.g. stage rank, time).  Returns (key, node, value) in long form,
    ``value`` the JSON text of the winning node; texts that are no JSON
    object add nothing.  Each (key, node) is reduced with ``max_by``
    (partial aggregation, skew-safe).
    """
    # variants keep each node as it is: nothing is lost to a fixed schema.  The
    # outer explode is filtered on the position: an inner one would parse the
    # JSON again in its inferred size filter
    parsed = F.from_json(F.col(json_col), "map<string,variant>", _PERMISSIVE)
    nodes = (docs.select(key_col, *order_cols, F.posexplode_outer(parsed).alias("_pos", "node", "_value"))
             .filter(F.col("_pos").isNotNull())
             .select(key_col, *order_cols, "node", F.coalesce(F.to_json("_value"), F.lit("null")).alias("value")))
    order = F.struct(*[F.col(c) for c in order_cols])
    return nodes.groupBy(key_col, "node").agg(F.max_by("value", order).alias("value"))


def overlay_documents(nodes: DataFrame, key_col: str) -> DataFrame:
    """One document per key, rebuilt from :func:`overlay_nodes` with its
    nodes in the order of their names (a document has few top-level nodes)."""
    member = F.concat(F.expr("substring(to_json(array(node)), 2, length(to_json(array(node))) - 2)"), F.lit(":"), "value")
    members = F.array_sort(F.collect_list(F.struct("node", member.alias("text"))))
    return (nodes.groupBy(key_col).agg(members.alias("_members"))
            .select(key_col, F.concat(F.lit("{"), F.array_join(F.transform("_members", lambda m: m["text"]), ","),
                                      F.lit("}")).alias("document")))


def result_overlay(base: DataFrame, updates: DataFrame, key_col: str, file_col: str, order_cols: list[str],
                   json_col: str) -> DataFrame:
    """P16 as the app writes result.json: a run's base is its result.json if
    it has one, else its ingestion.json; the updates' nodes go on top in
    their order.  Returns (key, node, value)."""
    rank = F.when(F.col(file_col) == "result.json", 1).when(F.col(file_col) == "ingestion.json", 0)
    chosen = (base.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
              .groupBy(key_col).agg(F.max_by(F.col(json_col), F.col("_rank")).alias(json_col)))
    first = chosen.select(key_col, F.lit(0).alias("_late"), *[F.lit(None).cast(updates.schema[c].dataType).alias(c)
                                                             for c in order_cols], json_col)
    later = updates.select(key_col, F.lit(1).alias("_late"), *order_cols, json_col)
    return overlay_nodes(first.unionByName(later), key_col, ["_late", *order_cols], json_col)
