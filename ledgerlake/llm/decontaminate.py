"""Benchmark decontamination with item-sized SimHash windows, in DataFrame
functions only.

Words are runs of letters and digits, lower-cased; shingles are ``shingle``
consecutive words and weigh as often as they occur.  A document is
contaminated by an item if one of its windows of the item's length (the whole
document, if it is shorter) has a weighted shingle similarity, sum of least
over sum of greatest weights, of at least ``similarity`` with the item.

1. Windows.  Every window of an item's length, at every position, is judged
   by how many of its positions hold a shingle of the items of that length: a
   window with fewer than ``similarity`` times the item's shingles cannot
   reach the similarity.  All others are laid, wherever they start; the
   sorted positions give them as ranges of starts, without looking at one
   window after the other.
2. Fingerprints.  Each window and each item gets a 64-bit SimHash of its
   weighted shingles.  The bits are cut into ``blocks`` blocks, and items are
   indexed under every block value up to floor(radius / blocks) flips away:
   by the pigeonhole principle any pair within ``radius`` bits agrees with
   an index entry, so the equi-join on (length, block, value) finds all of
   them.
3. Fingerprints alone meet in the index.  Pairs within the radius fetch their
   shingles and are verified by the exact similarity.

Defined cases: null and empty texts have no windows and are clean; items of
fewer than ``shingle`` words (null and empty ones too) have no shingle and
match nothing; equal items each match; of repeated rows each gets its own
result rows, and so do rows with null ids.  Other columns are not looked at.

At scale: the documents are read twice and never shuffled, only the positions
of shared shingles are; shingles exist as hashes inside a task.  The second
reading cuts the laid windows out of the texts that have any.  The benchmark
is the stated query set: its
index goes to every task, in blocks of items of bounded size, each block a
pass over the documents.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, text_key, written

BITS = 64
#: Shingles of the benchmark joined at once; a larger benchmark takes more passes.
PASS_SHINGLES = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, length: int) -> Column:
    """Hashes of the shingles, by position; none if there are fewer words."""
    return F.when(F.size(words) >= length, F.transform(F.sequence(F.lit(1), F.size(words) - (length - 1)),
                                                       lambda i: F.xxhash64(F.slice(words, i, length)))
                  ).otherwise(F.expr("cast(array() as array<bigint>)"))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of hashes, each as heavy as often it occurs."""
    one = F.lit(1).cast("long")

    def bit(b: Column) -> Column:
        held = F.aggregate(hashes, F.lit(0).cast("long"),
                           lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(one))
        return F.when(2 * held > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda fp, b: fp.bitwiseOR(bit(b)))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of least over sum of greatest weights of two shingle arrays."""
    shared = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, s: n + F.least(
        F.size(F.filter(a, lambda x: x == s)), F.size(F.filter(b, lambda x: x == s))))
    return shared / (F.size(a) + F.size(b) - shared)


def block_masks(blocks: int) -> list[list[int]]:
    """Bits of the blocks, of nearly equal width."""
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [list(range(a, b)) for a, b in itertools.pairwise(edge)]


def _signed(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _items(benchmark: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    words = words_of(F.col(f"`{text_col}`"))
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), words.alias("words")).where(F.size("words") >= shingle)
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.size("words").alias("n"),
                         shingles_of(F.col("words"), shingle).alias("ih"))
    return written(items.withColumn("ifp", simhash(F.col("ih"))), "benchmark-items")


def _starts(docs: DataFrame, text_col: str, items: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(text_id, n, start): every window of ``n`` words, the length of an item,
    that shares at least ``similarity`` of an item's shingles with the items
    of that length."""
    held = items.select("n", F.explode("ih").alias("h")).distinct()
    text = F.col(f"`{text_col}`").cast("string")
    cut = docs.select(text_key(text).alias("text_id"), words_of(text).alias("w"))
    cut = cut.select("text_id", F.size("w").alias("n_doc"), shingles_of(F.col("w"), shingle).alias("dh"))
    # outer: for an inner explode Spark infers a filter on the array's size, pushes
    # it below the projections and so builds the shingles twice
    at = cut.select("text_id", "n_doc", F.posexplode_outer("dh").alias("pos", "h"))
    shared = at.join(small(held, 16), "h").groupBy("text_id", "n", "n_doc").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    need = F.greatest(F.ceil(F.lit(similarity) * (F.col("n") - (shingle - 1)) - F.lit(1e-9)), F.lit(1)).cast("int")
    reach, last = F.least("n", "n_doc") - shingle, F.greatest(F.col("n_doc") - F.col("n"), F.lit(0))

    def range_of(pos: Column, i: Column) -> Column:
        """The starts whose first shared position is ``pos`` and which reach the needed one."""
        first = F.greatest(F.get("at", i + need - 1) - reach, F.coalesce(F.get("at", i - 1) + 1, F.lit(0)), F.lit(0))
        return F.struct(first.alias("first"), F.least(pos, last).alias("last"), F.get("at", i + need - 1).alias("needed"))

    ranges = shared.select("text_id", "n", F.explode_outer(F.filter(
        F.transform("at", range_of), lambda r: r["needed"].isNotNull() & (r["first"] <= r["last"]))).alias("r"))
    ranges = ranges.where(F.col("r").isNotNull())
    return written(ranges.select("text_id", "n", F.explode(F.sequence("r.first", "r.last")).alias("start")), "window-starts")


def _windows(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(row, doc_id, text_id, n, start, n_words, wh): all windows that can reach
    the similarity; ``row`` tells repeated rows apart."""
    starts = _starts(docs, text_col, items, shingle, similarity)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       text_key(text).alias("text_id"), text.alias("text"))
    # the texts with windows are cut into shingles once, then their windows are
    held = small(starts.select("text_id").distinct(), 32)
    cut = rows.join(held, "text_id", "left_semi").select("row", "doc_id", "text_id", words_of(F.col("text")).alias("w"))
    cut = written(cut.select("row", "doc_id", "text_id", F.size("w").alias("n_doc"), shingles_of(F.col("w"), shingle).alias("dh")),
                  "texts-with-windows")
    return cut.join(small(starts, 40), "text_id").select(
        "row", "doc_id", "text_id", "n", "start", F.least("n", "n_doc").alias("n_words"),
        F.slice("dh", F.col("start") + 1, F.least("n", "n_doc") - (shingle - 1)).alias("wh"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, similarity: float = 0.8,
                 radius: int = 20, blocks: int = 7) -> DataFrame:
    """Verified windows: doc_id, text_id, item_id, start, n_words, distance,
    similarity; each window and item once per document row."""
    items = _items(benchmark, item_col, item_text_col, shingle)
    total = items.agg(F.coalesce(F.sum(F.size("ih")), F.lit(0))).first()[0]
    passes = max(1, -(-total // PASS_SHINGLES))
    masks, near = block_masks(blocks), radius // blocks
    found = []
    for i in range(passes):
        these = items if passes == 1 else items.where(F.pmod(F.xxhash64("ih"), F.lit(passes)) == i)
        flips = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(_signed(bits)).alias("mask"), F.lit(_signed(c)).alias("flip"))
                          for b, bits in enumerate(masks) for r in range(near + 1) for c in itertools.combinations(bits, r)])
        index = these.select("item", "n", "ifp", F.explode(flips).alias("x")).select(
            "item", "n", "ifp", "x.block", F.col("ifp").bitwiseAND(F.col("x.mask")).bitwiseXOR(F.col("x.flip")).alias("value"))
        probes = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(_signed(bits)).alias("mask")) for b, bits in enumerate(masks)])
        window = ["row", "n", "start"]
        windows = _windows(docs, id_col, text_col, these, shingle, similarity)
        windows = written(windows.withColumn("wfp", simhash(F.col("wh"))), "windows")
        probing = windows.select(*window, "wfp", F.explode(probes).alias("p")).select(
            *window, "wfp", "p.block", F.col("wfp").bitwiseAND(F.col("p.mask")).alias("value"))
        pairs = probing.join(index, ["n", "block", "value"])
        apart = F.col("wfp").bitwiseXOR(F.col("ifp"))
        # a pair may agree in several blocks: the first of them counts
        earlier = reduce(lambda x, y: x | y, [
            (F.col("block") > b) & (F.bit_count(apart.bitwiseAND(F.lit(_signed(bits)))) <= near) for b, bits in enumerate(masks)])
        pairs = pairs.where(~earlier).withColumn("distance", F.bit_count(apart)).where(F.col("distance") <= radius)
        pairs = written(pairs.select(*window, "item", "distance"), "near-windows")
        verified = pairs.join(windows, window).join(these.select("item", "item_id", "ih"), "item").withColumn(
            "similarity", weighted_similarity(F.col("wh"), F.col("ih")))
        found.append(verified.where(F.col("similarity") >= similarity).select(
            "doc_id", "text_id", "item_id", "start", "n_words", "distance", "similarity"))
    return reduce(DataFrame.unionByName, found)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents (all columns) in which no item was found."""
    bad = written(contaminated(docs, benchmark, text_col=text_col, **how).select("text_id").distinct(), "contaminated")
    bad = small(bad, 32)
    return docs.join(bad, text_key(F.col(f"`{text_col}`").cast("string")) == bad.text_id, "left_anti")
