"""SimHash near-duplicates by the generalised pigeonhole principle.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a text's
shingles are its runs of ``shingle`` words joined by one space, repeats
included (the whole sequence if it has fewer words).  A fingerprint bit is set
if it is set in over half of the shingles' XXH64 (seed 42).  Texts without
words, empty and null texts have fingerprint zero and are linked like any
other.  Two fingerprints link at ``radius`` or fewer differing bits; a
component's id is the smallest doc_id in it (null only if all its doc_ids are
null).  Repeated rows share their component.

Search: correlated bits are grouped into partitions, each partition i gets a
threshold t_i (-1: not probed) with sum(t_i + 1) = radius + 1, chosen by
dynamic programming on estimated candidate counts.  Two fingerprints within
the radius then agree to t_i bits in at least one partition i, so probing
partition i's value and every value up to t_i flips away finds all pairs;
candidates are verified on all 64 bits.  A bucket with more than
``bucket_rows`` fingerprints is not paired: its members are linked through
shared *midpoints* (every fingerprint emits itself and its 1-bit neighbours;
two are within 2 bits if and only if they share one), which is linear and
exact.  Other radii flip half the bits on either side (:func:`_midpoint_edges`).

Components are found by alternating large-star and small-star rounds over
written edge tables; nothing but counts and a 64 x 64 table of bit counts
reaches the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_batches, text_key, texts_of, written

BITS = 64
#: Shingles hashed and counted at once, so that a very long text stays small.
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of one UTF-8 text (see the module docstring)."""
    words = text.lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in
                           zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """Fingerprints as signed 64-bit integers, computed per Arrow batch."""
    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in texts_of(column)], pa.int64())

    return of(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- which bits belong together ------------------------------------------------

def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have bits i and j both set, over
    all fingerprints: a table per task, added up by Spark."""
    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            x = np.unpackbits(fps.view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
            total += x.T @ x
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j].astype(np.int64))],
            names=["i", "j", "n"])

    rows = (nodes.select("fp").mapInArrow(table, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # at most 2080 rows
    both = np.zeros((BITS, BITS))
    for r in rows:
        both[r.i, r.j] = both[r.j, r.i] = r.n
    return nodes.count(), both


def correlated_partitions(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width: a chain that always
    goes on to the unused bit most correlated with the group so far."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    alike = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    unused, groups = list(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - k)
        group = [max(unused, key=lambda b: (spread[b], -b))]
        unused.remove(group[0])
        while len(group) < width:
            best = max(unused, key=lambda b: (alike[b, group].mean(), -b))
            group.append(best)
            unused.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def balls(bits: list[int], radius: int) -> list[int]:
    """Masks of every set of at most ``radius`` of the bits."""
    return [_mask(list(c)) for r in range(radius + 1) for c in itertools.combinations(bits, r)]


def estimated_candidates(n: int, both: np.ndarray, bits: list[int], equal_pairs: float, radius: int) -> list[float]:
    """Estimated pairs at partition distance <= e, for e = 0..radius: the
    counted pairs with equal values plus, for the distances 1..e, what
    independent bits would give."""
    p = np.diag(both) / max(n, 1)
    dist = np.zeros(radius + 1)
    dist[0] = 1.0
    for b in bits:
        differ = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - differ) + dist[:-1] * differ
        dist[0] *= 1 - differ
    return [equal_pairs + n * n / 2 * dist[1:e + 1].sum() for e in range(radius + 1)]


def thresholds(costs: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Per-partition thresholds with sum(t + 1) = radius + 1 of least cost, by
    dynamic programming; ``costs[i][t]`` is the cost of threshold t, not
    probing costs nothing."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, radius - spent + 1):
                total = cost + (row[t] if t >= 0 else 0.0)
                at = spent + t + 1
                if at not in step or total < step[at][0]:
                    step[at] = (total, [*chosen, t])
        best = step
    return best[radius + 1]


def plan_search(nodes: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to probe: of 1 to radius + 1
    partitions, the number and thresholds with the least estimated work."""
    n, both = bit_counts(nodes)
    layouts = {m: correlated_partitions(n, both, m) for m in range(1, radius + 2)}
    named = [(m, i, bits) for m, groups in layouts.items() for i, bits in enumerate(groups) if len(bits) < BITS]
    equal: dict[tuple[int, int], float] = {}
    if named:
        values = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                                    F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v")) for m, i, bits in named])
        rows = (nodes.select(F.explode(values).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("c"))
                .groupBy("x.m", "x.i").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("p")).collect())
        equal = {(r.m, r.i): r.p for r in rows}
    options = []
    for m, groups in layouts.items():
        costs = []
        for i, bits in enumerate(groups):
            found = estimated_candidates(n, both, bits, equal.get((m, i), 0.0), radius)
            costs.append([found[t] + 3.0 * n * len(balls(bits, t)) for t in range(radius + 1)])
        cost, chosen = thresholds(costs, radius)
        options.append((cost, [(bits, t) for bits, t in zip(groups, chosen) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


# --- links ----------------------------------------------------------------------

def _probe_rows(nodes: DataFrame, plan: list[tuple[list[int], int]], reach: bool) -> DataFrame:
    keys = [F.struct(F.lit(i).alias("part"),
                     F.col("fp").bitwiseAND(F.lit(_mask(bits))).bitwiseXOR(F.lit(flip)).alias("value"))
            for i, (bits, t) in enumerate(plan) for flip in balls(bits, t if reach else 0)]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.part", "k.value")


def _midpoint_edges(dense: DataFrame, radius: int) -> DataFrame:
    """Links among ``dense`` fingerprints (column fp): each emits every value
    within half the radius of it, and two within ``radius`` share one.  With
    an even radius sharing proves the link, so the least member of a value's
    group stands for it; an odd radius flips one bit more on one side."""
    half = radius // 2
    flips = F.array(*[F.lit(f) for f in balls(list(range(BITS)), half)])
    reach = dense.select("fp", F.explode(flips).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("mid"))
    least = reach.groupBy("mid").agg(F.min("fp").alias("least"))  # at most as many fingerprints as flips
    edges = reach.join(least, "mid").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    if radius % 2:
        far = F.array(*[F.lit(f) for f in balls(list(range(BITS)), half + 1)])
        wide = dense.select("fp", F.explode(far).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("mid"))
        edges = edges.unionByName(wide.join(least, "mid").where("fp <> least")
                                  .select(F.col("fp").alias("a"), F.col("least").alias("b")))
    return edges.distinct()


def links(nodes: DataFrame, radius: int, bucket_rows: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what
    pairs at ``radius`` or fewer bits connect."""
    plan = plan_search(nodes, radius)
    index = _probe_rows(nodes, plan, reach=False)
    counts = index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("held"))
    reach = max(t for _, t in plan)
    # a bucket with one member can only be met by a flipped probe
    counts = counts.where(f"held > {0 if reach else 1}")
    sized = written(_probe_rows(nodes, plan, reach=True).join(counts, ["part", "value"]), "simhash-probes")
    held = sized if not reach else index.join(counts, ["part", "value"])
    # without flips either end of a pair probes, so one order is enough
    ordered = F.col("x.fp") != F.col("y.fp") if reach else F.col("x.fp") < F.col("y.fp")
    near = (sized.where(f"held <= {bucket_rows}").alias("x")
            .join(held.where(f"held <= {bucket_rows}").alias("y"),
                  (F.col("x.part") == F.col("y.part")) & (F.col("x.value") == F.col("y.value")) & ordered)
            .where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius)
            .select(F.greatest("x.fp", "y.fp").alias("a"), F.least("x.fp", "y.fp").alias("b")))
    dense = sized.where(f"held > {bucket_rows}").select("fp")
    if reach:
        dense = dense.unionByName(held.where(f"held > {bucket_rows}").select("fp"))
    return near.unionByName(_midpoint_edges(dense.distinct(), radius)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the least node of each connected component, for every node
    that is not its own root.  ``edges`` holds a > b or a < b, never a = b."""
    stars = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return stars.withColumnRenamed("v", "root")
        state = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that AQE can split the join at a hub: it splits only plain shuffles
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars")


# --- operator ---------------------------------------------------------------------

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_id, fp) of every row, written: 40 bytes a document stand
    for its text in all that follows."""
    document_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    return written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_key(text).alias("text_id"),
                               fingerprint_column(text, shingle).alias("fp")), "fingerprints")


def classes(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, component_id, first) per distinct fingerprint; ``first`` is the
    component's least (doc_id, text_id), null doc_ids last."""
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_id")
    nodes = written(fps.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), radius))
    rooted = written(nodes.join(roots, F.col("fp") == F.col("u"), "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    return rooted.drop("first").join(least, "root").select("fp", F.col("first.doc_id").alias("component_id"), "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """(doc_id, text_id, fingerprint, component_id), one row per document."""
    fps = fingerprints(docs, id_col, text_col, shingle)
    found = classes(fps, radius)
    return fps.join(found, "fp").select("doc_id", "text_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id",
                                        "first")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 2) -> DataFrame:
    """The documents, with one of each group: the one with the least doc_id
    (null last, then by text); of fully repeated rows one stays."""
    fps = fingerprints(docs, id_col, text_col, shingle)
    firsts = classes(fps, radius).select("first.doc_id", "first.text_id").distinct()
    rows_of = fps.groupBy("doc_id", "text_id").agg(F.count(F.lit(1)).alias("copies"))
    kept = written(rows_of.alias("r").join(firsts.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id"))
                                           & (F.col("r.text_id") == F.col("f.text_id")), "left_semi"), "kept")
    key = text_key(F.col(f"d.`{text_col}`").cast("string"))

    def rows(of: DataFrame) -> DataFrame:
        k = of.alias("k")
        return docs.alias("d").join(k, F.col(f"d.`{id_col}`").eqNullSafe(F.col("k.doc_id"))
                                    & (key == F.col("k.text_id")), "left_semi")

    once = rows(kept.where("copies = 1"))
    if kept.where("copies > 1").isEmpty():
        return once
    return once.unionByName(rows(kept.where("copies > 1")).dropDuplicates([id_col, text_col]))
