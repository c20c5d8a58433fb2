"""SimHash near-dedup by the generalised pigeonhole principle.

A document's fingerprint is the bitwise majority of its shingles' XXH64 hashes.  Two fingerprints that differ in at most
``distance`` bits differ, in some partition i of the bits, in at most t_i bits, as long as the t_i add up to distance - m + 1 over m
partitions.  Correlated bits are put into the same partition, so that the partitions are as independent of each other
as can be; then m and the unequal thresholds t_i (-1: the partition isn't probed) are chosen by dynamic programming on the number of candidates and probes that
a histogram of each partition's values lets expect.  Each distinct fingerprint enters each partition's index by its value there
and probes it by the values within t_i bits; every pair that meets is verified on all bits.

Copies share a fingerprint and enter once.  A task that verifies a stretch of the index returns not its pairs but a forest
that connects the same fingerprints, so a group of n near copies costs n rows.  An index value that very many
fingerprints share is split into blocks, each pair of blocks a unit of work of its own.

Defined cases: a null text is empty; texts without words have fingerprint zero and are linked like any other; shorter
texts than a shingle are one shingle; repeated rows and ids link to each other; null ids take no part in the choice of
a component's id (a component of null ids alone has a null id); an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import components, give_back, join_unique, read, slices, stage

WORDS, DISTANCE, SEED, BITS = 3, 3, 42, 64
#: Fingerprints whose bits and histograms guide the partitions; the choice changes the cost, never the result.
PLAN_ROWS = 4_000
#: A value of a partition shared by more than BLOCK rows is split into blocks of about that many.
BLOCK = 8_192


def fingerprint(text: str, words: int = WORDS) -> int:
    data = text.encode("utf-8", "surrogatepass").lower().split()
    if not data:
        return 0
    if len(data) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(data), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), SEED) for s in zip(*[data[i:] for i in range(words)])]  # noqa: B905
    return majority(np.array(hashes, dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are those that over half of the hashes have; of no hashes zero."""
    counts, n = np.zeros(BITS, dtype=np.int64), len(hashes)
    for i in range(0, n, 1 << 15):
        some = hashes[i : i + (1 << 15)].astype(">u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``(id, fp)`` for each row, the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])
        give_back()

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def group_bits(sample: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the bits of near-equal size; each grows by the bit most correlated with those it has."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    z = bits - bits.mean(axis=0)
    sd = np.sqrt((z**2).mean(axis=0))
    tied = np.abs((z.T @ z) / max(1, len(sample)) / np.maximum(np.outer(sd, sd), 1e-12))
    free, parts = set(range(BITS)), []
    for i in range(m):
        part = [max(sorted(free), key=lambda b: tied[b, sorted(free)].sum())]
        free -= set(part)
        while len(part) < (BITS * (i + 1)) // m - (BITS * i) // m:
            part.append(max(sorted(free), key=lambda b: tied[b, part].sum()))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def masks_within(part: list[int], t: int) -> list[int]:
    """Bit masks of all flips of 0 to t bits of a partition, none for t = -1."""
    return [sum(1 << b for b in some) for r in range(t + 1) for some in combinations(part, r)]


def expected_pairs(sample: np.ndarray, part: list[int], t: int, total: int) -> float:
    """Candidate pairs that a partition with threshold t brings, from the sample's histogram of its values."""
    if t < 0 or not len(sample):
        return 0.0
    own = sample & np.uint64(sum(1 << b for b in part))
    values, n = np.unique(own, return_counts=True)
    meets = 0.0
    for flip in masks_within(part, t):
        other = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        hit = values[at] == other
        meets += float((n * n[at])[hit].sum()) - (len(sample) if flip == 0 else 0)
    # Values too rare to meet in the sample still meet at chance in the whole.
    meets = max(meets, len(masks_within(part, t)) * len(sample) ** 2 / 2.0 ** len(part))
    return meets / 2 * (total / len(sample)) ** 2


#: Cost of a row sent to the index, against one pair verified there.
ROW_COST = 40.0


def allocate(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds t_i with sum(t_i + 1) = budget of the least total cost, by dynamic programming over partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t, extra in cost.items():
                if used + t + 1 <= budget and c + extra < after.get(used + t + 1, (np.inf,))[0]:
                    after[used + t + 1] = (c + extra, [*ts, t])
        best = after
    return best.get(budget, (np.inf, []))


def plan(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, for the number of partitions that is cheapest."""
    found = []
    for m in range(1, distance + 3):
        parts = group_bits(sample, m)
        costs = []
        for part in parts:
            costs.append({-1: 0.0})
            for t in range(distance + 1):
                probes = sum(comb(len(part), r) for r in range(t + 1))
                if probes <= 600:
                    costs[-1][t] = expected_pairs(sample, part, t, total) + ROW_COST * total * (probes + (t > 0))
        # Differences d_i with sum d_i <= distance cannot all exceed t_i once sum(t_i + 1) = distance + 1.
        cost, ts = allocate(costs, distance + 1)
        found.append((cost, m, [(p, t) for p, t in zip(parts, ts, strict=False) if t >= 0]))
    return min(found)[2]


def flat_minimum(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest connected index for each of n nodes under the edges a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        on = root[a] != root[b]
        a, b = a[on], b[on]
    return root


def forest(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, smaller fingerprint) that connect whatever rows of equal key differ in few bits."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    nodes, at = np.unique(fps, return_inverse=True)
    root = np.arange(len(nodes))
    live, step = np.arange(len(keys)), 1
    while True:
        live = live[live + step < len(keys)]
        live = live[keys[live] == keys[live + step]]
        if not len(live):
            break
        a, b = at[live], at[live + step]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
        close = np.bitwise_count(nodes[a] ^ nodes[b]) <= distance
        if close.any():
            root = flat_minimum(np.concatenate([a[close], np.arange(len(nodes))]), np.concatenate([b[close], root]), len(nodes))
        step += 1
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(a, b)`` edges of a forest over the distinct fingerprints ``fp`` that links all within the distance."""
    total = distinct.count()
    if not total:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    some = [r[0] for r in distinct.orderBy(F.xxhash64("fp", F.lit(7))).limit(PLAN_ROWS).select("fp").collect()]
    chosen = plan(np.array(some, dtype=np.int64).view(np.uint64), max(1, total), distance)
    keyed = []
    for i, (part, t) in enumerate(chosen):
        mask = sum(1 << b for b in part)
        flips = masks_within(part, t)
        own = F.col("fp").bitwiseAND(F.lit(int(np.uint64(mask).view(np.int64))))
        # One of two sides probes: flips of the value reach the other's own entry.
        flipped = F.explode(F.array(*[F.lit(int(np.uint64(x).view(np.int64))) for x in flips]))
        keyed.append(distinct.select("fp", own.alias("v"), flipped.alias("x")).select(F.lit(i).alias("i"), F.col("v").bitwiseXOR(F.col("x")).alias("v"), "fp"))
    index = keyed[0]
    for k in keyed[1:]:
        index = index.unionByName(k)
    # Split what many share.  A value over BLOCK rows is one of at most rows / BLOCK.
    many = stage(index.groupBy("i", "v").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "shared")
    rows = index.select(F.xxhash64("i", "v").alias("key"), "fp")
    if many.head(1):
        split = many.select(F.xxhash64("i", "v").alias("key"), F.expr(f"cast(n div {BLOCK} + 1 as int)").alias("blocks"))
        met = index.select(F.xxhash64("i", "v").alias("key"), "fp").join(split, "key", "left")
        mine = F.expr("cast(pmod(xxhash64(fp), blocks) as int)")
        pairs = F.expr("transform(sequence(0, blocks - 1), o -> xxhash64(key, least(o, mine), greatest(o, mine)))")
        alone = met.where("blocks is null").select("key", "fp")
        rows = alone.unionByName(met.where("blocks is not null").withColumn("mine", mine).select(F.explode(pairs).alias("key"), "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def done(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = forest(keys, fps.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= 1 << 17:
                keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = int(np.searchsorted(keys, keys[-1]))  # sorted: the last key may go on
                if whole:
                    yield done(keys[:whole], fps[:whole])
                    held, size = [(keys[whole:], fps[whole:])], len(keys) - whole
        if size:
            yield done(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        give_back()

    return stage(rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long"), "links")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``(id, fp, component_id)`` for each row."""
    rows = stage(fingerprints(docs, id_col, text_col, words), "simhash")
    total = rows.count()
    distinct = stage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    found = components(links(distinct.select("fp"), distance))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stage(named, "named")
    low = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = stage(named.join(low, "root").select("fp", "component_id", "n"), "lookup")
    return join_unique(rows, lookup, "fp", F.col("n"), total).drop("n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_dedup": query}
ORACLE: dict[str, str] = {}
