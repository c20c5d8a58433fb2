"""Vector code compression by product quantisation, trained with Lloyd's rounds over cover trees.

Components become integers, vectors are cut into equal parts, and each part has a codebook of a few entries.  Vectors are
packed, where they lie, into blocks of bounded size, and each part of a block gets a cover tree: a node covers its points within a radius, its
children's centres are farther apart than theirs, and points are kept in the order of a walk through the tree, so that a node's
points are one stretch of it and *cumulative sums* give their number and sum at once.  A round sends the codebooks to the
trees.  Where the second-nearest entry of a node's centre is farther than the nearest by more than twice the radius, the triangle inequality
gives the whole subtree to the nearest entry; only ambiguous nodes descend, with the entries that are still in question, and what is
left in ambiguous leaves is compared with these exactly, in integers.  A task hands on one sum per part and entry; the codebooks, some thousand integers, are all that the driver holds.
Trees are written once to the shared folder and reread in every round, so a lost executor costs a reread.

Defined cases: vectors that are null, empty, or hold null or non-finite components are left out; so are those whose dimension isn't that of
the smallest usable id, or isn't a multiple of the number of parts (there is nothing to code them with); rows that repeat an id, or have
none, are coded each, null ids come last, and equal ids are ordered by their vectors; fewer vectors than entries make
smaller codebooks; of equally near entries the first counts; an entry without points stays; components of 2^17 and more are
refused, for their squares don't fit into 64 bits; an empty table gives no rows; columns that aren't named don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, join_unique, read, stage, unstage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block, points from which on a node is split, and the size that components stay below.
BLOCK, LEAF, LARGEST = 4096, 24, float(1 << 17)


@dataclass
class Tree:
    """A cover tree over the rows of a block's part.  ``order`` lists the points, a node's being order[low:high], its centre first."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # the first of a node's children, which follow each other
    children: np.ndarray

    def pack(self) -> bytes:
        arrays = [getattr(self, f.name) for f in fields(self)]
        return np.array([len(self.order), len(self.low)], dtype="<i8").tobytes() + b"".join(a.astype("<f8" if f.name == "radius" else "<i4").tobytes() for a, f in zip(arrays, fields(self), strict=True))

    @staticmethod
    def unpack(data: bytes) -> Tree:
        n, nodes = np.frombuffer(data, dtype="<i8", count=2)
        at, arrays = 16, []
        for f in fields(Tree):
            kind, count = ("<f8" if f.name == "radius" else "<i4"), int(n if f.name == "order" else nodes)
            arrays.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
            at += arrays[-1].nbytes
        return Tree(*arrays)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances in integers, each row of a to the rows (or the row) of b."""
    d = a - b
    return (d * d).sum(axis=-1)


def grow(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of the rows of ``x``: a node's points go to greedily chosen centres, each more than half the node's radius from
    the others, and to the first of these that covers them within it."""
    order = np.arange(len(x))
    low, high, radius, child, children = [0], [len(x)], [0.0], [0], [0]
    at = 0
    while at < len(low):
        lo, hi = low[at], high[at]
        own = order[lo:hi].copy()
        far = squares(x[own], x[own[0]])
        most = int(far.max()) if len(own) else 0
        radius[at] = float(np.sqrt(most) * (1 + 1e-9))
        if len(own) > leaf and most:
            child[at], cover, rest, start = len(low), most // 4, own, lo
            near = far <= cover
            while True:
                taken = rest[near]
                order[start : start + len(taken)] = taken
                low.append(start)
                high.append(start + len(taken))
                radius.append(0.0)
                child.append(0)
                children.append(0)
                start, rest = start + len(taken), rest[~near]
                if not len(rest):
                    break
                near = squares(x[rest], x[rest[0]]) <= cover
            children[at] = len(low) - child[at]
        at += 1
    return Tree(order, np.array(low), np.array(high), np.array(radius), np.array(child), np.array(children))


#: Stands for the distance to an entry that is out of the question.
NEVER = np.iinfo(np.int64).max


def compared(x: np.ndarray, book: np.ndarray, points: np.ndarray, open_: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Squared distances of points to the entries open to them, NEVER to the others.  ``known`` keeps what was computed (-1: not yet), for a centre is
    met again in its first child."""
    row, entry = np.nonzero(open_ & (known[points] < 0))
    known[points[row], entry] = squares(x[points[row]], book[entry])
    return np.where(open_, known[points], NEVER)


def assign(tree: Tree, x: np.ndarray, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray], int]:
    """Stretches ``(low, high, entry)`` that go to an entry whole, single points ``(place, entry)``, and how many distances it took.

    An entry farther from a node's centre than the nearest by more than twice the radius is out of the question for the whole subtree; a
    node with one entry left is assigned whole, and the others hand what is left to their children.
    """
    whole: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    places, choices = [np.zeros(0, dtype=np.int64)], [np.zeros((0, len(book)), dtype=bool)]
    active, known = np.zeros(1 if len(tree.order) else 0, dtype=np.int64), np.full((len(x), len(book)), -1)
    choice = np.ones((len(active), len(book)), dtype=bool)
    while len(active):
        d = compared(x, book, tree.order[tree.low[active]], choice, known)
        best = d.argmin(axis=1)
        root = np.where(choice, np.sqrt(d.astype(np.float64)), np.inf)
        first = root[np.arange(len(d)), best][:, None]
        # A small margin stands for the rounding of roots; a node of equal points needs none.
        choice = root - first <= 2 * tree.radius[active][:, None] + 1e-6 * (1 + first)
        sure = (choice.sum(axis=1) == 1) | (tree.radius[active] == 0)
        done = active[sure]
        whole.append((tree.low[done], tree.high[done], best[sure]))
        active, choice = active[~sure], choice[~sure]
        leaf = tree.children[active] == 0
        size = (tree.high - tree.low)[active[leaf]]
        places += [np.arange(lo, hi) for lo, hi in zip(tree.low[active[leaf]], tree.high[active[leaf]], strict=True)]
        choices.append(np.repeat(choice[leaf], size, axis=0))
        inner, n_children = active[~leaf], tree.children[active[~leaf]]
        choice = np.repeat(choice[~leaf], n_children, axis=0)
        before = np.concatenate([[0], np.cumsum(n_children)[:-1]]) if len(inner) else n_children
        active = np.repeat(tree.child[inner] - before, n_children) + np.arange(len(choice))
    at = np.concatenate(places)
    d = compared(x, book, tree.order[at], np.concatenate(choices), known)
    return whole, (at, d.argmin(axis=1)), int((known >= 0).sum())


def sums(tree: Tree, x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each entry the number of its points and, component by component, their sum."""
    out = np.zeros((len(book), 1 + x.shape[1]), dtype=np.int64)
    walk = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x[tree.order]], axis=1)
    total = np.concatenate([np.zeros((1, walk.shape[1]), dtype=np.int64), walk.cumsum(axis=0)])
    whole, (at, entry), _ = assign(tree, x, book)
    for low, high, to in whole:
        np.add.at(out, to, total[high] - total[low])
    np.add.at(out, entry, walk[at])
    return out


def codes(tree: Tree, x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entry of every row of ``x``."""
    walk = np.zeros(len(x), dtype=np.int64)
    whole, (at, entry), _ = assign(tree, x, book)
    for low, high, to in whole:
        for lo, hi, e in zip(low, high, to, strict=True):
            walk[lo:hi] = e
    walk[at] = entry
    out = np.empty_like(walk)
    out[tree.order] = walk
    return out


def whole_numbers(v: np.ndarray) -> np.ndarray:
    if len(v) and np.abs(v).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST:.0f} and more can't be coded in 64 bits")
    return np.floor(v * SCALE).astype(np.int64)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)


def blocks(rows: DataFrame, dim: int, parts: int) -> DataFrame:
    """``(ids, labels, points, trees)``: up to BLOCK vectors of a partition in each row, with the cover tree of each part."""
    kind = rows.schema["label"].dataType.simpleString()
    label_type = rows.select("label").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(label_type)), ("points", pa.binary()), ("trees", pa.list_(pa.binary()))])

    def pack(batch: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batch).combine_chunks()
        x = whole_numbers(t.column("v").combine_chunks().values.to_numpy(zero_copy_only=False)).reshape(-1, dim)
        trees = [grow(p).pack() for p in np.split(x, parts, axis=1)]
        return pa.RecordBatch.from_arrays([pa.array([t.column("id").to_pylist()], schema.field(0).type), pa.array([t.column("label").to_pylist()], schema.field(1).type), pa.array([x.astype("<i4").tobytes()]), pa.array([trees], schema.field(3).type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                piece = b.slice(at, BLOCK - n)
                held, n, at = [*held, piece], n + piece.num_rows, at + piece.num_rows
                if n == BLOCK:
                    yield pack(held)
                    held, n = [], 0
        if n:
            yield pack(held)
        give_back()

    return rows.where(F.size("v") == dim).mapInArrow(run, f"ids array<bigint>, labels array<{kind}>, points binary, trees array<binary>")


def opened(b: pa.RecordBatch, i: int, dim: int, parts: int) -> Iterator[tuple[int, Tree, np.ndarray]]:
    """The parts of a block: number, tree, and points."""
    x = np.frombuffer(b.column("points")[i].as_py(), dtype="<i4").reshape(-1, dim).astype(np.int64)
    for k, (t, p) in enumerate(zip(b.column("trees")[i].as_py(), np.split(x, parts, axis=1), strict=True)):
        yield k, Tree.unpack(t), p


def train(trees: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks ``[part, entry, component]`` after the rounds."""
    parts, entries, width = books.shape

    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], now: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            out = np.zeros((parts, entries, 1 + width), dtype=np.int64)
            for b in batches:
                for i in range(b.num_rows):
                    for k, tree, x in opened(b, i, parts * width, parts):
                        out[k] += sums(tree, x, now[k])
            at, entry = np.nonzero(out[:, :, 0])
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(list(out[at, entry]), pa.list_(pa.int64()))], names=["part", "entry", "sums"])
            give_back()

        total = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(1 + width)]
        found = trees.select("points", "trees").mapInArrow(run, "part int, entry int, sums array<bigint>").groupBy("part", "entry").agg(*total).collect()
        books = books.copy()
        for r in found:
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["s0"] for i in range(1, 1 + width)]
    return books


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, entries, error)`` of every vector: its entry in each part's codebook and the squared distances' sum."""
    parts, _, width = books.shape
    kind = trees.schema["labels"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                entry, error = [], 0
                for k, tree, x in opened(b, i, parts * width, parts):
                    entry.append(codes(tree, x, books[k]))
                    error = error + squares(x, books[k][entry[-1]])
                ids, labels = b.column("ids")[i].values, b.column("labels")[i].values
                made = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(entry, axis=1).astype(np.int32).ravel()), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, labels, made, pa.array(error)], names=["id", "label", "entries", "error"])
        give_back()

    return trees.mapInArrow(run, f"id bigint, label {kind}, entries array<int>, error bigint")


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, entries, error)`` of every usable vector, staged, and the codebooks ``[part, entry, component]``."""
    rows = usable(vectors, id_col, vec_col, label_col)
    first = rows.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(1).collect()
    dim = len(first[0]["v"]) if first else 0
    if not dim or dim % parts:
        kind = rows.schema["label"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"id bigint, label {kind}, entries array<int>, error bigint"), np.zeros((parts, 0, 0), dtype=np.int64)
    start = rows.where(F.size("v") == dim).select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    books = whole_numbers(np.array([r["v"] for r in start])).reshape(len(start), parts, dim // parts).transpose(1, 0, 2)
    trees = stage(blocks(rows, dim, parts), "trees")
    books = train(trees, books, rounds)
    coded = stage(encode(trees, books), "codes")
    unstage(trees)
    return coded, books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    coded = coded.withColumn("key", label)
    by_label = stage(coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    digest = F.sha2(F.lit(",".join(str(int(x)) for x in books.ravel())).cast("binary"), 256)
    code = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    rows = join_unique(coded.select("id", code.alias("code"), "error", "key"), by_label, "key", F.col("n"), coded.count())
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    """Lloyd's rounds as a chain of tables: books b0 to b6, nearest entries a0 to a6."""
    chain = []
    for i in range(ROUNDS + 1):
        chain.append(f"""
d{i} as (
  select v.r, v.part, b.entry, cast(sum((v.q - b.q) * (v.q - b.q)) as bigint) as error
  from v join b{i} b on b.part = v.part and b.pos = v.pos group by 1, 2, 3
),
a{i} as materialized (select r, part, arg_min(entry, (error, entry)) as entry, min(error) as error from d{i} group by 1, 2)""")
        if i < ROUNDS:
            chain.append(f"""
n{i} as (select v.part, v.pos, a.entry, cast(sum(v.q) as bigint) as s, count(*) as n from v join a{i} a on a.r = v.r and a.part = v.part group by 1, 2, 3),
b{i + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce((n.s - ((n.s % n.n) + n.n) % n.n) // n.n, b.q) as q from b{i} b left join n{i} n on n.part = b.part and n.entry = b.entry and n.pos = b.pos
)""")
    return f"""
with e as materialized (
  select vec_id, label, embedding::double[] as x, row_number() over (order by vec_id nulls last, embedding) as r from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
v as materialized (
  select r, (i - 1) // (n // {PARTS}) as part, (i - 1) % (n // {PARTS}) as pos, cast(floor(y * {SCALE}) as bigint) as q
  from (select r, len(x) as n, unnest(x) as y, generate_subscripts(x, 1) as i from e)
),
b0 as materialized (select part, r - 1 as entry, pos, q from v where r <= {ENTRIES}),{",".join(chain)},
c as (select r, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(error) as bigint) as error from a{ROUNDS} group by 1)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(q as varchar), ',' order by part, entry, pos)) from b{ROUNDS}) as codebooks_sha256
from c join e using (r)
"""


QUERIES = {"op12_vector_codes": query}
ORACLE = {"op12_vector_codes": _sql()}
