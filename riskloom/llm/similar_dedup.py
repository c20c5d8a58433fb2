"""Near-duplicates by true similarity: components of documents whose sets of five-word shingles have Jaccard 0.8 or more.

SimHash finds the first candidates: fingerprints of the five-word shingles that differ in few bits, by ``simhash_dedup.links``.  Fingerprints
alone miss most pairs near 0.8 (about ten of 64 bits differ there), so an index completes them.  Shingles are put into
one order for all documents, those that a sample shows to be common last.  Of n shingles in that order two similar documents
share one among the first n - ceil(0.8 n) + 1 of each, so only those are sent to the index, and only those that meet another
stay there.  The order and the sample change the cost, never the result: no link is lost.

The index is read in rounds: partners next to each other in the order of their sizes, then those a little farther, then all the
rest.  Only pairs of different components are proposed, so a group of n near copies is connected after about n
proposals and proposes no more.  A proposal that sizes and places of the shared shingle allow to be similar is checked by bitmaps,
each bit the parity of the shingles that fall on it (sets differ in at least as many shingles as bitmaps in bits), and then on the
whole sets.  A shingle of more than BLOCK documents is split into blocks, in the last round each pair of them a unit of work.

Defined cases: words are what white space separates, in lower case; a text of fewer than five words is one shingle; a text without words is
similar to nothing and stays; equal sets are one; rows that repeat an id are rows of their own, and exactly one row of each component stays,
that of the smallest id (a null id loses), then the first; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import components, give_back, join_unique, numbered, slices, stage, unstage, without
from riskloom.llm.simhash_dedup import DISTANCE, links, majority

WORDS, SEED = 5, 42
#: Similar: 5 * shared >= 4 * (shingles of either), in whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
#: Documents sampled for common shingles, the count that makes one common, and how many are held at most.
SAMPLE, COMMON, HELD = 16_000, 4, 65_536
#: Share of the sampled documents from which a shingle is dealt to several tasks, and their number.
HOT, SALTS = 1 / 1000, 64
#: Least bits of a bitmap, and documents of a shingle that are compared in one task.
BITMAP, BLOCK, FAR = 1024, 8_192, 1 << 62
#: Rounds: distances within a shingle.
ROUNDS = ((1, 2), (2, 8), (8, 32), (32, FAR))
#: Sets that are looked up by a broadcast of their row numbers; more are looked up by a shuffle.
LOOKED_UP = 500_000


def hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of a text's shingles, repeats included."""
    data = text.lower().encode("utf-8", "surrogatepass").split()
    if not data:
        return np.zeros(0, dtype=np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(data) < words:
        return np.array([digest(join(data), SEED)], dtype=np.uint64)
    return np.array([digest(join(s), SEED) for s in zip(*[data[i:] for i in range(words)])], dtype=np.uint64)  # noqa: B905


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(hashes(text, words).view(np.int64))


def similar(shared, n, m):
    """Whether sets of n and m shingles that share so many are similar."""
    return (NUMERATOR + DENOMINATOR) * shared >= NUMERATOR * (n + m)


def bitmap(own: np.ndarray) -> bytes:
    """Parities of the numbers of shingles that fall on each bit; of as many bits as there are shingles, rounded up to a power of two."""
    width = max(BITMAP, 1 << int(len(own) - 1).bit_length()) if len(own) else BITMAP
    on = np.bincount((own.view(np.uint64) % np.uint64(width)).astype(np.int64), minlength=width)
    return np.packbits(on & 1, bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ; a wider one is folded to the other's width."""
    if len(x) > len(y):
        x, y = y, x
    wide = np.frombuffer(y, dtype=np.uint64).reshape(-1, len(x) // 8)
    return int(np.bitwise_count(np.bitwise_xor.reduce(wide, axis=0) ^ np.frombuffer(x, dtype=np.uint64)).sum())


def prefix(own: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles that go to the index; ``common`` is sorted, and ``rank`` gives the place of each among the common ones."""
    n = len(own)
    if not n:
        return own
    late = np.zeros(n, dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        hit = common[at] == own
        late[hit] = rank[at[hit]] + 1
    return own[np.lexsort((own, late))][: n - -(-NUMERATOR * n // DENOMINATOR) + 1]


def common_shingles(texts: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Shingles that are common in a sample of the texts, sorted; the rank of each by its count; and those in very many."""
    total = texts.count()
    limit = int(min(1.0, SAMPLE / max(1, total)) * (1 << 30))
    some = texts.where(F.pmod(F.xxhash64("text", F.lit(13)), F.lit(1 << 30)) <= limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *[shingles(t, words) for t in b.column(0).to_pylist()]]))], names=["token"])
        give_back()

    counted = some.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    found = counted.orderBy(F.desc("n"), "token").limit(HELD).collect()
    token, n = np.array([r["token"] for r in found], dtype=np.int64), np.array([r["n"] for r in found], dtype=np.int64)
    rank = np.empty(len(n), dtype=np.int64)
    rank[np.lexsort((token, n))] = np.arange(len(n))
    order = np.argsort(token)
    return token[order], rank[order], token[n >= max(COMMON, HOT * min(SAMPLE, total))].tolist()


def signatures(rows: DataFrame, row: str, id_col: str, text_col: str, order, words: int) -> DataFrame:
    """``(row, id, h, n, fp, bits, tokens)``: a set's name, size, fingerprint and bitmap, and its shingles for the index."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = order.value
        for b in slices(batches):
            each = [hashes(t, words) for t in b.column(2).to_pylist()]
            own = [np.unique(x.view(np.int64)) for x in each]
            fps = np.array([majority(x) for x in each], dtype=np.uint64).view(np.int64)
            tokens = [prefix(x, common, rank) for x in own]
            ends = np.cumsum([0] + [len(x) for x in tokens]).astype("int32")
            flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *tokens])))
            names = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in own], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names), pa.array([len(x) for x in own], pa.int64()), pa.array(fps), pa.array([bitmap(x) for x in own], pa.binary()), flat], names=["row", "id", "h", "n", "fp", "bits", "tokens"])
        give_back()

    taken = rows.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return taken.mapInArrow(run, f"row long, id {kind}, h long, n long, fp long, bits binary, tokens array<long>")


def shared_index(sets: DataFrame, hot: list[int]) -> DataFrame:
    """``(token, row, na)`` of the shingles that meet another document, staged; na is the set's size * 2^32 + the shingle's place."""
    spark = sets.sparkSession
    na = F.shiftleft("n", 32) + F.col("at")
    each = sets.select("row", "n", F.posexplode("tokens").alias("at", "token"))
    # Shingles known to be hot are shared for sure; they are dealt by document as well, and none of their rows is alone.  They
    # are marked by a negative na: the rows of the index are many, and narrow.
    known = spark.createDataFrame([(x, True) for x in hot], "token long, hot boolean")
    each = each.join(F.broadcast(known), "token", "left").select("token", "row", F.when(F.col("hot"), -1 - na).otherwise(na).alias("na"))
    salt = F.when(F.col("na") < 0, F.pmod(F.xxhash64("row"), F.lit(SALTS))).otherwise(F.lit(0))
    dealt = each.repartition("token", salt).sortWithinPartitions("token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []  # the row that may be alone, so far

        def keep(cols: list[np.ndarray]) -> pa.RecordBatch:
            na = np.where(cols[2] < 0, -1 - cols[2], cols[2])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (cols[0], cols[1], na)], names=["token", "row", "na"])

        before, met = None, False
        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(3)]
            if last:
                cols = [np.concatenate([x, c]) for x, c in zip(last, cols, strict=True)]
            token = cols[0]
            if not len(token):
                continue
            same = token[1:] == token[:-1]
            both = np.append(same, False) | np.append(False, same) | (cols[2] < 0)
            # A held row may have met its like in an earlier batch.
            both[0] |= met and token[0] == before
            open_ = not both[-1]
            yield keep([c[both] for c in cols])
            last = [c[-1:] for c in cols] if open_ else []
            before, met = token[-1], not open_
        give_back()

    return stage(dealt.mapInArrow(run, "token long, row long, na long"), "index")


def near(a: int, b: int, n: np.ndarray, bits: list[bytes]) -> bool:
    """Whether the bitmaps of two sets let them be similar: those differ in n + m - 2 * shared shingles at most."""
    size = int(n[a] + n[b])
    return (NUMERATOR + DENOMINATOR) * (size - differing(bits[a], bits[b])) >= 2 * NUMERATOR * size


def met(token: np.ndarray, row: np.ndarray, na: np.ndarray, comp: np.ndarray, bits: list[bytes], low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of equal token, in order of token and size, ``low`` to ``high`` places apart, of different components, that may be
    similar by their sizes, the shingle's places and the bitmaps."""
    n, at = na >> 32, na & 0xFFFFFFFF
    live, step = np.arange(len(token)), low
    while step < high:
        live = live[live + step < len(token)]
        other = live + step
        # Sizes ascend within a token: once the partner is too large, all further ones are.
        stays = (token[live] == token[other]) & (DENOMINATOR * n[live] >= NUMERATOR * n[other])
        live, other = live[stays], other[stays]
        if not len(live):
            return
        shared = np.minimum(n[live] - at[live], n[other] - at[other])
        ok = similar(shared, n[live], n[other]) & (comp[live] != comp[other])
        ok[ok] = [near(a, b, n, bits) for a, b in zip(live[ok].tolist(), other[ok].tolist(), strict=True)]
        if ok.any():
            a, b = row[live[ok]], row[other[ok]]
            yield np.minimum(a, b), np.maximum(a, b)
        step += 1


def proposals(index: DataFrame, found: DataFrame, sets: DataFrame, low: int, high: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` that the index proposes in a round, staged, ``found`` being the components so far."""
    index = index.join(found.select(F.col("node").alias("row"), "root"), "row", "left").withColumn("comp", F.coalesce("root", "row")).drop("root")
    index = stage(index, "placed")
    total = index.count()
    # Shingles whose documents are one component already propose nothing; of those that the same documents have (those of a
    # passage, say) the first in the order stands for all, as the first that any two of these documents share.
    place = F.col("na").bitwiseAND(F.lit((1 << 32) - 1))
    per = index.groupBy("token").agg(
        F.count("*").alias("many"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum(F.xxhash64("row").bitwiseAND(F.lit((1 << 40) - 1))).alias("same"),
        F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("too"), F.min(F.struct("row", place.alias("at"))).alias("first"),
    ).where("lo <> hi")
    open_ = per.groupBy("many", "same", "too", "first.row").agg(F.min(F.struct("first.at", "token"))["token"].alias("token")).select("token", "many")
    rows = join_unique(index, stage(open_, "open"), "token", F.col("many"), total).where("many is not null").join(sets.select("row", "bits"), "row")
    last = high >= FAR
    blocks, mine = F.expr(f"cast(many div {BLOCK} + 1 as int)"), F.expr("cast(pmod(xxhash64(row), blocks) as int)")
    # Before the last round the blocks of a shingle go by themselves; in the last every two of them meet, at all distances.
    keys = F.expr("transform(sequence(0, blocks - 1), o -> xxhash64(token, least(o, mine), greatest(o, mine)))") if last else F.array(F.xxhash64("token", "mine"))
    split = rows.where(F.col("many") > BLOCK).withColumn("blocks", blocks).withColumn("mine", mine).select(F.explode(keys).alias("key"), "row", "na", "comp", "bits")
    whole = rows.where(F.col("many") <= BLOCK).select(F.col("token").alias("key"), "row", "na", "comp", "bits")
    found = stage(paired(whole, low, high).unionByName(paired(split, 1 if last else low, high)).distinct(), "proposed")
    unstage(index)
    return found


def paired(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``rows(key, row, na, comp, bits)`` as ``met`` has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def done(some: pa.Table) -> Iterator[pa.RecordBatch]:
            cols = [some.column(i).to_numpy() for i in range(4)]
            for a, b in met(*cols, some.column(4).to_pylist(), low, high):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                some = pa.Table.from_batches(held)
                keys = some.column(0).to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))  # sorted: the last key may go on
                if whole:
                    yield from done(some.slice(0, whole))
                    held, size = some.slice(whole).to_batches(), size - whole
        if size:
            yield from done(pa.Table.from_batches(held))
        held.clear()
        give_back()

    return rows.repartition("key").sortWithinPartitions("key", "na", "row").mapInArrow(run, "a long, b long")


def both(pairs: DataFrame, known: DataFrame, *cols: str) -> DataFrame:
    """The pairs with columns of both rows."""
    x, y = (known.select(F.col("row").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in cols]) for k in ("a", "b"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", *[f"{c}_{k}" for c in cols for k in ("a", "b")])


def close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs that bitmaps let be similar, staged."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            n = np.column_stack([b.column(2).to_numpy(), b.column(3).to_numpy()])
            ok = [near(0, 1, own, pair) for own, *pair in zip(n, b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    return stage(both(pairs, sets, "n", "bits").mapInArrow(compare, "a long, b long"), "close")


def verified(close: DataFrame, rows: DataFrame, row: str, text_col: str, words: int) -> DataFrame:
    """Those of the staged pairs ``(a, b)`` of row numbers whose sets are similar, staged; the former go."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, words).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["row", "own"])
        give_back()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
                ok.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    # Whole sets are made and moved only of the few documents that bitmaps leave.
    wanted = stage(close.select(F.explode(F.array("a", "b")).alias(row)).distinct(), "wanted")
    few = wanted.count() <= LOOKED_UP
    text = rows.join(F.broadcast(wanted) if few else wanted, row, "left_semi").select(F.col(f"`{row}`").cast("long").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = stage(text.mapInArrow(shingled, "row long, own binary"), "whole")
    out = stage(both(close, whole, "own").mapInArrow(verify, "a long, b long"), "similar")
    unstage(close, wanted, whole)
    return out


def fingerprint_pairs(sets: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)`` of row numbers that connect what has close fingerprints, staged; a forest, not all pairs."""
    total = sets.count()
    lead = stage(sets.groupBy("fp").agg(F.min("row").alias("lead"), F.count("*").alias("many")), "lead")
    alike = join_unique(sets.select("row", "fp"), lead, "fp", F.col("many"), total).where("row <> lead").select(F.col("lead").alias("a"), F.col("row").alias("b"))
    near = links(lead.select("fp"), distance)
    one, two = (lead.select(F.col("fp").alias(k), F.col("lead").alias(f"lead_{k}")) for k in ("a", "b"))
    apart = near.join(one, "a").join(two, "b").select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b"))
    return stage(alike.unionByName(apart).where("a <> b").distinct(), "proposed")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component of similar ones; columns are kept as they are."""
    rows, row = numbered(docs, id_col, "near")
    common, rank, hot = common_shingles(rows.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text")), words)
    order = docs.sparkSession.sparkContext.broadcast((common, rank))
    wide = stage(signatures(rows, row, id_col, text_col, order, words), "signatures")
    sets = stage(wide.drop("tokens"), "sets")
    filled = sets.where("n > 0")
    total = filled.count()
    names = stage(filled.groupBy("h").agg(F.min("row").alias("first"), F.count("*").alias("many")).where("many > 1"), "names")
    equal = stage(join_unique(filled.select("row", "h"), names, "h", F.col("many"), total).where("row <> first").select("row", "first"), "equal")
    single = without(filled, "row", equal.select("row"))

    index = shared_index(without(wide.where("n > 0").select("row", "n", "tokens"), "row", equal.select("row")), hot)
    unstage(wide)
    asked = fingerprint_pairs(single.select("row", "fp"), distance)
    edges = verified(close(asked, sets), rows, row, text_col, words)
    unstage(asked)
    edges = edges.unionByName(equal.select(F.col("first").alias("a"), F.col("row").alias("b")))
    found = components(edges)
    for low, high in ROUNDS:
        more = verified(proposals(index, found, sets, low, high), rows, row, text_col, words)
        if more.head(1):
            edges = edges.unionByName(more)
            found = components(edges)
    unstage(index)
    named = found.join(sets.select(F.col("row").alias("node"), "id"), "node")
    named = stage(named, "named")
    kept = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "node")).alias("best"), F.count("*").alias("many"))
    kept = stage(kept.select("root", F.col("best.node").alias("keep"), "many"), "kept")
    gone = join_unique(named, kept, "root", F.col("many"), named.count()).where("node <> keep").select(F.col("node").alias(row))
    return without(rows, row, stage(gone, "gone")).select(*[f"`{c}`" for c in docs.columns])
