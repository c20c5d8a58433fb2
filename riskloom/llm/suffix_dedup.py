"""Suffix-array dedup: passages of ``length`` bytes that start in an earlier document as well are found and cut out.

Equal ``length``-byte windows have the same minimizer (the least hash of a GRAM-byte string in the window) at the same
place, so windows are dealt to shards by it, in maximal stretches that share one.

1. Documents are dealt to buckets by a hash of their row; all steps use this one exchange, which the plan shares.
2. Each bucket sends its minimizers, packed by ranges of them; those that another bucket has, too, come back.
3. Each bucket sends the stretches whose minimizer is known to repeat, each different string once, with the rows of the first document
   that has it there; the other documents' copies are surely covered and are finished intervals.  Of a hot minimizer, one of
   HOT stretches and more, each window goes by itself to a shard of its own hash, so that no shard gets all of them.
4. A shard spools its strings to scratch files in order of their minimizers and sorts about ``sort_bytes`` of them at a time by
   external induction with common-prefix lengths (``induced_sort``).  Suffixes that share ``length`` bytes are one class, whose least
   document id decides which of its windows go.
5. The intervals go back to the buckets, are merged and cut out.

Memory: a task holds one bucket (``bucket_bytes``, or the longest document) with STRINGS of its strings at a time, one range's minimizers (RANGE_BYTES of text), or one
sort; strings of one part of a shard beyond ``sort_bytes`` are sorted all the same, from scratch files.

Defined cases: a null text is empty; rows that share an id don't remove from each other; null ids count as greater than
all others (and as one id); the bytes kept are those of the input's UTF-8 form, which a removed run may cut within a
character; very long and very repetitive texts are like others; empty tables give no rows; other columns don't matter.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import gives_back, read
from riskloom.llm.induced_sort import MEMORY_QUEUE, Queue, room, sorted_blocks

LENGTH, GRAM = 50, 24
#: Text bytes of a bucket, of a piece that is hashed at once, of a suffix sort, and of the texts that a range of minimizers comes from.
BUCKET_BYTES, HASH_BYTES, SORT_BYTES, RANGE_BYTES = 16 << 20, 1 << 17, 1 << 20, 64 << 20
#: Stretches from which on a minimizer is hot, the parts of a shard that are spooled apart, and strings that a bucket compares at once.
HOT, PARTS, STRINGS = 4096, 64, 1 << 15
NO_ID = np.iinfo(np.int64).max
MIX = np.uint64(0x9E3779B97F4A7C15)
SPREAD = (np.arange(1, 257, dtype=np.uint64) * MIX) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` bytes, by doubling a polynomial hash."""
    base, size, power = SPREAD[data], 1, int(MIX)
    out, have = None, 0
    while gram:
        if gram & 1:
            if out is None:
                out, have = base, size
            else:
                n = len(base) - have
                out = out[:n] * np.uint64(pow(power, size, 1 << 64)) + base[have : have + n]
                have += size
        gram >>= 1
        if gram:
            base = base[:-size] * np.uint64(pow(power, size, 1 << 64)) + base[size:]
            size *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def stretches(data: np.ndarray, length: int, gram: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, minimizer) of each maximal stretch of windows of one minimizer, cut at the edges and in repetitive text."""
    windows, width = len(data) - length + 1, length - gram + 1
    low, size = gram_hashes(data, gram), 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:windows], low[width - size : width - size + windows])
    new = np.empty(windows, dtype=bool)
    new[0] = True
    np.not_equal(low[1:], low[:-1], out=new[1:])
    new[edges[edges < windows]] = True
    start = np.nonzero(new)[0]
    sizes = np.diff(np.append(start, windows))
    for i in np.nonzero(sizes > width)[0].tolist():  # a repeated gram; no stretch needs more windows
        new[start[i] : start[i] + sizes[i] : width] = True
    start = np.nonzero(new)[0]
    return start, low[start]


def hashed(data: np.ndarray, edges: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, minimizer, text number) of all stretches within texts, which lie between the edges; the end is that of the last window."""
    found = []
    for at in range(0, len(data) - length + 1, HASH_BYTES):
        part = data[at : at + HASH_BYTES + length - 1]
        a, z = np.searchsorted(edges, [at, at + len(part)])
        start, key = stretches(part, length, gram, edges[a:z] - at)
        text = np.searchsorted(edges, start + at, "right") - 1
        end = np.minimum(np.append(start[1:], len(part) - length + 1) + length - 1, edges[text + 1] - at)
        ok = end - start >= length  # what is left of a text after its last window goes
        found.append((start[ok] + at, end[ok] + at, key[ok], text[ok]))
    if not found:
        return tuple(np.zeros(0, dtype=k) for k in (np.int64, np.int64, np.uint64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def window_keys(data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """A number of 48 bits for each window of ``length`` bytes, of which ``begin`` has the starts in ascending order."""
    out = np.empty(len(begin), dtype=np.uint64)
    for at in range(0, len(data), HASH_BYTES):
        a, z = np.searchsorted(begin, [at, at + HASH_BYTES])
        if a < z:
            out[a:z] = spread(gram_hashes(data[at : at + HASH_BYTES + length - 1], length)[begin[a:z] - at])
    return out


def spread(keys: np.ndarray) -> np.ndarray:
    """Minimizers as evenly spread numbers of 48 bits: least hashes crowd near zero."""
    return (keys * MIX) >> np.uint64(16)


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Which of equal parts of the 48-bit numbers each is in."""
    return ((key >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(32)


def heads(a: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    return np.nonzero(np.append(True, a[1:] != a[:-1]))[0] if len(a) else np.zeros(0, dtype=np.int64)


def spans(first: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    return zip(first.tolist(), [*first[1:].tolist(), n], strict=False)


def pack(*columns: np.ndarray) -> bytes:
    """Columns as planes of equal bytes, compressed."""
    head = [struct.pack("<I", len(columns))]
    for c in columns:
        head.append(struct.pack("<4sQ", np.dtype(c.dtype).str.encode(), len(c)))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + planes))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    (n,), at, out = struct.unpack_from("<I", raw), 4 + 12 * struct.unpack_from("<I", raw)[0], []
    for i in range(n):
        kind, size = struct.unpack_from("<4sQ", raw, 4 + 12 * i)
        kind = np.dtype(kind.rstrip(b"\0").decode())
        planes = np.frombuffer(raw, dtype=np.uint8, count=size * kind.itemsize, offset=at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(size) if kind.itemsize > 1 else planes.reshape(size).view(kind))
        at += size * kind.itemsize
    return out


def deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def undone(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def joined(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and the edges between them."""
    texts = column.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.binary())
    kind = np.dtype(np.int64 if pa.types.is_large_binary(texts.type) else np.int32)
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    edges = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    return data, edges - edges[0]


def words(data: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Strings as rows of 64-bit words, padded with zeros to ``most`` bytes and more."""
    width = -(-most // 8) * 8
    out = np.empty((len(start), width), dtype=np.uint8)
    at = np.arange(width)
    for a in range(0, len(start), 8192):
        rows = slice(a, a + 8192)
        take = np.minimum(start[rows, None] + at, len(data) - 1)
        np.multiply(data[take], at < size[rows, None], out=out[rows])
    return out.view(np.uint64)


def alike(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): strings in an order in which equal ones meet, and the group of each place."""
    h = size.astype(np.uint64) * MIX
    for i in range(rows.shape[1]):
        h = (h ^ rows[:, i]) * MIX
        h ^= h >> np.uint64(32)
    order = np.argsort(h, kind="stable")
    new = np.ones(len(order), dtype=bool)
    a, z = order[:-1], order[1:]
    # Strings of one hash that differ, if there ever are any, are groups of their own.
    new[1:] = (h[a] != h[z]) | (size[a] != size[z]) | (rows[a] != rows[z]).any(axis=1)
    return order, np.cumsum(new) - 1


def flat(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The strings' bytes, one after the other."""
    data = rows.view(np.uint8)
    return data[np.arange(data.shape[1]) < size[:, None]]


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs; runs that touch are one."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > reach[:-1])
    return begin[new], reach[np.append(np.nonzero(new)[0][1:] - 1, len(begin) - 1)]


def repeated(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... counts[i] of them, for each i."""
    total = int(counts.sum())
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(total)


def decided(strings: np.ndarray, sizes: np.ndarray, owner: np.ndarray, ids: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(occurrence, begin, end) of what is removed from strings, by one suffix sort.

    ``owner`` and ``ids`` have a string's number and a document's id for each occurrence; begin and end count in the string.
    """
    some, firsts, number, base, done = [], [], np.empty(len(sizes), dtype=np.int64), 0, 0
    for a in range(0, len(sizes), 1 << 18):  # equal strings of different buckets are one
        own = sizes[a : a + (1 << 18)]
        edge = np.append(0, np.cumsum(own))
        data = strings[done : done + edge[-1]]
        rows = words(data, edge[:-1], own, int(own.max()))
        order, group = alike(rows, own)
        number[a + order] = base + group
        one = order[heads(group)]
        some.append(flat(rows[one], own[one]))
        firsts.append(own[one])
        base, done = base + len(one), done + int(edge[-1])
    size, owner = np.concatenate(firsts), number[owner]
    edge = np.append(0, np.cumsum(size + 1))
    text, string = room(int(edge[-1]) + 1, np.uint16), room(int(edge[-1]) + 1, np.int32)
    at = 0
    for bytes_, own in zip(some, firsts, strict=True):
        a, z = edge[at], edge[at + len(own)]
        text[a:z] = 1  # between strings
        string[a:z] = np.repeat(np.arange(at, at + len(own)), own + 1)
        text[a + np.arange(len(bytes_)) + np.repeat(np.arange(len(own)), own)] = bytes_.astype(np.uint16) + np.uint16(2)
        at += len(own)
    text[-1] = 0
    del some
    least = np.full(len(size), NO_ID)
    np.minimum.at(least, owner, ids)
    # Classes of suffixes that share ``length`` bytes, in their order, and the least id of each.
    of, low, classes = room(len(text), np.int32), room(len(text), np.int64), 0
    for pos, lcp in sorted_blocks(text, length):
        new = lcp < length
        cls = np.cumsum(new) + (classes - 1)
        of[pos] = cls
        first = np.append(0, np.nonzero(new[1:])[0] + 1)
        best = np.minimum.reduceat(least[string[pos]], first)
        if not new[0]:
            best[0] = min(best[0], low[classes - 1])
        low[cls[first[0]] : cls[first[0]] + len(first)] = best
        classes = int(cls[-1]) + 1
    order = np.argsort(owner, kind="stable")
    owner_edge = np.searchsorted(owner[order], np.arange(len(size) + 1))
    for a in range(0, len(size), 1 << 14):
        own = size[a : a + (1 << 14)] - length + 1
        value = low[of[repeated(edge[a : a + len(own)], own)]]
        begin = np.append(0, np.cumsum(own))[:-1]
        new = np.append(True, value[1:] != value[:-1])
        new[begin] = True
        at = np.nonzero(new)[0]
        inside = np.searchsorted(begin, at, "right") - 1
        stop = np.minimum(np.append(at[1:], len(value)), begin[inside] + own[inside])
        # Each segment with each occurrence of its string.
        n = np.diff(owner_edge[a : a + len(own) + 1])[inside]
        occurrence = order[repeated(owner_edge[a + inside], n)]
        gone = np.repeat(value[at], n) < ids[occurrence]
        yield occurrence[gone], np.repeat(at - begin[inside], n)[gone], (np.repeat(stop - begin[inside], n) + length - 1)[gone]


def by_bucket(bucket: np.ndarray, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Intervals packed by bucket."""
    order = np.lexsort((begin, row, bucket))
    bucket, row, begin, end = bucket[order], row[order], begin[order], end[order]
    for a, z in spans(heads(bucket), len(bucket)):
        own = heads(row[a:z])
        many = np.diff(np.append(own, z - a)).astype(np.uint32)
        yield int(bucket[a]), pack(row[a:z][own], many, begin[a:z].astype(np.uint32), (end[a:z] - begin[a:z]).astype(np.uint32))


def dealt(docs: DataFrame, id_col: str, text_col: str, bucket_bytes: int, others: list[str]) -> tuple[DataFrame, int, int]:
    """The documents in buckets, the number of buckets, and the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(own, F.lit(int(NO_ID))).alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    return rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")).repartition("bucket"), buckets, size


def table(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def intervals(rows: DataFrame, size: int, length: int, gram: int, sort_bytes: int) -> DataFrame:
    """``(bucket, data)``: byte ranges of the rows to be removed, packed, not yet merged."""
    if not 0 < gram <= length:
        raise ValueError((gram, length))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = shards = max(partitions, -(-size // RANGE_BYTES))
    width = length - gram + 1

    @gives_back
    def send(t: pa.Table) -> pa.Table:
        """A bucket's minimizers, each once with its count, packed by ranges of them."""
        key = np.sort(spread(hashed(*joined(t["text"]), length, gram)[2]))
        at = heads(key)
        many, key = np.minimum(np.diff(np.append(at, len(key))), HOT).astype(np.uint16), key[at]
        place = part_of(key, ranges)
        first = heads(place)
        sent = [pack(deltas(key[a:z]), many[a:z]) for a, z in spans(first, len(key))]
        return table([place[first].astype(np.int32), [t["bucket"][0].as_py()] * len(first), sent], ["range", "bucket", "keys"], [pa.int32(), pa.int32(), pa.binary()])

    @gives_back
    def meet(t: pa.Table) -> pa.Table:
        """Those minimizers of each bucket that another bucket has, too, and which of them are hot."""
        parts = [unpack(x) for x in t["keys"].to_pylist()]
        key, many = np.concatenate([undone(k) for k, _ in parts]), np.concatenate([m for _, m in parts]).astype(np.int64)
        bucket = np.repeat(t["bucket"].to_numpy(), [len(k) for k, _ in parts])
        order = np.argsort(key, kind="stable")
        key, bucket, many = key[order], bucket[order], many[order]
        first = heads(key)
        n = np.diff(np.append(first, len(key)))
        hot = np.repeat(np.add.reduceat(many, first) >= HOT, n)
        both = np.repeat(n > 1, n)
        order = np.argsort(bucket[both], kind="stable")
        key, bucket, hot = key[both][order], bucket[both][order], hot[both][order]
        first = heads(bucket)
        sent = [pack(deltas(key[a:z]), hot[a:z].astype(np.uint8)) for a, z in spans(first, len(key))]
        return table([bucket[first], sent], ["bucket", "keys"], [pa.int32(), pa.binary()])

    found = rows.groupBy("bucket").applyInArrow(send, "range int, bucket int, keys binary").groupBy("range").applyInArrow(meet, "bucket int, keys binary")

    @gives_back
    def extract(t: pa.Table, known: pa.Table) -> pa.Table:
        """Messages (shard, bucket, data) of strings with their rows; finished intervals have no shard."""
        names, kinds = ["shard", "bucket", "data"], [pa.int32(), pa.int32(), pa.binary()]
        if not t.num_rows:
            return table([[], [], []], names, kinds)
        data, edges = joined(t["text"])
        ids, numbers, bucket = t["id"].to_numpy(), t["row"].to_numpy(), t["bucket"][0].as_py()

        def strings(start: np.ndarray, end: np.ndarray, key: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, bytes]]:
            """Messages of some strings, with all that the bucket has for their shards."""
            sizes = end - start
            string = words(data, start, sizes, length + width - 1)
            order, group = alike(string, sizes)
            first = heads(group)
            least = np.minimum.reduceat(ids[doc[order]], first)
            kept = ids[doc[order]] == least[group]
            over = order[~kept]
            sent = [(-1, bucket, x) for _, x in by_bucket(np.full(len(over), bucket), numbers[doc[over]], start[over] - edges[doc[over]], end[over] - edges[doc[over]])]
            rep, occurrence = order[first], order[kept]
            count = np.add.reduceat(kept, first, dtype=np.int64)
            begin = np.cumsum(count) - count
            by = np.argsort(key[rep], kind="stable")
            shard = part_of(key[rep][by], shards)
            for a, z in spans(heads(shard), len(by)):
                s = by[a:z]
                own = occurrence[repeated(begin[s], count[s])]
                docs, local = np.unique(doc[own], return_inverse=True)
                part = part_of(key[rep[s]] * np.uint64(shards) & np.uint64((1 << 48) - 1), PARTS).astype(np.uint8)
                sent.append((int(shard[a]), -1 - bucket, pack(part, sizes[rep[s]].astype(np.uint16), count[s].astype(np.uint32), flat(string[rep[s]], sizes[rep[s]]), local.astype(np.uint32), (start[own] - edges[doc[own]]).astype(np.uint32), numbers[docs], ids[docs])))
            return sent

        start, end, key, doc = hashed(data, edges, length, gram)
        key = spread(key)
        parts = [unpack(x) for x in known["keys"].to_pylist()]
        # Minimizers that two documents of this bucket share.
        order = np.argsort(key, kind="stable")
        first, one = heads(key[order]), ids[doc[order]]
        own = key[order][first][np.minimum.reduceat(one, first) != np.maximum.reduceat(one, first)] if len(first) else key
        keys = np.concatenate([own, *[undone(k) for k, _ in parts]])
        hot = np.concatenate([np.zeros(len(own), np.uint8), *[h for _, h in parts]]).astype(bool)
        keys, hot = np.unique(keys), np.sort(keys[hot])
        del order, one
        inside = lambda k, of: of[np.minimum(np.searchsorted(of, k), len(of) - 1)] == k if len(of) else np.zeros(len(k), dtype=bool)
        hit = inside(key, keys)
        start, end, key, doc = start[hit], end[hit], key[hit], doc[hit]
        if not len(key):
            return table([[], [], []], names, kinds)
        cut = inside(key, hot)
        if cut.any():
            # Of a hot minimizer each window is a string, under its own hash.
            many = end[cut] - start[cut] - length + 1
            begin = repeated(start[cut], many)
            doc = np.concatenate([doc[~cut], np.repeat(doc[cut], many)])
            start, end = np.concatenate([start[~cut], begin]), np.concatenate([end[~cut], begin + length])
            key = np.concatenate([key[~cut], window_keys(data, begin, length)])
        # A few strings are held at a time: those of as many whole shards as come to STRINGS.
        order, sent = np.argsort(key, kind="stable"), []
        first = heads(part_of(key[order], shards))
        cuts = np.append(first[:1], first[1:][np.diff(first // STRINGS) > 0])
        for a, z in spans(cuts, len(order)):
            at = order[a:z]
            sent += strings(start[at], end[at], key[at], doc[at])
        return table([[s if s >= 0 else bucket % shards for s, _, _ in sent], [b for _, b, _ in sent], [x for _, _, x in sent]], names, kinds)

    pieces = rows.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(extract, "shard int, bucket int, data binary")

    @gives_back
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool = [Queue(8 << 20, ("<u1",)), Queue(MEMORY_QUEUE, ("<u2", "<u4")), Queue(MEMORY_QUEUE, ("<i4", "<i8", "<i8", "<u4"))]
        size, held, waiting = np.zeros(PARTS, dtype=np.int64), [], 0

        def out(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "data"])

        def deal() -> None:
            """Spool the messages held, by parts."""
            nonlocal waiting
            part, sizes, count, data, local, start = (np.concatenate(x) for x in list(zip(*[m for _, m in held], strict=True))[:6])
            each = [len(m[4]) for _, m in held]
            local = local.astype(np.int64) + np.repeat(np.cumsum([0, *[len(m[6]) for _, m in held]])[:-1], each)
            row, one = np.concatenate([m[6] for _, m in held])[local], np.concatenate([m[7] for _, m in held])[local]
            bucket = np.repeat(np.array([b for b, _ in held], dtype=np.int32), each)
            order = np.argsort(part, kind="stable")
            begin, first = np.cumsum(sizes, dtype=np.int64) - sizes, np.cumsum(count, dtype=np.int64) - count
            for a, z in spans(heads(part[order]), len(order)):
                s, p = order[a:z], int(part[order[a]])
                spool[0].push(p, data[repeated(begin[s], sizes[s].astype(np.int64))])
                spool[1].push(p, sizes[s], count[s])
                o = repeated(first[s], count[s].astype(np.int64))
                spool[2].push(p, bucket[o], row[o], one[o], start[o])
                size[p] += int(sizes[s].sum())
            held.clear()
            waiting = 0

        for b in batches:
            for bucket, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if bucket >= 0:
                    yield out([(bucket, data)])
                    continue
                held.append((-1 - bucket, unpack(data)))
                waiting += len(data)
                if waiting >= 1 << 20:
                    deal()
        if held:
            deal()
        ready, count, p = [], 0, 0
        while p < PARTS:
            some, total = [], 0
            while p < PARTS and (not some or total + size[p] <= sort_bytes):
                some, total, p = [*some, p], total + int(size[p]), p + 1
            if not total:
                continue
            strings, both, places = ([c for k in some for c in q.drain(k)] for q in spool)
            sizes, many = (np.concatenate(x) for x in zip(*both, strict=True))
            bucket, row, one, start = (np.concatenate(x) for x in zip(*places, strict=True))
            owner = np.repeat(np.arange(len(sizes)), many.astype(np.int64))
            for at, begin, end in decided(np.concatenate([x[0] for x in strings]), sizes.astype(np.int64), owner, one, length):
                ready.append((bucket[at], row[at], start[at] + begin, start[at] + end))
                count += len(at)
            if count >= 1 << 19:
                yield out(list(by_bucket(*(np.concatenate(x) for x in zip(*ready, strict=True)))))
                ready, count = [], 0
        if count:
            yield out(list(by_bucket(*(np.concatenate(x) for x in zip(*ready, strict=True)))))

    return pieces.repartitionById(shards, F.col("shard")).mapInArrow(shard, "bucket int, data binary")


def cut_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, sort_bytes: int = SORT_BYTES, whole_characters: bool = False) -> DataFrame:
    """``docs`` with the kept bytes of each row's text in ``kept`` and the maximal runs removed in ``removed_begins`` and ``removed_ends``.

    Columns of these names are replaced; the text column itself is left out.  With ``whole_characters`` bytes of a character cut in two
    aren't kept either.
    """
    new = ["kept", "removed_begins", "removed_ends"]
    fields = [f for f in docs.schema.fields if f.name != text_col and f.name.lower() not in new]
    rows, _, size = dealt(docs, id_col, text_col, bucket_bytes, [f.name for f in fields])
    spans_ = intervals(rows, size, length, gram, sort_bytes)

    @gives_back
    def cut(t: pa.Table, found: pa.Table) -> pa.Table:
        data, edges = joined(t["text"])
        numbers, n = t["row"].to_numpy(), t.num_rows
        parts = [unpack(x) for x in found["data"].to_pylist()]
        begin = end = np.zeros(0, dtype=np.int64)
        if parts and n:
            order = np.argsort(numbers)
            row = np.concatenate([np.repeat(r, m.astype(np.int64)) for r, m, _, _ in parts])
            doc = order[np.searchsorted(numbers[order], row)]
            begin = np.concatenate([b for _, _, b, _ in parts]).astype(np.int64) + edges[doc] + doc  # a gap keeps runs of two texts apart
            begin, end = merged(begin, begin + np.concatenate([s for _, _, _, s in parts]))
        doc = np.searchsorted(edges + np.arange(n + 1), begin, "right") - 1
        begin, end = begin - doc, end - doc
        step = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(step, begin, 1)
        np.add.at(step, end, -1)
        stays = np.cumsum(step[:-1], dtype=np.int8) == 0
        kept = data[stays]
        sizes = np.diff(edges) - np.bincount(doc, weights=end - begin, minlength=n).astype(np.int64)
        ends = np.append(0, np.cumsum(sizes))
        if whole_characters and len(begin):
            whole = kept.tobytes()
            some = [whole[a:z] for a, z in zip(ends, ends[1:], strict=False)]
            for i in np.unique(doc).tolist():
                some[i] = some[i].decode("utf-8", "ignore").encode()
            made = pa.array(some, pa.binary())
        else:
            made = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes())])
        runs = pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=n))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(runs, pa.array(x - edges[doc])) for x in (begin, end)]
        return pa.table([*[t[f"c{i}"] for i in range(len(fields))], made, *lists], names=[*[f"c{i}" for i in range(len(fields))], *new])

    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)] + ["kept binary, removed_begins array<long>, removed_ends array<long>"])
    out = rows.groupBy("bucket").cogroup(spans_.groupBy("bucket")).applyInArrow(cut, schema)
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)], *new)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with what stays of each text, columns as they are.  Bytes of a character cut in two go; a null text becomes empty."""
    others = [c for c in docs.columns if c != text_col]
    # Other columns go under names that clash with none.
    renamed = docs.select(F.col(f"`{id_col}`").alias("row_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(others)])
    out = cut_out(renamed, "row_id", "text", whole_characters=True, **options)
    own = {c: F.col(f"o{i}") for i, c in enumerate(others)} | {text_col: F.col("kept").cast("string")}
    return out.select(*[own[c].alias(c) for c in docs.columns])


def removed_bytes() -> Column:
    return F.aggregate(F.zip_with("removed_begins", "removed_ends", lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_out(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (F.octet_length("kept") + removed_bytes()).cast("long").alias("n_bytes"), removed_bytes().alias("n_removed"),
        F.size("removed_begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op3_suffix_dedup": query}
ORACLE: dict[str, str] = {}
