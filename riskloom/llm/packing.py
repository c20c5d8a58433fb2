"""Packing: Karmarkar-Karp multiway differencing of document pieces into windows of fixed capacity.

Each task tokenises its documents in turn, cuts full windows off their fronts, and cuts what is left of each into
near-equal pieces of at most ``piece`` tokens.  ``batch`` such pieces at a time are dealt to k windows: all start as partitions
with one filled slot, and the two partitions of the largest imbalance (fullest slot less emptiest) are merged again
and again, fullest slots against emptiest ones, until one partition is left.  k starts at the least number that can
hold the tokens and rises whenever the fullest window exceeds the capacity.  Nothing is shuffled, and a task holds one batch.

Defined cases: a null or empty text gives its end id alone; strings of the vocabulary's added tokens become those tokens; repeated rows and null ids are packed like any other; an
empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.byte_bpe import encoder
from riskloom.llm.common import give_back, read, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY, END_ID, PIECE, BATCH = 2048, 1, 512, 1024


def merged(a: list, b: list, k: int) -> list:
    """Slots of two partial partitions, the fullest of one put with the emptiest of the other.

    A partition is a list of (sum, tie, content) in ascending order; slots that it lacks up to k are empty.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(b) == 1:
        # The common case: one slot goes into the emptiest of a.
        if len(a) < k:
            insort(a, b[0])
        else:
            low, one = a.pop(0), b[0]
            insort(a, (low[0] + one[0], min(low[1], one[1]), (low[2], one[2])))
        return a
    spare = max(0, len(a) + len(b) - k)
    # The emptiest ``spare`` slots of a meet those of b that find no empty slot, the fullest with the emptiest.
    pairs = zip(a[:spare], reversed(b[:spare]), strict=True)
    both = [(x[0] + y[0], min(x[1], y[1]), (x[2], y[2])) for x, y in pairs]
    return sorted(both + a[spare:] + b[spare:])


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in k groups of near-equal sums; groups that stay empty are left out."""
    heap = [(-s if k > 1 else 0, i, [(s, i, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a = heapq.heappop(heap)
        _, _, b = heap[0]
        slots = merged(a, b, k)
        gap = slots[-1][0] - (slots[0][0] if len(slots) == k else 0)
        heapq.heapreplace(heap, (-gap, tie, slots))
    groups = []
    for _, _, content in heap[0][2] if heap else []:
        flat, stack = [], [content]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                flat.append(x)
        groups.append(sorted(flat))
    return groups


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of indices, none of which exceeds the capacity; the count of windows rises until that holds."""
    if any(s > capacity for s in sizes):
        raise ValueError("a piece exceeds the capacity")
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        groups = differencing(sizes, k)
        most = max((sum(sizes[i] for i in g) for g in groups), default=0)
        if most <= capacity:
            return groups
        k += max(1, k * (most - capacity) // (4 * capacity))


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then near-equal pieces of the rest."""
    whole = n // capacity * capacity
    out = [(s, capacity) for s in range(0, whole, capacity)]
    rest = n - whole
    if rest:
        parts = -(-rest // piece)
        edges = [whole + rest * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID, piece: int = PIECE, batch: int = BATCH) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``; ids are little-endian uint32 bytes.

    The windows of one task have consecutive numbers above its own number times 2^36.
    """
    if not 0 < piece <= capacity:
        raise ValueError((piece, capacity))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, next_id = encoder(path), TaskContext.get().partitionId() << 36
        id_type = None
        waiting: list[tuple] = []

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True))
            kinds = [id_type, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        def dealt() -> list[tuple]:
            nonlocal next_id
            out = []
            for group in windows([w[2] for w in waiting], capacity):
                offset = 0
                for i in group:
                    doc, start, length, n, ids = waiting[i]
                    out.append((doc, start, length, n, next_id, offset, ids))
                    offset += length
                next_id += 1
            waiting.clear()
            return out

        for b in slices(batches):
            id_type, out = b.schema.field(0).type, []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = enc.encode_added(text) + end
                n = len(ids) // 4
                for start, length in cuts(n, capacity, piece):
                    own = ids[4 * start : 4 * (start + length)]
                    if length == capacity:
                        out.append((doc, start, length, n, next_id, 0, own))
                        next_id += 1
                    else:
                        waiting.append((doc, start, length, n, own))
                        if len(waiting) >= batch:
                            out += dealt()
                if len(out) > 4096:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
        if waiting:
            yield rows(dealt())
        give_back()

    taken = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return taken.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(read(spark, sf_dir, "documents")))


QUERIES = {"op9_packing": query}
ORACLE: dict[str, str] = {}
