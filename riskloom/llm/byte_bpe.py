"""Byte-level BPE: overlapping chunk encoding, and decoding by concatenated bytes.

A text becomes rows of overlapping chunks (one of up to ``long_chars`` characters is a single chunk and encoded where it is read), which tasks pre-tokenise independently of each other; a chunk that starts inside a pre-token yields wrong
borders at first, so neighbouring chunks are stitched at the first border after a non-space character that both found
in their overlap (without one, the left chunk is read on until it meets one).  The pre-tokens are then encoded, each by itself.

Defined cases: a null text is empty and gives no ids; special tokens' strings are ordinary text; repeated rows and null
ids keep their rows; an empty table gives no rows; only the named columns are looked at.
"""

from __future__ import annotations

import base64
import bisect
import functools
import json

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import read, slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters of a chunk and of its overlap with the next one, and the length up to which a text is one chunk.
CHUNK, OVERLAP, LONG = 8_192, 256, 8_192
#: Pre-tokens whose ids a worker remembers, the latest used, and their longest length.
KNOWN, KNOWN_CHARS = 65_536, 32
_loaded: dict[str, "Encoder"] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in JSON vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_added(path: str) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` JSON file with their ids; a rank file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens are only matched as they stand")
    return {x["content"]: x["id"] for x in added}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a rank file or from a ``tokenizers`` JSON file of a byte-level BPE, without added tokens."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added, of = {x["content"] for x in spec.get("added_tokens", [])}, byte_alphabet()
        return {bytes(of[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in added}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Encodes texts; ids are kept as little-endian uint32 bytes."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        ranks = load_ranks(path)
        self.exact = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # The look-ahead only matters where two white spaces meet; without it the pattern runs far faster.
        plain = pattern.replace(r"|\s+(?!\S)", "")
        self.plain = self.exact if plain == pattern else tiktoken.Encoding("byte-bpe-plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        # White space is spelled out, for the two pattern engines differ on control characters.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.bytes_of[v] = k
        self.known = functools.lru_cache(KNOWN)(self.encode)
        self.added = load_added(path)
        # Of those that start at the same place the longest matches.
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def encode(self, text: str) -> bytes:
        """Ids of a text as bytes.  White spaces stand alone if they number one less than the words between them."""
        words = text.split()
        alone = len(text) - sum(map(len, words)) == len(words) - 1
        return np.array((self.plain if alone else self.exact).encode_ordinary(text), dtype="<u4").tobytes()

    def encode_added(self, text: str) -> bytes:
        """Ids of a text in which the strings of added tokens are these tokens."""
        if self.split is None or not any(x in text for x in self.added):
            return self.encode(text)
        parts = self.split.split(text)
        return b"".join([np.array([self.added[p]], dtype="<u4").tobytes() if i % 2 else self.encode(p) for i, p in enumerate(parts)])

    def encode_pieces(self, text: str, ends: list[int]) -> bytes:
        """Ids of a text cut into its pre-tokens, which end at ``ends``; those of KNOWN_CHARS and less are remembered."""
        pieces = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return b"".join([self.known(p) if len(p) <= KNOWN_CHARS else self.encode(p) for p in pieces])

    def borders(self, text: str) -> list[int]:
        """Ends of the pre-tokens of a text read from its start."""
        return [m.end() for m in self.pattern.finditer(text)]

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


def encoder(path: str = RANKS) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def marked(ends: list[int], length: int) -> bytes:
    """Borders as a bit for each character that ends a pre-token: an eighth of the text, where numbers would be nearly its size."""
    bits = np.zeros(length, dtype=np.uint8)
    bits[np.array(ends, dtype=np.int64) - 1] = 1
    return np.packbits(bits).tobytes()


def unmarked(bits: bytes) -> list[int]:
    return (np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8))) + 1).tolist()


def stitch(text: str, chunk: int, overlap: int, found: list[list[int]], borders) -> list[int]:
    """Ends of the pre-tokens of the whole text, from those of its chunks; found[i] are offsets within chunk i.

    ``borders(text)`` reads on where an overlap has no common border.
    """
    mine, i, far = list(found[0]), 1, 1
    whole: list[int] = []
    while i < len(found):
        start = i * chunk
        theirs = [start + x for x in found[i]]
        end_mine = min(len(text), start + overlap)
        known = set(theirs[: bisect.bisect_left(theirs, end_mine)])
        meet = next((p for p in mine[bisect.bisect_right(mine, start) :] if p in known and not text[p - 1].isspace()), None)
        if meet is None:
            # Read on from the last sure border, through this chunk's end; it becomes the left side of the next overlap.  Each time
            # that fails again twice as many chunks are read, so the reading stays in proportion to the text.
            begin = whole[-1] if whole else 0
            i += far
            mine = [begin + x for x in borders(text[begin : min(len(text), i * chunk + overlap)])]
            far *= 2
            continue
        far = 1
        whole += mine[: bisect.bisect_right(mine, meet)]
        mine = theirs[bisect.bisect_right(theirs, meet) :]
        i += 1
    return whole + mine


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP, long_chars: int = LONG) -> DataFrame:
    """``(id_col, ids array<int>)``, a row for each row of ``docs``."""
    if not 0 < overlap <= chunk <= long_chars:
        raise ValueError((overlap, chunk, long_chars))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {kind}, ids array<int>"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches):
            parts = [enc.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype("int32")
            flat = np.frombuffer(b"".join(parts), dtype="<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["id", "ids"])

    def pre_tokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for df in frames:
            df["ends"] = [marked(enc.borders(t), len(t)) for t in df["piece"]]
            yield df

    def join_up(df: pd.DataFrame) -> pd.DataFrame:
        enc = encoder(path)
        df = df.sort_values("at")
        whole = "".join([t[:chunk] for t in df["piece"]])
        ends = stitch(whole, chunk, overlap, [unmarked(x) for x in df["ends"]], enc.borders)
        return pd.DataFrame({"id": [df["id"].iloc[0]], "ids": [np.frombuffer(enc.encode_pieces(whole, ends), dtype="<i4")]})

    brief = rows.where(F.length("text") <= long_chars).mapInArrow(short, schema)
    cut = rows.where(F.length("text") > long_chars).withColumn("row_no", F.monotonically_increasing_id())
    cut = cut.withColumn("at", F.explode(F.expr(f"sequence(0, cast((length(text) - 1) div {chunk} as int))")))
    cut = cut.select("id", "row_no", "at", F.expr(f"substring(text, at * {chunk} + 1, {chunk + overlap})").alias("piece")).repartition("row_no", "at")
    cut = cut.mapInPandas(pre_tokenise, f"id {kind}, row_no long, at int, piece string, ends binary")
    return brief.unionByName(cut.groupBy("row_no").applyInPandas(join_up, schema)).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str = RANKS) -> DataFrame:
    """``encoded`` with a binary column ``decoded`` at the end: the bytes of the ids, concatenated."""
    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    at = [f.name for f in fields].index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches):
            out = [None if x is None else enc.decode(x.values.to_numpy(zero_copy_only=False)) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.select(*[f.name for f in fields]).mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", decoded binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decode(encode(read(spark, sf_dir, "documents")))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op6_byte_bpe": query}
ORACLE: dict[str, str] = {}
