"""Language identification by the nearest of several centroids per language.

A text is its vector of hashed byte trigrams (lower case, whatever isn't a letter taken as one space), weighted by log(1 + tf) * idf and of length
one.  Document frequencies are counted over all training documents.  Spherical k-means on a bounded sample of them (at
most ``fit_rows`` rows, dealt to the languages evenly by a hash of the id; of more languages than that, the first by name) gives each language a few centroids.  A text gets the language of the
centroid of greatest cosine, and is rejected where its distance 1 - cosine exceeds the radius: the quantile ``share`` of the
distances that the first ``CUT`` characters of the sample's texts have to their own language.  Short cuts are farther off than whole texts, so clean
texts stay however short they are, while words of other languages, farther still, go at any length.  Noise meets more trigrams the
longer it is, so a text of ``RICH`` different trigrams and more has a radius of its own: the same quantile of the sample's whole texts that
are as rich, and half of what is left up to 1.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; no labelled training rows
make every text ``und``; a null label doesn't train; repeated rows and null ids are predicted each (a null id isn't
held out and doesn't train); an empty table gives no rows; whole texts count, of any length; columns that aren't named don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskloom.llm.common import give_back, read, slices

DIMENSIONS = 8192  # a power of two
FIT_ROWS, CENTROIDS, ROUNDS, CUT, SHARE, RICH = 2000, 6, 12, 12, 0.99, 256
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


#: ASCII letters and the bytes of all other characters stay, the rest becomes a space.
KEPT = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8)


def counts(text: str) -> np.ndarray:
    """How often each hashed byte trigram occurs."""
    b = KEPT[np.frombuffer(f"  {text.lower()} ".encode(), dtype=np.uint8)]
    b = b[1:][(b[1:] != 32) | (b[:-1] != 32) | (np.arange(len(b) - 1) == 0)].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMENSIONS, dtype=np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1), minlength=DIMENSIONS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors, a row for each text; a text without any trigram known to idf has a zero row."""
    out = np.empty((len(texts), DIMENSIONS), dtype=np.float32)
    for i, t in enumerate(texts):
        out[i] = counts(t)
    np.log1p(out, out=out)
    out *= idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=out, where=norm > 0)


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    radius: np.ndarray  # the greatest accepted distance
    rich_radius: float = 1.0  # the same for texts of many different trigrams

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        label, score, accepted = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        at = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if at and len(self.languages):
            x = vectors([texts[i] for i in at], self.idf)
            cosine, rich = x @ self.centroids.T, np.count_nonzero(x, axis=1) >= RICH
            best = cosine.argmax(axis=1)
            score[at] = np.clip(cosine[np.arange(len(at)), best], 0, 1)
            accepted[at] = 1 - score[at] <= np.where(rich, self.rich_radius, self.radius[best])
            for i, b in zip(at, best, strict=True):
                label[i] = self.languages[b]
        return label, score, accepted


def spherical_kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Unit centroids; the start takes the row least like those taken so far, so the result is determined."""
    mean = x.sum(axis=0)
    start = [int((x @ mean).argmax())]
    while len(start) < min(k, len(x)):
        start.append(int((x @ x[start].T).max(axis=1).argmin()))
    c = x[start]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many of the texts each trigram occurs, and at the end the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                seen[:-1] += counts(t) > 0
                seen[-1] += 1
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["feature", "n"])

    total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in texts.mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        total[r["feature"]] = r["n"]
    return total


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS, k: int = CENTROIDS, share: float = SHARE) -> Model:
    """Learn from the rows of ``train`` that have a text with a label and an id."""
    spark = train.sparkSession
    rows = train.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    seen = document_frequencies(rows.select("text"))
    idf = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1).astype(np.float32)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(fit_rows).collect()}
    langs = sorted(sizes)
    each = max(1, fit_rows // max(1, len(langs)))
    # Ids below a hash limit, some three times as many as are wanted, are ranked; texts are then picked by a broadcast of
    # fit_rows ids at most.
    limits = spark.createDataFrame([(x, int(min(1.0, (3 * each + 50) / n) * (1 << 30))) for x, n in sizes.items()], "lang string, most long")
    low = rows.select("id", "lang").join(F.broadcast(limits), "lang").where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) <= F.col("most"))
    ranked = low.selectExpr("id", "lang", "row_number() over (partition by lang order by xxhash64(id), id) as r").where(F.col("r") <= each).select("id", "lang").distinct()
    picked = rows.join(F.broadcast(ranked), ["id", "lang"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            yield pd.DataFrame({"lang": df["lang"], "start": df["text"].str[:CUT], "v": [x.astype("<f2").tobytes() for x in vectors(df["text"].tolist(), idf)]})

    sample = picked.select("lang", "text").mapInPandas(run, "lang string, start string, v binary").collect()
    sample.sort(key=lambda r: (r["lang"], bytes(r["v"]), r["start"]))
    owner, centroids, short, long = [], [], [], []
    for lang in langs:
        x = np.array([np.frombuffer(r["v"], dtype="<f2") for r in sample if r["lang"] == lang], dtype=np.float32).reshape(-1, DIMENSIONS)
        x = x[np.abs(x).sum(axis=1) > 0]
        if not len(x):
            continue
        c = spherical_kmeans(x, k, ROUNDS)
        rich = np.count_nonzero(x, axis=1) >= RICH
        long.append(1 - (x[rich] @ c.T).max(axis=1))
        starts = vectors([r["start"] for r in sample if r["lang"] == lang], idf)
        short.append(1 - (starts[np.abs(starts).sum(axis=1) > 0] @ c.T).max(axis=1))
        owner += [lang] * len(c)
        centroids.append(c)
    far, far_rich = (np.concatenate(d) if d else np.zeros(0) for d in (short, long))
    radius = float(np.quantile(far, share)) if len(far) else 1.0
    rich_radius = (1 + float(np.quantile(far_rich, share))) / 2 if len(far_rich) else radius
    return Model(idf, owner, np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32), np.full(len(owner), radius), rich_radius)


def judged(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` as c0, c1 and so on, whatever their names, with ``lang_pred``, ``score`` and ``accepted``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    at, names = docs.columns.index(text_col), [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            label, score, accepted = sent.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(label, pa.string()), pa.array(score), pa.array(accepted)], names=[*names, "lang_pred", "score", "accepted"])
        give_back()

    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)]).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return docs.toDF(*names).mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted`` (columns of those names are replaced)."""
    made = ["lang_pred", "score", "accepted"]
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in made]
    return judged(docs, model, text_col).select(*[f"c{i}" for i in kept], *made).toDF(*[docs.columns[i] for i in kept], *made)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text isn't rejected, with all their columns and no others."""
    return judged(docs, model, text_col).where("accepted").select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


QUERIES = {"op2_language_id": query}
ORACLE: dict[str, str] = {}
