"""Language by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte 1- to 3-grams, normalised to length
one. Document frequencies count all training rows. The centroids of a language
are fitted by spherical k-means on at most `sample_rows` of its training rows,
those with the smallest hash of their id. A text goes to the centroid with the
greatest cosine; beyond the distance that nearly all training rows of that
centroid keep, it is marked as rejected.

Defined cases: a null text or one without a letter is `und` with score 0, as is
every text if nothing was learned. Rows whose language or text is null teach
nothing. Equal cosines go to the first language by name. Repeated rows are
predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.storage import small
from ticketlens.llm.textblocks import LOWER, blocks
from ticketlens.session import materialize

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """`bits`: hashed features are 2 ** bits. `sample_rows`: bound of the rows per language that fit its centroids."""

    bits: int = 12
    sample_rows: int = 1_000
    centroids: int = 4
    rounds: int = 12
    reject_quantile: float = 0.999
    reject_slack: float = 1.25


@dataclass
class Model:
    languages: list[str]
    of_centroid: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray
    settings: Settings


#: ASCII letters in lower case; bytes beyond ASCII stay; all else is a blank.
_LETTERS = np.where(
    (np.arange(256) >= 128) | ((LOWER >= ord("a")) & (LOWER <= ord("z"))), LOWER, np.uint8(ord(" "))
).astype(np.uint8)


def gram_counts(texts: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix of counts: rows x 2 ** bits) for each block of texts."""
    width, shift = 1 << bits, np.uint32(32 - bits)
    for block in blocks(texts, 1 << 20, 512):
        clean = _LETTERS[block.data]
        row = np.repeat(np.arange(block.rows, dtype=np.int64), np.diff(block.bounds))
        keep = np.ones(len(clean), dtype=bool)
        keep[1:] = (clean[1:] != 32) | (clean[:-1] != 32) | (row[1:] != row[:-1])
        code, row = clean[keep].astype(np.uint32), row[keep]
        total = np.zeros(block.rows * width, dtype=np.int64)
        gram = np.zeros(len(code), dtype=np.uint32)
        for n in (1, 2, 3):
            if len(code) < n:
                break
            gram = (gram[: len(code) - n + 1] << np.uint32(8)) | code[n - 1 :]
            same = row[: len(gram)] == row[n - 1 :]
            cell = ((gram + np.uint32(n * 0x51ED270B)) * np.uint32(0x9E3779B1)) >> shift
            total += np.bincount(row[: len(gram)][same] * width + cell[same], minlength=len(total))
        yield block.first, total.reshape(block.rows, width)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts).astype(np.float32) * idf
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def document_frequencies(train: DataFrame, text: str, bits: int) -> tuple[np.ndarray, int]:
    """In how many of all training rows each feature occurs, and their number; at most 2 ** bits rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, counts in gram_counts(batch.column(0), bits):
                found += (counts > 0).sum(axis=0)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], rows), pa.int64())], ["cell", "n"]
        )

    sums = train.select(F.col(text).alias("text")).mapInArrow(count, "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n")
    )
    frequency, rows = np.zeros(1 << bits, dtype=np.int64), 0
    for cell, n in sums.collect():
        if cell < 0:
            rows = n
        else:
            frequency[cell] = n
    return frequency, rows


def fit_centroids(points: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out first points; the centroids and the distance that nearly all their rows keep."""
    centres = [points.mean(axis=0)]
    while len(centres) < min(settings.centroids, len(points)):
        nearest = (points @ np.array(centres).T).max(axis=1)
        centres.append(points[int(np.argsort(nearest, kind="stable")[len(points) // 20])])
    centres = np.array(centres, dtype=np.float32)
    for _ in range(settings.rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        near = (points @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = points[near == k].mean(axis=0)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    cosine = points @ centres.T
    near, distance = cosine.argmax(axis=1), 1 - cosine.max(axis=1)
    radius = [np.quantile(distance[near == k], settings.reject_quantile) if (near == k).any() else 0.0 for k in range(len(centres))]
    return centres, np.array(radius) * settings.reject_slack


def fit(train: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> Model:
    """Learn from all rows of `train` with a language and a text."""
    rows = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    frequency, n = document_frequencies(rows, text, settings.bits)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    # the rows that fit the centroids: a bounded number of ids per language, found without their texts
    place = F.row_number().over(Window.partitionBy("lang").orderBy("digest", "doc_id"))
    chosen = rows.select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id)).alias("digest"), F.col(doc_id).alias("doc_id"))
    chosen = materialize(chosen.withColumn("place", place).filter(F.col("place") <= settings.sample_rows).drop("place", "digest").distinct())
    own = rows.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = own.join(small(chosen), ["doc_id", "lang"], "left_semi").select("doc_id", "lang", "text")

    def to_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts in gram_counts(batch.column("text"), settings.bits):
                packed = [row.tobytes() for row in vectors(counts, idf)]
                part = batch.slice(first, len(packed))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), pa.array(packed, pa.binary())], ["doc_id", "lang", "vector"]
                )

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["doc_id", "vector"], kind="stable").iloc[: settings.sample_rows]
        points = np.stack([np.frombuffer(v, dtype=np.float32) for v in ordered["vector"]])
        centres, radius = fit_centroids(points, settings)
        return pd.DataFrame({
            "lang": ordered["lang"].iloc[0], "centroid": range(len(centres)),
            "vector": [c.astype(np.float32).tobytes() for c in centres], "radius": radius,
        })

    id_type = dict(own.dtypes)["doc_id"]
    packed = sample.mapInArrow(to_vectors, f"doc_id {id_type}, lang string, vector binary")
    fitted = packed.groupBy("lang").applyInPandas(cluster, "lang string, centroid int, vector binary, radius double")
    found = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centroid"]))
    languages = sorted({r["lang"] for r in found})
    return Model(
        languages, np.array([languages.index(r["lang"]) for r in found], dtype=np.int64),
        np.array([np.frombuffer(r["vector"], dtype=np.float32) for r in found]).reshape(len(found), 1 << settings.bits),
        np.array([r["radius"] for r in found]), idf, settings,
    )


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns, lang_pred, score (the cosine) and rejected, for each row."""
    kept = docs.select(
        *[F.col(c) for c in keep], F.col(text).alias("__text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"),
    )
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = batch.column("__letter").to_numpy(zero_copy_only=False)
            for first, counts in gram_counts(batch.column("__text"), model.settings.bits):
                rows = len(counts)
                known = letter[first : first + rows] & (len(model.languages) > 0)
                cosine = np.zeros((rows, 1), dtype=np.float32)
                if len(model.languages):
                    cosine = vectors(counts, model.idf) @ model.centroids.T
                near = cosine.argmax(axis=1)
                best = np.clip(cosine[np.arange(rows), near].astype(np.float64), 0, 1)
                which = np.full(rows, len(model.languages))
                far = np.ones(rows, dtype=bool)
                if len(model.languages):
                    which = np.where(known, model.of_centroid[near], which)
                    far = 1 - best > model.radius[near]
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in keep], pa.array(names[which], pa.string()),
                        pa.array(np.where(known, best, 0.0)), pa.array(far | ~known),
                    ],
                    [*keep, "lang_pred", "score", "rejected"],
                )

    types = dict(kept.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], "lang_pred string, score double, rejected boolean"])
    return kept.mapInArrow(score, schema)
