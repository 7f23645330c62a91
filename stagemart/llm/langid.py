"""Language identification: the nearest of several centroids per language, by cosine of hashed TF-IDF n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagemart.llm.shipping import session_of
from stagemart.llm.words import ALPHANUMERIC, LOWER, Block, blocks

UNKNOWN = "und"
BLOCK_ROWS = 512
_SHARES = 1 << 40
_SIZES = 64
_LETTER = ALPHANUMERIC.copy()
_LETTER[0x30:0x3A] = False
#: Letters keep their byte, all else is one gap.
_FOLDED = np.where(_LETTER, LOWER, 0).astype(np.uint32)


@dataclass(frozen=True)
class LanguageOptions:
    """``sample_per_language`` bounds the labelled texts that the centroids are fitted to: those of the least
    hashes of id and text, a repeated row once; document frequencies count all labelled texts. A text is rejected when its
    cosine is under ``slack`` times the least that any sampled text of about its number of n-grams, or
    more, had; texts with fewer n-grams than any sampled one are kept."""

    features: int = 4096
    centroids: int = 4
    sample_per_language: int = 400
    rounds: int = 12
    slack: float = 0.3
    max_languages: int = 1000


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray
    usual: int


def _counts(block: Block, features: int) -> np.ndarray:
    """Hashed counts of byte trigrams of letters with a gap before and after each text, a row a text.

    Two gaps in a row carry nothing and are not counted.
    """
    size = block.rows
    spread = np.zeros(len(block.data) + 2 * size, np.uint32)
    starts = block.offsets[:-1] + 2 * np.arange(size) + 1
    lengths = np.diff(block.offsets)
    row = np.repeat(np.arange(size), lengths)
    spread[np.arange(len(block.data)) + 2 * row + 1] = _FOLDED[block.data]
    first, second, third = spread[:-2], spread[1:-1], spread[2:]
    centre = np.repeat(starts - 1, lengths) + np.arange(len(block.data)) - np.repeat(block.offsets[:-1], lengths)
    gram = (first << np.uint32(16) | second << np.uint32(8) | third)[centre]
    told = (second[centre] > 0).nonzero()[0]
    hashed = (gram[told] * np.uint32(0x9E3779B1)) >> np.uint32(32 - features.bit_length() + 1)
    return np.bincount(row[told] * features + hashed, minlength=size * features).reshape(size, features)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    found = np.log1p(counts.astype(np.float32)) * idf
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    return np.divide(found, norm, out=found, where=norm > 0)


def _size(vectors: np.ndarray) -> np.ndarray:
    """Binary size class of the number of n-grams."""
    return np.ceil(np.log2(1 + (vectors > 0).sum(axis=1))).astype(np.int64)


def _clusters(points: np.ndarray, options: LanguageOptions) -> np.ndarray:
    """Spherical k-means; the first centroids are points far from one another."""
    chosen = [0]
    near = points @ points[0]
    for _ in range(min(options.centroids, len(points)) - 1):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, points @ points[chosen[-1]])
    centres = points[chosen].copy()
    for _ in range(options.rounds):
        nearest = np.argmax(points @ centres.T, axis=1)
        for index in range(len(centres)):
            if (nearest == index).any():
                centres[index] = points[nearest == index].sum(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def fit_languages(
    labelled: DataFrame, id_column: str, text_column: str, label_column: str, options: LanguageOptions = LanguageOptions()
) -> LanguageModel:
    """Learn from the rows of ``labelled`` that have a label; no row at all gives a model that knows no language."""
    rows = labelled.select(
        F.xxhash64(F.col(id_column), F.col(text_column).cast("binary")).alias("h"), F.col(text_column).cast("binary").alias("text"), F.col(label_column).cast("string").alias("label")
    ).where("label is not null")
    sizes = {row.label: row["count"] for row in rows.groupBy("label").count().limit(options.max_languages + 1).collect()}
    if len(sizes) > options.max_languages:
        raise ValueError(f"more than {options.max_languages} languages")
    session_of(labelled)
    features = options.features

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0), rows=BLOCK_ROWS):
                total += (_counts(block, features) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(features)), pa.array(total)], ["gram", "n"])

    per_gram = rows.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    seen = np.zeros(features)
    for row in per_gram.collect():
        seen[row.gram] = row.n
    total = sum(sizes.values())
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + 1

    # twice as many as wanted, of which the least hashes are taken, so that no more reach the driver
    shares = {label: min(_SHARES, -(-2 * options.sample_per_language * _SHARES // count)) for label, count in sizes.items()}
    wanted = F.lit(0)
    for label, share in shares.items():
        wanted = F.when(F.col("label") == label, F.lit(share)).otherwise(wanted)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0), rows=BLOCK_ROWS):
                found = _vectors(_counts(block, features), idf)
                labels = batch.column(1).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([labels, pa.array([row.tobytes() for row in found], pa.binary())], ["label", "vector"])

    drawn = rows.where(F.pmod("h", F.lit(_SHARES)) < wanted).groupBy("label", "h").agg(F.min("text").alias("text"))
    least_first = Window.partitionBy("label").orderBy(F.pmod("h", F.lit(_SHARES)), "h")
    drawn = drawn.withColumn("nth", F.row_number().over(least_first)).where(F.col("nth") <= options.sample_per_language)
    chosen = drawn.select("text", "label").mapInArrow(sampled, "label string, vector binary")
    points: dict[str, list[np.ndarray]] = {}
    for row in chosen.collect():
        vector = np.frombuffer(row.vector, np.float32)
        if vector.any():
            points.setdefault(row.label, []).append(vector)
    languages, centres, owner, least = sorted(points), [], [], np.full(_SIZES, np.inf)
    for index, label in enumerate(languages):
        own = np.stack(sorted(points[label], key=lambda vector: vector.tobytes()))
        found = _clusters(own, options)
        centres.append(found)
        owner += [index] * len(found)
        np.minimum.at(least, _size(own), options.slack * (own @ found.T).max(axis=1))
    smallest = np.isfinite(least).nonzero()[0][:1]
    least = np.minimum.accumulate(least[::-1])[::-1]
    least[: smallest[0] if len(smallest) else _SIZES] = 0
    least[~np.isfinite(least)] = least[np.isfinite(least)].max(initial=0)
    usual = max(range(len(languages)), key=lambda index: sizes[languages[index]], default=-1)
    return LanguageModel(
        languages, idf, np.concatenate(centres) if centres else np.zeros((0, features), np.float32), np.array(owner, np.int64), least, usual
    )


def identified(documents: DataFrame, text: Column, model: LanguageModel) -> Column:
    """A struct (lang, score, rejected) for each text, of its whole content and nothing else.

    ``lang`` is a learned label, or ``und`` for a text that is null or has no letter, and for all
    texts under a model that knows no language; those score 0 and are rejected. ``score`` is the
    cosine to the nearest centroid, 0 to 1. ``rejected`` marks a text farther off than any sampled
    text of its size by the slack. Of equal cosines the first label in order wins. A text
    whose letters form no n-gram gets the most frequent label with score 0 and is rejected.
    """
    shared = session_of(documents).sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, rejected boolean")
    def nearest(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        for column in texts:
            labels: list[str] = []
            scores, rejected = [np.zeros(0)], [np.zeros(0, bool)]
            for block in blocks(column, rows=BLOCK_ROWS):
                found = _vectors(_counts(block, len(held.idf)), held.idf)
                near = found @ held.centroids.T
                best = np.argmax(near, axis=1)
                score = np.clip(near[np.arange(len(near)), best].astype(np.float64), 0, 1)
                own = np.where(score > 0, held.owner[best], held.usual)
                labels += [held.languages[index] for index in own]
                scores.append(score)
                rejected.append((score <= 0) | (score < held.least[_size(found)]))
            yield pa.StructArray.from_arrays(
                [pa.array(labels, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(rejected))], ["lang", "score", "rejected"]
            )

    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.languages:
        return none
    told = F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))
    found = nearest(F.when(told, text.cast("binary")))
    return F.when(told, found).otherwise(none)


def identify_languages(
    documents: DataFrame,
    learn_from: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    options: LanguageOptions = LanguageOptions(),
    output: str = "language",
) -> DataFrame:
    """``documents`` with a struct column ``output``, see :func:`identified`; learns where ``learn_from`` holds.

    Labels and ids of a row take no part in its prediction. Repeated rows get the same answer each; null and empty texts are
    ``und``; whole texts are read, however long; an empty table gives an empty one. A column named ``output`` raises ValueError;
    other columns pass through.
    """
    if output in documents.columns:
        raise ValueError(f"there is a column {output} already")
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label"), learn_from.alias("learn")
    )
    model = fit_languages(rows.where("learn"), "id", "text", "label", options)
    return documents.withColumn(output, identified(documents, F.col(text_column), model))
