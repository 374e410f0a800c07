"""Quality of documents by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm.common import fresh, text_bytes, text_slices

GRAMS, SHAPES, KINDS, CONCENTRATION = 2048, 512, 8, 1024
#: Weight of the three blocks of a vector: byte trigrams, character shapes, concentration.
BLOCK_WEIGHTS = (1.0, 1.0, 0.7)


def _kinds() -> np.ndarray:
    """Character kind of every byte: upper, lower, beyond ASCII, digit, space, line end, stop, other."""
    kind = np.full(256, 7, np.uint32)
    kind[ord("A") : ord("Z") + 1], kind[ord("a") : ord("z") + 1], kind[128:], kind[ord("0") : ord("9") + 1] = 0, 1, 2, 3
    kind[[32, 9]], kind[[10, 11, 12, 13]], kind[[ord(c) for c in ".,;:"]] = 4, 5, 6
    return kind


_KIND = _kinds()


def _grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n bytes from each place on (the last n - 1 places wrap into following texts)."""
    h = np.zeros(len(values), np.uint32)
    padded = np.concatenate([values, np.zeros(n, values.dtype)])
    for i in range(n):
        h = (h + padded[i : i + len(values)] + np.uint32(1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h


def features(texts: pa.Array, block: int = 512) -> Iterator[np.ndarray]:
    """Raw feature rows of whole texts, some texts at a time: 2048 + 512 counts and one concentration.

    Trigrams of bytes and triples of character kinds are counted in hashed bins. Concentration says
    how much more often two random eight-byte pieces of a text agree than in plain text.
    """
    for at in range(0, len(texts), block):
        part = texts.slice(at, block)
        values, edges = text_bytes(part)
        owner = np.repeat(np.arange(len(part), dtype=np.int64), np.diff(edges))
        rest = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(values))  # bytes from here to the text's end

        def counted(bins: np.ndarray, width: int, need: int, owner=owner, rest=rest, n=len(part)) -> np.ndarray:
            inside = rest >= need
            return np.bincount(owner[inside] * width + bins[inside], minlength=n * width).reshape(n, width)

        kind = _KIND[values]
        padded = np.concatenate([kind, np.zeros(2, np.uint32)])
        shape = (kind * KINDS + padded[1:-1]) * KINDS + padded[2:]
        eight = counted((_grams(values, 8) >> np.uint32(22)).astype(np.int64), CONCENTRATION, 8).astype(np.float64)
        n = eight.sum(1)
        agree = (eight * (eight - 1)).sum(1) / np.maximum(n * (n - 1), 1)
        out = np.empty((len(part), GRAMS + SHAPES + 1), np.float32)
        out[:, :GRAMS] = counted((_grams(values, 3) >> np.uint32(21)).astype(np.int64), GRAMS, 3)
        out[:, GRAMS:-1] = counted(shape.astype(np.int64), SHAPES, 3)
        out[:, -1] = np.log2(1 + agree * CONCENTRATION)
        yield out


@dataclass
class Voters:
    """Labelled vectors and what makes others comparable with them; its size is bounded by the sample."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    prior: float

    def weighted(self, raw: np.ndarray) -> np.ndarray:
        return weighted(raw, self.idf)

    def score(self, raw: np.ndarray) -> np.ndarray:
        """Similarity-weighted vote of the nearest labelled vectors, from all cosine products.

        A vote weighs the eighth power of its similarity; a little of the share of label 1 settles
        texts that resemble nothing. Products are in double precision and the score is rounded, so
        that it doesn't depend on the other texts of a block.
        """
        if not len(self.labels):
            return np.full(len(raw), self.prior)
        vectors = unit(self.weighted(raw) @ self.directions.astype(np.float64))
        cosine = vectors @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, nearest, 1), 0) ** 8
        votes = (weight * self.labels[nearest]).sum(1)
        return np.round((votes + 0.01 * self.prior) / (weight.sum(1) + 0.01), 9)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Blocks of unit length: damped counts by rarity, damped shapes, concentration as an angle."""
    raw = raw.astype(np.float64)
    grams = unit(np.log1p(raw[:, :GRAMS]) * idf) * BLOCK_WEIGHTS[0]
    shapes = unit(np.sqrt(raw[:, GRAMS:-1])) * BLOCK_WEIGHTS[1]
    angle = np.minimum(raw[:, -1:] / 8, 1) * (np.pi / 2)
    return np.concatenate([grams, shapes, np.cos(angle) * BLOCK_WEIGHTS[2], np.sin(angle) * BLOCK_WEIGHTS[2]], 1)


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text leaves 0; a null id counts as an empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4096, dims: int = 64, neighbours: int = 15, seed: int = 5) -> Voters:
    """Voters from at most ``sample`` labelled documents that aren't held out.

    The sample is a documented bound: the labelled ids with the smallest MD5. Its ids are broadcast
    (``sample`` numbers at most), so documents are scanned, not shuffled. Rows with a null id or a
    label other than 0 and 1 teach nothing, of ids labelled twice the first by label counts, and of
    documents that share an id the text with the smallest MD5. Without any label the score is 0.5.

    Latent directions come from a randomised singular value decomposition of the sample's vectors.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_label")).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[bytes, int, bytes]] = {}  # digest, label and features by id
        for batch, texts in text_slices(batches, "text"):
            ids, given = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "_label"))
            values, edges = text_bytes(texts)
            better: dict[int, tuple[bytes, int]] = {}
            for i, key in enumerate(ids):
                digest = hashlib.md5(values[edges[i] : edges[i + 1]]).digest()
                held = better.get(key) or best.get(key)
                if held is None or digest < held[0]:
                    better[key] = (digest, i)
            if better:
                raw = np.concatenate(list(features(texts.take(pa.array([i for _, i in better.values()])))))
                best |= {key: (digest, given[i], r.tobytes()) for (key, (digest, i)), r in zip(better.items(), raw, strict=True)}
        columns = [pa.array(list(best), pa.int64()), *(pa.array([x[i] for x in best.values()], kind) for i, kind in enumerate((pa.binary(), pa.int32(), pa.binary())))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "label", "raw"])

    # A task leaves one row an id, so that few are shuffled and at most ``sample`` reach the driver.
    each = rows.mapInArrow(measure, "doc_id long, digest binary, label int, raw binary").groupBy("doc_id")
    table = each.agg(F.min("label").alias("label"), F.min_by("raw", "digest").alias("raw")).toArrow().sort_by("doc_id")
    y = table.column("label").to_numpy().astype(np.float32)
    if not len(y):
        return Voters(np.ones(GRAMS), np.zeros((0, 0)), np.zeros((0, 0)), y, neighbours, 0.5)
    raw = np.frombuffer(b"".join(table.column("raw").to_pylist()), np.float32).reshape(len(y), -1)
    idf = (np.log((1 + len(y)) / (1 + (raw[:, :GRAMS] > 0).sum(0))) + 0.1).astype(np.float32)
    blocks = [raw[i : i + 512] for i in range(0, len(raw), 512)]
    x = np.concatenate([weighted(b, idf).astype(np.float32) for b in blocks])
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(x @ rng.standard_normal((x.shape[1], min(dims + 16, len(y))), np.float32))[0]
    for _ in range(3):
        q = np.linalg.qr(x @ np.linalg.qr(x.T @ q)[0])[0]
    directions = np.linalg.svd(q.T @ x, full_matrices=False)[2][:dims].T.astype(np.float32)
    return Voters(idf, directions, np.concatenate([unit(weighted(b, idf) @ directions.astype(np.float64)) for b in blocks]), y, neighbours, float(y.mean()))


def score_quality(docs: DataFrame, voters: Voters, column: str = "score") -> DataFrame:
    """The rows with the quality score (0 to 1) of their whole text; null counts as empty.

    The voters are broadcast (at most a few MB by the sample's bound). A task holds one slice of
    text and, for 512 texts at a time, their features and products with all voters. Repeated rows
    give repeated rows, an empty table an empty one; no other column plays a part in the score.
    """
    rows = docs.withColumn(column, F.lit(0.0))
    names = rows.columns
    # A broadcast is pickled by reference, so it holds plain values; the class travels with the function.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(getattr(voters, f.name) for f in fields(Voters)))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Voters(*sent.value)
        for batch, texts in text_slices(batches, "text"):
            scores = np.concatenate([model.score(raw) for raw in features(texts)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.clip(scores, 0, 1), pa.float64())], names=names)

    return rows.mapInArrow(vote, rows.schema)


def classify_quality(docs: DataFrame, labels: DataFrame, at: float = 0.3, **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 if the score is at least ``at``) of every document."""
    scored = score_quality(docs.select("doc_id", "text"), fit(docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, at: float = 0.3, **options) -> DataFrame:
    """The documents whose predicted quality is 1, with all their columns."""
    score = fresh(docs, "_score")
    return score_quality(docs, fit(docs, labels, **options), score).filter(F.col(score) >= at).select(*docs.columns)
