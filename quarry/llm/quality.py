"""Quality classifier (operator 6): nearest-neighbour voting over latent-semantic vectors.

A text is a bag of hashed terms of three kinds: its words, the shapes of its words (runs of
upper case, lower case, digits, other letters and each mark), and how often words repeat. The
kinds are weighted by inverse frequency and scaled by themselves, then a truncated singular
value decomposition of the labelled sample maps them to a few latent dimensions. The labelled
vectors (at most ``train_rows``, a documented bound of some hundred KB) are broadcast; every
document's cosines with all of them are computed in exact blocks, and the ``neighbours`` most
similar ones vote with their similarity to the power ``sharpness``.

Defined results: null and empty texts have no terms and get the sample's share of label 1;
without usable labels every score is 0.5 and ``passed`` keeps every document; a document with several labels counts once per label; rows
that repeat score alike; extra columns are carried along in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, held_out, mix, span_hashes, text_blocks, text_of, words

WORD_TERMS = 2048
SHAPE_TERMS = 1024
REPEAT_TERMS = 64
DIMENSIONS = 48
TRAIN_ROWS = 3_000
NEIGHBOURS = 25
SHARPNESS = 4
THRESHOLD = 0.7
_BLOCK = 256
_TERMS = WORD_TERMS + SHAPE_TERMS + REPEAT_TERMS
_KINDS = (slice(0, WORD_TERMS), slice(WORD_TERMS, WORD_TERMS + SHAPE_TERMS), slice(WORD_TERMS + SHAPE_TERMS, _TERMS))


def _classes() -> np.ndarray:
    """Letters by case, digits and bytes beyond ASCII as one class each; a mark is its own."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91], table[97:123], table[48:58], table[128:] = 1, 2, 3, 2
    return table


_CLASS = _classes()


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the hashed terms, a row per text of the block."""
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    out = np.zeros((n, _TERMS), np.float32)
    if not len(starts):
        return out
    hashes = span_hashes(data, starts, ends)
    # Shapes: classes with runs shortened to one byte.
    classes = _CLASS[data]
    first = np.ones(len(data), bool)
    first[1:] = classes[1:] != classes[:-1]
    first[starts] = True
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    keep = first & (np.cumsum(inside[:-1]) > 0)
    place = np.concatenate([[0], np.cumsum(keep)])
    shapes = span_hashes(classes[keep], place[starts], place[ends])
    key = owner * _TERMS
    flat = np.concatenate([
        key + (hashes % np.uint64(WORD_TERMS)).astype(np.int64),
        key + WORD_TERMS + (shapes % np.uint64(SHAPE_TERMS)).astype(np.int64),
        key + WORD_TERMS + SHAPE_TERMS + _repeat_bins(hashes, owner),
    ])
    return np.bincount(flat, minlength=n * _TERMS).reshape(n, _TERMS).astype(np.float32)


def _repeat_bins(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per word the octave of its share among its text's words, finer for short texts."""
    order = np.argsort(hashes ^ mix(owner.astype(np.uint64)), kind="stable")
    same = hashes[order] ^ mix(owner[order].astype(np.uint64))
    change = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    sizes = np.diff(np.concatenate([change, [len(same)]]))
    times = np.empty(len(order), np.int64)
    times[order] = np.repeat(sizes, sizes)
    total = np.bincount(owner)[owner]
    share = np.minimum((-2 * np.log2(times / total)).astype(np.int64), 7)
    length = np.minimum(np.log2(total).astype(np.int64) // 2, 7)
    return share * 8 + length


@dataclass
class Model:
    weights: np.ndarray  # inverse frequency of every term
    projection: np.ndarray  # terms by dimensions
    vectors: np.ndarray  # labelled texts by dimensions, of length one
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        v = weighted(counts, self.weights) @ self.projection
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS, sharpness: int = SHARPNESS) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        k = min(neighbours, len(self.vectors))
        for lo in range(0, len(counts), _BLOCK):
            part = counts[lo : lo + _BLOCK]
            cosines = self.latent(part) @ self.vectors.T
            top = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, top, 1), 0) ** sharpness
            total = votes.sum(1)
            some = total > 1e-12
            out[lo : lo + _BLOCK][some] = ((votes * self.labels[top]).sum(1) / np.maximum(total, 1e-12))[some]
        return np.clip(out, 0, 1)


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = np.log1p(counts)
    x *= weights
    for kind in _KINDS:
        x[:, kind] /= np.maximum(np.linalg.norm(x[:, kind], axis=1, keepdims=True), 1e-9)
    return x


def train(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    seen = (counts > 0).sum(0)
    weights = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + 1
    x = weighted(counts, weights)
    projection = _leading(x, min(dimensions, *x.shape))
    vectors = x @ projection
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Model(weights, projection, vectors, labels, float(labels.mean()))


def _leading(x: np.ndarray, d: int, more: int = 16, rounds: int = 8) -> np.ndarray:
    """The leading ``d`` right singular vectors, by iterating a subspace a little larger.

    Nothing as large as a product of ``x`` with itself is held.
    """
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(d + more, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    inner = x @ q
    values, turn = np.linalg.eigh(inner.T @ inner)
    return (q @ turn[:, np.argsort(-values)[:d]]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_column: str = "doc_id", text_column: str = "text") -> Model | None:
    """A model from at most ``train_rows`` labelled documents that are not held out."""
    marked = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
    order = F.xxhash64(F.col("id"), F.lit("train"))
    usable = marked.filter(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("id")))
    ids = usable.withColumn("order", order).orderBy("order", "id", "quality").limit(train_rows)
    texts = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text")).join(F.broadcast(ids), "id")

    def count(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(2)):
                found = terms(data, offsets)
                rows, columns = np.nonzero(found)
                cuts = np.searchsorted(rows, np.arange(hi - lo + 1)).astype(np.int32)
                listed = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(v)) for v in (columns.astype(np.int32), found[rows, columns])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *listed], ["order", "quality", "terms", "counts"]
                )

    counted = texts.select("order", "quality", "text").mapInArrow(count, "order long, quality int, terms array<int>, counts array<float>")
    found = counted.orderBy("order", "quality").limit(train_rows).toArrow().combine_chunks()
    if not found.num_rows:
        return None
    counts = np.zeros((found.num_rows, _TERMS), np.float32)
    sizes = pc.list_value_length(found["terms"]).to_numpy()
    counts[np.repeat(np.arange(found.num_rows), sizes), pc.list_flatten(found["terms"]).to_numpy()] = pc.list_flatten(found["counts"]).to_numpy()
    return train(counts, found["quality"].to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model | None, text_column: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Every row as ``row`` with score and predicted."""
    source = docs.select(carried(keep), text_of(text_column).alias("text"))
    if model is None:
        scored = source.select("row", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            for batch in batches:
                out = np.zeros(batch.num_rows)
                for lo, hi, data, offsets in text_blocks(batch.column(1)):
                    out[lo:hi] = shared.value.scores(terms(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["row", "score"])

        scored = source.mapInArrow(run, source.select("row", F.lit(0.0).alias("score")).schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def passed(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents the classifier does not reject."""
    model = fit(docs, labels, **options)
    if model is None:
        return docs
    return score(docs, model).filter("predicted = 1").select("row.*")
