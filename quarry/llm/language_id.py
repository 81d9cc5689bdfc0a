"""Language identification (operator 3): averaged hashed subword embeddings, linear softmax.

A text's vector is the mean of the embeddings of all its byte n-grams (2 to 4 bytes, ASCII
letters lower-cased), each hashed into a fixed number of rows; a linear layer and a softmax
give the languages. Both are trained by stochastic gradient descent in numpy on a bounded,
reproducible sample of labelled rows (``train_rows``, by hash of the id). As the model is
linear, prediction sums rows of the product table, one pass over the bytes per n-gram size.

A fifth of the sample calibrates: a temperature for the probabilities, and the score below
which a prediction counts as rejected (column ``accepted``), set so that of the accepted ones
at least ``precision`` are right.

Defined results: null texts and texts without a letter are ``und`` with score 0, not accepted;
texts shorter than every n-gram get the most frequent language at its share; without any row
to learn from every text is ``und``; repeated rows are predicted alike; extra columns are
carried along in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, held_out, text_blocks, text_of

SIZES = (2, 3, 4)
ROWS = 1 << 15
DIMENSIONS = 16
TRAIN_ROWS = 2_000
EPOCHS = 4
RATE = 0.5
PRECISION = 0.99
UNKNOWN = "und"


def ngram_rows(data: np.ndarray, size: int) -> np.ndarray:
    """The table row of the n-gram that starts at each byte; the last ones run past the end."""
    lower = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    padded = np.concatenate([lower, np.zeros(size, np.uint8)]).astype(np.uint32)
    n = len(data)
    code = padded[:n].copy()
    for j in range(1, size):
        code |= padded[j : j + n] << np.uint32(8 * j)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32((0x85EBCA6B + 2 * size) & 0xFFFFFFFF)
    return (code >> np.uint32(17)).astype(np.int64)


def _counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    rows = [ngram_rows(data, s)[: max(0, len(data) - s + 1)] for s in SIZES]
    return np.unique(np.concatenate(rows), return_counts=True)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # ROWS + 1 by languages; the last row is zero
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text of the block."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        lengths = np.diff(offsets)
        filled = np.flatnonzero(lengths > 0)
        n_grams = np.zeros(len(lengths))
        for size in SIZES:
            rows = ngram_rows(data, size)
            for back in range(1, size):  # n-grams that would run into the next text
                ends = offsets[1:][lengths >= back] - back
                rows[ends] = ROWS
            if len(filled):
                total[filled] += np.add.reduceat(self.table[rows], offsets[:-1][filled], axis=0)
            n_grams += np.maximum(lengths - size + 1, 0)
        return total / np.maximum(n_grams, 1)[:, None] + self.bias


def train(texts: list[bytes], labels: list[str], epochs: int = EPOCHS, rate: float = RATE, precision: float = PRECISION) -> Model:
    """Fit on four fifths of the texts, calibrate on the rest."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    held = np.arange(len(texts)) % 5 == 4 if len(texts) >= 50 else np.zeros(len(texts), bool)
    fit = np.flatnonzero(~held)
    rng = np.random.default_rng(7)
    embedding = rng.normal(0, 0.1, (ROWS, DIMENSIONS))
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages)))
    counts = np.bincount(target[fit], minlength=len(languages)) + 0.5
    bias = np.log(counts / counts.sum())
    counted = [_counted(t) for t in texts]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit):
            rows, times = counted[i]
            if not len(rows):
                continue
            share = times / times.sum()
            mean = share @ embedding[rows]
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            # The mean spreads a text's gradient thinly over its n-grams; steps grow with their number.
            back = weights @ p
            weights -= step * np.outer(mean, p)
            embedding[rows] -= step * np.minimum(share * len(rows), 4.0)[:, None] * back
    table = np.zeros((ROWS + 1, len(languages)), np.float32)
    table[:ROWS] = embedding @ weights
    model = Model(languages, table, bias, 1.0, 0.0)
    if held.any():
        logits = np.array([
            (times / max(times.sum(), 1)) @ table[rows] + bias for rows, times in (counted[i] for i in np.flatnonzero(held))
        ])
        truth = target[held]
        temperatures = np.geomspace(0.05, 10, 60)
        losses = []
        for t in temperatures:
            model.temperature = float(t)
            losses.append(-np.log(model.probabilities(logits)[np.arange(len(truth)), truth] + 1e-12).mean())
        model.temperature = float(temperatures[int(np.argmin(losses))])
        p = model.probabilities(logits)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = (p.argmax(axis=1) == truth)[order]
        good = np.flatnonzero(np.cumsum(right) / np.arange(1, len(right) + 1) >= precision)
        model.threshold = float(p.max(axis=1)[order[good[-1]]]) if len(good) else 1.0
    return model


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model | None:
    """A model from at most ``train_rows`` labelled rows that are not held out."""
    labelled = docs.filter(
        F.col(text_column).isNotNull() & F.col(lang_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column))
    )
    order = F.xxhash64(F.col(id_column), F.lit("train"))
    ids = labelled.select(F.col(id_column).alias("id"), order.alias("order")).orderBy("order", "id").limit(train_rows)
    chosen = labelled.join(F.broadcast(ids.select("id").distinct()), F.col(id_column) == F.col("id"), "left_semi")
    # Repeated ids could bring more rows than asked for; the bound holds all the same.
    sample = chosen.select(F.encode(text_column, "UTF-8").alias("t"), F.col(lang_column).cast("string").alias("lang"), order.alias("o"))
    rows = sample.orderBy("o", "lang").limit(train_rows).collect()
    return train([bytes(r.t) for r in rows], [r.lang for r in rows]) if rows else None


def predict(docs: DataFrame, model: Model | None, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as ``row`` with lang_pred, score and accepted."""
    letters = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    source = docs.select(carried(keep), text_of(text_column).alias("text"), letters.alias("letters"))
    if model is None:
        return source.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                p = m.probabilities(m.logits(data, offsets))
                best[lo:hi], score[lo:hi] = p.argmax(axis=1), p.max(axis=1)
            known = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            best[~known], score[~known] = len(m.languages), 0.0
            accepted = known & (score >= m.threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(accepted)],
                ["row", "lang_pred", "score", "accepted"],
            )

    schema = source.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("accepted")).schema
    return source.mapInArrow(run, schema)


def identify(docs: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    return predict(docs, fit(docs, **options), keep=keep)
