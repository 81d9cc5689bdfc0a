"""Exact top-k search by inner product with a pivot table (operator 9).

Vectors are turned into integers, floor(scale * x). For a query q and a candidate x,
2<q, x> = |q|^2 + |x|^2 - |q - x|^2, and for every pivot p the distance |q - x| is at least
| |q - p| - |x - p| |. The table of distances to all pivots gives the largest of these bounds,
hence an upper bound of the score. Candidates are evaluated in falling order of that bound
until no bound left can reach the k-th score found; scores are exact integers.

Vectors are packed into blocks of rows by a hash, queries as well. Every block of queries meets
every block of candidates once, through an equi-join on the query block's number; a pair of
blocks yields at most k rows per query, and the best k of all blocks are taken at the end.

Defined results: vectors that are null, or hold a null or non-finite component, take no part,
nor do rows without an id; a shorter vector counts as padded with zeros; of rows that repeat
an id each is a candidate of its own, and a query only leaves out its own row; equal scores go
to the smaller id, then the earlier row; a table with fewer candidates returns them all.
Scores are exact while sums of products stay below 2^53, else they are computed with whole
integers and held to the range of a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import numbered
from quarry.scale import materialize

SCALE = 1024
PIVOTS = 48
BLOCK = 4096
QUERY_BLOCK = 1024
STEP = 256
_EXACT = float(2**53)
_PACKED = "no int, ids binary, uids binary, width int, vectors binary"
_FOUND = "query_uid long, query_id long, vec_id long, uid long, score long"


def _pack(no: int, part: pd.DataFrame, scale: int) -> pd.DataFrame:
    part = part.sort_values("uid")
    width = max((len(v) for v in part["vector"]), default=0)
    matrix = np.zeros((len(part), width))
    for i, v in enumerate(part["vector"]):
        matrix[i, : len(v)] = v
    matrix = np.floor(matrix * scale)
    return pd.DataFrame({
        "no": [no], "ids": [part["id"].to_numpy(np.int64).tobytes()], "uids": [part["uid"].to_numpy(np.int64).tobytes()],
        "width": [width], "vectors": [matrix.tobytes()],
    })


def _unpack(row, width: int):
    ids, uids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.uids, np.int64)
    vectors = np.zeros((len(ids), width))
    vectors[:, : row.width] = np.frombuffer(row.vectors, np.float64).reshape(len(ids), row.width)
    return ids, uids, vectors


def _packed(rows: DataFrame, size: int, scale: int, name: str) -> DataFrame:
    blocks = max(1, -(-rows.count() // size))
    placed = rows.withColumn("no", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    return materialize(
        placed.groupBy("no").applyInPandas(lambda key, part: _pack(key[0], part, scale), _PACKED), name
    )


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with the rows of ``x``."""
    if len(q) == 0 or len(x) == 0 or np.abs(q).max() * np.abs(x).max() * len(q) < _EXACT:
        return (x @ q).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(q, row)) for row in x]
    return np.array([min(max(v, -(2**63)), 2**63 - 1) for v in whole], np.int64)


def search_block(q_uids, q, uids, ids, x, pivots: np.ndarray, k: int):
    """Per query the rows of its k best candidates in this block, found through the pivot table."""
    to_q, to_x = _distances(q, pivots), _distances(x, pivots)
    q_squares, x_squares = (q * q).sum(1), (x * x).sum(1)
    slack = 1e-6 * (1 + q_squares.max(initial=0) + x_squares.max(initial=0))
    results = []
    for i in range(len(q)):
        apart = np.abs(to_x - to_q[i]).max(axis=1) if pivots.size else np.zeros(len(x))
        bound = (q_squares[i] + x_squares - apart * apart) / 2 + slack
        order = np.argsort(-bound, kind="stable")
        order = order[uids[order] != q_uids[i]]
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        for at in range(0, len(order), STEP):
            if len(best) == k and bound[order[at]] < scores[-1]:
                break
            chunk = order[at : at + STEP]
            best = np.concatenate([best, chunk])
            scores = np.concatenate([scores, _exact(q[i], x[chunk])])
            # Complementing turns the order round without leaving the range of a long.
            top = np.lexsort((uids[best], ids[best], ~scores))[:k]
            best, scores = best[top], scores[top]
        results.append((best, scores))
    return results


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, pivots: int = PIVOTS, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row where ``is_query`` holds."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = numbered(
        vectors.select(F.col(id_column), F.col(vector_column)),
        F.col(id_column).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.drop("row").filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    candidates = _packed(rows, block, scale, "candidates")
    asked = _packed(rows.filter("asks"), query_block, scale, "queries")
    chosen = rows.orderBy(F.xxhash64("uid", F.lit("pivot"))).limit(pivots).select("vector").collect()
    width = max((len(r.vector) for r in chosen), default=0)
    table = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        table[i, : len(r.vector)] = r.vector
    table = np.floor(table * scale)
    numbers = [r.no for r in asked.select("no").collect()]

    meet = candidates.select(
        F.explode(F.array(*[F.lit(n) for n in numbers]) if numbers else F.array().cast("array<int>")).alias("ask"),
        *[F.col(c).alias(f"x_{c}") for c in ("ids", "uids", "width", "vectors")],
    )
    pairs = meet.join(asked.withColumnRenamed("no", "ask"), "ask")

    def score(batches):
        for batch in batches:
            for row in batch.itertuples():
                w = max(row.width, row.x_width, table.shape[1])
                q_ids, q_uids, q = _unpack(row, w)
                ids, uids = np.frombuffer(row.x_ids, np.int64), np.frombuffer(row.x_uids, np.int64)
                x = np.zeros((len(ids), w))
                x[:, : row.x_width] = np.frombuffer(row.x_vectors, np.float64).reshape(len(ids), row.x_width)
                p = np.zeros((len(table), w))
                p[:, : table.shape[1]] = table
                found = search_block(q_uids, q, uids, ids, x, p, k)
                sizes = [len(best) for best, _ in found]
                at = np.concatenate([b for b, _ in found]) if found else np.zeros(0, np.int64)
                yield pd.DataFrame({
                    "query_uid": np.repeat(q_uids, sizes), "query_id": np.repeat(q_ids, sizes), "vec_id": ids[at], "uid": uids[at],
                    "score": np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64),
                })

    with_bounds = pairs.repartition(F.xxhash64("ask", "x_uids"))
    found = with_bounds.mapInPandas(score, _FOUND)
    ordered = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return (
        found.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
