"""Mixing sources to target weights by balanced sampling (operator 10), the cube method.

A source's target is its weight's share of the total, capped at ``most`` times its size; what
lies above a cap is reshared by weight until nothing does. A document is taken ``floor(rate)``
times for sure and once more with the fractional part as inclusion probability. The flight
phase walks the probabilities of three documents at a time along the direction that keeps the
expected number of documents and of words, until at most two of a block are still fractional.
Blocks are bounded and dealt by hash within a source; what they leave over is blocked again,
until one block of the source remains, whose last two documents are the landing problem: of their
four outcomes the one whose word total is nearest wins, and single documents of that last block
make good the rest. Every earlier block keeps a bounded reserve of short documents out of its
flight for that, about as many words as the rounding of its longest document can miss.

Defined results: null text has size 0; a null source is a source of its own, last in order;
sources of no words have target 0; rows that repeat are sampled each; reruns agree, because
order and random numbers come from hashes of the rows; an empty table gives no rows; extra
columns are carried along in ``row``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, in_order, lookup, mix, numbered, text_of
from quarry.scale import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 10_000
RESERVE = 8  # longest rows of a source that its blocks together keep words for
_LEFT = "source_no long, uid long, size double, rate double, prob double, draw long, done boolean"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_no, source_size, target of a table of sources (source, source_size).

    The level all uncapped sources reach per unit of weight rises with every source that meets
    its cap; each round is one aggregate, and the rounds end when no further source does.
    """
    ordered = in_order(sizes, F.col("source").asc_nulls_last()).withColumnRenamed("position", "source_no")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(most)
    table = ordered.withColumn("weight", weight).withColumn("cap", cap)
    total = table.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    want = min(share, most) * total
    level = 0.0
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        fixed, rest = table.agg(
            F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        reached = (want - (fixed or 0.0)) / rest if rest else level
        if not rest or reached <= level * (1 + 1e-12):
            break
        level = reached
    return table.select(
        "source", "source_no", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target")
    )


def flight(size: np.ndarray, prob: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move the probabilities until at most two are fractional; totals of rows and size stay.

    Three fractional rows always have a direction that changes neither total: the cross
    product of (1, 1, 1) and their sizes.
    """
    p = prob.tolist()
    x = size.tolist()
    u = (draw.view(np.uint64) >> np.uint64(11)).astype(np.float64) / 2.0**53
    u = u.tolist()
    tiny = 1e-9
    live: list[int] = []
    for i in range(len(p)):
        if p[i] <= tiny or p[i] >= 1 - tiny:
            p[i] = float(round(p[i]))
            continue
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        step = [x[c] - x[b], x[a] - x[c], x[b] - x[a]]
        if step == [0.0, 0.0, 0.0]:
            step = [1.0, -1.0, 0.0]
        up = min(((1 - p[j]) if s > 0 else p[j]) / abs(s) for j, s in zip(live, step) if s)
        down = min((p[j] if s > 0 else (1 - p[j])) / abs(s) for j, s in zip(live, step) if s)
        by = up if u[i] < down / (up + down) else -down
        keep = []
        for j, s in zip(live, step):
            v = p[j] + by * s
            if v <= tiny or v >= 1 - tiny:
                p[j] = float(round(v))
            else:
                p[j] = v
                keep.append(j)
        live = keep
    return np.array(p)


def landing(size: np.ndarray, start: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Round the last few: the outcome with the nearest word total, then the nearest count.

    ``start`` holds the probabilities before the flight. What the rounding leaves of the words
    is made good by turning over single documents, large ones first, as long as the total comes
    nearer; only documents that started fractional may turn.
    """
    p = prob.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    want, count = float((p * size)[left].sum()), float(p[left].sum())
    options = np.array(np.meshgrid(*[[0.0, 1.0]] * len(left))).reshape(len(left), -1).T if len(left) else np.zeros((1, 0))
    errors = [(abs(float((o * size[left]).sum()) - want), abs(float(o.sum()) - count), i) for i, o in enumerate(options)]
    p[left] = options[min(errors)[2]]
    missing = float((start * size).sum() - (p * size).sum())
    for i in np.argsort(-size, kind="stable"):
        gain = size[i] if p[i] == 0 else -size[i]
        if 0 < start[i] < 1 and abs(missing - gain) < abs(missing):
            p[i] = 1 - p[i]
            missing -= gain
    return p


def reserve(size: np.ndarray, prob: np.ndarray, rate: float, source_part: float, block_rows: int) -> np.ndarray:
    """Places of the short rows that a block keeps out of its flight for the last block; sizes fall.

    Of a row's words a share can turn either way, the rate's fractional part or what that lacks
    to 1. The shortest rows stay whose share makes up half the longest row and half of
    ``source_part``, the block's part of what the source's longest rows want from all blocks.
    Where a quarter of the block's rows is not enough, it is each second or third short row.
    """
    usable = np.flatnonzero((prob > 0) & (prob < 1) & (size > 0))[::-1]
    most = min(len(size), block_rows) // 4
    if not len(usable) or not most:
        return usable[:0]
    need = (size[usable[-1]] + source_part) / (2 * max(min(rate % 1, 1 - rate % 1), 1e-3))
    for step in (1, 2, 3):
        stay = usable[::step][:most]
        words = np.cumsum(size[stay])
        if words[-1] >= need:
            break
    return stay[: int(np.searchsorted(words, need)) + 1]


def _fly(block_rows: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        last = bool(part["blocks"].iloc[0] == 1)
        # Large documents first: short ones come late, when few others are left to balance them.
        part = part.sort_values(["size", "draw", "uid"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        size, draw = part["size"].to_numpy(np.float64), part["draw"].to_numpy(np.int64)
        start = part["prob"].to_numpy(np.float64)
        if last:
            p = landing(size, start, flight(size, start, draw))
        else:
            p, flies = start.copy(), np.ones(len(part), bool)
            source_part = RESERVE * float(part["longest"].iloc[0] / part["blocks"].iloc[0])
            flies[reserve(size, start, float(part["rate"].iloc[0]), source_part, block_rows)] = False
            p[flies] = flight(size[flies], start[flies], draw[flies])
        part["prob"] = p
        part["draw"] = mix(draw.view(np.uint64)).view(np.int64)
        part["done"] = (p <= 0) | (p >= 1)
        return part[["source_no", "uid", "size", "rate", "prob", "draw", "done"]]

    return run


def _sampled(rows: DataFrame, block_rows: int) -> DataFrame:
    """uid and a probability of 0 or 1 for every row (source_no, uid, size, rate, prob, draw)."""
    finished = []
    pending = rows.withColumn("done", (F.col("prob") <= 0) | (F.col("prob") >= 1))
    while True:
        most = pending.groupBy("source_no").count().agg(F.max("count")).first()[0] or 0
        last = most <= block_rows
        # A source whose rows make one block lands in this round, whatever the others' sizes.
        per_source = pending.groupBy("source_no").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("long").alias("blocks"), F.max("size").alias("longest")
        )
        blocked = lookup(pending, per_source, "source_no").withColumn("block", F.pmod("draw", F.col("blocks")))
        flown = materialize(blocked.groupBy("source_no", "block").applyInPandas(_fly(block_rows), _LEFT), "flown")
        finished.append(flown.filter("done"))
        pending = flown.filter("not done")
        if last:
            break
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select("uid", "prob")


def mix_sources(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row as ``row`` with size, source_size, target and copies (0 to ``most``)."""
    text = text_of(text_column)
    draw = F.xxhash64(F.col(id_column), text)
    rows = numbered(
        docs, n_words(text).alias("size"), F.col(source_column).cast("string").alias("source"), draw.alias("draw")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    goal = materialize(targets(materialize(sizes, "sizes"), weights, share, most), "targets")
    # A null source joins under a key of its own.
    key = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    goal = goal.withColumn("key", key).drop("source")
    joined = lookup(rows.withColumn("key", key), goal, "key").drop("key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate)
    narrow = joined.select(
        "source_no", "uid", F.col("size").cast("double").alias("size"), "rate",
        (F.col("rate") - F.floor("rate")).alias("prob"), "draw",
    )
    sampled = materialize(_sampled(narrow, block_rows), "sampled")
    return joined.join(sampled, "uid").select(
        "row", "size", "source_size", "target",
        (F.floor("rate") + F.col("prob")).cast("long").alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    rows = mix_sources(docs, **options)
    return rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
