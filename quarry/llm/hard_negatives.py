"""Mining of hard negatives with an inverted multi-index (operator 11).

Vectors become integers, floor(scale * x). Each half of the vectors has a codebook of its own; a
row's two nearest codewords name its cell. For a query q with halves q1, q2 no row of cell
(a, b) scores above q1*c_a + |q1| r_a + q2*c_b + |q2| r_b, where r is the largest distance of
any row to its codeword. Codebooks are fitted on a bounded sample; every row is indexed, and the
radii cover all rows.

Cells lie in parts of a bounded number of rows; a cell that outgrows a part is dealt over parts
of its own. A query travels to the parts whose bounds can still matter and meets them in one
exchange, in which every row of the index moves once. In a part a multi-sequence heap visits the
cells by falling bound, until no cell left can add to any of the query's windows: a window is
certified once it holds k rows that no bound exceeds, or once the bound falls below its lower end.

An anchor's positives are the k best rows of its label: its best part is searched first, then
every part whose bound reaches the k-th score found there. The windows of its negatives follow
from the positives' scores.

Defined results: rows without an id, a label or a vector take no part, nor do vectors that hold
null or become non-finite; shorter vectors count as padded with zeros; rows that repeat an id
each take part, and an anchor leaves out its own row only; equal scores go to the smaller id,
then the earlier row; a positive below zero has an empty window; no rows give no rows. Scores
are exact integers of any size inside a task; those returned are held to the range of a long.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import numbered
from quarry.scale import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80  # of the positive's score
CODEWORDS = 16
SAMPLE_ROWS = 4096
PART_ROWS = 8192
VISIT_ROWS = 512  # rows of the next cells that are scored at once
_EXACT = 2.0**53 / 128
_LONG = 2**63 - 1


# --- codebooks and cells -----------------------------------------------------------------

@dataclass
class Codebooks:
    words: list[np.ndarray]  # of the two halves
    radii: list[np.ndarray]

    def halves(self, vectors: np.ndarray) -> list[np.ndarray]:
        cut = vectors.shape[1] // 2
        return [vectors[:, :cut], vectors[:, cut:]]

    def nearest(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half the codeword of every row and the distance to it."""
        out = []
        for half, words in zip(self.halves(vectors), self.words):
            code = (((words * words).sum(1))[None, :] - 2 * half @ words.T).argmin(1)
            out.append((code, np.sqrt(((half - words[code]) ** 2).sum(1))))
        return out

    def bounds(self, query: np.ndarray) -> list[np.ndarray]:
        """Per half the most any row of each codeword can add to the query's score."""
        out = []
        for half, words, radii in zip(self.halves(query[None]), self.words, self.radii):
            top = words @ half[0] + np.linalg.norm(half[0]) * radii
            out.append(top + 1e-9 * (1 + np.abs(half[0]).sum() * (np.abs(words).max(initial=0) + radii.max(initial=0))))
        return out


def fit_half(sample: np.ndarray, codewords: int, rounds: int = 12) -> np.ndarray:
    """k-means from rows far apart."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen, apart = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < codewords and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    words = sample[chosen].copy()
    for _ in range(rounds):
        code = ((words * words).sum(1)[None, :] - 2 * sample @ words.T).argmin(1)
        n = np.bincount(code, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, code, sample)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def cells_by_bound(first: np.ndarray, second: np.ndarray):
    """Pairs of codewords by falling sum of their bounds: a heap over the two sorted sequences."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap, seen = [(-(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(a) and step[1] < len(b) and step not in seen:
                seen.add(step)
                heapq.heappush(heap, (-(first[a[step[0]]] + second[b[step[1]]]), *step))


# --- a part of the index -----------------------------------------------------------------

@dataclass
class Part:
    cells: dict[tuple[int, int], slice]
    uids: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    largest: float


def scores_of(query: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products; as Python integers where doubles could not hold a hundredfold of them."""
    if np.abs(query).max(initial=0) * largest * len(query) < _EXACT:
        return (rows @ query).astype(np.int64)
    whole = [int(v) for v in query]
    out = np.empty(len(rows), object)
    out[:] = [sum(a * int(b) for a, b in zip(whole, row)) for row in rows]
    return out


def search(part: Part, books: Codebooks, uid: int, label: int, query: np.ndarray, windows: list, k: int, same: bool):
    """Per window (least, most; None: open) the rows of its k best scores in this part, and those scores."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    waiting: list[slice] = []

    def needed():
        """The least score that can still enter some window."""
        lows = []
        for (least, _), (_, scores) in zip(windows, found):
            full = len(scores) == k
            lows.append(-np.inf if least is None and not full else scores[-1] if full else least)
        return min(lows, default=np.inf)

    def visit():
        at = np.concatenate([np.arange(s.start, s.stop) for s in waiting])
        at = at[((part.labels[at] == label) == same) & (part.uids[at] != uid)]
        scores = scores_of(query, part.vectors[at], part.largest)
        for w, (least, most) in enumerate(windows):
            fits = np.ones(len(at), bool) if least is None else ((scores >= least) & (scores <= most)).astype(bool)
            rows, values = np.concatenate([found[w][0], at[fits]]), np.concatenate([found[w][1], scores[fits]])
            order = sorted(range(len(rows)), key=lambda i: (-int(values[i]), part.ids[rows[i]], part.uids[rows[i]])) if values.dtype == object else (
                np.lexsort((part.uids[rows], part.ids[rows], ~values))
            )
            order = np.asarray(order[:k], np.int64)
            found[w] = (rows[order], values[order])
        waiting.clear()

    size = 0
    for bound, a, b in cells_by_bound(*books.bounds(query)):
        own = part.cells.get((a, b))
        if own is None:
            continue
        if waiting and size >= VISIT_ROWS:
            visit()
            size = 0
        if bound < needed():
            break
        waiting.append(own)
        size += own.stop - own.start
    if waiting:
        visit()
    return found


def _windows(positives) -> list:
    """[80 %, 100 %] of every positive score, in whole numbers."""
    if positives is None:
        return [(None, None)]
    return [(-(-LEAST_PERCENT * int(p) // 100), int(p)) for p in positives]


_ROW = "part int, asks boolean, a int, b int, uid long, id long, label long, vector array<double>, positives array<long>"
_FOUND = "anchor_uid long, nth int, uid long, id long, score long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((len(column), 0))


def _searcher(books, width: int, k: int, same: bool):
    """Over rows sorted by part, the index before those who ask: keeps one part at a time."""

    def close(rows: list[pa.RecordBatch]) -> Part:
        whole = pa.Table.from_batches(rows).combine_chunks()
        a, b = (whole[c].to_numpy() for c in ("a", "b"))
        cuts = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1, [len(a)]])
        cells = {(int(a[s]), int(b[s])): slice(int(s), int(e)) for s, e in zip(cuts[:-1], cuts[1:])}
        vectors = _matrix(whole["vector"].combine_chunks(), width)
        return Part(cells, *(whole[c].to_numpy() for c in ("uid", "id", "label")), vectors, float(np.abs(vectors).max(initial=0)))

    def run(batches):
        number, pending, part = None, [], None
        for batch in batches:
            numbers, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                run_of = batch.slice(lo, hi - lo)
                if numbers[lo] != number:
                    number, pending, part = numbers[lo], [], None
                if not asks[lo]:
                    pending.append(run_of)
                    continue
                if part is None and pending:
                    part, pending = close(pending), []
                if part is None:
                    continue
                out: list[list] = [[] for _ in range(5)]
                queries = _matrix(run_of.column(7), width)
                for query, uid, label, positives in zip(queries, run_of.column(4).to_pylist(), run_of.column(6).to_pylist(), run_of.column(8).to_pylist()):
                    for nth, (rows, scores) in enumerate(search(part, books.value, uid, label, query, _windows(positives), k, same)):
                        values = (uid, nth, part.uids[rows], part.ids[rows], [min(max(int(s), -_LONG - 1), _LONG) for s in scores])
                        out[0] += [values[0]] * len(rows)
                        out[1] += [values[1]] * len(rows)
                        for column, more in zip(out[2:], values[2:]):
                            column.extend(more)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], ["anchor_uid", "nth", "uid", "id", "score"])

    return run


# --- the index and those who ask ---------------------------------------------------------

@dataclass
class Index:
    rows: DataFrame  # part, a, b, uid, id, label, vector, asks; written
    books: Codebooks
    parts: dict[tuple[int, int], tuple[int, int]]  # cell -> first part, number of parts
    n_parts: int
    width: int


def build_index(rows: DataFrame, codewords: int = CODEWORDS, sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS) -> Index:
    """``rows``: written, with uid, id, label, asks and vector, a whole number in every component."""
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    padding = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector"))
    rows = rows.withColumn("vector", F.concat("vector", padding))
    chosen = rows.orderBy(F.xxhash64("uid", F.lit("sample"))).limit(sample_rows).select("vector").toArrow()
    sample = _matrix(chosen["vector"].combine_chunks(), width)
    cut = width // 2
    books = Codebooks([fit_half(sample[:, :cut], codewords), fit_half(sample[:, cut:], codewords)], [])
    shared = spark.sparkContext.broadcast(books)

    def assign(batches):
        for batch in batches:
            (a, near), (b, close) = shared.value.nearest(_matrix(batch.column(4), width))
            own = [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(near), pa.array(close)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], ["uid", "id", "label", "asks", "vector", "a", "b", "near", "close"])

    schema = "uid long, id long, label long, asks boolean, vector array<double>, a int, b int, near double, close double"
    placed = materialize(rows.select("uid", "id", "label", "asks", "vector").mapInArrow(assign, schema), "cells")
    # As many rows as there are pairs of codewords.
    sizes = placed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("near").alias("near"), F.max("close").alias("close")).orderBy("a", "b").collect()
    books.radii = [np.zeros(len(w)) for w in books.words]
    parts, number, filled = {}, 0, 0
    for r in sizes:
        books.radii[0][r.a], books.radii[1][r.b] = max(books.radii[0][r.a], r.near), max(books.radii[1][r.b], r.close)
        pieces = -(-r.n // part_rows)
        if filled and (pieces > 1 or filled + r.n > part_rows):
            number, filled = number + 1, 0
        parts[r.a, r.b] = (number, pieces)
        number, filled = (number + pieces, 0) if pieces > 1 else (number, filled + r.n)
    n_parts = number + (filled > 0)
    places = spark.createDataFrame([(*cell, *place) for cell, place in parts.items()], "a int, b int, first int, pieces int")
    part = (F.col("first") + F.pmod(F.xxhash64("uid"), F.col("pieces"))).cast("int").alias("part")
    indexed = placed.join(F.broadcast(places), ["a", "b"]).select(part, "a", "b", "uid", "id", "label", "vector", "asks")
    return Index(materialize(indexed, "index"), books, parts, n_parts, width)


def _reached(index: Index, asking: DataFrame) -> DataFrame:
    """``asking`` (uid, vector) with every part and the most a row of it can score: uid, part, bound, best."""
    cells = list(index.parts)
    a, b = (np.array([c[i] for c in cells], int) for i in range(2))
    firsts, pieces = (np.array([index.parts[c][i] for c in cells], int) for i in range(2))
    shared, width = asking.sparkSession.sparkContext.broadcast((index.books, a, b, firsts, pieces, index.n_parts)), index.width

    def run(batches):
        books, a, b, firsts, pieces, n_parts = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                few = batch.slice(lo, 64)
                bounds = np.full((few.num_rows, n_parts), -np.inf)
                for i, query in enumerate(_matrix(few.column(1), width)):
                    first, second = books.bounds(query)
                    top = first[a] + second[b]
                    np.maximum.at(bounds[i], firsts, top)
                    for c in np.flatnonzero(pieces > 1):
                        bounds[i, firsts[c] : firsts[c] + pieces[c]] = top[c]
                best = np.zeros(bounds.shape, bool)
                best[np.arange(len(bounds)), bounds.argmax(1)] = True
                uids = np.repeat(few.column(0).to_numpy(), n_parts)
                numbers = np.tile(np.arange(n_parts, dtype=np.int32), few.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(numbers), pa.array(bounds.ravel()), pa.array(best.ravel())], ["uid", "part", "bound", "best"])

    return asking.select("uid", "vector").mapInArrow(run, "uid long, part int, bound double, best boolean")


def _visit(index: Index, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """Every ask (part, uid, id, label, vector, positives) against its part."""
    names = [c.split()[0] for c in _ROW.split(", ")]
    nobody = F.lit(None).cast("int")
    stored = index.rows.withColumn("asks", F.lit(False)).withColumn("positives", F.lit(None).cast("array<long>"))
    who = asks.withColumn("asks", F.lit(True)).withColumn("a", nobody).withColumn("b", nobody)
    both = stored.select(names).unionByName(who.select(names))
    dealt = both.repartition(max(1, index.n_parts), "part").sortWithinPartitions("part", "asks", "a", "b", "uid")
    shared = index.rows.sparkSession.sparkContext.broadcast(index.books)
    return dealt.mapInArrow(_searcher(shared, index.width, k, same), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_uid", "nth").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, **index_options,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every hard negative."""
    vector = F.transform(F.col(vector_column), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    scaled = F.transform(F.col(vector_column), lambda x: x.cast("double") * scale)
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e300))
    usable = F.col(id_column).isNotNull() & label.isNotNull() & F.col(vector_column).isNotNull() & F.coalesce(finite, F.lit(False))
    taken = vectors.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
                           F.when(usable, vector).alias("vector")).filter("vector is not null and id is not null and label is not null")
    rows = numbered(taken).select("uid", "row.*")
    index = build_index(rows, **index_options)
    anchors = materialize(index.rows.filter("asks").select("uid", "id", "label", "vector"), "anchors")
    reached = materialize(_reached(index, anchors), "reached")

    def asks(which: DataFrame, positive: Column) -> DataFrame:
        return anchors.join(which, "uid").select("part", "uid", "id", "label", "vector", positive.alias("positives"))

    nothing = F.lit(None).cast("array<long>")
    home = materialize(_visit(index, asks(reached.filter("best").select("uid", "part"), nothing), positives, True), "home")
    enough = home.groupBy("anchor_uid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= positives)
    enough = materialize(enough.select(F.col("anchor_uid").alias("uid"), "least"), "enough")
    far = reached.filter("not best").join(enough, "uid", "left").filter(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
    others = _visit(index, asks(far.select("uid", "part"), nothing), positives, True)
    near = materialize(_best(home.unionByName(others), positives).select("anchor_uid", "rank", "id", "score"), "positives")

    # A positive below zero asks for a score of at least 80 % and at most 100 % of it: for nothing.
    wanted = near.filter("score >= 0").groupBy(F.col("anchor_uid").alias("uid")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("of"), F.min("score").alias("least")
    )
    wanted = materialize(wanted.select("uid", F.transform("of", lambda x: x["score"]).alias("scores"), (F.col("least") * (LEAST_PERCENT / 100)).alias("low")), "wanted")
    slack = 1 + F.abs("low") * 1e-9
    places = reached.join(wanted, "uid").filter(F.col("bound") + slack >= F.col("low")).select("uid", "part", "scores")
    hard = _best(_visit(index, asks(places, F.col("scores")), negatives, False), negatives)
    # Positives fall in score, so the asked ones are the first: the n-th window is the positive of rank n + 1.
    pairs = near.select("anchor_uid", (F.col("rank") - 1).alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = hard.join(pairs, ["anchor_uid", "nth"]).join(anchors.select(F.col("uid").alias("anchor_uid"), F.col("id").alias("anchor_id")), "anchor_uid")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
