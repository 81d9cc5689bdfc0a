"""Similarity join of word-shingle sets by parity sketches (operator 7).

Every shingle of five words flips one bit of a sparse parity sketch. Two sketches differ in at
most as many bits as the sets differ in shingles. A similarity of s leaves at most n (1 - s) of
a set's n shingles without a partner, and the sketch is so wide (blocks by 58 bits of a 64-bit
hash) that a foreign shingle falls into none of its blocks. So at most n (1 - s) of its non-empty
blocks differ from the partner's: with one block more, at least one equal block is among those
chosen, provided all documents choose in the same order. Blocks that many documents share come last in that order
(a bounded table of counts; it only moves work, never results). Equal blocks are joined per
size band.

Documents with equal sets are one class and travel once. Of documents that share a block all
are compared with one pivot, in large blocks the rows left outside the largest component with a
second one. Where a block then still holds more than one component, its rows are dealt over cells
of bounded size with their dense parity sketches, and each row outside the largest component is
compared with all rows of other components. A dense sketch of the size band bounds the difference
from below by its Hamming distance; only pairs that it does not rule out become rows, and their
sets decide.

Defined results: A-Z are lower-cased; fewer words than five are one shingle; null, empty and
blank texts have no shingles and link with nothing; rows that repeat are members of one class;
a null doc_id never names a component unless all its members lack one; an empty table gives
no rows; extra columns are carried along in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import discard, lookup, mix, numbered, text_blocks, text_of, word_hashes, words, written
from quarry.llm.components import components
from quarry.scale import materialize

WIDTH = 5
PERCENT = 75
BLOCK_BITS = 6
BAND_BITS = 2  # sizes within a factor of 4 share a band
COMMON_BLOCKS = 1 << 16
LARGE_BLOCK = 64  # only above it a second pivot is worth a round; every pair is compared either way
VERIFIED_PARTS = 2
CELL_ROWS = 1024
CELL_WORDS = 128
_BANDS = 31  # the low bits of a block name its band
_COMPARED_WORDS = 1 << 20
_SEEN_OFTEN = 3


# --- shingles and sketches of a block of texts -------------------------------------------

def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in order of (text, hash), and their owners."""
    lower = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    starts, ends, owner = words(lower, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    each = word_hashes(lower, starts, ends)
    total = np.bincount(owner, minlength=len(offsets) - 1)
    short = total[owner] < width
    place = np.arange(len(owner)) - (np.cumsum(total) - total)[owner]
    value = np.zeros(len(each), np.uint64)
    for j in range(width):
        follows = np.zeros(len(each), np.uint64)
        follows[: max(len(each) - j, 0)] = each[j:]
        use = place + j < total[owner]  # words of the same text only
        value = np.where(use, mix(value + follows + np.uint64(j + 1)), value)
    begins = np.where(short, place == 0, place + width <= total[owner])
    owner, value = owner[begins], value[begins]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def most_changed(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The most blocks of a set of n shingles that a linked partner may lack."""
    return n * (100 - percent) // 100


def band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) // BAND_BITS


def block_signatures(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash of (block number, parity word) per non-empty block of the sparse sketch."""
    block = value >> np.uint64(BLOCK_BITS)
    bit = np.uint64(1) << (value & np.uint64((1 << BLOCK_BITS) - 1))
    first = np.ones(len(block), bool)
    first[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    if not len(at):
        return value, owner
    parity = np.bitwise_xor.reduceat(bit, at)
    return mix(mix(block[at]) + parity), owner[at]


def chosen_blocks(value: np.ndarray, owner: np.ndarray, sizes: np.ndarray, common: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures with their band mixed in, for every band a set may meet a partner in."""
    signature, who = block_signatures(value, owner)
    if not len(signature):
        return signature, who
    place = np.zeros(len(signature), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, signature), len(common) - 1)
        place = np.where(common[at] == signature, rank[at], 0)
    order = np.lexsort((signature, place, who))
    signature, who = signature[order], who[order]
    firsts = np.searchsorted(who, np.arange(len(sizes)))
    nth = np.arange(len(who)) - firsts[who]
    take = nth <= most_changed(sizes)[who]
    signature, who = signature[take], who[take]
    own = band(sizes)
    upper = np.left_shift(1, (own + 1) * BAND_BITS)
    near = 100 * sizes >= PERCENT * upper  # its larger partners may be in the next band
    named = lambda b: (mix(signature + b) & ~np.uint64(_BANDS)) | b
    mine = own[who].astype(np.uint64)
    low, high = named(mine), named(mine + np.uint64(1))[near[who]]
    return np.concatenate([low, high]), np.concatenate([who, who[near[who]]])


def dense_sketch(value: np.ndarray, bits: int) -> np.ndarray:
    """A parity sketch of ``bits`` bits as 64-bit words."""
    flips = np.bincount((value % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.uint64)


# --- passes over the texts ---------------------------------------------------------------

_SETS = "uid long, n long, low long, high long, often array<long>, times array<long>"


def _summaries(batches):
    """Size and fingerprint of every set; blocks that a run of texts repeats ride on its first row."""
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1), 4 << 20):
            value, owner = shingles(data, offsets)
            n = np.bincount(owner, minlength=hi - lo)
            sums = [np.zeros(hi - lo, np.uint64) for _ in range(2)]
            filled = np.flatnonzero(n)
            if len(filled):
                at = (np.cumsum(n) - n)[filled]
                sums[0][filled] = np.add.reduceat(mix(value), at)
                sums[1][filled] = np.add.reduceat(mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
            signature, _ = block_signatures(value, owner)
            often, times = np.unique(signature, return_counts=True)
            often, times = often[times >= _SEEN_OFTEN], times[times >= _SEEN_OFTEN]
            lists = np.full(hi - lo + 1, len(often), np.int32)
            lists[0] = 0
            carried = [pa.ListArray.from_arrays(pa.array(lists), pa.array(x)) for x in (often.view(np.int64), times.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), *[pa.array(s.view(np.int64)) for s in sums], *carried],
                ["uid", "n", "low", "high", "often", "times"],
            )


def _emit_blocks(common: np.ndarray, rank: np.ndarray):
    def run(batches):
        for batch in batches:
            uids = batch.column(0).to_numpy()
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                value, owner = shingles(data, offsets)
                sizes = np.bincount(owner, minlength=hi - lo)
                key, who = chosen_blocks(value, owner, sizes, common, rank)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(uids[lo:hi][who])], ["block", "uid"])

    return run


def _emit_sketches(batches):
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            value, owner = shingles(data, offsets)
            sizes = np.bincount(owner, minlength=hi - lo)
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            own = band(sizes)
            out = {k: [] for k in ("uid", "n", "band", "sketch")}
            for i, uid in enumerate(batch.column(0).to_pylist()[lo:hi]):
                near = 100 * sizes[i] >= PERCENT * (1 << int((own[i] + 1) * BAND_BITS))
                for b in (own[i], own[i] + 1) if near else (own[i],):
                    sketch = dense_sketch(value[cuts[i] : cuts[i + 1]], max(64, 2 << int((b + 1) * BAND_BITS)))
                    for column, x in zip(out.values(), (uid, int(sizes[i]), int(b), sketch.view(np.int64))):
                        column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def _emit_sets(batches):
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            value, owner = shingles(data, offsets)
            cuts = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(cuts), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets], ["uid", "set"])


# --- the join ----------------------------------------------------------------------------

def _common_blocks(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent blocks, ascending by signature, with a rank that grows with frequency."""
    seen = sets.filter(F.size("often") > 0).select(F.explode(F.arrays_zip("often", "times")).alias("b"))
    rows = (
        seen.groupBy(F.col("b.often").alias("block")).agg(F.sum("b.times").alias("times"))
        .orderBy(F.desc("times"), "block").limit(COMMON_BLOCKS).toPandas()
    )
    common = rows["block"].to_numpy(np.int64).view(np.uint64)
    rank = np.ceil(np.log2(rows["times"].to_numpy(np.float64) + 1)).astype(np.int64)
    order = np.argsort(common)
    return common[order], rank[order]


def _alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, band) that their sketches of that band do not rule out, as (a, b)."""
    side = lambda name: sketches.select(F.col("uid").alias(name), "band", *[F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch")])
    met = pairs.join(side("a"), ["a", "band"]).join(side("b"), ["b", "band"])
    apart = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x
    )
    # (n + m)(1 - s)/(1 + s) is the most two linked sets may differ.
    near = met.filter((apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)))
    return near.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")


def _verified(near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``near`` whose ``sets`` are similar enough."""
    exact = near.join(sets.withColumnsRenamed({"uid": "a", "set": "set_a"}), "a").join(sets.withColumnsRenamed({"uid": "b", "set": "set_b"}), "b")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - shared
    return exact.filter(100 * shared >= percent * union).select("a", "b")


def _linked(near: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    The pairs are dealt by ``a`` and verified one part after the other: sets take more room than their
    texts and travel twice, and what a part moved is dropped before the next one.
    """
    near = written(near.distinct(), "near")
    links = None
    for part in range(VERIFIED_PARTS):
        some = near.filter(F.pmod(F.xxhash64("a"), F.lit(VERIFIED_PARTS)) == part)
        ends = materialize(some.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "ends")
        sets = materialize(lookup(texts, ends, "uid", "left_semi").mapInArrow(_emit_sets, "uid long, set array<long>"), "sets")
        more = written(_verified(some, sets, percent), "links")
        discard(sets, ends)
        links = more if links is None else links.unionByName(more)
    discard(near)
    return links


def _asked(pairs: DataFrame) -> DataFrame:
    """Each pair once, by one band that both ends have."""
    ends = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("block").bitwiseAND(_BANDS).alias("band"))
    return written(ends.groupBy("a", "b").agg(F.min("band").alias("band")), "asked")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of blocks of more than two members and more than one component, with their component
    ``root``, the block's largest one ``main``, its number of rows ``n`` and of rows outside main ``askers``."""
    root = F.coalesce("root", "uid").alias("root")
    rooted = members.join(roots.withColumnRenamed("node", "uid"), "uid", "left").select("block", "uid", root)
    per_root = rooted.groupBy("block", "root").agg(F.count(F.lit(1)).alias("n"))
    blocks = per_root.groupBy("block").agg(
        F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("n")
    ).filter("roots > 1 and n > 2")
    blocks = blocks.select("block", F.col("largest.root").alias("main"), "n", (F.col("n") - F.col("largest.n")).alias("askers"))
    return written(rooted.join(materialize(blocks, "mixed"), "block"), "open")


def _cells(rows: DataFrame, cell_rows: int) -> DataFrame:
    """Rows of ``_mixed`` dealt over cells (block, slice, chunk) of bounded size.

    The rows of a block are cut into slices, those that ask into chunks, and every chunk meets
    every slice. A block that fits is one cell, in which every row stands once.
    """
    slices, chunks = F.ceil(F.col("n") / cell_rows), F.ceil(F.col("askers") / cell_rows)
    asks = F.col("root") != F.col("main")
    cell = lambda s, c, a: F.struct(s.cast("int").alias("slice"), c.cast("int").alias("chunk"), a.alias("asks"))
    mine, part = F.pmod(F.xxhash64("uid"), slices), F.pmod(F.xxhash64("uid", F.lit(1)), chunks)
    stands = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: cell(mine, c, F.lit(False)))
    calls = F.transform(F.sequence(F.lit(0).cast("long"), slices - 1), lambda s: cell(s, part, F.lit(True)))
    dealt = F.when((slices == 1) & (chunks == 1), F.array(cell(F.lit(0), F.lit(0), asks))).when(asks, F.concat(stands, calls)).otherwise(stands)
    # The sketch comes last: rows travel to their cells with it, each once per cell.
    return rows.withColumn("cell", F.explode(dealt)).select("block", "cell.slice", "cell.chunk", "cell.asks", "uid", "root", "size", "sketch")


def _runs(batches):
    """Record batches of whole cells; rows come sorted by cell."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = [rows.column(c).to_numpy() for c in ("block", "slice", "chunk")]
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        last = int(new[-1]) if len(new) else 0
        if last:
            yield rows.slice(0, last), np.concatenate([[0], new])
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _compare(percent: int):
    """Of every cell the pairs of an asking row and a row of another component that sketches do not rule out."""

    def pairs(uid, root, size, sketch, asks, first, end):
        askers = np.flatnonzero(asks)
        reach = np.cumsum(end[askers] - first[askers])
        lo, most = 0, max(1, _COMPARED_WORDS // sketch.shape[1])
        while lo < len(askers):
            hi = max(lo + 1, int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + most, side="right")))
            some = askers[lo:hi]
            met = end[some] - first[some]
            i = np.repeat(some, met)
            j = np.arange(len(i)) - np.repeat(np.cumsum(met) - met, met) + first[i]
            i, j = (x[(root[i] != root[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))] for x in (i, j))
            apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
            near = apart * (100 + percent) <= (size[i] + size[j]) * (100 - percent)
            ends = np.sort(np.stack([uid[i[near]], uid[j[near]]], axis=1), axis=1)
            yield np.unique(ends, axis=0)
            lo = hi

    def run(batches):
        for rows, cuts in _runs(batches):
            first, end = (np.repeat(x, np.diff(cuts)) for x in (cuts[:-1], cuts[1:]))
            uid, root, size, asks = (rows.column(c).to_numpy() for c in ("uid", "root", "size", "asks"))
            lists = rows.column("sketch").combine_chunks()
            lengths, words_ = pc.list_value_length(lists).to_numpy(), lists.flatten().to_numpy().view(np.uint64)
            begins = np.cumsum(lengths) - lengths
            for width in np.unique(lengths):  # one width per cell
                at = np.flatnonzero(lengths == width)
                sketch = words_[(begins[at][:, None] + np.arange(width))]
                place = np.zeros(len(lengths), np.int64)
                place[at] = np.arange(len(at))
                own_first = place[first[at]]
                for ends in pairs(uid[at], root[at], size[at], sketch, asks[at], own_first, own_first + end[at] - first[at]):
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return run


def _folded(sketch: Column) -> Column:
    """A sketch of at most CELL_WORDS words: halves laid over each other flip no more bits than before."""
    words_ = F.lit(CELL_WORDS)
    laid = F.transform(F.sequence(F.lit(1), words_), lambda w: F.aggregate(
        F.sequence(w, F.size(sketch), words_), F.lit(0).cast("long"), lambda x, at: x.bitwiseXOR(F.element_at(sketch, at))))
    return F.when(F.size(sketch) <= words_, sketch).otherwise(laid)


def _links(members: DataFrame, texts: DataFrame, sketches: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links that join all similar documents of ``members`` (block, uid), and their components."""

    def joined(links, near):
        more = _linked(near, texts, percent)
        links = more if links is None else materialize(links.unionByName(more), "links")
        return links, materialize(components(links), "roots")

    # First everyone meets the first row of its blocks.
    pivot = materialize(members.groupBy("block").agg(F.min("uid").alias("a")), "pivots")
    star = members.join(pivot, "block").select("block", "a", F.col("uid").alias("b"))
    asked = _asked(star)
    links, roots = joined(None, _alike(asked, sketches, percent))
    discard(pivot, asked)
    # In large blocks the rows outside the largest component then meet one row of it, another in each block.
    large = _mixed(members, roots).filter(F.col("n") > LARGE_BLOCK)
    drawn = large.filter("root = main").groupBy("block").agg(F.min_by("uid", F.xxhash64("uid", "block")).alias("a"))
    met = large.filter("root <> main").join(materialize(drawn, "pivots"), "block").select("block", "a", F.col("uid").alias("b"))
    near = _alike(_asked(met), sketches, percent)
    links, roots = joined(links, near)
    # What is left is compared inside cells; only pairs that sketches do not rule out leave them.
    kept = sketches.select("uid", "band", F.col("n").alias("size"), _folded(F.col("sketch")).alias("sketch"))
    rows = _mixed(members, roots).withColumn("band", F.col("block").bitwiseAND(_BANDS))
    cells = _cells(rows.join(kept, ["uid", "band"]), CELL_ROWS)
    key = ["block", "slice", "chunk"]
    near = cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare(percent), "a long, b long")
    return joined(links, near)


def _named(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (uid, row) and, in a table of their own, what ``join_similar`` says of each uid."""
    rows = numbered(docs, F.col(id_column).alias("id"))
    texts = rows.select("uid", text_of(f"row.{text_column}").alias("text"))
    sets = materialize(texts.mapInArrow(_summaries, _SETS), "sets")
    common, rank = _common_blocks(sets)
    narrow = sets.select("uid", "n", "low", "high")
    key = ["n", "low", "high"]
    classes = narrow.filter("n > 0").groupBy(key).agg(F.min("uid").alias("class_uid"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.filter("copies > 1"), "classes")
    classed = lookup(narrow, classes, key, "left").select("uid", "n", F.coalesce("class_uid", "uid").alias("class_uid"))
    classed = materialize(classed, "classed")
    discard(sets, classes)
    dropped = materialize(classed.filter("(class_uid <> uid) or (n = 0)").select("uid"), "copies")
    own = lookup(texts, dropped, "uid", "left_anti")
    blocks = own.mapInArrow(_emit_blocks(common, rank), "block long, uid long")
    # Only blocks that two documents share go on; each is seen once, in one exchange.
    least = Window.partitionBy("block")
    shared = blocks.withColumn("least", F.min("uid").over(least)).withColumn("most", F.max("uid").over(least))
    members = written(shared.filter("least <> most").select("block", "uid"), "members")
    wanted = materialize(members.select("uid").distinct(), "wanted")
    sketches = lookup(texts, wanted, "uid", "left_semi").mapInArrow(_emit_sketches, "uid long, n long, band long, sketch array<long>")
    _, roots = _links(members, texts, materialize(sketches, "sketches"), percent)
    roots = roots.withColumnRenamed("node", "class_uid")
    rooted = lookup(classed, roots, "class_uid", "left").select("uid", "n", "class_uid", F.coalesce("root", "class_uid").alias("root"))
    ids = rows.select("uid", "id")
    rooted = materialize(rooted.join(ids, "uid"), "rooted")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("uid"))).alias("first")
    several = materialize(rooted.groupBy("root").agg(first, F.count(F.lit(1)).alias("size")).filter("size > 1"), "components")
    named = lookup(rooted, several, "root", "left").select(
        "uid", F.col("n").alias("n_shingles"), "class_uid",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        (F.col("size").isNull() | (F.col("first.uid") == F.col("uid"))).alias("kept"),
    )
    return rows.select("uid", "row"), materialize(named, "named")


def join_similar(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row as ``row`` with n_shingles, class_uid, component_id and ``kept``: the row of
    its component with the smallest id."""
    rows, named = _named(docs, percent, id_column, text_column)
    return rows.join(named, "uid").drop("uid")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of every group of similar ones.

    Texts meet only the numbers of the few that go, not those of all that stay.
    """
    rows, named = _named(docs, **options)
    dropped = materialize(named.filter("not kept").select("uid"), "dropped")
    return lookup(rows, dropped, "uid", "left_anti").select("row.*")
