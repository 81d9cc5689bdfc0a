"""Removing byte strings that repeat anywhere in the corpus (operator 2), by a suffix array.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts elsewhere.

Cover. The starts of all such strings are cut into phrases where the smallest hash of the next
``COVER`` grams changes. A boundary depends only on the bytes of the string it lies in, so equal
strings have their next boundary at equal places: the boundaries are a difference cover of the
positions that is sparse and defined by content. Texts become strings of phrase names.

Suffix array. Phrases that can matter (the bytes after their end occur twice) are sorted by the
difference-cover scheme modulo three: triples of names at positions 1 and 2 modulo 3 are sorted
and named, the names' string is sorted by triples again, and so on until ``LEVELS`` triples
cover a string; the remaining suffixes (position 0) are merged by their own name and the rank
of the next sampled one. Any two suffixes meet in one of three sorted lists (both sampled,
both followed by a sampled one after one, or after two names). Adjacent suffixes of a list are
compared on the prefix that holds every string starting in the phrase: equal ones repeat whole.

Edges. What the adjacent comparison leaves open (the phrases at the ends of a repeat) is
decided string by string by 128-bit hashes, against the open phrases and one representative of
every repeated phrase that ends alike.

Texts that are equal are sorted once; all strings of a text that occurs twice repeat.

Defined results: null and empty texts have no bytes and the checksum of the empty string;
texts shorter than ``LENGTH`` lose nothing, whatever repeats; rows that repeat are equal texts;
an empty table gives no rows; extra columns are carried along in ``row``.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import discard, lookup, mix, numbered, text_blocks, text_of, written
from quarry.scale import materialize

LENGTH = 200
GRAM = 20
COVER = 90  # two windows of grams fit into a string: 2 * COVER + GRAM - 1 <= LENGTH
AFTER = LENGTH - COVER  # bytes behind a phrase that belong to all strings starting in it
LEVELS = 2
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Hashes:
    """Hashes of any spans of one block of bytes, from running sums of scaled bytes."""

    def __init__(self, data: np.ndarray, base: int = 0):
        powers, self._inverse = _tables(len(data) + 1, _BASES[base])
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self._sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[begin]) * self._inverse[begin])


def _tables(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        size = max(n, 1 << 16)
        out = []
        for step in (base, pow(base, -1, 2**64)):
            steps = np.full(size, step, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        _TABLES[base] = (out[0], out[1])
    return _TABLES[base]


def boundaries(data: np.ndarray) -> np.ndarray:
    """Starts of the phrases of one text, and where the last one's next begins; empty if too short."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64)
    step = np.uint64(_BASES[0] | 1)
    sums = {1: data.astype(np.uint64) + np.uint64(1)}
    for size in (1, 2, 4, 8):
        factor = np.uint64(pow(int(step), size, 2**64))
        sums[2 * size] = sums[size][:-size] * factor + sums[size][size:]
    count = n - GRAM + 1
    grams = sums[16][:count] * np.uint64(pow(int(step), 4, 2**64)) + sums[4][16 : 16 + count]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    # The place in the low half lets the minimum say where it is; equal grams: the last one.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(count, dtype=np.uint64))
    size = 1
    while 2 * size <= COVER:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = COVER - size
    least = np.minimum(least[: len(least) - rest], least[rest:])
    return np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]])


def phrases(data: np.ndarray):
    """begin, next boundary, end of the strings, name, prefix and what follows, per phrase with
    strings of its own; names of all phrases. One text."""
    cuts = boundaries(data)
    if not len(cuts):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.view(np.uint64)
    hashes = Hashes(data)
    names = hashes(cuts[:-1], cuts[1:])
    last = len(data) - LENGTH
    own = int(np.searchsorted(cuts[:-1], last, side="right"))
    begin, following = cuts[:own], cuts[1 : own + 1]
    end = np.minimum(following - 1, last) + LENGTH
    prefix = hashes(begin, end) ^ mix((end - begin).astype(np.uint64))
    after = hashes(following, np.minimum(following + AFTER, len(data)))
    return begin, following, end, names, prefix, after


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat, kind))


def _after(batches):
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            found = [phrases(data[offsets[i] : offsets[i + 1]])[5].view(np.int64) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), _lists(found, pa.int64())], ["uid", "after"])


_SUFFIXES = "uid long, t int, s0 long, s1 long, s2 long, open boolean, begin int, end int, prefix long, after long"


def _suffixes(batches):
    """A row per name that a wanted suffix (position in ``wanted``) or its triples need."""
    reach = 3**LEVELS + 4  # a remaining suffix needs the ranks one and two names on, those all their triples
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            out = []
            for i in range(hi - lo):
                begin, _, end, names, prefix, after = phrases(data[offsets[i] : offsets[i + 1]])
                wanted = np.sort(np.array(batch.column(2)[lo + i].as_py(), np.int64))
                need = np.zeros(len(names) + reach + 1, np.int64)
                np.add.at(need, wanted, 1)
                np.subtract.at(need, wanted + reach, 1)
                at = np.flatnonzero(np.cumsum(need)[: len(names)] > 0)
                # Past the end of a text its own end marks follow, which equal no name.
                ends = mix(np.array([batch.column(0)[lo + i].as_py()], np.int64).view(np.uint64)) + np.arange(2, dtype=np.uint64)
                padded = np.concatenate([names, ends]).view(np.int64)
                is_wanted = np.zeros(len(names), bool)
                is_wanted[wanted] = True
                pad = lambda x: np.concatenate([x, np.zeros(len(names) - len(x), x.dtype)])[at]
                out.append((
                    np.full(len(at), batch.column(0)[lo + i].as_py()), at.astype(np.int32), padded[at], padded[at + 1], padded[at + 2],
                    is_wanted[at], pad(begin).astype(np.int32), pad(end).astype(np.int32), pad(prefix).view(np.int64), pad(after).view(np.int64),
                ))
            columns = [np.concatenate(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "t", "s0", "s1", "s2", "open", "begin", "end", "prefix", "after"])


def _strings(batches):
    """128-bit hashes of all strings that start in the phrases listed in ``wanted``."""
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            out = []
            for i in range(hi - lo):
                text = data[offsets[i] : offsets[i + 1]]
                asked = batch.column(2)[lo + i].as_py()
                first = np.array([a["begin"] for a in asked], np.int64)
                count = np.array([a["end"] for a in asked], np.int64) - LENGTH - first + 1
                is_open = np.repeat(np.array([a["open"] for a in asked], bool), count)
                at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                out.append((
                    Hashes(text)(at, at + LENGTH).view(np.int64), Hashes(text, 1)(at, at + LENGTH).view(np.int64),
                    np.full(len(at), batch.column(0)[lo + i].as_py()), at.astype(np.int32), is_open,
                ))
            columns = [np.concatenate(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["low", "high", "uid", "begin", "open"])


# --- the suffix array --------------------------------------------------------------------

def named(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(uid, t) of ``rows`` with the sorted keys' number in ``name``: equal keys share it, it grows with the key.

    Distinct keys are sorted over all partitions; a key that fills a third of the rows is one
    row there, and the join back splits it.
    """
    sorted_keys = rows.select(*keys).distinct().orderBy(*keys).withColumn(name, F.monotonically_increasing_id())
    names = materialize(sorted_keys, "names")
    out = written(rows.join(names, keys).select("uid", "t", name), "sampled")
    discard(names)
    return out


def _following(rows: DataFrame, column: str, shifts: tuple[int, ...]) -> DataFrame:
    """``rows`` with the column's values ``shifts`` positions on in the same text (null past the end)."""
    window = Window.partitionBy("uid").orderBy("t").rangeBetween
    ahead = [F.first(F.when(F.lit(True), F.col(column))).over(window(s, s)).alias(f"{column}_{s}") for s in shifts]
    return rows.select("*", *ahead)


def sorted_suffixes(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(uid, t, rank) of the sampled suffixes (t mod 3 > 0) of ``rows`` (uid, t, s0, s1, s2).

    Each level sorts and names triples; the next one recurses on the string of these names,
    whose neighbours are three times as far apart.
    """
    sampled = named(rows.filter("t % 3 > 0").select("uid", "t", "s0", "s1", "s2"), ["s0", "s1", "s2"], "name")
    for level in range(1, levels):
        step = 3**level
        triples = _following(sampled, "name", (step, 2 * step))
        # Past a text's end nothing follows; minus one sorts first and equals no name.
        keys = ["name", f"name_{step}", f"name_{2 * step}"]
        triples = triples.fillna(-1, subset=keys[1:])
        before, sampled = sampled, named(triples.withColumnRenamed("name", "first"), ["first", *keys[1:]], "name")
        discard(before)
    return sampled.withColumnRenamed("name", "rank")


def adjacent_equal(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(uid, t) of suffixes whose neighbour in one of the three merged lists has an equal prefix.

    ``rows`` has uid, t, s0, s1, prefix of the suffixes asked for, ``ranks`` the sampled ranks.
    """
    own = ["uid", "t", "prefix"]
    none = F.lit(0).cast("long")
    after = lambda shift: ranks.select("uid", (F.col("t") - shift).alias("t"), "rank")
    last = F.coalesce("rank", F.lit(-1).cast("long"))
    part = F.col("t") % 3
    lists = [
        rows.filter(part > 0).select(*own).join(ranks, ["uid", "t"]).select(last.alias("a"), none.alias("b"), none.alias("c"), *own),
        rows.filter(part < 2).select("s0", *own).join(after(1), ["uid", "t"], "left").select(F.col("s0").alias("a"), last.alias("b"), none.alias("c"), *own),
        rows.filter(part != 1).select("s0", "s1", *own).join(after(2), ["uid", "t"], "left").select(F.col("s0").alias("a"), F.col("s1").alias("b"), last.alias("c"), *own),
    ]
    # One list after the other, so that only one is on the disks at a time.
    return reduce(DataFrame.unionByName, [written(_compared(merged), "whole") for merged in lists]).distinct()


def _compared(merged: DataFrame) -> DataFrame:
    """(uid, t) of rows next to one of equal prefix in the order of (a, b, c). The row's own place
    ends the order, so equal suffixes may fall into several partitions; a pair cut apart there
    is left to the edges."""
    merged = merged.orderBy("a", "b", "c", "prefix", "uid", "t")

    def compare(batches):
        last = None
        for batch in batches:
            prefix, uid, t = (batch.column(i).to_numpy() for i in range(3))
            if last is not None:
                prefix, uid, t = (np.concatenate([[x], y]) for x, y in zip(last, (prefix, uid, t)))
            if not len(t):
                continue
            same = prefix[1:] == prefix[:-1]
            equal = np.zeros(len(t), bool)
            equal[1:] |= same
            equal[:-1] |= same
            last = (prefix[-1], uid[-1], t[-1])
            yield pa.RecordBatch.from_arrays([pa.array(uid[equal]), pa.array(t[equal].astype(np.int32))], ["uid", "t"])

    return merged.select("prefix", "uid", "t").mapInArrow(compare, "uid long, t int")


# --- the operator ------------------------------------------------------------------------

def repeated_spans(texts: DataFrame) -> DataFrame:
    """uid and the spans (begin, end) of strings that start twice in ``texts`` (uid, text)."""
    after = materialize(texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(_after, "uid long, after array<long>"), "after")
    each = after.select("uid", F.posexplode("after").alias("t", "after"))
    twice = each.groupBy("after").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("after")
    wanted = each.join(materialize(twice, "twice"), "after", "left_semi").groupBy("uid").agg(F.collect_list("t").alias("wanted"))
    wanted = written(wanted, "wanted")
    discard(after)
    some = lookup(texts, wanted.select("uid"), "uid", "left_semi")
    rows = some.join(wanted, "uid").select("uid", "text", "wanted").mapInArrow(_suffixes, _SUFFIXES)
    rows = written(rows, "suffixes")
    ranks = sorted_suffixes(rows.select("uid", "t", "s0", "s1", "s2"))
    whole = adjacent_equal(rows.filter("open").select("uid", "t", "s0", "s1", "prefix"), ranks)
    marked = rows.filter("open").drop("open").join(whole.withColumn("whole", F.lit(True)), ["uid", "t"], "left")
    marked = written(marked.select("uid", "begin", "end", "prefix", "after", F.col("whole").isNull().alias("open")), "marked")
    discard(wanted, rows, ranks, whole)
    spans = marked.filter("not open").select("uid", "begin", "end")

    # Edges: open phrases, and one phrase of each repeated kind that ends like an open one.
    ends = materialize(marked.filter("open").select("after").distinct(), "ends")
    kinds = marked.filter("not open").join(ends, "after", "left_semi").groupBy("prefix").agg(F.min(F.struct("uid", "begin", "end")).alias("one"))
    asked = marked.filter("open").select("uid", "begin", "end", F.lit(True).alias("open")).unionByName(
        kinds.select("one.*", F.lit(False).alias("open"))
    )
    asked = materialize(asked.groupBy("uid").agg(F.collect_list(F.struct("begin", "end", "open")).alias("wanted")), "asked")
    source = lookup(texts, asked.select("uid"), "uid", "left_semi").join(asked, "uid").select("uid", "text", "wanted")
    strings = written(source.mapInArrow(_strings, "low long, high long, uid long, begin int, open boolean"), "strings")
    equal = strings.groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("low", "high")
    edges = strings.filter("open").join(equal, ["low", "high"], "left_semi")
    return spans.unionByName(edges.select("uid", "begin", (F.col("begin") + LENGTH).alias("end")))


def _cut(text: bytes, spans: list) -> tuple[int, int, list[tuple[int, int]]]:
    runs: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return sum(e - b for b, e in runs), len(runs), [(b, e) for b, e in runs]


_REMOVED = "uid long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _removed(with_bytes: bool):
    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for uid, text, spans, n in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                raw = text.encode()
                if n > 1 and len(raw) >= LENGTH:
                    spans = [{"begin": 0, "end": len(raw)}]
                total, count, runs = _cut(raw, spans or [])
                cuts = [0, *[x for run in runs for x in run], len(raw)]
                kept = b"".join(raw[cuts[i] : cuts[i + 1]] for i in range(0, len(cuts), 2))
                for column, value in zip(out, (uid, total, count, kept if with_bytes else None, hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["uid", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, text_column: str = "text", with_bytes: bool = True) -> DataFrame:
    """Every row as ``row`` with n_bytes, n_removed, n_spans, kept (bytes, if asked for) and kept_sha256."""
    text = text_of(text_column)
    rows = numbered(docs, F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"))
    groups = rows.groupBy("digest").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups.filter("n > 1"), "groups")
    classed = materialize(lookup(rows.select("uid", "digest", "n_bytes"), groups, "digest", "left").select(
        "uid", "digest", "n_bytes", F.coalesce("first", "uid").alias("first"), F.coalesce("n", F.lit(1)).alias("n")), "classed")
    copies = materialize(classed.filter("first <> uid").select("uid"), "copies")
    texts = lookup(rows.select("uid", text_of(f"row.{text_column}").alias("text")), copies, "uid", "left_anti")
    spans = repeated_spans(texts).groupBy("uid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    several = classed.filter(f"first = uid and n > 1 and n_bytes >= {LENGTH}").select("uid", "n")
    touched = materialize(spans.join(several, "uid", "full").select("uid", "spans", F.coalesce("n", F.lit(1)).alias("n")), "spans")
    affected = lookup(texts, touched.select("uid"), "uid", "left_semi").join(touched, "uid").select("uid", "text", "spans", "n")
    cut = materialize(affected.mapInArrow(_removed(with_bytes), _REMOVED), "cut")
    result = lookup(classed.select("uid", "first", "digest"), cut.withColumnRenamed("uid", "first"), "first", "left") if not with_bytes else (
        classed.select("uid", "first", "digest").join(cut.withColumnRenamed("uid", "first"), "first", "left"))
    out = rows.select("uid", "row", "n_bytes").join(result, "uid")
    untouched = F.encode(text_of(f"row.{text_column}"), "UTF-8") if with_bytes else F.lit(None).cast("binary")
    zero = F.lit(0).cast("long")
    return out.select(
        "row", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.when(F.col("kept_sha256").isNull(), untouched).otherwise(F.col("kept")).alias("kept"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )
