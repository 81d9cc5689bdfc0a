"""What several corpus operators share: reading, white space, row numbers, text blocks for numpy."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.scale import materialize, shared_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
_IN_PARTITION_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, packed tightly: for tables with texts or many rows.

    Afterwards Spark may drop the shuffle files that led to it. It does so once the driver has
    collected what refers to them, which a quiet driver puts off while the disks fill.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables once what was made of them is written and nothing reads them any more."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def carried(keep: list[str] | None) -> Column:
    """The input's columns, or those asked for, as one struct ``row`` that no own column can clash with."""
    return F.struct(*(keep if keep else ["*"])).alias("row")


def numbered(df: DataFrame, *own: Column) -> DataFrame:
    """The rows as one struct ``row`` beside own columns and a stable number ``uid``, written once.

    The input's columns are inside the struct, so no name of theirs can clash with ours.
    """
    packed = df.select(F.struct("*").alias("row"), *own, F.monotonically_increasing_id().alias("uid"))
    return written(packed, "rows")


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """The rows sorted over all partitions, with a gapless ``position`` from 0.

    The sorted rows are written once; a row's number is its partition's start plus its place
    there. Only one count per partition reaches the driver.
    """
    ranked = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    ranked = materialize(ranked, "ordered")
    part = F.shiftright("_place", _IN_PARTITION_BITS)
    counts = {r["p"]: r["n"] for r in ranked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    schema = "_part int, _start long"
    offsets = df.sparkSession.createDataFrame([(int(p), s) for p, s in starts], schema)
    inside = F.col("_place") - F.shiftleft(F.col("_part").cast("long"), _IN_PARTITION_BITS)
    return (
        ranked.withColumn("_part", part.cast("int"))
        .join(F.broadcast(offsets), "_part")
        .withColumn("position", F.col("_start") + inside)
        .drop("_part", "_start", "_place")
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, end row, their bytes, their offsets.

    Works on the Arrow buffers in place. A longer text is a block of its own, so memory is
    bounded by the longest text. Nulls count as empty.
    """
    texts = pc.fill_null(texts, "")
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


_POWERS = np.ones(1, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        table = np.full(max(n, 64), _BASE, np.uint64)
        table[0] = 1
        _POWERS = np.cumprod(table, dtype=np.uint64)
    return _POWERS


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and owning text of every word (maximal run of bytes that are no ASCII white space)."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    opens[firsts] = inside[firsts]
    closes = np.zeros(len(data) + 1, bool)
    closes[1:] = inside
    closes[1:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0]
    closes[lasts] = inside[lasts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order, not empty and do not overlap."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    values *= _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


_TABLED = 64  # places of a word whose values are looked up


def _place_values(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) << np.uint64(8)) + byte.astype(np.uint64) + _BASE)


_PLACES = _place_values(np.repeat(np.arange(_TABLED), 256), np.tile(np.arange(256), _TABLED))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the sum of a scrambled value per place and byte.

    Unlike a polynomial's, its values at different places are unrelated, so no pattern of bytes
    cancels. Spans are in order, not empty and do not overlap.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    byte = data[place + np.repeat(starts, lengths)].astype(np.int64)
    values = _PLACES[np.minimum(place, _TABLED - 1) * 256 + byte]
    far = place >= _TABLED
    if far.any():
        values[far] = _place_values(place[far], byte[far])
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


LOOKUP_ROWS = 200_000


def lookup(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a written table to ``big``: broadcast where its counted rows are few, else by shuffle.

    ``small`` holds short rows (keys and numbers), so the row bound is a size bound. Beyond it
    the shuffle join's hot keys are split by adaptive execution.
    """
    few = small.count() <= LOOKUP_ROWS
    return big.join(F.broadcast(small) if few else small, on, how)
