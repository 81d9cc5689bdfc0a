"""Removal of lines that several documents repeat (operator 13), from column functions only.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at
least ``min_points`` code points that at least ``min_documents`` documents hold keep their lines
in the document with the largest id only.

Every long line becomes a row (hash, document, position); the text stays behind. The rows are
partitioned by ranges of the hash and sorted by document, last one first, and position, so a
partition streams over each key's run: its first document is the one that keeps the lines, and
the third one makes the key a repeated one. A key that is frequent in a sample of the rows is
cut into slices of documents, so that no task holds it whole; the runs of such a key, one row
each, are put together in a small table. The sample only decides the layout, never a result.
What goes back to a document is a compressed bitmap: words of 64 lines, those alone in which a
line goes. Texts meet their bitmaps once.

Defined results: null and empty texts are one empty line, which stays; rows that share an id
(null ids too) are one document, whose lines stay in each of its rows or in none; a null id is
the smallest; an empty table gives no rows; extra columns are carried along in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import carried, text_of, written
from quarry.scale import materialize

MIN_POINTS = 20
MIN_DOCUMENTS = 3
SAMPLE_ROWS = 200_000
FREQUENT = 100  # rows of the sample from which a key is cut, so at most SAMPLE_ROWS / FREQUENT keys are
SLICES = 64
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD_BITS = 6


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Without white space at both ends, A-Z in lower case; lines of ASCII take the short way."""
    bare = F.btrim(line, F.lit(_WHITE))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _digest(value: Column, size: int) -> Column:
    """The first ``size`` bytes of the SHA-256."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, size)


def _long_lines(docs: DataFrame, min_points: int) -> DataFrame:
    """id, twin, hash, position of every line whose key is long enough."""
    each = docs.select("id", "twin", F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    keyed = each.select("id", "twin", "position", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_points).select(_digest(F.col("key"), 16).alias("hash"), "id", "twin", "position")


def _frequent(lines: DataFrame) -> DataFrame:
    """hash of the keys that hold a large share of the rows, judged by a sample of bounded size."""
    share = min(1.0, SAMPLE_ROWS / max(1, lines.count()))
    counts = lines.sample(share, 7).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "hash").limit(SAMPLE_ROWS // FREQUENT)
    return materialize(found.select("hash", F.lit(True).alias("frequent")), "frequent")


def repeated_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """id, twin, position of the lines that go, out of written rows (hash, id, twin, position)."""
    frequent = _frequent(lines)
    slice_of = F.when(F.col("frequent"), F.pmod(F.xxhash64("id"), F.lit(SLICES)) + 1).otherwise(F.lit(0)).cast("int")
    sliced = lines.join(F.broadcast(frequent), "hash", "left").withColumn("slice", slice_of).drop("frequent")
    last_first = F.desc_nulls_last("id")
    ranged = sliced.repartitionByRange("hash", "slice").sortWithinPartitions("hash", "slice", last_first, "position")
    run = Window.partitionBy("hash", "slice").orderBy(last_first)  # takes the order as it is
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = ranged.withColumn("nth", F.dense_rank().over(run)).withColumn("documents", F.max("nth").over(whole))
    done = (F.col("slice") == 0) & (F.col("documents") >= min_documents) & (F.col("nth") > 1)
    runs = materialize(nth.filter(done | (F.col("slice") > 0)), "runs")

    rare = runs.filter(F.col("slice") == 0)
    # The keys that were cut: few, and each with one row per slice.
    heads = runs.filter((F.col("slice") > 0) & (F.col("nth") == 1)).groupBy("hash", "slice").agg(F.first("id").alias("id"), F.max("documents").alias("documents"))
    largest = F.max_by("id", F.struct(F.col("id").isNotNull(), F.col("id"))).alias("keeper")
    cut = materialize(heads.groupBy("hash").agg(F.sum("documents").alias("in_all"), largest), "cut")
    often = runs.filter(F.col("slice") > 0).join(F.broadcast(cut.filter(F.col("in_all") >= min_documents)), "hash")
    often = often.filter(~F.col("id").eqNullSafe(F.col("keeper")))
    columns = ["id", "twin", "position"]
    return rare.select(columns).unionByName(often.select(columns))


def bitmaps(dropped: DataFrame) -> DataFrame:
    """id, twin, n_dropped and ``keep``: the 64-line words, in order, that do not keep all lines."""
    bit = F.expr(f"shiftleft(1L, position & {(1 << _WORD_BITS) - 1})")
    by_document = dropped.repartition("id", "twin")  # both groupings below reuse it
    words = by_document.groupBy("id", "twin", F.shiftright("position", _WORD_BITS).alias("word")).agg(F.bit_or(bit).alias("gone"))
    listed = F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("lines"))))
    return words.groupBy("id", "twin").agg(F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"), listed.alias("keep"))


def drop_repeated_lines(
    docs: DataFrame, min_points: int = MIN_POINTS, min_documents: int = MIN_DOCUMENTS,
    id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Every row as ``row`` with n_lines, n_dropped, the bitmap ``keep`` and ``kept_text``."""
    text = text_of(text_column)
    # Rows alike in id and text are alike in what goes, so the two name a row well enough.
    source = docs.select(carried(keep), F.col(id_column).alias("id"), text.alias("text"), _digest(text, 8).alias("twin"))
    lines = written(_long_lines(source.select("id", "twin", "text"), min_points), "lines")
    found = bitmaps(repeated_lines(lines, min_documents))
    found = materialize(found, "bitmaps").withColumnsRenamed({"id": "_id", "twin": "_twin"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin"))
    met = source.join(found.hint("shuffle_hash"), same, "left")  # the texts stream past the bitmaps
    # One word per 64 lines, so that a line's bit is one step away.
    spread = F.expr(
        "flatten(transform(keep, (w, i) -> concat("
        "array_repeat(-1L, w.word - if(i = 0, -1, get(keep, i - 1).word) - 1), array(w.lines))))"
    )
    kept = F.expr(f"filter(lines, (x, i) -> shiftright(coalesce(get(spread, shiftright(i, {_WORD_BITS})), -1L), i & {(1 << _WORD_BITS) - 1}) & 1L = 1L)")
    return (
        met.withColumn("lines", lines_of(F.col("text"))).withColumn("spread", spread)
        .select(
            "row", F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep",
            F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        )
    )
