"""Exact deduplication (operator 1) against immutable snapshots screened by binary-fuse filters.

A snapshot keeps one row per distinct digest and, for every bucket of digests, a static
binary-fuse filter: three hashed slots in neighbouring segments, one byte each, no false
negatives. A batch is first grouped by its own digests (partial counts, so a text that fills
a third of the batch is one row afterwards); the groups pass the filters bucket by bucket.
Groups the filter refuses are new. Positives join the exact bucket by digest. Groups of more
than one row are then compared byte by byte with the row that stays; digests under which
different texts meet are regrouped by the text itself.

Defined results: null text counts as empty; a null doc_id comes after every number; rows that
repeat id and text form a group of which one row stays; an empty table gives no rows; extra
columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, lookup, mix, numbered
from quarry.scale import materialize

BUCKET_KEYS = 1 << 17
_FILTER = "bucket int, seed long, segment int, segments int, slots binary"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


# --- the filter -------------------------------------------------------------------------

def _slots(keys: np.ndarray, seed: int, segment: int, segments: int):
    h = mix(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
    mask, step = np.uint64(segment - 1), np.uint64(segment)
    second = (first + step) ^ ((h >> np.uint64(18)) & mask)
    third = (first + step + step) ^ (h & mask)
    return np.stack([first, second, third], 1).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def fuse_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, number of segments and slots of a filter that holds all ``keys``."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    segment = 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25))
    room = n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    segments = max(1, int(np.ceil(room / segment)) - 2)
    size = (segments + 2) * segment
    for seed in range(1, 200):
        places, prints = _slots(keys, seed * 0x9E3779B9, segment, segments)
        count = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, np.int64)
        index = np.arange(len(keys))
        for j in range(3):
            np.bitwise_xor.at(held, places[:, j], index)
        peeled, frontier = [], np.flatnonzero(count == 1)
        while len(frontier):
            owners, at = np.unique(held[frontier], return_index=True)
            peeled.append((owners, frontier[at]))
            touched = places[owners]
            for j in range(3):
                np.subtract.at(count, touched[:, j], 1)
                np.bitwise_xor.at(held, touched[:, j], owners)
            frontier = np.unique(touched)
            frontier = frontier[count[frontier] == 1]
        if sum(len(o) for o, _ in peeled) == len(keys):
            break
    else:
        raise ValueError("no seed gives a filter")
    slots = np.zeros(size, np.uint8)
    for owners, own in reversed(peeled):
        others = np.bitwise_xor.reduce(slots[places[owners]], axis=1) ^ slots[own]
        slots[own] = prints[owners] ^ others
    return seed * 0x9E3779B9, segment, segments, slots.tobytes()


def may_hold(keys: np.ndarray, seed: int, segment: int, segments: int, slots: bytes) -> np.ndarray:
    places, prints = _slots(keys.astype(np.uint64), seed, segment, segments)
    table = np.frombuffer(slots, np.uint8)
    return np.bitwise_xor.reduce(table[places], axis=1) == prints


def _key(digest: Column) -> Column:
    return F.xxhash64(digest)


@dataclass
class Snapshot:
    """Distinct digests (digest, key, bucket, keeper, n) and the filters of their buckets."""

    keys: DataFrame
    filters: DataFrame
    buckets: int


def _grouped(rows: DataFrame) -> DataFrame:
    # A struct compares field by field: numbers before nulls, then the id, then the row number.
    keeper = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("uid"))
    return rows.groupBy("digest").agg(F.min(keeper).alias("keeper"), F.count(F.lit(1)).alias("n"))


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("key", _key(F.col("digest"))).withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))


def snapshot(rows: DataFrame, bucket_keys: int = BUCKET_KEYS) -> Snapshot:
    """The immutable snapshot of ``rows`` (digest, id, uid)."""
    groups = materialize(_grouped(rows), "snapshot")
    buckets = max(1, -(-groups.count() // bucket_keys))
    keys = _bucketed(groups, buckets)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, slots = fuse_filter(part["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": part["bucket"].iloc[:1], "seed": [seed], "segment": [segment], "segments": [segments], "slots": [slots]})

    filters = keys.select("bucket", "key").groupBy("bucket").applyInPandas(build, _FILTER)
    return Snapshot(keys, materialize(filters, "filters"), buckets)


def screen(groups: DataFrame, known: Snapshot) -> DataFrame:
    """``groups`` of a batch with ``maybe``: false where the snapshot surely lacks the digest."""
    asked = _bucketed(groups, known.buckets).withColumn("part", F.pmod(F.shiftright("key", 20), F.lit(8)).cast("int"))
    # A bucket's questions are dealt over eight tasks, each with its copy of the filter.
    filters = known.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(7))))

    def ask(questions: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = questions[["digest", "key"]].copy()
        if len(found) and len(out):
            f = found.iloc[0]
            out["maybe"] = may_hold(out.pop("key").to_numpy().view(np.uint64), int(f.seed), int(f.segment), int(f.segments), f.slots)
        else:
            out["maybe"] = False
        return out[["digest", "maybe"]]

    tested = (
        asked.select("bucket", "part", "digest", "key").groupBy("bucket", "part")
        .cogroup(filters.groupBy("bucket", "part")).applyInPandas(ask, "digest string, maybe boolean")
    )
    return groups.join(tested, "digest")


def deduplicate(
    docs: DataFrame, is_new: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
    digest=sha256, bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """Every row of ``docs`` as ``row`` with digest, keep_id, group_size and kept.

    Rows where ``is_new`` holds are the incoming batch, the others the snapshot. The row with
    the smallest id of equal texts stays.
    """
    text = normalised(F.col(text_column))
    new = F.coalesce(is_new, F.lit(True)) if is_new is not None else F.lit(True)
    rows = numbered(docs, F.col(id_column).alias("id"), digest(text).alias("digest"), new.alias("new"))
    narrow = rows.select("digest", "id", "uid", "new")
    known = snapshot(narrow.filter(~F.col("new")), bucket_keys)
    batch = materialize(_grouped(narrow.filter("new")), "batch")
    tested = materialize(screen(batch, known), "screened")

    fresh = tested.filter(~F.col("maybe")).drop("maybe")
    exact = known.keys.select("digest", "keeper", "n")
    met = (
        exact.unionByName(tested.filter("maybe").drop("maybe"))
        .groupBy("digest").agg(F.min("keeper").alias("keeper"), F.sum("n").alias("n"))
    )
    groups = materialize(met.unionByName(fresh).filter("n > 1"), "groups")
    rows, groups = _split_collisions(rows, groups, text_column)
    out = lookup(rows, groups, "digest", "left")
    alone = F.col("n").isNull()
    return out.select(
        "row", "digest",
        F.when(alone, F.col("id")).otherwise(F.col("keeper.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keeper.uid") == F.col("uid"))).alias("kept"),
    )


def _split_collisions(rows: DataFrame, groups: DataFrame, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Compare every member with the row that stays; regroup by text where a digest lies."""
    text = normalised(F.col(f"row.{text_column}"))
    keeper = groups.select("digest", F.col("keeper.uid").alias("keeper_uid"))
    members = lookup(rows.select("digest", "uid", text.alias("text")), keeper, "digest")
    stays = members.filter("uid = keeper_uid").select("digest", F.col("text").alias("kept_text"))
    others = members.filter("uid <> keeper_uid").select("digest", "text")
    differ = others.join(stays, "digest").filter("text <> kept_text").select("digest").distinct()
    differ = materialize(differ, "collisions")
    if differ.isEmpty():
        return rows, groups
    # The text becomes part of the digest of these rows, so groups stay plain equi-joins.
    marked = rows.join(differ.withColumn("lies", F.lit(True)), "digest", "left")
    own = F.when(F.col("lies"), F.concat("digest", F.lit(" "), text)).otherwise(F.col("digest"))
    rows = marked.withColumn("digest", own).drop("lies")
    again = _grouped(rows.filter(F.instr("digest", " ") > 0).select("digest", "id", "uid")).filter("n > 1")
    kept = groups.join(differ, "digest", "left_anti")
    return rows, materialize(kept.unionByName(again), "groups")


def with_digest(result: DataFrame) -> DataFrame:
    """The query's columns: the digest may hold a colliding text, so it is taken anew from it."""
    return result.select("row.doc_id", "keep_id", "group_size", "kept", F.substring_index("digest", " ", 1).alias("text_sha256"))


def unique(docs: DataFrame, is_new: Column | None = None) -> DataFrame:
    """``docs`` without the repeated texts."""
    return deduplicate(docs, is_new).filter("kept").select("row.*")


def newer_half(docs: DataFrame, id_column: str = "doc_id") -> Column:
    """True for ids above the median: ids grow with time, so the older half is the snapshot."""
    middle = docs.agg(F.percentile_approx(id_column, 0.5).alias("m")).first()["m"]
    return F.lit(True) if middle is None else F.col(id_column).isNull() | (F.col(id_column) > middle)
