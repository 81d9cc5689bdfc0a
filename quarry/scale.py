"""Helpers that keep plans safe at cluster scale.

* ``fits`` proves that a lookup table is small before it is broadcast,
* ``lookup_join`` broadcasts a proven-small table and otherwise salts the join,
* ``materialize`` cuts lineage with a table in the shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
SALTS = 32


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; taken from ``spark.checkpoint.dir``."""
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, packed tightly, and read it back.

    Used for tables that one query reads more than once (postings and the
    statistics over them). Losing an executor then costs a re-read, not a
    recomputation of the lineage. ``options`` go to the writer.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """True when ``df`` is measured to be below both bounds.

    Counted where the rows are, one number per task. The input is computed for it, so pass
    a written or a driver-side table.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes"),
    ).first()
    return measured["n"] <= max_rows and (measured["bytes"] or 0) <= max_bytes


def settle(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """Compute a request-side table once; say whether it is small.

    It is written, measured as written, and only then fetched: up to the broadcast bounds it
    becomes a local table of known size. A larger one is never broadcast.
    """
    written = materialize(df, name)
    if not fits(written):
        return shuffled(written), False
    return df.sparkSession.createDataFrame(written.toArrow(), df.schema), True


PUSHED_VALUES = 500
# Parquet readers test a list of this length value by value; a longer one only by its range.
_CHUNK = 10


def pushed_values(lookup: DataFrame, columns: list[str]) -> Column | None:
    """A filter for the scan of the table ``lookup`` will be joined to, if the values are few.

    A join alone does not skip partitions and row groups of sorted tables, literal
    values do. Looks at no more than the bound plus one row; None means no filter.
    """
    rows = lookup.select(*columns).distinct().limit(PUSHED_VALUES + 1).collect()
    if len(rows) > PUSHED_VALUES:
        return None
    condition = F.lit(True)
    for column in columns:
        values = sorted({row[column] for row in rows if row[column] is not None})
        chunks = [values[i : i + _CHUNK] for i in range(0, len(values), _CHUNK)]
        one_of = reduce(lambda a, b: a | b, [F.col(column).isin(c) for c in chunks], F.lit(False))
        condition = condition & one_of
    return condition


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for joins that must not broadcast it, whatever Spark guesses of its size."""
    return df.hint("merge")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: list[str],
    small_fits: bool | None = None,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join a table that grows with the data to a lookup table.

    A lookup table measured to be small is broadcast; to be measured it is written once, so it
    is not computed again for the join. A larger one is joined by shuffle with ``salts`` slices
    per key: rows of ``big`` go to a slice by the hash of ``spread_by`` and the lookup rows are
    repeated per slice, so a key that holds a third of ``big`` is shared by ``salts`` tasks.
    Where ``spread_by`` lies inside the keys a slice would not split anything: then the plain
    join does, and adaptive execution splits what is skewed. Both are held to a merge join: Spark
    guesses a table's size from its compressed files and takes no notice of the slices, so it would
    fetch millions of lookup rows to the driver to broadcast them.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti`` (seen from ``big``).
    """
    if small_fits is None:
        small = materialize(small, "lookup")
        small_fits = fits(small)
    if small_fits:
        return big.join(F.broadcast(small), keys, how)
    if set(spread_by) <= set(keys):
        return big.join(shuffled(small), keys, how)
    sliced = shuffled(small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    spread = big.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    return spread.join(sliced, [*keys, "_slice"], how).drop("_slice")


HOT_ROWS, HOT_KEYS = 50_000, 1_000
# Rows read and pairs met by one task of a ``spread_join``, and pairs of one slice of a key.
TASK_ROWS, TASK_PAIRS, SLICE_PAIRS = 500_000, 20_000_000, 50_000_000


def spread_join(big: DataFrame, lookup: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Inner equi-join of a stored table to a large stored lookup table in which only hot keys are sliced.

    ``lookup_join`` repeats every lookup row per slice, which for millions of unfolded rows costs more
    than the join. Here the rows of both tables per key are counted first, so they are read twice; a key
    with more than ``HOT_ROWS`` of ``big`` is cut into slices of about that many, one with more pairs than
    ``SLICE_PAIRS`` likewise. There are at most ``HOT_KEYS`` keys of many rows: with more, the share that makes
    a key hot grows with the table. The number of tasks follows the pairs: bytes say little of a join in which
    few rows meet many.
    """
    counts = materialize(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    asked = materialize(lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m")), "lookup_counts")
    share = max(HOT_ROWS, -(-(counts.agg(F.sum("_n")).first()[0] or 0) // HOT_KEYS))
    met = materialize(counts.join(shuffled(asked), keys).withColumn(
        "_slices", F.greatest(F.ceil(F.col("_n") / share), F.least("_n", F.ceil(F.col("_n") * F.col("_m") / SLICE_PAIRS))).cast("int")
    ), "met_keys")
    size = met.agg(F.sum(F.col("_n") + F.col("_slices") * F.col("_m")), F.sum(F.col("_n").cast("double") * F.col("_m"))).first()
    hot = met.where("_slices > 1").select(*keys, "_slices")
    spark = big.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism,
        -(-(size[0] or 0) // TASK_ROWS), int((size[1] or 0) // TASK_PAIRS) + 1,
    )

    def sliced(table: DataFrame, slice_of: Column) -> DataFrame:
        known = table.join(F.broadcast(hot), keys, "left").withColumn("_slices", F.coalesce("_slices", F.lit(1)))
        return known.withColumn("_slice", slice_of).drop("_slices").repartition(tasks, *keys, "_slice")

    spread = sliced(big, F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int"))
    repeated = sliced(lookup, F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    return spread.join(shuffled(repeated), [*keys, "_slice"]).drop("_slice")


SPREAD_ROWS = 100_000


def spread_rows(table: DataFrame) -> DataFrame:
    """A stored table of narrow rows over all cores: small files hold many rows that are unfolded and typed."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    rows = table.count()
    if rows <= SPREAD_ROWS or table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(max(cores, -(-rows // SPREAD_ROWS)))


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A table of driver-side rows (searches, property types) with a size Spark knows."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = pa.Table.from_arrays(
        [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, schema)],
        names=schema.fieldNames(),
    )
    return spark.createDataFrame(arrow, schema)
