"""Tables in the folder that driver and executors share, and size-checked joins."""

from __future__ import annotations

import atexit
import contextlib
import gc
import shutil
import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most rows of a slim (one or two long columns) join side that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

_LOCAL: dict[str, str] = {}
#: Folders made by this process, in order.
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one
    (master local: one machine) or the warehouse (any cluster)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there when this process ends goes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)

    def clear() -> None:
        with contextlib.suppress(Exception):
            remove(spark, path)

    atexit.register(clear)
    return path


def materialize(df: DataFrame, name: str = "table", by: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and rereads it: lineage ends here, and the
    rows survive lost executors. Later readers see the same rows and files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def made() -> int:
    """How many work folders this process has made: a mark for drop_made."""
    return len(_MADE)


def drop_made(spark: SparkSession, mark: int) -> None:
    """Removes the work folders made since the mark but for the last, the result of a finished stage: what it was made from isn't needed again."""
    for path in _MADE[mark:-1]:
        remove(spark, path)
    del _MADE[mark:-1]


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of df's size: for a scan, the bytes of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def parts_for(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    """Partitions so that each holds about bytes_each of df's input, within [least, 200000];
    least where the optimizer has no size, as for rows made in the driver."""
    size = size_in_bytes(df)
    return least if size >= 1 << 60 else max(least, min(200_000, -(-size // bytes_each)))


def join_slim(df: DataFrame, slim: DataFrame, on: list[str], how: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Joins df with a materialized slim table: broadcast if the table's counted
    rows are within ``most``, else a shuffle join that AQE may split."""
    return df.join(F.broadcast(slim) if slim.limit(most + 1).count() <= most else slim, on, how)


def join_hot(df: DataFrame, keys: DataFrame, on: list[str], count: str, how: str = "inner", hot: int = 2000) -> DataFrame:
    """Inner or left join of materialized df with materialized keys, whose column ``count`` says how many rows of df a
    key has. Keys with more than 1 / hot of all those rows (fewer than hot keys, so they are broadcast) never
    meet in one task; the rest shuffles. Rows of keys that df lacks don't matter. The column count goes."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(keys.drop(count)), on, how)
    bound = max(1, (keys.agg(F.sum(count)).first()[0] or 0) // hot)
    heavy = keys.filter(F.col(count) > bound).drop(count)
    known = F.broadcast(heavy.select(*on))
    return df.join(F.broadcast(heavy), on).unionByName(df.join(known, on, "left_anti").join(keys.filter(F.col(count) <= bound).drop(count), on, how))


def ranked(df: DataFrame, group: list[str], order: list, parts: int) -> DataFrame:
    """df with rank (from 1) and total (rows) of its group in the given order, however large a group: rows are
    range-partitioned and sorted, numbered in their partition as they are written, and shifted by the group's rows in
    the partitions before. order must name every row that ranks differently; nulls are a group."""
    keys = [*[F.col(g).asc_nulls_last() for g in group], *order]
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    rows = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # The id is the partition in the upper bits and the row's place in it in the lower 33.
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"), F.sum("_n").over(Window.partitionBy(*group)).alias("total"))
    # At most partitions + groups rows.
    shift = materialize(shift, "shift")
    match = F.col("_part") == F.col("_p")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_{g}"))
    small = shift.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = rows.join(F.broadcast(shift) if small else shift, match)
    return out.select(*df.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "total")


def release_memory() -> None:
    """Gives a Python worker's freed memory back to the machine: workers live as long as their
    executor, and what one stage's arrays took would be missing in the next."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def process_cache(owner: str) -> dict:
    """A dictionary of this process. Functions reach workers by value with copies of their module's
    globals, so a global there lasts for a task only; this lasts as long as the worker, or until another
    owner asks for its own: a worker goes on to other operators, which need the memory."""
    caches = sys.modules.setdefault("_tessera_cache", types.ModuleType("_tessera_cache")).__dict__.setdefault("caches", {})
    for other in [x for x in caches if x != owner]:
        del caches[other]
    return caches.setdefault(owner, {})


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) that gives freed memory back after every batch it reads and at its end."""

    def read(batches):
        for batch in batches:
            yield batch
            del batch
            release_memory()

    def whole(batches):
        yield from run(read(batches))
        gc.collect()
        release_memory()

    return df.mapInArrow(whole, schema)
