"""Shared plumbing: table access, durable intermediate tables, joins that stay even under hot keys."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with at least 1/HOT_SHARE of all rows is hot; so there are at most HOT_SHARE hot keys.
HOT_SHARE = 512
#: Rows of a batch that a Python function gets while a table is written.
BATCH, BATCH_KEY = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bits of the bitmap that `among` broadcasts.
BITMAP = 1 << 26
#: The white space of the word contracts: space and tab to carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in a session of one process that names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends at committed files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    # Python functions of this job get small batches: texts may be long, and a task holds several copies of a batch.
    size = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(min(BATCH, int(size)) if int(size) > 0 else BATCH))
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(BATCH_KEY, size)
    # Shuffle files of the finished job go once the driver's JVM has collected what refers to them.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Empties tables of `materialize` that nothing reads any more."""
    for df in tables:
        paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for path in paths:
            df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)


def trim() -> None:
    """Gives freed memory back to the system: Python workers live on between stages."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that trims its worker when it is done."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return wrapped


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def join_hot(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows with one row per group, even if a group holds a third of all rows.

    Groups of at least 1/HOT_SHARE of `total` rows number HOT_SHARE at most and are broadcast; the
    others are shuffled, each with a small share of the rows. `rows` should be a stored table: it is
    scanned twice. `key` must not be null.
    """
    least = max(2, -(-total // HOT_SHARE))
    hot = groups.where(F.col(count) >= least)
    cold = groups.where(F.col(count) < least)
    first = rows.join(F.broadcast(hot), key, "inner")
    names = hot.select(key)
    rest = rows.join(F.broadcast(names), key, "left_anti").join(cold, key, how)
    return first.unionByName(rest)


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has in any case."""
    taken = {c.lower() for df in tables for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mapped(rows: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have their long key in ids (one column of that name), and those that surely have not.

    A bitmap of BITMAP hashed keys is broadcast, 8 MB whatever the number of ids, so neither part is shuffled here.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP))
    no, map_ = fresh("map_no", rows), fresh("map", rows)
    maps = ids.select(F.bitmap_bucket_number(place).alias(no), F.bitmap_bit_position(place).alias("bit")).groupBy(no).agg(F.bitmap_construct_agg("bit").alias(map_))
    maps = materialize(maps, "bitmap")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(map_), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")) % 2 == 1, F.lit(False))
    met = rows.withColumn(no, F.bitmap_bucket_number(place)).join(F.broadcast(maps), no, "left")
    return met.where(held).select(*rows.columns), met.where(~held).select(*rows.columns)


def among(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """The inner join of rows with others, one row a key, where few rows have a partner: those without are not shuffled.

    The join is named, so that plans do not change with the size of the table.
    """
    return mapped(rows, others.select(key), key)[0].join(others.hint("merge"), key)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
