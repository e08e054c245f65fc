"""Shared pieces: written tables in the cluster's folder, column selection, and connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder in ``spark.checkpoint.dir``; every executor reaches it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        ensure_checkpoint_dir(spark)
        named = spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet in the shared folder and read back: cuts lineage, keeps column pruning, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stored` wrote, once everything that reads them has been stored itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def perhaps_among(rows: DataFrame, keys: DataFrame, *names: str, bits: int = 1 << 25) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be one of ``keys``, rows whose key is none for certain).

    A prefilter in front of an exact join: a bitmap of fixed size (4 MB) over hashed keys is broadcast, so the other rows are not shuffled.
    Few rows are let through in vain while the keys are far fewer than ``bits``.
    """
    def slot() -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(bits)) + 1

    pages = keys.groupBy(F.bitmap_bucket_number(slot()).alias("__page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot())).alias("__bits"))
    at = F.bitmap_bit_position(slot())
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    joined = rows.join(F.broadcast(pages), F.bitmap_bucket_number(slot()) == F.col("__page"), "left")
    held = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))) % 2 == 1, F.lit(False))
    return joined.filter(held).drop("__page", "__bits"), joined.filter(~held).drop("__page", "__bits")


def small_batches(spark: SparkSession) -> None:
    """Rows are whole texts here: hand them to Python workers a thousand at a time unless the session says otherwise.

    The setting belongs to the session and is read when a query runs, so it stays for the session's later queries.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows in a batch for Python workers while a query runs; the session's own setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return freed memory of a Python worker, which lives on and is used again by other stages, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node long, component long): the smallest node reachable over the edges, for every node that has an edge.

    Alternating large-star and small-star contraction. Each round is two minimum aggregations and two joins of
    the edge list with them; the number of rounds grows with the logarithm of the longest path. No component is
    gathered in one task. Null ends and loops are ignored; the edge list may be empty or hold repeats.
    """
    edges = (edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
             .filter(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = stored(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above a node move to its smallest neighbour
        large = (both.filter(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).distinct())
        # small star: the node and its lower neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b")))
                 .filter(F.col("a") != F.col("b")).distinct())
        edges, before = stored(small, "edges"), edges
        discard(before)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
