"""What the operators of this subpackage share: reading, checkpoints, Arrow batches, ranks and components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.checkpoints import checkpoint

#: Rows that a driver-side or broadcast structure may hold; beyond it every operator takes its shuffle path.
BROADCAST_ROWS = 200_000
#: Rows that a group has at least to be joined by broadcast for its size.
HOT = 256
#: Rows that a function over Arrow batches turns into Python values at a time.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def let_go() -> None:
    """Give freed memory back to the system: workers that wait for their next task stand beside those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, setup: Callable[[], None] | None = None, done: Callable[[], object] | None = None, rows: int = BATCH_ROWS) -> DataFrame:
    """Run `work` on slices of each Arrow batch. Python holds one slice's values; a lost task is run again.

    `done` is called when a task ends, to drop what it has remembered: workers are used again by other operators.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup:
            setup()
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    out = work(batch.slice(at, rows))
                    if out is not None and out.num_rows:
                        yield out
                    out = None
                batch = None
        finally:
            if done:
                done()
            let_go()

    return df.mapInArrow(run, schema)


def joined_back(rows: DataFrame, groups: DataFrame, on: list[str], total: int, count: str = "n", hot: int = HOT, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`rows` with their group's columns; `groups` has the number of its rows, of `total` in all, in `count`.

    Groups of total / limit rows or more are `limit` at most, whatever the data: they are broadcast, so that no
    task has to take all rows of a hot group. The others are joined by shuffle.
    """
    least = max(hot, -(-total // limit))
    large = F.broadcast(groups.where(F.col(count) >= least))
    small = groups.where(F.col(count) < least)
    return rows.join(large, on).unionByName(rows.join(large.select(*on), on, "left_anti").join(small, on))


def attached(rows: DataFrame, more: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """`rows` joined with `more`, which has a row for each key: by broadcast where `more` was counted to be small."""
    return rows.join(F.broadcast(more) if more.count() <= BROADCAST_ROWS else more, on, how)


def ranked(df: DataFrame, groups: list[str], order: list[str], to: str, buckets: int = 256) -> DataFrame:
    """Add `to`: a gapless rank from 0 in each group, without gathering a group in one task.

    Rows are dealt by (group, bucket of a hash of `order`), counted there, and the bucket counts (at most
    groups x buckets rows, few per group) are summed to each bucket's first rank. `order` has to tell rows
    apart; rows that are equal in it get ranks in an undefined but gapless order.
    """
    bucket, first = fresh("bucket"), fresh("first")
    df = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = df.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias(first))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy(*groups, bucket).orderBy(*order)) - 1
    joined = df.withColumn(to, own).join(starts.hint("shuffle_hash"), [*groups, bucket])
    return joined.withColumn(to, (F.col(to) + F.col(first)).cast("long")).drop(bucket, first)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected `edges`: (node, component), component the smallest node reachable.

    Alternates large-star and small-star rounds (Kiveris et al., Connected Components in MapReduce and
    Beyond, 2014) until the edges no longer change; a round needs aggregates and joins by node only, a
    node's neighbours are never gathered, and each round ends in a checkpoint.
    """
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    stars = checkpoint(stars)
    seen = None
    while True:
        # large star: each larger neighbour of a node is linked to the node's smallest neighbour
        both = stars.union(stars.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # small star: each smaller neighbour, and the node itself, is linked to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        stars = checkpoint(small)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return stars.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        seen = now
