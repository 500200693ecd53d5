"""What the text operators share: reading, settings, checked broadcasts, links and components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrill.session import written

# What `[\x20\x09-\x0D]` matches; Python's bytes.split() splits at the same six bytes.
SPACES = " \t\n\x0b\x0c\r"

# Texts per Arrow batch, by number and by bytes: a batch of long texts still fits a worker.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Sets how many texts go to a Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ordered_id(name: str = "doc_id") -> Column:
    return F.col(name).cast("bigint").alias(name)


def shared_table(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Shuffle files that nothing refers to any more are let go of, so that the disk holds the
    written rows alone.
    """
    spark, out = df.sparkSession, written(df, purpose)
    del df
    let_go(spark)
    return out


def let_go(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files that nothing refers to any more, before many new ones are written."""
    gc.collect()
    spark._jvm.System.gc()


def in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    return df.mapInArrow(function, schema)


def grouped(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: neighbours are put together up to ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; a scan that stops as soon as it has more."""
    return df.limit(rows + 1).count() <= rows


def pairs_both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """``node, component`` (smallest node reachable) of an undirected graph of links ``a, b``.

    Alternating large-star and small-star steps: each step rewires links towards smaller
    neighbours, so that the number of steps grows with the logarithm of a component's
    diameter and no step has more links than the one before. A hot node costs no more than
    others: the smallest neighbour is an aggregate with a map-side part, and the join back
    to the node's links is split by adaptive execution. Only links move, never documents.
    """
    edges = shared_table(
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    while True:
        large = _star(pairs_both_ways(edges), keep=F.col("b") > F.col("a"))
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), keep=F.lit(True))
        after = shared_table(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), purpose)
        changed = not after.exceptAll(edges).isEmpty() or after.count() != edges.count()
        edges = after
        if not changed:
            break
    # now every link goes from a component's smallest node to one of the others
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("component")))


def _star(directed: DataFrame, keep: Column) -> DataFrame:
    """Links every kept neighbour ``b`` of ``a``, and ``a`` itself, to the smallest of them all."""
    least = directed.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = directed.join(least, "a")
    neighbours = joined.where(keep).select(F.col("m").alias("x"), F.col("b").alias("y"))
    own = least.select(F.col("m").alias("x"), F.col("a").alias("y"))
    both = neighbours.unionByName(own).where(F.col("x") != F.col("y"))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
