"""Duplicate files by a cascade of ever dearer keys, and which copy to keep.

Sizes first: they are metadata, so contents of files whose size nobody shares are never read, as long as the repeated
sizes are few enough to filter the scan with. What is left is hashed where it is read; only path, size, time and hash
are shuffled, never a content. Equal keys are counted map-side, and no group is gathered in one task.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import copylike, human_size

#: Repeated sizes that are broadcast to filter the scan; with more of them all contents are hashed.
SIZES = 1_000_000
# Fixed value: bytes of the quick hash.
FIRST = 1 << 20


def _repeated(files: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur twice or more. A hot key shuffles a count per task, and the rows join by AQE's skew split."""
    many = files.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n")
    return files.join(many, keys, "left_semi")


def duplicates(files: DataFrame, strict_mtime: bool = False, most_sizes: int = SIZES) -> DataFrame:
    """Rows (path, size, mtime, content) that have a copy: path, size, mtime, hash. Unreadable contents (null) are dropped.

    strict_mtime: copies must also have been changed in the same second.
    """
    shared = files.groupBy("size").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("size")
    few = shared.limit(most_sizes + 1).count() <= most_sizes
    base = files.join(F.broadcast(shared), "size", "left_semi") if few else files
    hashed = base.where(F.col("content").isNotNull()).select("path", "size", "mtime", F.sha2("content", 256).alias("hash"), F.unix_seconds("mtime").alias("mtime_s"))
    return _repeated(hashed, ["size", "hash", *(["mtime_s"] if strict_mtime else [])])


def _blake2b(contents: pd.Series) -> pd.Series:
    return contents.map(lambda c: None if c is None else hashlib.blake2b(c).hexdigest())


def hashes(files: DataFrame, first: int = FIRST) -> DataFrame:
    """path, size, first_sha256 (of the first MiB), sha256 and blake2b of each content; null where it can't be read."""
    blake2b = F.pandas_udf(_blake2b, "string")
    return files.select("path", "size", F.sha2(F.substring("content", 1, first), 256).alias("first_sha256"), F.sha2("content", 256).alias("sha256"), blake2b("content").alias("blake2b"))


def known_content(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Files (path, size, content) with whether the store already has their content: by size, then by hash."""
    key = lambda df: df.where(F.col("content").isNotNull()).select("path", "size", F.sha2("content", 256).alias("hash"))
    there = key(stored).select("size", "hash").distinct().withColumn("_t", F.lit(True))
    return key(files).join(there, ["size", "hash"], "left").select("path", "hash", F.coalesce("_t", F.lit(False)).alias("stored"))


def ranked(copies: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Each copy with ``action``: keep for the best of its group (no copy-like name, short name, path), else delete.

    The best is a minimum per group, so no group is sorted in one task.
    """
    keys = keys or ["hash"]
    name = F.regexp_extract("path", r"([^/\\]*)$", 1)
    order = F.struct(copylike(name).cast("int").alias("c"), F.length(name).alias("l"), F.lower("path").alias("p"), F.col("path"))
    own = copies.withColumn("_o", order)
    best = own.groupBy(*keys).agg(F.min("_o").alias("_b"))
    return own.join(best, keys).select(*copies.columns, F.when(F.col("_o") == F.col("_b"), "keep").otherwise("delete").alias("action"))


def report(files: DataFrame, strict_mtime: bool = False) -> DataFrame:
    """path, action, size_bytes, size_human, hash of every copy."""
    keys = ["hash", "mtime_s"] if strict_mtime else ["hash"]
    return ranked(duplicates(files, strict_mtime), keys).select("path", "action", F.col("size").alias("size_bytes"), human_size(F.col("size")).alias("size_human"), "hash")


def totals(files: DataFrame) -> DataFrame:
    """Groups, files in them, and files and bytes that could go."""
    each = duplicates(files).groupBy("hash").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    return each.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_files"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_delete"), F.coalesce(F.sum((F.col("n") - 1) * F.col("size")), F.lit(0)).alias("bytes_delete"))


def numbered(groups: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``group_no`` from 1 in the given total order, without a single-task window.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the rows of the partitions
    before. Only one count per partition reaches the driver.
    """
    from folioforge.session import checkpoint

    spark = groups.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = groups.repartitionByRange(width, *order).sortWithinPartitions(*order)
    placed = checkpoint(placed.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")))
    counts = sorted((r["_part"], r["n"], r["first"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_id").alias("first")).collect())
    offsets, total = {}, 0
    for part, n, first in counts:
        offsets[part] = total - first + 1
        total += n
    if not offsets:
        return placed.drop("_part", "_id").withColumn("group_no", F.lit(None).cast("long"))
    table = F.create_map(*[F.lit(x) for p, o in offsets.items() for x in (p, F.lit(o).cast("long"))])
    return placed.withColumn("group_no", F.col("_id") + F.element_at(table, F.col("_part"))).drop("_part", "_id")
