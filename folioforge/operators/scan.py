"""Scans over views of keys: ordered distinct union, fallback, lookups and checks between sets of keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Views that are tried where a database names none.
DEFAULT_VIEWS = ["($All)", "AllDocuments", "All Documents", "すべての文書", "全ての文書", "すべてのドキュメント"]


def manifest(dbs: DataFrame) -> DataFrame:
    """Databases with a title and a file, one row per view to read: views, else the one view, else the defaults."""
    ok = dbs.where(F.col("title").isNotNull() & F.col("db_file").isNotNull())
    views = F.when(F.size("views") > 0, F.col("views")).when(F.col("view_name").isNotNull(), F.array("view_name")).otherwise(F.array(*map(F.lit, DEFAULT_VIEWS)))
    return ok.select("replica", "title", F.posexplode(views).alias("view_ord", "view"))


def ordered_union(views: list[DataFrame], key: str, pos: str) -> DataFrame:
    """Keys of several views, each at its first sight: view number and place there. Null keys are left out."""
    marked = [v.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lit(i).alias("view_ord"), F.col(pos).alias("pos")) for i, v in enumerate(views)]
    first = reduce(DataFrame.union, marked).groupBy("key").agg(F.min(F.struct("view_ord", "pos")).alias("m"))
    return first.select("key", "m.view_ord", "m.pos")


def with_fallback(first: DataFrame, other: DataFrame) -> DataFrame:
    """The first scan, or the other one if the first gives nothing. The test is one row, whatever the size."""
    there = first.limit(1).select(F.lit(1).alias("_there"))
    return first.unionByName(other.join(F.broadcast(there), F.lit(True), "left_anti"))


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(F.col(key) == value)


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows with whether the right side has their key."""
    keys = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_m", F.lit(True))
    return left.join(keys, key, "left").withColumn("matched", F.coalesce("_m", F.lit(False))).drop("_m")


def childless(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents that no child names."""
    return parents.join(children.select(key), key, "left_anti")


def since(files: DataFrame, ending: str, date: str) -> DataFrame:
    """Files of an ending made on or after a date."""
    return files.where(F.lower("path").endswith(ending.lower()) & (F.col("created") >= F.lit(date).cast("timestamp")))


def inside(path, root: str):
    """Whether a path lies under a root folder once ``..`` and ``.`` are resolved; a sibling with the same start doesn't."""
    steps = F.split(F.regexp_replace(path, r"\\", "/"), "/")
    depth = F.aggregate(
        steps, F.struct(F.array().cast("array<string>").alias("at"), F.lit(False).alias("out")),
        lambda s, x: F.when((x == "") | (x == "."), s).when(x == "..", F.struct(F.slice(s["at"], 1, F.greatest(F.size(s["at"]) - 1, F.lit(0))).alias("at"), (s["out"] | (F.size(s["at"]) == 0)).alias("out"))).otherwise(F.struct(F.concat(s["at"], F.array(x)).alias("at"), s["out"].alias("out"))),
    )
    return ~depth["out"] & ~path.startswith("/") & (F.get(depth["at"], F.lit(0)) == root)
