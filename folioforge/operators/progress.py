"""Job state from an append-only progress log: the last line of a key counts.

A key is (db, unid); a retry counts up ``try_no``. ``processing`` without an end is work to do again, ``done`` and
``skipped`` are finished, ``error`` is tried again up to a limit. All of it is two aggregates and joins on the key; no
key's lines are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["db", "unid"]


def note_key(unid: Column) -> Column:
    """A unid in one spelling: upper case, without blanks of any kind around it."""
    return F.upper(F.regexp_replace(unid, r"(?U)^\s+|\s+\z", ""))


def latest(log: DataFrame) -> DataFrame:
    """The last line of each key by line number; rows without a key or number are ignored, repeated lines count once."""
    good = log.where(F.col("db").isNotNull() & F.col("unid").isNotNull() & F.col("line_no").isNotNull())
    last = good.groupBy("db", note_key(F.col("unid")).alias("unid")).agg(F.max(F.struct("line_no", "ts", "status", "try_no", "err", "out_path")).alias("l"))
    return last.select("db", "unid", "l.*")


def summary(log: DataFrame) -> DataFrame:
    """Keys per status."""
    return latest(log).groupBy("status").agg(F.count("*").alias("n_keys"), F.max("try_no").alias("max_try"))


def remaining(candidates: DataFrame, log: DataFrame, max_try: int = 3) -> DataFrame:
    """Candidate keys with work left and their tries so far: unseen keys (0), unfinished ones, and errors below the limit."""
    state = latest(log).select(*KEY, "status", "try_no")
    status, tries = F.col("status"), F.coalesce("try_no", F.lit(0))
    drop = status.isin("done", "skipped") | ((status == "error") & (tries >= max_try))
    return candidates.select(*KEY).distinct().join(state, KEY, "left").where(~F.coalesce(drop, F.lit(False))).select(*KEY, "status", tries.cast("int").alias("tries"))


def retry_errors(log: DataFrame, max_try: int = 3) -> DataFrame:
    """Only keys whose last line is an error below the limit."""
    return latest(log).where((F.col("status") == "error") & (F.coalesce("try_no", F.lit(0)) < max_try)).select(*KEY, "try_no", "err")


def drop_by_keyword(log: DataFrame, keyword: str) -> DataFrame:
    """The log without all lines of the notes of which any line names the keyword in its output.

    A note is its unid, however written and in whatever database; lines without one stay.
    """
    key = note_key(F.col("unid"))
    hit = log.where(F.col("out_path").contains(keyword)).select(key.alias("_k")).distinct()
    return log.withColumn("_k", key).join(hit, "_k", "left_anti").drop("_k")


def islands(log: DataFrame) -> DataFrame:
    """Lines of a key with a group number that grows where the status changes, and a position in the group.

    Windows are per key: adjacent equal statuses are one island, as runs of equal style are one piece of text.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy("db", "unid").orderBy("line_no")
    own = log.select("db", note_key(F.col("unid")).alias("unid"), "line_no", "status", "err", "ts")
    change = F.coalesce((F.col("status") != F.lag("status").over(w)).cast("int"), F.lit(1))
    grouped = own.withColumn("change", change).withColumn("island", F.sum("change").over(w))
    place = W.partitionBy("db", "unid", "island").orderBy("line_no")
    return grouped.withColumn("pos", F.row_number().over(place)).drop("change")


def merged(log: DataFrame) -> DataFrame:
    """One row per island: first and last line, how many, and its texts in order."""
    each = islands(log)
    return each.groupBy("db", "unid", "island", "status").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count("*").alias("n_lines"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "ts"))), lambda x: x["ts"]), "|").alias("stamps"))


def suppressed(log: DataFrame) -> DataFrame:
    """Lines that differ from the line before in their key: repeats of status and error right after each other are dropped."""
    from pyspark.sql import Window as W

    w = W.partitionBy("db", "unid").orderBy("line_no")
    own = log.select("db", note_key(F.col("unid")).alias("unid"), "line_no", "status", "err", "try_no")
    same = F.lag("status").over(w).eqNullSafe(F.col("status")) & F.lag("err").over(w).eqNullSafe(F.col("err")) & F.lag("line_no").over(w).isNotNull()
    return own.withColumn("same", same).where(~F.col("same")).drop("same")


def carried(log: DataFrame) -> DataFrame:
    """Each line with the last error of its key so far and how often its key was started."""
    from pyspark.sql import Window as W

    w = W.partitionBy("db", "unid").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    own = log.select("db", note_key(F.col("unid")).alias("unid"), "line_no", "status", "err")
    return own.withColumns({"last_err": F.last("err", ignorenulls=True).over(w), "starts": F.count_if(F.col("status") == "processing").over(w)})


def first_keys(log: DataFrame, n: int | None) -> DataFrame:
    """The first n keys in order of their first line; all of them for none or 0."""
    keys = log.groupBy("db", note_key(F.col("unid")).alias("unid")).agg(F.min("line_no").alias("first_line"))
    return keys.orderBy("first_line", "db", "unid").limit(n) if n else keys
