"""References to records that do not exist, by range-partitioned sorted parent arrays.

Keys (replica, unid) are brought to one spelling and cut into ranges of neighbouring keys. The events of the parents
(deliveries, deletions) and the references of a range meet in one sorted stream, parents first: a task reads the
parents of a range into one sorted array and probes the references that follow in vectorised batches by binary search.
An entry of the array is key + time, so one search finds the last event of a key up to a time.

A range is named by the leading digits of its keys: as many as the number of parents asks for, and more wherever the
parents under a beginning are counted to be too many for one array, until none is. A range that draws many references is
split by a salt, as many ways as its measured count asks for; its parents go to every part. Parents are reduced to the
turns of their state, first per key and day and then per key, before they are shuffled to their ranges, so a note that
was delivered very often isn't put in order in one task.

Defined results: keys that can't be read name nothing, so their references are orphans; deliveries without a key are
none; a reference without ``seen_at`` is compared with all events; a delivery and a deletion at one instant count as
deletion, then delivery; repeated references are reported each under its own id.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Least hexadecimal digits of the unid that name a range.
RANGE_DIGITS = 3
#: Parents (turns) that a range is meant to hold, and those beyond which it is cut further.
RANGE_PARENTS, MOST_PARENTS = 100_000, 400_000
#: References that one part of a range takes before the range is split.
PART_ROWS = 200_000
_LATE = 9_223_372_036_854_775_807
DAY = 86_400_000_000


# Separators and blanks that keys are written with.
_LOOSE = ":-_ \t\r\n\u00a0\u3000\u200b\ufeff"


def replica_key(column: Column) -> Column:
    """16 hexadecimal digits, or null. Accepts colons, blanks, leading underscores, a file ending and either case."""
    bare = F.translate(F.upper(column), _LOOSE, "")
    bare = F.when(F.endswith(bare, F.lit(".NSF")), F.left(bare, F.length(bare) - 4)).otherwise(bare)
    return F.when((F.length(bare) == 16) & bare.rlike("^[0-9A-F]{16}$"), bare)


def unid_key(column: Column) -> Column:
    """32 hexadecimal digits, or null. Accepts groups with hyphens or colons, OF/ON marks and either case."""
    bare = F.translate(F.upper(column), _LOOSE, "")
    marked = (F.length(bare) == 36) & bare.startswith("OF") & (F.substring(bare, 19, 2) == "ON")
    digits = F.when(marked, F.concat(F.substring(bare, 3, 16), F.substring(bare, 21, 16))).otherwise(bare)
    return F.when((F.length(digits) == 32) & digits.rlike("^[0-9A-F]{32}$"), digits)


def events(docs: DataFrame, stubs: DataFrame) -> DataFrame:
    """The turns of each key's state: key, at (us), alive.

    A key that was never deleted has one turn, its first delivery: a minimum, combined map-side, so a key with any
    number of deliveries shuffles a row per task. Only for keys with deletions are all events put in order, and those
    that repeat the state before are dropped.
    """
    made = docs.select(F.concat(unid_key(F.col("unid")), replica_key(F.col("replica"))).alias("key"), F.unix_micros("received_at").alias("at"), F.lit(1).alias("alive"))
    gone = stubs.select(F.concat(unid_key(F.col("unid")), replica_key(F.col("replica"))).alias("key"), F.unix_micros("deleted_at").alias("at"), F.lit(0).alias("alive"))
    made, gone = (x.where(F.col("key").isNotNull() & F.col("at").isNotNull()) for x in (made, gone))
    deleted = gone.select("key").distinct()
    plain = made.groupBy("key").agg(F.min("at").alias("at")).join(deleted, "key", "left_anti").select("key", "at", F.lit(1).alias("alive"))
    # At one instant the delivery counts.
    moved = made.join(deleted, "key", "left_semi").union(gone).groupBy("key", "at").agg(F.max("alive").alias("alive"))
    daily = _turns(moved.withColumn("day", F.floor(F.col("at") / DAY)), "key", "day")
    return plain.unionByName(_turns(daily, "key").select("key", "at", "alive"))


def _turns(moved: DataFrame, *group: str) -> DataFrame:
    """The first row of each group and those that differ from the one before."""
    before = F.lag("alive").over(W.partitionBy(*group).orderBy("at"))
    return moved.withColumn("before", before).where(~F.col("before").eqNullSafe(F.col("alive"))).drop("before")


def range_digits(parents: int) -> int:
    """Digits that cut so many parents of even spread into ranges of about ``RANGE_PARENTS``."""
    return max(RANGE_DIGITS, math.ceil(math.log(max(1.0, parents / RANGE_PARENTS), 16)))


def deeper(parents: DataFrame, digits: int, most: int = MOST_PARENTS) -> list[dict[str, int]]:
    """Beginnings that are too full for one array and the digits that their keys are named by instead, by rounds.

    A full beginning is cut two digits after its keys begin to differ; the next round counts what comes of it. At most
    parents / most rows of a round reach the driver. The turns of a single key are never cut.
    """
    rounds: list[dict[str, int]] = []
    own = parents.select("key", F.substring("key", 1, digits).alias("p"))
    while True:
        counted = own.groupBy("p").agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
        full = {r["p"]: len(os.path.commonprefix([r["a"], r["b"]])) + 2 for r in counted.where((F.col("n") > most) & (F.col("a") < F.col("b"))).collect()}
        if not full:
            return rounds
        rounds.append(full)
        own = _renamed(own.where(F.col("p").isin(list(full))), "p", full)


def _renamed(df: DataFrame, column: str, full: dict[str, int]) -> DataFrame:
    digits = F.try_element_at(F.create_map(*[F.lit(x) for pair in full.items() for x in pair]), F.col(column))
    return df.withColumn(column, F.when(digits.isNotNull(), F.substr("key", F.lit(1), digits)).otherwise(F.col(column)))


def ranged(df: DataFrame, digits: int, rounds: list[dict[str, int]]) -> DataFrame:
    """With ``range``, the beginning of the key that names its range."""
    out = df.withColumn("range", F.substring("key", 1, digits))
    for full in rounds:
        out = _renamed(out, "range", full)
    return out


def references(links: DataFrame, attachments: DataFrame) -> DataFrame:
    """All references: ref_table, ref_id, key (null: names nothing), at (us), seen_at."""
    blank = lambda c: F.when(F.translate(F.col(c), " \t\r\n\u00a0\u3000", "") != "", F.col(c))
    # notes://host/replica/view/unid?query with any number of slashes after the scheme.
    rest = F.when(F.lower(F.substring(F.trim("raw"), 1, 6)) == "notes:", F.ltrim(F.expr("substring(trim(raw), 7)"), F.lit("/")))
    step = lambda k: F.nullif(F.trim(F.substring_index(F.get(F.split(rest, "/"), F.lit(k)), "?", 1)), F.lit(""))
    url_replica, url_unid = step(1), step(3)
    replica = replica_key(F.coalesce(blank("replica"), url_replica, F.col("doc_replica")))
    link = links.select(F.lit("link_notes").alias("ref_table"), F.col("link_id").alias("ref_id"), unid_key(F.coalesce(blank("unid"), url_unid)).alias("u"), replica.alias("r"), "seen_at")
    att = attachments.select(F.lit("doc_attachments").alias("ref_table"), F.col("att_id").alias("ref_id"), unid_key(F.col("unid")).alias("u"), replica_key(F.col("replica")).alias("r"), "seen_at")
    every = link.union(att)
    return every.select("ref_table", "ref_id", F.concat("u", "r").alias("key"), F.coalesce(F.unix_micros("seen_at"), F.lit(_LATE)).alias("at"), "seen_at")


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted stream of (part, parents before references) to misses. Holds the parents of one range at a time."""
    part, chunks, keys, alive = None, [], None, None

    def entries(pdf: pd.DataFrame) -> np.ndarray:
        # key + time as one fixed-width byte string: sorts like the pair.
        time = (pdf["at"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
        out = np.empty(len(pdf), dtype=[("k", "S48"), ("t", "V8")])
        out["k"], out["t"] = pdf["key"].to_numpy(dtype="S48"), time.view("V8")
        return out

    for pdf in batches:
        misses = []
        for name, group in pdf.groupby("part", sort=False):
            if name != part:
                part, chunks, keys, alive = name, [], None, None
            is_ref = group["ref_table"].notna().to_numpy()
            if not is_ref.all():
                chunks.append(group[~is_ref])
                keys = None
            refs = group[is_ref]
            if refs.empty:
                continue
            if keys is None:
                own = pd.concat(chunks) if chunks else group[:0]
                chunks = [own] if len(own) else []
                packed = _ordered(entries(own))
                order = np.argsort(packed, kind="stable")
                keys, alive = packed[order], own["alive"].to_numpy()[order].astype(bool)
                heads = np.array([k[:48] for k in keys.tolist()], dtype="S48")
            if len(keys):
                want = _ordered(entries(refs))
                at = np.searchsorted(keys, want, side="right") - 1
                safe = np.maximum(at, 0)
                there = (at >= 0) & (heads[safe] == refs["key"].to_numpy(dtype="S48")) & alive[safe]
            else:
                there = np.zeros(len(refs), bool)
            misses.append(refs.loc[~there, ["ref_table", "ref_id", "seen_us"]])
        if misses:
            yield pd.concat(misses)


def _ordered(entries: np.ndarray) -> np.ndarray:
    """Key and big-endian time as hexadecimal text, since byte strings of numpy drop trailing zeros."""
    time = entries["t"].tobytes().hex().encode()
    return np.char.add(entries["k"], np.array([time[i : i + 16] for i in range(0, len(time), 16)], dtype="S16")) if len(entries) else np.empty(0, "S64")


def orphans(refs: DataFrame, parents: DataFrame, digits: int | None = None, part_rows: int = PART_ROWS, most: int = MOST_PARENTS) -> DataFrame:
    """ref_table, ref_id and seen_at of the references whose key isn't alive at their time."""
    from folioforge.session import checkpoint

    spark = refs.sparkSession
    parents = checkpoint(parents)  # counted and read again
    digits = range_digits(parents.count()) if digits is None else digits
    rounds = deeper(parents, digits, most)
    # Keys that name nothing go through as misses, spread by their id.
    keyed = ranged(refs, digits, rounds)
    keyed = keyed.withColumn("range", F.coalesce("range", F.concat(F.lit("-"), F.pmod(F.xxhash64("ref_id"), F.lit(64)).cast("string"))))
    # One row per range: their number follows the number of parents, some tens of bytes for ``RANGE_PARENTS`` of them.
    parts = keyed.groupBy("range").agg(F.greatest(F.ceil(F.count("*") / part_rows), F.lit(1)).cast("int").alias("parts"))
    own = keyed.join(F.broadcast(parts), "range")
    none = lambda kind: F.lit(None).cast(kind)
    salted = own.select(F.concat_ws("/", "range", F.pmod(F.xxhash64("ref_table", "ref_id"), F.col("parts")).cast("string")).alias("part"), F.coalesce("key", F.lit("")).alias("key"), "at", none("int").alias("alive"), "ref_table", F.col("ref_id").cast("long").alias("ref_id"), F.unix_micros("seen_at").alias("seen_us"))
    spread = ranged(parents, digits, rounds).join(F.broadcast(parts), "range")
    spread = spread.select(F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("s"), "range", "key", "at", "alive")
    spread = spread.select(F.concat_ws("/", "range", F.col("s").cast("string")).alias("part"), "key", "at", "alive", none("string").alias("ref_table"), none("long").alias("ref_id"), none("long").alias("seen_us"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = spread.union(salted).repartition(width, "part").sortWithinPartitions("part", F.col("ref_table").isNotNull())
    missed = stream.mapInPandas(_probe, "ref_table string, ref_id long, seen_us long")
    return missed.select("ref_table", "ref_id", F.timestamp_micros("seen_us").alias("seen_at"))


def report(found: DataFrame) -> DataFrame:
    """Orphans per table and calendar month (UTC) in which they were seen; null for those without a time."""
    return found.groupBy("ref_table", F.date_format("seen_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("orphans"))


def find(links: DataFrame, attachments: DataFrame, docs: DataFrame, stubs: DataFrame, **options: int) -> DataFrame:
    """Orphan references of link_notes and doc_attachments."""
    return orphans(references(links, attachments), events(docs, stubs), **options)
