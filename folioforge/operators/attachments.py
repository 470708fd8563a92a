"""Attachments of notes: names, references, images, fallback files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import icon_class, sanitize_filename, stem, strip_sequence, suffix


def ordered(atts: DataFrame) -> DataFrame:
    """Attachments numbered within their note by name and type (code points), then id."""
    w = W.partitionBy("unid").orderBy("name", "type", "att_id")
    return atts.select("att_id", "unid", "name", "type", F.row_number().over(w).alias("ord"))


def resolve(atts: DataFrame) -> DataFrame:
    """Files by their references: by display name first (first registered wins), then by name (last wins).

    ``path`` is null where neither names a file of the note.
    """
    files = atts.where((F.col("type") == "file") & F.col("content_path").isNotNull())
    by_display = files.where(F.col("saved_name").isNotNull()).groupBy("unid", F.col("saved_name").alias("_k")).agg(F.min_by("content_path", "att_id").alias("_p1"))
    by_name = files.where(F.col("name").isNotNull()).groupBy("unid", F.col("name").alias("_k")).agg(F.max_by("content_path", "att_id").alias("_p2"))
    refs = atts.where(F.col("ref_name").isNotNull()).select("att_id", "unid", "ref_name").withColumn("_k", F.col("ref_name"))
    out = refs.join(by_display, ["unid", "_k"], "left").join(by_name, ["unid", "_k"], "left")
    return out.select("att_id", "unid", "ref_name", F.coalesce("_p1", "_p2").alias("path"), F.when(F.col("_p1").isNotNull(), "display").when(F.col("_p2").isNotNull(), "name").alias("by"))


def images(atts: DataFrame) -> DataFrame:
    """Inline images numbered within their note by their index, not by their name (image 10 comes after 9)."""
    w = W.partitionBy("unid").orderBy(F.col("ref_index").asc_nulls_last(), "att_id")
    return atts.where(F.col("type") == "image").select("att_id", "unid", "name", "ref_index", (F.row_number().over(w) - 1).alias("seq"))


def image_sources(atts: DataFrame, refs: DataFrame) -> DataFrame:
    """Image references (unid, alt) with the attachment they mean: by name, then by stem, then by saved name."""
    own = atts.where(F.col("type") == "image")
    keys = F.array(F.struct(F.lit(1).alias("prio"), F.col("name").alias("k")), F.struct(F.lit(2).alias("prio"), stem(F.col("name")).alias("k")), F.struct(F.lit(3).alias("prio"), F.col("saved_name").alias("k")))
    exploded = own.select("unid", "att_id", F.explode(keys).alias("x")).select("unid", "att_id", "x.prio", F.col("x.k").alias("alt")).where(F.col("alt").isNotNull())
    best = exploded.groupBy("unid", "alt").agg(F.min(F.struct("prio", "att_id")).alias("m"))
    return refs.join(best, ["unid", "alt"], "left").select(*refs.columns, F.col("m.att_id").alias("image_id"))


def display_names(atts: DataFrame) -> DataFrame:
    """The last saved name of each name of a note."""
    return atts.where(F.col("name").isNotNull() & F.col("saved_name").isNotNull()).groupBy("unid", "name").agg(F.max_by("saved_name", "att_id").alias("display_name"))


def unique_names(named: DataFrame, group: str, order: str, name: str = "pretty") -> DataFrame:
    """(group, order, name) with ``file_name``: a name that the group already has gets the first free of ``_2``, ``_3``, ...

    Given and generated names count alike, in the given order. A generated name only meets names that are equal but for
    trailing numbers, so these are a part of their own: parts are spread over all tasks, and a task reads a part in
    order and holds its names, not its rows. Rows without a group or order form a group of their own, in any order.
    """
    width = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.concat_ws("/", F.regexp_replace(stem(F.col(name)), r"(_\d+)+$", ""), suffix(F.col(name)))
    own = named.select(group, order, name, stem(F.col(name)).alias("_s"), suffix(F.col(name)).alias("_e"), part.alias("_p"))
    own = own.repartition(width, group, "_p").sortWithinPartitions(group, "_p", order, name)
    kinds = {f.name: f.dataType.simpleString() for f in own.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, taken, last = None, set(), {}
        for pdf in batches:
            out = []
            for g, p, own_name, s, e in zip(pdf[group].astype(object).where(pdf[group].notna(), None), pdf["_p"], pdf[name], pdf["_s"], pdf["_e"], strict=True):
                if at != (g, p):
                    at, taken, last = (g, p), set(), {}
                free = own_name
                if free in taken:
                    n = last.get(own_name, 2)
                    while (free := f"{s}_{n}{e}") in taken:
                        n += 1
                    last[own_name] = n + 1
                taken.add(free)
                out.append(free)
            yield pdf[[group, order, name]].assign(file_name=out)

    return own.mapInPandas(run, f"{group} {kinds[group]}, {order} {kinds[order]}, {name} string, file_name string")


def preferred_name(atts: DataFrame) -> DataFrame:
    """The name to save a file under: saved name, else name without counters, else ``attachment``; pictures as gif.

    Names that collide within a note are numbered in order of id.
    """
    base = F.coalesce(F.when(F.col("saved_name") != "", F.col("saved_name")), F.when(F.col("name") != "", F.col("name")), F.lit("attachment"))
    pretty = sanitize_filename(strip_sequence(base))
    pretty = F.when((F.col("type") == "image") & (suffix(pretty) == ""), F.concat(pretty, F.lit(".gif"))).otherwise(pretty)
    return unique_names(atts.select("att_id", "unid", pretty.alias("pretty")), "unid", "att_id").select("att_id", "unid", "pretty", "file_name")


def fallback(atts: DataFrame, files: DataFrame) -> DataFrame:
    """Attachments with the file (unid, path) that was extracted for them: by the name of their reference, then by their own."""
    f = files.select("unid", F.regexp_extract("path", r"([^/]*)$", 1).alias("_n"), "path").groupBy("unid", "_n").agg(F.min("path").alias("path"))
    by = lambda c, to: f.select("unid", F.col("_n").alias(c), F.col("path").alias(to))
    out = atts.select("att_id", "unid", "ref_name", "name").join(by("ref_name", "_p1"), ["unid", "ref_name"], "left").join(by("name", "_p2"), ["unid", "name"], "left")
    return out.select("att_id", "unid", F.coalesce("_p1", "_p2").alias("path"), F.when(F.col("_p1").isNotNull(), "ref_name").when(F.col("_p2").isNotNull(), "name").alias("by")).where(F.col("path").isNotNull())


def fuzzy(atts: DataFrame, files: DataFrame) -> DataFrame:
    """Files (unid, path) that may be an attachment's: same note, same ending, one stem within the other; the first by path.

    Note and ending are equality keys, so the comparison of stems stays within them.
    """
    bare = lambda c: F.regexp_replace(F.lower(stem(c)), r"\s", "")
    a = atts.select("att_id", "unid", F.lower(suffix(F.col("name"))).alias("_s"), bare(F.col("name")).alias("_a")).where(F.col("_a") != "")
    f = files.select("unid", "path", F.lower(suffix(F.col("path"))).alias("_s"), bare(F.regexp_extract("path", r"([^/]*)$", 1)).alias("_f")).where(F.col("_f") != "")
    hit = a.join(f, ["unid", "_s"]).where(F.contains("_a", "_f") | F.contains("_f", "_a"))
    return hit.groupBy("att_id", "unid").agg(F.min("path").alias("path"))


def salvaged(atts: DataFrame, files: DataFrame) -> DataFrame:
    """Attachments and, marked, the files of their notes that none of them uses."""
    used = atts.where(F.col("content_path").isNotNull()).select("unid", F.col("content_path").alias("path"))
    extra = files.join(used, ["unid", "path"], "left_anti").select("unid", "path", F.lit(True).alias("salvaged"))
    return used.select("unid", "path", F.lit(False).alias("salvaged")).unionByName(extra)


def usable(atts: DataFrame) -> DataFrame:
    """Attachments that aren't empty."""
    return atts.where(F.col("size") > 0)


def icons(atts: DataFrame, folder: str = "attachments/icons") -> DataFrame:
    """The icon class and path of each file."""
    return atts.where(F.col("type") == "file").select("att_id", "unid", "name", icon_class(F.col("name")).alias("icon"), F.concat(F.lit(folder + "/"), icon_class(F.col("name")), F.lit(".gif")).alias("icon_path"))


def icons_by_path(atts: DataFrame, refs: DataFrame) -> DataFrame:
    """References (unid, content_path, name) with the icon of the file at that path, else of their own name's ending."""
    known = atts.where((F.col("type") == "file") & F.col("content_path").isNotNull()).groupBy("unid", "content_path").agg(F.max_by("name", "att_id").alias("_n"))
    return refs.join(known, ["unid", "content_path"], "left").select(*refs.columns, icon_class(F.coalesce("_n", "name")).alias("icon"))


def first_per_extension(atts: DataFrame) -> DataFrame:
    """The first attachment of each ending."""
    return atts.select(F.lower(suffix(F.col("name"))).alias("ext"), "att_id", "name").where(F.col("ext") != "").groupBy("ext").agg(F.min("att_id").alias("att_id"), F.min_by("name", "att_id").alias("name"), F.count("*").alias("n"))
