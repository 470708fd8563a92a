"""Items of notes: which count, which value, and what is shown of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import categories, iso_day, legacy_path, out_path, preview, title
from folioforge.operators.progress import note_key

# Items that are shown in the document itself.
PRIMARY = ["Subject", "From", "To", "CC", "Body", "Categories", "Created", "Modified"]
USED_IN_BODY = ["Subject", "Body"]


def items(fields: DataFrame) -> DataFrame:
    """Items with a name that isn't internal and with a value; of equal names of a note the last counts.

    Nulls in lists are dropped; a list without entries is no value. ``ord`` is that of the first, the value of the last.
    """
    listed = F.filter("value_list", lambda x: x.isNotNull())
    own = fields.select(note_key(F.col("unid")).alias("unid"), "replica", "name", "type", "ord", "field_id", F.when(F.col("value") != "", F.col("value")).alias("value"), F.when(F.size(listed) > 0, listed).alias("value_list"))
    own = own.where(F.col("name").isNotNull() & (F.col("name") != "") & ~F.col("name").startswith("$") & (F.col("name") != "Form") & (F.col("value").isNotNull() | F.col("value_list").isNotNull()))
    last = own.groupBy("unid", "replica", "name").agg(F.min("ord").alias("ord"), F.max(F.struct("ord", "field_id", "type", "value", "value_list")).alias("l"))
    return last.select("unid", "replica", "name", "ord", "l.type", "l.value", "l.value_list")


def typed(fields: DataFrame) -> DataFrame:
    """The first value there is: list, number, text, with the kind it is."""
    each = items(fields)
    number = F.regexp_replace("value", ",", ".").try_cast("double")
    return each.select("unid", "replica", "name", F.when(F.col("value_list").isNotNull(), "list").when(F.col("type").startswith("number") & number.isNotNull(), "number").otherwise("text").alias("kind"), F.size(F.coalesce("value_list", F.array().cast("array<string>"))).alias("n_list"), F.when(F.col("type").startswith("number"), number).alias("number"), F.coalesce(F.col("value"), F.array_join("value_list", ", ")).alias("text"))


def appendix(fields: DataFrame, allow: list[str] | None = None, used: list[str] | None = None) -> DataFrame:
    """Items that the document itself doesn't show, with a preview, in order of their lower-case names."""
    from pyspark.sql import Window as W

    hidden = sorted({*(allow or PRIMARY), *(used or USED_IN_BODY)})
    rows = items(fields).where(~F.col("name").isin(hidden))
    place = F.row_number().over(W.partitionBy("unid", "replica").orderBy(F.lower("name"), "name"))
    return rows.select("unid", "replica", "name", "type", preview(F.col("value"), F.col("value_list")).alias("preview"), place.alias("pos"))


def paths(docs: DataFrame, fields: DataFrame) -> DataFrame:
    """Output folder of every delivered note, and the older layout's: joined once with its subject and categories."""
    picked = items(fields).where(F.col("name").isin("Subject", "Categories"))
    wide = picked.groupBy("unid", "replica").agg(*[F.max(F.when(F.col("name") == n, F.col(c))).alias(f"{n}_{c}") for n in ("Subject", "Categories") for c in ("value", "value_list")])
    own = docs.select("rec_id", note_key(F.col("unid")).alias("unid"), "replica", "db_title", "form", "created").where(F.col("unid").isNotNull())
    j = own.join(wide, ["unid", "replica"], "left")
    name = title(F.col("Subject_value"), F.col("Subject_value_list"), F.col("unid"))
    cats = categories(F.col("Categories_value"), F.col("Categories_value_list"))
    args = (F.col("db_title"), F.col("form"), cats, iso_day(F.col("created")), name)
    return j.select("rec_id", name.alias("title"), out_path(*args).alias("out_path"), legacy_path(*args).alias("legacy_path"))


def links(link_notes: DataFrame) -> DataFrame:
    """Links per note and kind: to a note (it has a unid), to a database only, or unusable."""
    kind = F.when(F.coalesce(F.trim("unid"), F.lit("")) != "", "note").when(F.coalesce(F.trim("replica"), F.lit("")) != "", "database").otherwise("other")
    return link_notes.groupBy(note_key(F.col("doc_unid")).alias("doc_unid"), kind.alias("kind")).agg(F.count("*").alias("n_links"), F.countDistinct("raw").alias("n_targets"))
