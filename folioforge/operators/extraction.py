"""Extraction of the files in notes: names, contents, and the references in the text that point at them.

From exported notes come two narrow tables, the attachments with what is known of them and the payloads; they meet on
note and name. Names are made clean and unique per note; contents are hashed where they are decoded. The references in
the rich text get the path of the file they mean, by name first, then by display name; images by their name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import sanitize_filename, strip_sequence, suffix
from folioforge.operators import tokens
from folioforge.operators.attachments import unique_names
from folioforge.sources import dxl

ATTACHMENT = "array<struct<name:string,type:string,ref:struct<element:string,name:string,index:int>,size:bigint,created:string,modified:string>>"


def attachments(normalised: DataFrame) -> DataFrame:
    """path, unid, pos and the metadata of each attachment of the notes."""
    each = normalised.select("path", "unid", F.posexplode(F.from_json(F.get_json_object("payload", "$.attachments"), ATTACHMENT)).alias("pos", "a"))
    return each.select("path", "unid", "pos", "a.name", "a.type", F.col("a.ref.element").alias("ref_element"), F.col("a.ref.name").alias("ref_name"), F.col("a.ref.index").alias("ref_index"), "a.size", "a.created", "a.modified")


def display_names(normalised: DataFrame) -> DataFrame:
    """path, name, displayname of the references in the text; of several for one name the last counts."""
    toks = _tokens(normalised).where("t = 'attachmentref'")
    return toks.groupBy("path", "name").agg(F.max_by("displayname", F.struct("field", "dewey")).alias("displayname"))


def _tokens(normalised: DataFrame) -> DataFrame:
    key = F.xxhash64("path")
    own = normalised.select(key.alias("record_id"), "path", "payload")
    return tokens.tokens(own).join(own.select("record_id", "path"), "record_id")


def extract(notes: DataFrame) -> DataFrame:
    """Files of exported notes (path, xml): path, unid, pos, name, type, file_name, content_path, size, sha256, stamp, error, content.

    A file without a payload has no content and an error; an inline picture keeps the ending of its format.
    """
    normalised = dxl.normalise(notes)
    meta = attachments(normalised)
    # Of several payloads for one name the first counts.
    data = dxl.payloads(notes).groupBy("path", "name").agg(F.min_by(F.struct("format", "content"), F.xxhash64("content")).alias("d"))
    shown = display_names(normalised)
    j = meta.join(data, ["path", "name"], "left").join(shown, ["path", "name"], "left")
    base = F.coalesce(F.when(F.trim("displayname") != "", F.trim("displayname")), F.when(F.col("name") != "", F.col("name")), F.lit("attachment"))
    borrowed = F.when((suffix(base) == "") & (F.col("type") == "file"), F.concat(base, suffix(F.col("name")))).otherwise(base)
    named = F.when((F.col("type") == "image") & (suffix(base) == ""), F.concat(base, F.lit("."), F.coalesce("d.format", F.lit("gif")))).otherwise(borrowed)
    pretty = j.withColumn("pretty", sanitize_filename(strip_sequence(named)))
    unique = pretty.join(unique_names(pretty.select("path", "pos", "pretty"), "path", "pos").drop("pretty"), ["path", "pos"])
    content = F.col("d.content")
    return unique.select(
        "path", "unid", "pos", "name", "type", "displayname", "file_name", F.when(content.isNotNull(), F.concat(F.lit("attachments/"), "file_name")).alias("content_path"),
        F.coalesce(F.octet_length(content).cast("long"), F.lit(0)).alias("size"), F.sha2(content, 256).alias("sha256"), F.coalesce("modified", "created").alias("stamp"), F.when(content.isNull(), "no content").alias("error"), content.alias("content"),
    )


def references(notes: DataFrame, files: DataFrame) -> DataFrame:
    """path, node_path, t and the file each reference or image in the text means; null where none does."""
    toks = _tokens(dxl.normalise(notes)).where(F.col("t").isin("attachmentref", "img")).select("path", "node_path", "t", F.coalesce("name", "alt").alias("want"), F.col("displayname").alias("shown"))
    keyed = files.where(F.col("content_path").isNotNull())
    by_name = keyed.groupBy("path", F.col("name").alias("want")).agg(F.max_by("content_path", "pos").alias("p1"))
    by_shown = keyed.groupBy("path", F.col("displayname").alias("shown")).agg(F.min_by("content_path", "pos").alias("p2")).where(F.col("shown").isNotNull())
    out = toks.join(by_name, ["path", "want"], "left").join(by_shown, ["path", "shown"], "left")
    return out.select("path", "node_path", "t", F.coalesce("p1", "p2").alias("content_path"))


def empty_folders(folders: DataFrame, files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Folders (path) below which no file lies at any depth, except those to keep and what leads to them.

    Each file names all folders above it, so a folder that holds only empty folders comes out in the same anti-join.
    """
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps) - 1, F.lit(1))), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    used = files.select(F.explode(above).alias("path")).distinct()
    own = folders.where(~F.col("path").isin(list(keep))) if keep else folders
    return own.join(used, "path", "left_anti")
