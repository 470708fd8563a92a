"""Readers: JSON documents, progress lines, manifests, file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "ts string, db string, unid string, status string, `try` int, err string, out string"
MANIFEST_SCHEMA = "title string, server string, db_file string, view_name string, views array<string>"


def json_documents(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """path and payload of the JSON files in a folder: one whole file is one document."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", F.decode("content", "UTF-8").alias("payload"))


def progress_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a progress log; blank and corrupt ones are left out. ``line_no`` orders lines as they stand in a file."""
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")
    return parse_lines(raw)


def parse_lines(raw: DataFrame) -> DataFrame:
    """(line_no, value) to the columns of the log."""
    row = F.from_json("value", LOG_SCHEMA)
    return raw.withColumn("r", row).where(F.col("r").isNotNull() & F.col("r.unid").isNotNull()).select("line_no", "r.ts", "r.db", "r.unid", "r.status", F.col("r.try").alias("try_no"), "r.err", F.col("r.out").alias("out_path"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Databases of a manifest that name a title and a file."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path).where("title IS NOT NULL AND db_file IS NOT NULL")


def inventory(spark: SparkSession, folder: str, with_content: bool = False) -> DataFrame:
    """path, size, mtime[, content] of the files below a folder. Contents are read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    columns = ["path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")]
    return files.select(*columns, *(["content"] if with_content else []))


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles of a file, an object with ``profiles`` or a bare list: name and settings; unnamed ones are numbered.

    Of equal names the last counts.
    """
    text = spark.read.text(path, wholetext=True).select("value")
    listed = F.coalesce(F.get_json_object("value", "$.profiles"), F.col("value"))
    each = text.select(F.posexplode(F.from_json(listed, "array<map<string,string>>")).alias("pos", "settings"))
    named = each.withColumn("name", F.coalesce(F.try_element_at("settings", F.lit("name")), F.concat(F.lit("profile_"), (F.col("pos") + 1).cast("string"))))
    return named.groupBy("name").agg(F.max(F.struct("pos", F.map_entries("settings").alias("e"))).alias("m")).select("name", F.map_from_entries("m.e").alias("settings"))
