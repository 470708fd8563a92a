"""Writers: documents, rendered files, logs, reports, failures. Writes are per partition and replaceable, so a lost task repeats them."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_log(lines: DataFrame, path: str) -> None:
    """Append lines to a log as JSON, one per row."""
    lines.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def quarantine(df: DataFrame, error: str, path: str) -> DataFrame:
    """Write the rows with an error apart; the others are returned."""
    df.where(F.col(error).isNotNull()).write.mode("append").parquet(path)
    return df.where(F.col(error).isNull())


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a folder's address names (file, hdfs, s3, gs, abfs), and the folder in it."""
    if "://" in root:
        fs, base = pafs.FileSystem.from_uri(root)
        return fs, os.path.realpath(base) if isinstance(fs, pafs.LocalFileSystem) else base.rstrip("/")
    return pafs.LocalFileSystem(), os.path.realpath(root)


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write (path, content) below a folder all executors share; returns path and error per file.

    A file appears whole or not at all: it is written beside its place and renamed. Paths that lead out of the folder
    are refused.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(root)
        local = isinstance(fs, pafs.LocalFileSystem)
        for pdf in batches:
            errors = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    to = posixpath.normpath(posixpath.join(base, path))
                    to = os.path.realpath(to) if local else to
                    if not to.startswith(base + "/"):
                        raise ValueError("path leads out of the folder")
                    if content is None:
                        raise ValueError("no content")
                    fs.create_dir(posixpath.dirname(to), recursive=True)
                    part = f"{to}.{uuid.uuid4().hex}.part"
                    with fs.open_output_stream(part) as f:
                        f.write(content)
                    fs.move(part, to)
                    errors.append(None)
                except (OSError, ValueError, TypeError) as e:
                    errors.append(str(e)[:400])
            yield pd.DataFrame({"path": pdf["path"], "error": errors})

    return files.select("path", "content").mapInPandas(run, "path string, error string")


def write_documents(documents: DataFrame, root: str) -> DataFrame:
    """Write (path, payload) as one JSON file per document, ``path`` without its ending and ``.json``; path and error."""
    to = F.concat(F.regexp_replace("path", r"\.[^./]+$", ""), F.lit(".json"))
    return write_files(documents.select(to.alias("path"), F.encode("payload", "UTF-8").alias("content")), root)
