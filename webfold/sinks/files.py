"""K1: Markdown documents as files, through a data source that commits them together.

``df.write.format("markdown_files").mode("append").save(folder)`` writes the columns
``relative_path`` and ``markdown_content``, one file a row, below a folder that the driver and all
executors share.  Tasks write into a staging folder of the job; when all have succeeded the driver
renames each file to its place (renaming replaces a file whole), and a failed job removes what was
staged.  So no reader ever sees half a file, nor files of a task that was lost.
A path that leaves the folder is an error.  Of rows with equal paths the last to be renamed stays.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "relative_path string, markdown_content string"


@dataclass
class Staged(WriterCommitMessage):
    """The list of a task's files, by the name of the file that holds it: lists of all paths never meet on the driver."""

    listing: str
    files: int


class MarkdownFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "markdown_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("markdown_files appends: files of the same path are replaced, others stay")
        if missing := {"relative_path", "markdown_content"} - set(schema.names):
            raise ValueError(f"markdown_files needs the columns {sorted(missing)}")
        return MarkdownWriter(self.options["path"])


class MarkdownWriter(DataSourceWriter):
    def __init__(self, base: str):
        self.base = os.path.abspath(base)
        self.staging = os.path.join(self.base, f"_staging-{uuid.uuid4().hex}")

    def place(self, relative: str) -> str:
        out = os.path.normpath(os.path.join(self.base, relative or ""))
        if not relative or not out.startswith(self.base + os.sep):
            raise ValueError(f"not a path below the folder: {relative!r}")
        return out

    def write(self, iterator: Iterator[Row]) -> Staged:
        task = TaskContext.get()
        folder = os.path.join(self.staging, f"{task.partitionId()}-{task.taskAttemptId()}")
        os.makedirs(folder, exist_ok=True)
        n = 0
        with open(os.path.join(folder, "listing"), "w", encoding="utf-8") as listing:
            for n, row in enumerate(iterator, 1):
                place = self.place(row["relative_path"])
                staged = os.path.join(folder, f"{n}.md")
                with open(staged, "w", encoding="utf-8") as file:
                    file.write(row["markdown_content"] or "")
                listing.write(f"{staged}\0{place}\0\n")
        return Staged(os.path.join(folder, "listing"), n)

    def commit(self, messages: list[Staged | None]) -> None:
        with ThreadPoolExecutor(32) as pool:  # tasks' files are renamed side by side
            list(pool.map(_move, [m.listing for m in messages if m is not None]))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[Staged | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


def _move(listing: str) -> None:
    """Rename a task's staged files to their places."""
    with open(listing, encoding="utf-8", newline="\n") as pairs:
        rest = ""
        for line in pairs:  # a path may hold a line break; a pair ends with a zero byte and one
            rest += line
            if rest.endswith("\0\n"):
                staged, place = rest[:-2].split("\0")
                os.makedirs(os.path.dirname(place), exist_ok=True)
                os.replace(staged, place)
                rest = ""


def export_markdown_files(crawled: DataFrame, base_dir: str, spark: SparkSession | None = None) -> None:
    """K1 as files: one ``<base>/<relative_path>`` per page, all or none."""
    spark = spark or crawled.sparkSession
    spark.dataSource.register(MarkdownFiles)
    crawled.select("relative_path", "markdown_content").write.format("markdown_files").mode("append").save(base_dir)
