"""Tables as CSV files of their own: a reader of ragged files of any width, and a writer that names files inside its tasks.

The reader takes files through Spark, so they may lie in any store that Spark knows; a Python data source would have to open
them itself. The writer is a Python data source, since Spark's own writers name files as they like.
"""

from __future__ import annotations

import csv
import io
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Cells that a chunk of rows has before it is handed on.
CHUNK = 20_000
NAME = "table_files"


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) to (path, header, at, rows): chunks of a file's rows, each with the first row and its own number."""
    csv.field_size_limit(sys.maxsize)
    kind = pa.list_(pa.string())
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = io.StringIO(memoryview(content.as_buffer()).tobytes().decode("utf-8-sig", "replace"), newline="")
            header, at, held, cells = None, 0, [], 0
            for row in csv.reader(text):
                if not row:  # an empty line
                    continue
                header = row if header is None else header
                held.append(row)
                cells += len(row)
                if cells >= CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([header], kind), pa.array([at], pa.int32()), pa.array([held], pa.list_(kind))], ["path", "header", "at", "rows"])
                    at, held, cells = at + len(held), [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([header], kind), pa.array([at], pa.int32()), pa.array([held], pa.list_(kind))], ["path", "header", "at", "rows"])


def read_rows(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, header, row_idx, cells): every line of the CSV files, as an array of its own length, beside the file's first line.

    Quoted cells may hold line ends. Tasks get files by their bytes, a file is read by one task, and nothing is shuffled. Empty lines are left
    out; invalid bytes become replacement characters; an empty file gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    chunks = files.select(F.col("_metadata.file_path").alias("path"), "content").mapInArrow(_cutter, "path string, header array<string>, at int, rows array<array<string>>")
    return chunks.select("path", "header", "at", F.posexplode("rows").alias("i", "cells")).select("path", "header", (F.col("at") + F.col("i")).alias("row_idx"), "cells")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _TableFilesWriter(DataSourceWriter):
    """Rows (file, cells...) to files below a staging folder, which the commit renames to the place of the result.

    A file is written beside its place and renamed when it is whole, so two attempts of a task leave one file. Nothing is to be seen at the place
    of the result before all tasks have ended, and a job that fails leaves what was there.
    """

    def __init__(self, path: str, staging: str) -> None:
        self.path, self.staging = path, staging

    def write(self, iterator: Iterator) -> _Written:
        store, top = _store(self.staging)
        attempt, name, out, files = TaskContext.get().taskAttemptId(), None, None, 0

        def close() -> None:
            out.flush()
            out.detach().close()
            store.move(f"{top}/{name}.{attempt}", f"{top}/{name}")

        for row in iterator:
            if row[0] != name:
                if out is not None:
                    close()
                name, files = row[0], files + 1
                store.create_dir(f"{top}/{name}".rsplit("/", 1)[0], recursive=True)
                out = io.TextIOWrapper(pa.PythonFile(store.open_output_stream(f"{top}/{name}.{attempt}"), mode="w"), "utf-8", newline="")
                lines = csv.writer(out)
            cells = row[1] if isinstance(row[1], list) else row[1:]
            lines.writerow(["" if c is None else c for c in cells])
        if out is not None:
            close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, staging = _store(self.staging)
        _, path = _store(self.path)
        store.create_dir(staging, recursive=True)
        if store.get_file_info(path).type != fs.FileType.NotFound:
            store.delete_dir(path)
        store.move(staging, path)

    def abort(self, messages: list) -> None:
        store, staging = _store(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class TableFiles(DataSource):
    """``df.write.format("table_files").mode("overwrite").option("path", ...)``: the first column names a row's file, the others, or one array, are its cells."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> _TableFilesWriter:
        path = self.options["path"].rstrip("/")
        return _TableFilesWriter(path, self.options.get("staging") or f"{path}.staging")


def write_files(rows: DataFrame, path: str, file_col: str, order: list[str], columns: list[str] | str) -> None:
    """One CSV file for each value of ``file_col``, a path below ``path``; its rows in order. What was at ``path`` is replaced.

    ``columns`` are the cells, or the name of an array of cells: then a row has as many as its array.
    """
    spark = rows.sparkSession
    spark.dataSource.register(TableFiles)
    dealt = rows.repartition(file_col).sortWithinPartitions(file_col, *order)
    cells = [F.col(columns).cast("array<string>").alias(columns)] if isinstance(columns, str) else [F.col(c).cast("string").alias(c) for c in columns]
    dealt.select(file_col, *cells).write.format(NAME).mode("overwrite").option("path", path).option("staging", f"{path.rstrip('/')}.{uuid.uuid4().hex[:12]}").save()
