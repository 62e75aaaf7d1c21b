"""Token counts of flat token files by a scan for separators.

A token file is nothing but 16-bit little-endian ids, every document closed by the separator id; it has no index and
no header. ``write_token_files`` makes such files of about ``FILE_BYTES``, and ``scan_token_files`` finds the documents of any
such files again: files are cut into blocks, numpy searches each block for the separator, and the blocks are stitched by a running
maximum of the last separator and a running count of separators.

The task that encodes documents also lists their ids, one line a document with its number in the file, and one writer stores
both streams of the task side by side (``file=F/kind=tokens`` and ``file=F/kind=names``). They come from one pass over the rows and
are committed together, so a document is found again whatever the order in which a plan gives its rows, behind a shuffle or after
a task was run twice. Files are named by the encoder, never by Spark.

Scale: the writer starts a new file when one holds ``FILE_BYTES``, so a task reads files of some megabytes one by one
whatever the size of the table; blocks never leave the task that read their file, and only the places of separators go through
the window over (file, block). Only a document that alone is longer makes a longer file; such a one must stay under 2 GB, the
limit of a binary value.

Defined cases: a null or empty text is a document of 0 tokens; an empty table writes no file and gives no rows; ids
behind a file's last separator are an unfinished document (``closed`` false); an odd last byte is ignored; a very long text is
counted whole, over as many blocks as it takes; repeated rows and equal texts are counted each; null ids come back as null; a text's
own literal of the separator is ordinary text and gives other ids; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy
from vellum.llm._shared import new_path, written
from vellum.llm._tokens import token_ids

#: The vocabulary's end-of-text id; ordinary text never gives it.
SEPARATOR, BLOCK = 50256, 1 << 20
_CLOSING = np.array([SEPARATOR], "<u2").tobytes().decode("latin-1")
#: Bytes of ids that close a token file.
FILE_BYTES = 16_000_000


def _encoder(path: str | None, limit: int):
    """From (text, name) the rows (file, kind, no, value) of both streams. A file ends with the document that fills it."""

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn, no, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), ([], [], [], [])
                for ids, name in zip(token_ids(part.column(0).to_pylist(), path), part.column(1).to_pylist(), strict=True):
                    data = ids.astype("<u2").tobytes()
                    for kind, value in (("tokens", data), ("names", f"{no} {name}".encode())):
                        for column, x in zip(out, (f"{task:07d}-{turn:05d}", kind, no, value), strict=True):
                            column.append(x)
                    no, size = no + 1, size + len(data) + 2
                    if size >= limit:
                        turn, no, size = turn + 1, 0, 0
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)], ["file", "kind", "no", "value"])

    return encode


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, text_col: str = "text", id_col: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Writes the texts' ids as flat files, and beside each the ids of its documents. Spark's text writer puts raw bytes; the line separator is the separator id."""
    name = F.base64(F.encode(F.to_json(F.struct(F.col(id_col).alias("doc_id"))), "UTF-8")) if id_col else F.lit("")
    rows = docs.select(F.col(text_col).alias("text"), name.alias("name")).mapInArrow(_encoder(vocabulary, file_bytes), "file string, kind string, no bigint, value binary")
    ordered = rows.sortWithinPartitions("file", "kind", "no").select("file", "kind", F.col("value").cast("string"))
    ordered.write.partitionBy("file", "kind").option("encoding", "ISO-8859-1").option("lineSep", _CLOSING).text(path)


@tidy
def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, ends = [], []
        for start, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            ids = np.frombuffer(memoryview(data.as_buffer())[: len(data.as_buffer()) // 2 * 2], "<u2")
            n.append(len(ids))
            ends.append(np.flatnonzero(ids == SEPARATOR) + start)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], ["file", "start", "n", "ends"])


def scan_token_files(spark: SparkSession, path: str, block: int = BLOCK, name: str = "([^/]+)$") -> DataFrame:
    """(file, doc_no, start, n_tokens, closed): every document of the token files under ``path``; places count ids.

    ``name`` is a pattern whose group is the file's name in its path.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", name, 1).alias("file"), "length", "content")
    starts = F.expr(f"sequence(0L, greatest((length - 1) div {block}, 0L))")
    cut = files.select("file", "content", F.explode(starts).alias("b")).select(
        "file", (F.col("b") * (block // 2)).alias("start"), F.expr(f"substring(content, cast(b * {block} + 1 as int), {block})").alias("ids")
    )
    found = cut.mapInArrow(_searcher, "file string, start bigint, n bigint, ends array<bigint>")
    return stitched(written(found, "separators"))


def stitched(found: DataFrame) -> DataFrame:
    """Documents from the blocks' separators: (file, start, n, ends), where a document may run over many blocks."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = found.select(
        "file", "start", "n", "ends",
        F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before) + 1, F.lit(0)).alias("open"),
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("done"),
    )
    docs = known.select("file", F.posexplode(F.expr("transform(ends, (e, i) -> struct(e, if(i = 0, open, ends[i - 1] + 1) as s))")).alias("i", "d"), "done")
    closed = docs.select("file", (F.col("done") + F.col("i")).cast("bigint").alias("doc_no"), F.col("d.s").alias("start"), (F.col("d.e") - F.col("d.s")).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = found.groupBy("file").agg(F.max(F.try_element_at("ends", F.lit(-1))).alias("e"), F.sum("n").alias("n"), F.sum(F.size("ends")).alias("doc_no"))
    start = F.coalesce(F.col("e") + 1, F.lit(0)).cast("bigint")
    rest = ends.select("file", F.col("doc_no").cast("bigint"), start.alias("start"), (F.col("n") - start).alias("n_tokens"), F.lit(False).alias("closed")).filter("n_tokens > 0")
    return closed.union(rest)


def document_names(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    """(file, no, doc_id): the documents that ``write_token_files`` put into the files under ``path``."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", _CLOSING).option("pathGlobFilter", "part-*").text(f"{path}/file=*/kind=names")
    file = F.regexp_extract(F.input_file_name(), "/file=([^/]+)/kind=names/[^/]+$", 1)
    row = F.from_json(F.decode(F.unbase64(F.substring_index("value", " ", -1)), "UTF-8"), f"doc_id {id_type}")
    return lines.select(file.alias("file"), F.substring_index("value", " ", 1).cast("bigint").alias("no"), row["doc_id"].alias("doc_id"))


def count_tokens(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(doc_id, token_file, doc_no, start, n_tokens) of each row, from flat files that it writes to the shared folder.

    Every document of a file must have its name and every name its document; a difference is an error.
    """
    spark = docs.sparkSession
    path, id_type = new_path(spark, "token-files"), docs.select(id_col).schema[0].dataType.simpleString()
    write_token_files(docs, path, vocabulary, text_col, id_col, file_bytes)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "file=*")):
        none = spark.createDataFrame([], f"doc_id {id_type}, token_file string, doc_no bigint, start bigint, n_tokens bigint")
        return none
    found, names = scan_token_files(spark, f"{path}/file=*/kind=tokens", block, "/file=([^/]+)/kind=tokens/[^/]+$"), written(document_names(spark, path, id_type), "names")
    system.delete(place, True)
    both = found.filter("closed").join(names, (found.file == names.file) & (found.doc_no == names.no), "full")
    whole = F.when(names.no.isNull() | found.file.isNull(), F.raise_error(F.lit("token files and names differ"))).otherwise(F.col("doc_id"))
    return both.select(whole.alias("doc_id"), found.file.alias("token_file"), "doc_no", "start", "n_tokens")
