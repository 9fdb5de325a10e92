"""Token ids as Parquet list columns.

Documents are ranged by id, encoded, and written with one file per range, in
ascending id order.  The token column is dictionary-encoded (at most a
vocabulary's worth of values per row group), the bookkeeping columns are
delta-encoded integers, row groups and pages have set sizes, and Parquet's
column and page indexes let a reader fetch some documents' tokens, or only the
bookkeeping, without the rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlab.llm.chunks import encoder, pack_ids, tokenizer_path
from feedlab.llm.common import map_arrow, tasks_for

END_ID = 1
# Parquet writer settings: version 2 pages delta-encode integers that have no
# dictionary; sizes are bytes.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}

_FILE = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                   ("n_tokens", pa.int32()), ("tokens", pa.list_(pa.int32()))])
_FILE_DDL = "shard int, doc_id long, local_start long, n_tokens int, tokens array<int>"


def _encode(path: str, end_id: int):
    end = pack_ids([end_id])

    def run(batches):
        encode, shard, start = encoder(path, False), TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, 500):       # a short run of texts at a time
                part = b.slice(at, 500)
                bufs = [encode(t.as_py()) + end for t in part.column(1)]
                sizes = np.array([len(x) // 4 for x in bufs], dtype=np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                  pa.array(np.frombuffer(b"".join(bufs), dtype="<i4")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bufs), shard, dtype=np.int32)), part.column(0),
                     pa.array(start + ends[:-1]), pa.array(sizes.astype(np.int32)), tokens], schema=_FILE)
                start += int(ends[-1])
    return run


def write_token_files(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", *,
                      tokenizer: str | None = None, end_id: int = END_ID, files: int | None = None) -> None:
    """Write ``docs`` to ``path`` in ascending id order (a null id comes first).

    A null or empty text is the end id alone; repeated rows are written once
    each, in any order among rows of one id; an id with many rows goes over several
    files.  A very long text is one row of one file.  An empty table writes files
    without rows; other columns are ignored.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = ("doc_id", "_text", "_row")
    src = (src.withColumn("_text", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
           .repartitionByRange(files or tasks_for(src), *keys).sortWithinPartitions(*keys).select("doc_id", "text"))
    (map_arrow(src, _encode(tokenizer or tokenizer_path("word_bpe_49k.json"), end_id), _FILE_DDL)
     .write.options(**FILE_OPTIONS).parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens; no token is read.

    The starts inside a file are stored; one row per file gives the files' own.
    """
    rows = spark.read.parquet(path).select("shard", "doc_id", "local_start", "n_tokens")
    return _started(rows).select("doc_id", "start", "n_tokens")


def _started(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy("shard").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    return (rows.join(before, "shard")
            .withColumn("start", F.col("before") + F.col("local_start"))
            .withColumn("n_tokens", F.col("n_tokens").cast("long")))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, tokens; given ids are pushed to the page indexes."""
    rows = spark.read.parquet(path).select("doc_id", "tokens")
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def _checksums(batches):
    for b in batches:
        lists = b.column("tokens")
        values = np.asarray(lists.values, dtype="<u4")
        ends = np.asarray(lists.offsets)
        crc = [zlib.crc32(values[i:j]) for i, j in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column("shard"), b.column("doc_id"), b.column("local_start"), pa.array(np.diff(ends).astype(np.int32)),
             pa.array(crc, pa.int64())], names=["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, all from the files."""
    rows = spark.read.parquet(path)
    sums = map_arrow(rows.select("shard", "doc_id", "local_start", "tokens"), _checksums,
                     "shard int, doc_id long, local_start long, n_tokens int, ids_crc32 long")
    totals = rows.groupBy("shard").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    return sums.join(before, "shard").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"),
                                             F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
