"""Token ids in Parquet files that can be read selectively, in document order."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField

from reviewloom.llm.batches import add_columns
from reviewloom.llm.word_pieces import word_pieces

COLUMNS = "doc_id part first n_tokens ids".split()


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Writes each document's ids, ended by ``end_id``, below ``path`` in ascending order of ``key``.

    One row a document: its key, the file's number in order (``part``), the ids before it in that
    file (``first``), its number of ids, and the ids as a list. Texts are range-partitioned before
    they are encoded, so that no text is encoded twice. Ids are dictionary-encoded; the ordered
    integer columns are delta-encoded; small row groups and pages with their indexes let a reader
    of some keys or of the integer columns skip the rest.

    A null text counts as empty and gives the end id alone. Rows with a null key come first; rows
    with equal keys come in the order in which they are read, and all stay. Other columns are not
    written. A very long text is one long list. An empty table gives files without rows.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    # the row's place spreads a key that many rows share; the sample for the ranges reads no text
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "_place").sortWithinPartitions("doc_id", "_place")

    def make():
        encode = word_pieces(content.value).encode
        part, before = TaskContext.get().partitionId(), 0

        def compute(texts: pa.Array) -> list[pa.Array]:
            nonlocal before
            packed = [x + end for x in encode(texts.to_pylist())]
            n = np.array([len(x) for x in packed], np.int64) // 4
            ends = np.cumsum(n)
            first, before = before + ends - n, before + (int(ends[-1]) if len(n) else 0)
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), ids)
            return [pa.array(np.full(len(n), part, np.int32)), pa.array(first), pa.array(n), lists]

        return compute

    fields = [
        StructField("part", IntegerType()),
        StructField("first", LongType()),
        StructField("n_tokens", LongType()),
        StructField("ids", ArrayType(IntegerType())),
    ]
    writer = (
        add_columns(rows, ["_text"], fields, make)
        .select(COLUMNS)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
    )
    for name in ("doc_id", "part", "first", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before, in the order of writing.

    ``start`` needs the integer columns alone: a file's total is one row, and a prefix sum over
    those gives each file's place. Selecting columns or filtering on keys reads only their pages.
    """
    rows = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("part")
        .agg(F.max(F.col("first") + F.col("n_tokens")).alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # one row per file of at least megabytes, so the broadcast is a millionth of the tokens
    return (
        rows.join(F.broadcast(starts), "part")
        .withColumn("start", F.col("_before") + F.col("first"))
        .drop("_before")
    )


def id_checksums(df: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """``df`` with the crc32 of each id list as little-endian unsigned 32-bit integers; null for null."""

    def make():
        def compute(lists: pa.Array) -> list[pa.Array]:
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            at, null = lists.offsets.to_numpy(), lists.is_null().to_pylist()
            sums = [
                None if null[i] else crc32(values[at[i] : at[i + 1]].tobytes()) for i in range(len(null))
            ]
            return [pa.array(sums, pa.int64())]

        return compute

    return add_columns(df, [ids], [StructField(out, LongType())], make).drop(ids)
