"""Token files: documents' ids in ascending document order, range-coded in checksummed blocks.

``write_token_files`` range-partitions the documents by id, encodes every text with a
public tokenizer, appends a closing id and writes segments: a segment holds whole
consecutive documents (their ids and lengths) and their tokens as independent blocks
of :mod:`counterpoise.llm.rangecoder`.  Segments are rows of Parquet files, so Spark's
committer makes the write atomic and any store Spark reaches will do; a lost executor
costs its tasks only.

``read_token_files`` decodes segments in parallel, verifies every checksum and gives the
documents back with the position of their first id in the whole.

Defined cases: null and empty texts hold the closing id alone; repeated rows are kept,
equal ids in the order of their text's hash; null ids come first; an empty table gives
empty files; other columns are ignored; a damaged block raises ``CorruptBlock``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from counterpoise.llm import rangecoder, tokens
from counterpoise.llm.common import ship

ship(__name__)

SEGMENT = 2560 * rangecoder.BLOCK  # ids after which a segment ends with its document
PARTITION_BYTES = 24 << 20  # text of a file


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, closing_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(max(1, math.ceil(size / PARTITION_BYTES)), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows = rows.withColumn("file", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer_path, tokens.cut_blank)
        segment, file = 0, 0
        doc_ids: list[pa.Array] = []
        ids: list[np.ndarray] = []
        lens: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal segment, doc_ids, ids, lens
            flat, n = np.concatenate(ids), np.concatenate(lens)
            blocks = [flat[i : i + rangecoder.BLOCK] for i in range(0, len(flat), rangecoder.BLOCK)]
            own = pa.concat_arrays(doc_ids)
            out = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(flat)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                 pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.array(n, pa.int64())),
                 pa.array([b"".join(rangecoder.encode_blocks(blocks))], pa.binary())],
                names=["file", "segment", "n_ids", "doc_ids", "lengths", "payload"])
            segment, doc_ids, ids, lens = segment + 1, [], [], []
            return out

        for b in batches:
            for lo, hi in tokens.column_slices(b.column(1)):
                file = b.column(2)[lo].as_py()
                own, at = enc.encode(b.column(1).slice(lo, hi - lo))
                n = np.diff(at) + 1
                flat = np.full(len(own) + len(n), closing_id, np.uint32)
                flat[np.arange(len(own)) + np.repeat(np.arange(len(n)), n - 1)] = own
                doc_ids.append(b.column(0).slice(lo, hi - lo))
                ids.append(flat)
                lens.append(n)
                if sum(map(len, ids)) >= SEGMENT:
                    yield flush()
        if ids:
            yield flush()

    schema = f"file int, segment int, n_ids long, doc_ids array<{kind}>, lengths array<long>, payload binary"
    rows.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids array<int>)``; with ``digests`` the last is ``ids_crc32`` of the ids as little-endian u32."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc_ids, n = b.column(2)[i].values, np.asarray(b.column(3)[i].values, np.int64)
                got = rangecoder.decode_blocks(b.column(4)[i].as_py())
                flat = np.concatenate(got).astype("<u4") if got else np.zeros(0, "<u4")
                ends = np.cumsum(n)
                if int(n.sum()) != len(flat):
                    raise rangecoder.CorruptBlock("segment's lengths differ")
                at = np.concatenate([[0], ends])
                if digests:
                    view = memoryview(flat).cast("B")
                    last = pa.array([zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32)))
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, b.column(0)[i].as_py()), pa.int32()), pa.array(np.full(k, b.column(1)[i].as_py()), pa.int32()),
                     doc_ids, pa.array(ends - n), pa.array(n), last],
                    names=["file", "segment", "doc_id", "inside", "n_tokens", "last"])

    last = "long" if digests else "array<int>"
    docs = files.select("file", "segment", "doc_ids", "lengths", "payload").mapInArrow(
        run, f"file int, segment int, doc_id {kind}, inside long, n_tokens long, last {last}")
    # Where segments begin: prefix sums over files (one row each), then over each file's segments.
    before = (Window.unboundedPreceding, -1)
    per_file = files.groupBy("file").agg(F.sum("n_ids").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(*before)), F.lit(0)).alias("file_start"))
    begins = files.select("file", "segment", F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("file").orderBy("segment").rowsBetween(*before)), F.lit(0)).alias("segment_start"))
    begins = begins.join(per_file, "file").select("file", "segment", (F.col("file_start") + F.col("segment_start")).alias("first"))
    return docs.join(begins, ["file", "segment"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", F.col("last").alias("ids_crc32" if digests else "ids"))
