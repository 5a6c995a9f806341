"""Token ids in ORC files, ordered by document id.

One row per document: its id, its place in the file and its token ids as a list
of integers, which ORC writes with integer run-length encoding.  Files are in ascending doc_id
order from one to the next and inside.  Row-group indexes and a Bloom filter
on ``doc_id`` let readers skip stripes and row groups from metadata alone;
stripes are read in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import materialise
from ocellus.llm.tokens import in_blocks, shared_encoder
from ocellus.session import scratch_path

VOCAB, END_ID = "byte_bpe_50k.json", 2
#: ORC's own settings: rows between index entries, the filter's error rate.
ORC = {"orc.create.index": "true", "orc.row.index.stride": "1000",
       "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


def _encode(vocab: str, end_id: int):
    def run(batches):
        encoder, end, seq = shared_encoder(vocab), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in in_blocks(texts):
                raw = encoder.encode(texts[a:b])
                sizes = np.array([len(r) // 4 + 1 for r in raw])
                ids = np.frombuffer(b"".join(r + end for r in raw), "<i4")
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.arange(seq, seq + b - a)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["doc_id", "seq", "ids"])
                seq += b - a
    return run


_SCHEMA = "doc_id long, seq long, ids array<int>"


def write_token_orc(docs: DataFrame, path: str, vocab: str = VOCAB, end_id: int = END_ID) -> None:
    """Encode every whole text of ``docs`` (null: empty), end each document
    with ``end_id`` and write the rows in ascending doc_id order (null ids
    first, rows of one id by a hash of the text, which also deals an id that
    very many rows share to several files; repeated rows are written each).
    Texts are encoded whole, whatever their length, about 4,000,000 characters
    of them at a time.  An empty table gives files that hold the schema.
    Other columns are ignored."""
    order = ("doc_id", F.xxhash64("text"))
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_encode(vocab, end_id), _SCHEMA).write.options(**ORC).orc(path))


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, seq, ids, part``: the rows of the files, ``part`` being the
    file's place in the order and ``seq`` the row's in the file.  With ``doc_ids`` only these documents; stripes and
    row groups without them are skipped by their statistics and filters."""
    rows = spark.read.schema(_SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return rows.select("doc_id", "seq", "ids", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
                       .cast("int").alias("part"))


def _digest(batches):
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy().view("<u4")
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("seq"), pa.array(np.diff(offsets), pa.int64()),
             pa.array(sums, pa.int64())], names=["doc_id", "part", "seq", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files:
    ``start`` counts the ids of all documents before, in the files' order."""
    docs = materialise(spark, read_token_orc(spark, path).mapInArrow(
        _digest, "doc_id long, part int, seq long, n_tokens long, ids_crc32 long"), "token-index")
    # one row per file: few enough for one task
    files = docs.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = files.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    return (docs.withColumn("upto", inside).join(before, "part")
            .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_output(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and index them."""
    path = scratch_path(spark, "token-orc")
    write_token_orc(docs, path, **how)
    return token_index(spark, path)
