"""Token-id files: frequency-ranked ids, byte-aligned variable-length coding, separate control bytes.

A file holds blocks in ascending document order. A block is

    magic ``TIB1``, then u32: documents, ids, data bytes, crc32 of all that follows
    i64 document ids, u32 ids per document
    control bytes: two bits per id, four ids per byte, low bits first: the id's data bytes less one
    data bytes: the id's rank, little-endian, 1 to 4 bytes

An id's rank is its place in the order of falling frequency over the whole corpus (ties: the smaller
id), so that the commonest 256 ids take one byte. The rank table is one row per id of the vocabulary
(u32, bounded by the vocabulary's size) and stands in a file of its own. Decoding is a numpy table
lookup: a control byte gives the lengths of its four ids.

Null and empty texts are the end id alone; rows with one id stay apart, in any order; null ids come
first and are stored as the least 64-bit integer; an empty table gives no blocks; other columns are not
looked at.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import binary_array, new_path, shuffle_partitions, steps, written
from .files import read_file, write_file
from .tokens import encoder

MAGIC = b"TIB1"
#: Stands for a null document id in a block.
NO_ID = -(1 << 63)
#: Bytes of ids that one block gathers (a longer document is a block of its own).
BLOCK_BYTES = 8 << 20
#: Lengths of the four ids of a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode_block(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """A block's bytes; ``ranks`` holds all documents' ids one after another."""
    ranks = ranks.astype("<u4")
    size = np.ones(len(ranks), dtype=np.uint8)
    for bits in (8, 16, 24):
        size += ranks >= 1 << bits
    code = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    code[: len(ranks)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = ranks.view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < size[:, None]]
    body = doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + control.tobytes() + data.tobytes()
    return MAGIC + struct.pack("<IIII", len(doc_ids), len(ranks), len(data), zlib.crc32(body)) + body


def decode_blocks(data: bytes):
    """``(doc_ids, counts, ranks)`` of each block of a file."""
    at = 0
    while at < len(data):
        docs, ids, size, crc = struct.unpack_from("<IIII", data, at + 4)
        control_size = -(-ids // 4)
        end = at + 20 + 12 * docs + control_size + size
        if data[at : at + 4] != MAGIC or end > len(data) or zlib.crc32(memoryview(data)[at + 20 : end]) != crc:
            raise ValueError("not a whole token-id block")
        doc_ids = np.frombuffer(data, "<i8", docs, at + 20)
        counts = np.frombuffer(data, "<u4", docs, at + 20 + 8 * docs)
        control = np.frombuffer(data, np.uint8, control_size, at + 20 + 12 * docs)
        lengths = LENGTHS[control].reshape(-1)[:ids]
        raw = np.zeros((ids, 4), dtype=np.uint8)
        raw[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8, size, end - size)
        yield doc_ids, counts, raw.view("<u4").reshape(-1)
        at = end


def write_token_files(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, drops_space: bool = False) -> tuple[DataFrame, str]:
    """Write the files; ``(path, part, block, n_docs, n_tokens, n_bytes)`` per block, and the rank table's path."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")

    def tokenise(batches):
        encode = encoder(vocabulary, drops_space)
        for batch in steps(batches):
            ids, bounds = encode.ids(batch.column(1), end_id)
            yield pa.RecordBatch.from_arrays([batch.column(0), binary_array(ids.view(np.uint8), bounds * encode.dtype.itemsize)], ["doc_id", "ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = written(picked.mapInArrow(tokenise, "doc_id long, ids binary"), "ids")

    def count(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=encoder(vocabulary, drops_space).dtype))
            if len(found) > len(total):
                found, total = total, found.astype(np.int64)
            total[: len(found)] += found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["token", "n"])

    # one row per id of the vocabulary: bounded by the vocabulary, not by the corpus
    ranked = tokens.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    order = ranked.sort_values(["n", "token"], ascending=[False, True])["token"].to_numpy()
    table = write_file(folder, "ranks", order.astype("<u4").tobytes())
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, dtype=np.uint32)
    rank[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank)

    def write(batches):
        dtype, part, block = encoder(vocabulary, drops_space).dtype, None, 0
        for batch in steps(batches, "ids", BLOCK_BYTES):
            values = batch.column(2).to_pylist()
            part = batch.column(0)[0].as_py() if part is None else part
            counts = np.fromiter(map(len, values), dtype=np.int64) // dtype.itemsize
            data = encode_block(pc.fill_null(batch.column(1), NO_ID).to_numpy(zero_copy_only=False), counts, shared.value[np.frombuffer(b"".join(values), dtype=dtype)])
            path = write_file(folder, f"part-{part:06d}-{block:06d}", data)
            yield pa.RecordBatch.from_pylist([{"path": path, "part": part, "block": block, "n_docs": len(values), "n_tokens": int(counts.sum()), "n_bytes": len(data)}])
            block += 1

    parts = tokens.repartitionByRange(shuffle_partitions(spark), "doc_id").withColumn("part", F.spark_partition_id()).sortWithinPartitions("doc_id").select("part", "doc_id", "ids")
    kinds = "path string, part long, block long, n_docs long, n_tokens long, n_bytes long"
    return written(parts.mapInArrow(write, kinds), "blocks"), table


def read_token_files(spark: SparkSession, blocks: DataFrame, table: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document in the files."""
    # one row per block: its documents' ids begin after those of all blocks before it
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("part_start"))
    placed = blocks.join(before, "part").withColumn("start", F.col("part_start") + F.sum("n_tokens").over(W.partitionBy("part").orderBy("block")) - F.col("n_tokens"))

    def read(batches):
        order = np.frombuffer(read_file(table), "<u4")
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for doc_ids, counts, ranks in decode_blocks(read_file(path)):
                    tokens = order[ranks]
                    ends = np.cumsum(counts, dtype=np.int64)
                    parts = [tokens[a:b] for a, b in zip(ends - counts, ends, strict=True)]
                    columns = [pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(start + ends - counts), pa.array(counts.astype(np.int64)), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, *([pa.array([p.astype("<i4") for p in parts], pa.list_(pa.int32()))] if keep_ids else [])], names)
                    start += int(ends[-1])

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])]
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    dealt = placed.select("path", "start").repartition(shuffle_partitions(spark), "path")
    return dealt.mapInArrow(read, kinds)
