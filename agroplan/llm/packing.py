"""Packing of tokenised documents into sequences by the sum-of-squares rule.

A piece goes where the sum, over all residual gaps, of the squared number of open sequences with that
gap becomes smallest; ties go to the smaller gap that is left. Pieces are dealt at random into groups
of bounded size that are packed side by side, longest pieces first. The sequences that a group could
not fill well are taken apart, and their pieces are packed again in ever fewer groups, until one
group holds what is left or nothing improves.

A document's ids are those of its whole text and the end id. Only longer ones are cut, into pieces of
``capacity``; the last piece may be shorter. Null and empty texts are one end id. Rows are told apart
by (id, piece) and a row hash of the text's ids, so that repeated rows are all packed; other columns
are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, steps, written
from .tokens import encoder

#: Pieces that one group packs at a time.
GROUP = 16_384
#: Sequences filled to at least this part are final at once.
FULL = 0.995


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each length, placed in the given order."""
    open_ = np.zeros(capacity + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    used, never = 0, np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        have = open_[n:]
        change = np.where(have > 0, 2 * (open_[: capacity + 1 - n] - have) + 2, never)
        if have[0]:
            change[0] = 1 - 2 * have[0]  # a filled sequence has no gap
        best = int(change.argmin())
        fresh = 2 * int(open_[capacity - n]) + 1 if n < capacity else 0
        if change[best] > fresh:
            gap, where = capacity, used
            used += 1
        else:
            gap = best + n
            where = stacks[gap].pop()
            open_[gap] -= 1
        sequence[i], offset[i] = where, capacity - gap
        if left := gap - n:
            stacks[left].append(where)
            open_[left] += 1
    return sequence, offset


def token_pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int, capacity: int, drops_space: bool = True, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, row, piece, start, length, ids_crc32[, ids])``: each document's ids, cut to ``capacity``."""
    names = {"doc_id": pa.int64(), "row": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    schema = pa.schema([*names.items(), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])])

    def run(batches):
        encode = encoder(vocabulary, drops_space)
        for batch in steps(batches):
            flat, bounds = encode.ids(batch.column(2), end_id)
            tokens = flat.astype("<u4")
            sizes = np.diff(bounds)
            counts = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = bounds[owner] + piece * capacity
            end = np.minimum(begin + capacity, bounds[owner + 1])
            raw = tokens.tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
            own = [batch.column(i).take(pa.array(owner)) for i in (0, 1)]
            out = [*own, pa.array(piece, pa.int32()), pa.array(piece * capacity), pa.array(end - begin), pa.array(crc, pa.int64())]
            if keep_ids:
                out.append(list_array(tokens.astype("<i4"), np.concatenate([[0], np.cumsum(end - begin)])))
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    kinds = "doc_id long, row long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, kinds)


def pack_lengths(pieces: DataFrame, capacity: int) -> DataFrame:
    """``(row, piece, length)`` with ``(sequence_id, offset)``."""
    schema = "row long, piece int, length long, sequence_id long, offset long, turn long, fill long"
    spread = F.xxhash64("row", "piece")

    def pack(turn: int):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
            sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
            fill = np.bincount(sequence, weights=group["length"]).astype(np.int64)
            # turn, group and place in it make the number; a group has at most 2**24 sequences
            return group.assign(sequence_id=(turn << 56) + (int(key[0]) << 24) + sequence, offset=offset, turn=turn, fill=fill[sequence])[["row", "piece", "length", "sequence_id", "offset", "turn", "fill"]]

        return run

    done, left, turn = None, pieces.select("row", "piece", "length"), 1
    n = left.count()
    while n:
        groups = max(1, -(-n // GROUP))
        packed = written(left.withColumn("g", F.pmod(spread, F.lit(groups))).groupBy("g").applyInPandas(pack(turn), schema), "packed")
        last = groups == 1 or turn == 20
        good = packed if last else packed.where(F.col("fill") >= int(FULL * capacity))
        done = good if done is None else done.unionAll(good)
        if last:
            break
        left = packed.where(F.col("fill") < int(FULL * capacity)).select("row", "piece", "length")
        before, n = n, left.count()
        if n > before // 2:  # no group can do much better: these lengths don't fill sequences
            done = done.unionAll(packed.where(F.col("fill") < int(FULL * capacity)))
            break
        turn += 1
    empty = left.select("row", "piece", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    return empty if done is None else done.select("row", "piece", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 4096, drops_space: bool = True, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])`` per piece."""
    pieces = written(token_pieces(docs, id_col, text_col, vocabulary, end_id, capacity, drops_space, keep_ids), "pieces")
    placed = pack_lengths(pieces, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return pieces.join(placed, ["row", "piece"]).select(*columns)
