"""Substring deduplication by prefix doubling over sampled text positions.

A byte is removed when a string of ``length`` bytes covers it that also starts in a document with a
smaller id. Strings are compared by prefix doubling: with k = ceil(length / 2), a position's rank is
the hash of its k bytes, and the rank of the whole string is the pair of the ranks at the position
and at offset ``length - k``.

Sorting a (position, rank) pair for every byte would shuffle tens of times the input, so the first
round sorts a sample that misses nothing: each string of ``length`` bytes stands under its anchor,
the position in it with the least rank (winnowing), and consecutive strings with one anchor form a
segment. Round 1 sorts the segments by the anchor's rank. A rank that only one document has is
unique: its strings are past the search. A segment that occurs whole in a smaller document is
settled. Round 2 doubles: in what is left (borders of repeats), every position's rank pair is sorted
and reranked, and it is settled against the smaller documents.

Null and empty texts have no bytes; matches do not cross documents; rows with the same id do not
match each other, and each is cut by its own text; a null id matches nothing; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, binary_array, list_array, mix, prefix_hash, shuffle_partitions, span_hash, steps, written

#: Request lists that a join may broadcast: rows, and entries in them; more are shuffled.
SMALL_ROWS, SMALL_ENTRIES = 500_000, 4_000_000
_LOW48 = np.uint64((1 << 48) - 1)


class Segments:
    """The segments of a few texts: anchor rank, hash, first and last start, and each text's share of them."""

    def __init__(self, texts: list[bytes], length: int):
        k = (length + 1) // 2
        self.length, self.k = length, k
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        self.begins = ends - np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        n = len(data)
        if n < length:
            self.rank = self.anchor_rank = self.hash = np.empty(0, dtype=np.uint64)
            self.first = self.last = np.empty(0, dtype=np.int64)
            self.bounds = np.zeros(len(texts) + 1, dtype=np.int64)
            return
        sums = prefix_hash(data)
        at = np.arange(n - k + 1)
        self.rank = span_hash(sums, at, at + k)
        bits = np.uint64(max(24, int(n).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        least = (self.rank & ~low) | at.astype(np.uint64)
        width, have = length - k + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        anchor = (least & low).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), ends - self.begins)[: n - length + 1]
        whole = np.arange(n - length + 1) + length <= ends[owner]
        change = np.ones(len(anchor), dtype=bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
        self.first = np.flatnonzero(change)
        self.last = np.concatenate([self.first[1:], [len(anchor)]]) - 1
        self.first, self.last = (x[whole[self.first]] for x in (self.first, self.last))
        self.anchor_rank = self.rank[anchor[self.first]] & _LOW48
        self.hash = span_hash(sums, self.first, self.last + length) & _LOW48
        self.bounds = np.searchsorted(self.first, np.concatenate([self.begins, ends[-1:]]))

    def pair(self, start: np.ndarray) -> np.ndarray:
        """The doubled rank of the strings that begin at ``start``."""
        return mix(self.rank[start] * np.uint64(0xD1342543DE82EF95) + self.rank[start + self.length - self.k])


def _deal(part: np.ndarray, owner: np.ndarray, owners: dict[str, np.ndarray], columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per part: the owners (ids, rows), how many entries each has, and the entries."""
    order = np.argsort(part, kind="stable")
    part, owner = part[order], owner[order]
    runs = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (np.diff(owner) != 0)]))
    counts = np.diff(np.concatenate([runs, [len(part)]]))
    cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(part) != 0])), [len(part)]])
    run_cuts = np.searchsorted(runs, cuts)
    out = [pa.array(part[cuts[:-1]].astype(np.int32)), *(list_array(o[owner[runs]], run_cuts) for o in owners.values()), list_array(counts.astype(np.int32), run_cuts)]
    for values in columns.values():
        out.append(binary_array(values[order].view(np.uint8).reshape(-1, 8)[:, :6].reshape(-1), cuts * 6) if values.dtype == np.uint64 else list_array(values[order], cuts))
    return pa.RecordBatch.from_arrays(out, ["part", *owners, "counts", *columns])


def _dealt(table: pa.Table, owners: tuple[str, ...], *names: str) -> list[np.ndarray]:
    """What :func:`_deal` sent: the owner of each entry, and the entries by column."""
    *own, counts = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in (*owners, "counts"))
    out = [np.repeat(o, counts) for o in own]
    for name in names:
        column = table.column(name)
        if pa.types.is_binary(column.type):
            raw = np.zeros((len(out[0]), 8), dtype=np.uint8)
            raw[:, :6] = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 6)
            out.append(raw.view(np.uint64).reshape(-1))
        else:
            out.append(column.combine_chunks().flatten().to_numpy(zero_copy_only=False))
    return out


def _per_owner(owners: list[np.ndarray], *columns: np.ndarray) -> tuple[list[pa.Array], list[pa.ListArray]]:
    order = np.lexsort(owners[::-1])
    owners = [o[order] for o in owners]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([np.diff(o) != 0 for o in owners], axis=0)
    starts = np.flatnonzero(new)
    return [pa.array(o[starts].astype(np.int64)) for o in owners], [list_array(c[order], np.concatenate([starts, [len(order)]])) for c in columns]


def _first_of(*keys: np.ndarray, by: np.ndarray) -> np.ndarray:
    """For each entry, the least ``by`` among the entries with the same keys."""
    order = np.lexsort((by, *keys))
    new = np.ones(len(order), dtype=bool)
    for key in keys:
        new[1:] &= key[order][1:] == key[order][:-1]
    new[1:] = ~new[1:]
    out = np.empty(len(order), dtype=by.dtype)
    out[order] = by[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else by
    return out


def repeated_segments(docs: DataFrame, length: int, partitions: int) -> DataFrame:
    """Round 1. ``(doc_id, covered, asked)``: segment hashes that are settled, and those that round 2 needs."""

    def deal(batches):
        for batch in steps(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            seg = Segments(as_bytes(batch.column(1)), length)
            if len(seg.hash):
                owner = np.repeat(np.arange(len(ids)), np.diff(seg.bounds))
                yield _deal((seg.anchor_rank % np.uint64(partitions)).astype(np.int32), owner, {"ids": ids}, {"ranks": seg.anchor_rank, "hashes": seg.hash})

    def rerank(table: pa.Table) -> pa.Table:
        ids, ranks, hashes = _dealt(table, ("ids",), "ranks", "hashes")
        order = np.argsort(ranks, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(ranks[order]) != 0]))
        sizes = np.diff(np.concatenate([starts, [len(ranks)]]))
        many = np.zeros(len(ranks), dtype=bool)
        many[order] = np.repeat(sizes > 1, sizes)
        ids, ranks, hashes = ids[many], ranks[many], hashes[many]
        least = _first_of(ranks, by=ids)
        owner = _first_of(ranks, hashes, by=ids)  # the smallest document with this very segment
        covered, partial = owner < ids, (owner == ids) & (least < ids)
        last_partial = -_first_of(ranks, by=np.where(partial, -ids, np.iinfo(np.int64).max))
        asked = (owner == ids) & (partial | (ids < last_partial))
        out_ids = np.concatenate([ids[covered], ids[asked]])
        values = np.concatenate([hashes[covered], hashes[asked]]).view(np.int64)
        kind = np.concatenate([np.zeros(int(covered.sum()), np.int8), np.ones(int(asked.sum()), np.int8)])
        (key,), (value, flag) = _per_owner([out_ids], values, kind)
        return pa.table({"doc_id": key, "hashes": value, "asked": flag})

    found = docs.mapInArrow(deal, "part int, ids array<long>, counts array<int>, ranks binary, hashes binary").groupBy("part").applyInArrow(rerank, "doc_id long, hashes array<long>, asked array<byte>")
    pick = lambda want: F.array_distinct(F.flatten(F.collect_list(F.transform(F.filter(F.arrays_zip("hashes", "asked"), lambda x: x["asked"] == want), lambda x: x["hashes"]))))
    return found.groupBy("doc_id").agg(pick(0).alias("covered"), pick(1).alias("asked"))


def doubled_matches(docs: DataFrame, asked: DataFrame, length: int, partitions: int) -> DataFrame:
    """Round 2. ``(doc_id, row, starts)``: starts, in the asked segments, of strings that a smaller document has."""
    entries = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("asked")), F.lit(0))).first()
    small = entries[0] <= SMALL_ROWS and entries[1] <= SMALL_ENTRIES
    joined = docs.join(F.broadcast(asked) if small else asked, "doc_id").select("doc_id", "text", "asked", "row")

    def deal(batches):
        for batch in steps(batches):
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3))
            seg = Segments(as_bytes(batch.column(1)), length)
            wanted = [np.isin(seg.hash[a:b], np.array(w, dtype=np.int64).view(np.uint64)) for a, b, w in zip(seg.bounds[:-1], seg.bounds[1:], batch.column(2).to_pylist(), strict=True)]
            chosen = np.flatnonzero(np.concatenate(wanted)) if wanted else []
            if not len(chosen):
                continue
            sizes = seg.last[chosen] - seg.first[chosen] + 1
            start = np.repeat(seg.first[chosen] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.searchsorted(seg.bounds, chosen, side="right") - 1, sizes)
            pair = seg.pair(start)
            yield _deal((pair % np.uint64(partitions)).astype(np.int32), owner, {"ids": ids, "rows": rows}, {"pairs": pair >> np.uint64(16), "starts": (start - seg.begins[owner]).astype(np.int64)})

    def rerank(table: pa.Table) -> pa.Table:
        ids, rows, pairs, starts = _dealt(table, ("ids", "rows"), "pairs", "starts")
        covered = _first_of(pairs, by=ids) < ids
        (key, row), (value,) = _per_owner([ids[covered], rows[covered]], starts[covered])
        return pa.table({"doc_id": key, "row": row, "starts": value})

    found = joined.mapInArrow(deal, "part int, ids array<long>, rows array<long>, counts array<int>, pairs binary, starts array<long>").groupBy("part").applyInArrow(rerank, "doc_id long, row long, starts array<long>")
    return found.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept)`` for every row.

    ``spans`` holds the removed byte ranges [from, to) and ``kept`` the bytes that are left.
    """
    spark = docs.sparkSession
    partitions = 2 * shuffle_partitions(spark)
    # rows that share an id are told apart by their texts
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("row"))
    known = docs.where("doc_id is not null")
    round1 = written(repeated_segments(known, length, partitions), "segments")
    round2 = doubled_matches(known, round1.where(F.size("asked") > 0).select("doc_id", "asked"), length, partitions)
    # few rows share an id, so that a document's list of them stays short
    doubled = written(round2, "doubled").groupBy("doc_id").agg(F.collect_list(F.struct("row", "starts")).alias("doubled"))
    results = round1.select("doc_id", "covered").join(doubled, "doc_id", "left")

    def cut(batches):
        for batch in steps(batches):
            texts = as_bytes(batch.column(1))
            doubled = [next((d["starts"] for d in found or () if d["row"] == row), []) for row, found in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            hit = [bool(c) or bool(s) for c, s in zip(batch.column(2).to_pylist(), doubled, strict=True)]
            rows = []
            for i, text in enumerate(texts):
                spans = []
                if hit[i]:
                    seg = Segments([text], length)
                    edge = np.zeros(len(text) + 1, dtype=np.int32)
                    done = np.isin(seg.hash, np.array(batch.column(2)[i].as_py() or [], dtype=np.int64).view(np.uint64))
                    np.add.at(edge, seg.first[done], 1)
                    np.add.at(edge, seg.last[done] + length, -1)
                    starts = np.array(doubled[i], dtype=np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + length, -1)
                    inside = np.concatenate([[False], np.cumsum(edge) > 0])
                    turn = np.flatnonzero(inside[1:] != inside[:-1])
                    spans = list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                left = b"".join([*kept, text[at:]])
                rows.append({"doc_id": batch.column(0)[i].as_py(), "n_bytes": len(text), "n_removed": len(text) - len(left), "n_spans": len(spans), "kept_sha256": hashlib.sha256(left).hexdigest(), "spans": [{"from": a, "to": b} for a, b in spans], "kept": left})
            yield pa.RecordBatch.from_pylist(rows, schema)

    span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(span)), ("kept", pa.binary())])
    return docs.join(results, "doc_id", "left").select("doc_id", "text", "covered", "doubled", "row").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<`from`:long,`to`:long>>, kept binary")
