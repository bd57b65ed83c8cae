"""Vector code compression: product codebooks fitted with norm-of-sum bounds.

A vector's components x become floor(``scale`` * x) and are cut into ``parts`` equal consecutive parts;
each part is coded as its nearest entry of the codebook at that place (squared Euclidean distance in
integers, ties to the lower index). A codebook starts as that part of the ``entries`` smallest ids; each
of ``rounds`` rounds assigns all parts and replaces each entry by the componentwise floor of its parts'
mean; unused entries stay.

A round does not compare every part with every entry. A row keeps, for each part, an upper bound on the
distance to its entry and, for each of ``GROUPS`` groups of entries, a lower bound on the distance to the
others, with the round in which each was measured. All codebooks so far are kept, so that a bound is
carried to the present round by the true net displacement |C_now - C_then| of the entries (the norm of
the sum of their steps, never more than the sum of the steps' norms). Only groups whose lower bound does
not exceed the upper one are compared exactly. Bounds are rounded outwards, so that codes are exact.

The rows' bounds are a written table of each round; sums of parts are added up in tasks, then by Spark;
codebooks have ``entries`` x width numbers, whatever the data.

Vectors that are null or hold null or non-finite components are dropped; shorter ones (empty ones too)
count as ending in zeros, as does a width that ``parts`` does not divide; components beyond
+-2^27 after scaling are held there. Fewer than ``entries`` vectors give as many entries; rows with
equal ids are ordered by their components, null ids last; null labels are one group; an empty table
gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, release, small_side, written

#: Groups of entries that share a lower bound.
GROUPS = 4
#: Scaled components are held within this; distances then fit 64 bits.
LARGEST = 1 << 27
#: What a bound may be off by, relatively, when carried in floating point.
_SLACK = 1e-9


def scaled_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``(vec_id, label, ints)`` of the rows whose vectors are whole and finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ints = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    return rows.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), ints.alias("ints"))


# --- exact distances and bounds, on arrays -------------------------------------------------


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, entries) between integer rows; in floating point where that is exact too."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if int(top) ** 2 * 4 * x.shape[1] < 1 << 53 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + _SLACK)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - _SLACK)).astype(np.float32), np.float32(-np.inf))


class Codebooks:
    """The codebooks of all rounds so far; ``books[t]`` is (parts, entries, width of a part)."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        now = books[-1].astype(np.float64)
        #: net[s, p, j]: how far entry j is now from where it was in round s.
        self.net = np.stack([np.sqrt(((now - b) ** 2).sum(2)) for b in books])
        sizes = np.argsort((books[0].astype(np.float64) ** 2).sum(2), axis=1, kind="stable")
        #: entries by group, each ascending, so that ties go to the lower index.
        self.groups = [[np.sort(m) for m in np.array_split(order, min(GROUPS, len(order)))] for order in sizes]
        self.far = np.stack([[[net[p, m].max() for m in self.groups[p]] for p in range(len(now))] for net in self.net])
        self.group_of = np.empty(now.shape[:2], dtype=np.int64)
        for p, groups in enumerate(self.groups):
            for g, m in enumerate(groups):
                self.group_of[p, m] = g


class Bounds:
    """Codes and bounds of n rows; ``since`` and ``low_since`` are the rounds in which the bounds were measured."""

    FIELDS = (("code", np.uint8), ("up", np.float32), ("since", np.uint8), ("low", np.float32), ("low_since", np.uint8))

    def __init__(self, n: int, parts: int, groups: int, data: dict[str, np.ndarray] | None = None):
        shapes = {"code": (n, parts), "up": (n, parts), "since": (n, parts), "low": (n, parts, groups), "low_since": (n, parts, groups)}
        for name, kind in self.FIELDS:
            setattr(self, name, np.zeros(shapes[name], kind) if data is None else data[name].view(kind).reshape(shapes[name]).copy())
        self.rescans = np.zeros(n, dtype=np.int32)

    def first(self, x: np.ndarray, known: Codebooks) -> None:
        """All entries are compared."""
        every = np.arange(len(x))
        for p, book in enumerate(known.books[-1]):
            d = squared(x[:, p], book)
            code = d.argmin(1)
            self.code[:, p], self.up[:, p] = code, _up(np.sqrt(d[every, code].astype(np.float64)))
            d[every, code] = np.iinfo(np.int64).max
            for g, members in enumerate(known.groups[p]):
                self.low[:, p, g] = _down(np.sqrt(d[:, members].min(1).astype(np.float64)))

    def again(self, x: np.ndarray, known: Codebooks) -> None:
        """Only what the carried bounds leave open is compared."""
        now = len(known.books) - 1
        for p, book in enumerate(known.books[-1]):
            old = self.code[:, p].astype(np.int64)
            upper = self.up[:, p] + known.net[self.since[:, p], p, old]
            groups = np.arange(len(known.groups[p]))
            lower = self.low[:, p].astype(np.float64) - known.far[self.low_since[:, p], p, groups]
            some = np.flatnonzero((lower <= upper[:, None] * (1 + _SLACK)).any(1))
            if not len(some):
                continue
            own = ((x[some, p] - book[old[some]]) ** 2).sum(1)
            tight = np.sqrt(own.astype(np.float64))
            self.up[some, p], self.since[some, p] = _up(tight), now
            open_ = lower[some] <= tight[:, None] * (1 + _SLACK)
            left = np.flatnonzero(open_.any(1))
            some, own, open_, lower = some[left], own[left], open_[left], lower[some[left]]
            self.rescans[some] += 1
            best, code, home = own.copy(), old[some], known.group_of[p, old[some]]
            least, second = np.full((2, len(some), len(groups)), np.iinfo(np.int64).max)
            for g, members in enumerate(known.groups[p]):
                r = np.flatnonzero(open_[:, g])
                if not len(r):
                    continue
                d = squared(x[some[r], p], book[members])
                at = d.argmin(1)
                least[r, g] = d[np.arange(len(r)), at]
                d[np.arange(len(r)), at] = np.iinfo(np.int64).max
                second[r, g] = d.min(1)
                entry = members[at]
                nearer = (least[r, g] < best[r]) | ((least[r, g] == best[r]) & (entry < code[r]))
                best[r[nearer]], code[r[nearer]] = least[r[nearer], g], entry[nearer]
            moved = code != old[some]
            self.code[some, p] = code
            self.up[some, p] = _up(np.sqrt(best.astype(np.float64)))
            mine = known.group_of[p, code]
            for g in groups:
                measured = np.where(mine == g, second[:, g], least[:, g])
                low = np.where(open_[:, g], np.sqrt(measured.astype(np.float64)), lower[:, g])
                # an entry that was left joins the others of its group
                joins = moved & (home == g) & ~open_[:, g]
                low = np.where(joins, np.minimum(low, np.sqrt(own.astype(np.float64))), low)
                set_ = open_[:, g] | joins
                self.low[some[set_], p, g], self.low_since[some[set_], p, g] = _down(low[set_]), now

    def errors(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        parts = np.arange(book.shape[0])
        return ((x - book[parts[None, :], self.code]) ** 2).sum((1, 2))


# --- passes over the table ------------------------------------------------------------------


def _binary(x: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(x).reshape(len(x), -1).view(np.uint8).reshape(-1)
    width = len(flat) // max(len(x), 1)
    offsets = (np.arange(len(x) + 1) * width).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)


def _padded(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width``, with zeros behind shorter ones."""
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


_STATE = "vec_id long, vector binary, " + ", ".join(f"{name} binary" for name, _ in Bounds.FIELDS) + ", rescans int"


def _with_label(ddl: str, label: T.DataType) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField("label", label)])


def _slices(batches, rows: int = 4096):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def assign_first(vectors: DataFrame, known: Codebooks, parts: int, width: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(known.books)

    def run(batches):
        known = Codebooks(shared.value)
        for batch in _slices(batches):
            x = _padded(batch.column("ints"), width).reshape(batch.num_rows, parts, -1)
            state = Bounds(len(x), parts, len(known.groups[0]))
            state.first(x, known)
            yield _state_batch(batch, x, state)

    return written(vectors.mapInArrow(run, _with_label(_STATE, vectors.schema["label"].dataType)), "codes")


def _state_batch(batch: pa.RecordBatch, x: np.ndarray, state: Bounds) -> pa.RecordBatch:
    fields = {name: _binary(getattr(state, name)) for name, _ in Bounds.FIELDS}
    columns = {"vec_id": batch.column("vec_id"), "vector": _binary(x.reshape(len(x), -1).astype("<i4"))} | fields | {"rescans": pa.array(state.rescans), "label": batch.column("label")}
    return pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def _read_state(batch: pa.RecordBatch, parts: int, groups: int) -> tuple[np.ndarray, Bounds]:
    n = batch.num_rows
    x = _bytes(batch.column("vector")).view("<i4").reshape(n, parts, -1).astype(np.int64)
    state = Bounds(n, parts, groups, {name: _bytes(batch.column(name)) for name, _ in Bounds.FIELDS})
    state.rescans = batch.column("rescans").to_numpy().copy()
    return x, state


def assign_again(state: DataFrame, known: Codebooks, parts: int, final: bool) -> DataFrame:
    """The state of the next round, or at last ``(vec_id, code, error, rescans, label)``."""
    shared = state.sparkSession.sparkContext.broadcast(known.books)

    def run(batches):
        known = Codebooks(shared.value)
        for batch in _slices(batches):
            x, bounds = _read_state(batch, parts, len(known.groups[0]))
            bounds.again(x, known)
            if not final:
                yield _state_batch(batch, x, bounds)
                continue
            columns = {"vec_id": batch.column("vec_id"), "code": pa.array([c.tobytes().hex() for c in bounds.code]), "error": pa.array(bounds.errors(x, known.books[-1])), "rescans": pa.array(bounds.rescans), "label": batch.column("label")}
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    ddl = "vec_id long, code string, error long, rescans int" if final else _STATE
    return written(state.mapInArrow(run, _with_label(ddl, state.schema["label"].dataType)), "codes")


def next_codebook(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """Each entry's floor of the mean of its parts; sums by task, then by (part, entry, component)."""
    parts, entries, size = book.shape

    def run(batches):
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, size), np.int64)
        for batch in _slices(batches):
            x = _bytes(batch.column("vector")).view("<i4").reshape(batch.num_rows, parts, size).astype(np.int64)
            code = _bytes(batch.column("code")).reshape(batch.num_rows, parts).astype(np.int64) + np.arange(parts) * entries
            counts += np.bincount(code.reshape(-1), minlength=len(counts))
            np.add.at(sums, code.reshape(-1), x.reshape(-1, size))
        used = np.flatnonzero(counts)
        cell = (used[:, None] * size + np.arange(size)).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.repeat(counts[used], size)), pa.array(sums[used].reshape(-1))], ["cell", "n", "total"])

    dealt = state.select("vector", "code").mapInArrow(run, "cell long, n long, total long")
    found = dealt.groupBy("cell").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    new = book.copy().reshape(-1)
    for r in found:  # at most entries x width
        new[r["cell"]] = int(r["total"]) // r["n"]
    return new.reshape(book.shape)


def encode_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, code, error, rescans)`` and the last codebooks (parts, entries, width of a part).

    ``code`` holds two hex digits for each part, ``error`` the squared distances to the codes' entries
    and ``rescans`` how many (part, round) the bounds could not settle.
    """
    if not 0 < entries <= 256 or not 0 <= rounds < 256:
        raise ValueError("an index and a round have to fit a byte")
    vectors = scaled_vectors(rows, id_col, vector_col, label_col, scale)
    longest = vectors.agg(F.max(F.size("ints"))).first()[0]
    if longest is None:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).alias("rescans")), np.zeros((parts, 0, 0), np.int64)
    width = parts * max(1, -(-longest // parts))
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.zeros((len(seeds), width), dtype=np.int64)
    for row, seed in zip(start, seeds, strict=True):
        row[: len(seed["ints"])] = seed["ints"]
    books = [start.reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()]
    state = assign_first(vectors, Codebooks(books), parts, width)
    for _ in range(rounds):
        books.append(next_codebook(state, books[-1]))
        old, state = state, assign_again(state, Codebooks(books), parts, len(books) > rounds)
        discard(old)
    return (state if rounds else assign_again(state, Codebooks(books), parts, True)), books[-1]


def codebook_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (a written table) with ``label_error``, the errors summed over equal labels."""
    sums = small_side(written(coded.groupBy(F.col("label").alias("its")).agg(F.sum("error").alias("label_error")), "sums"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("its")), "left").drop("its")


#: DuckDB, for tables of 64 vectors or more with distinct ids and one width.
CODES_SQL = """
WITH RECURSIVE kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comp AS (
  SELECT vec_id, (i - 1) // (len(embedding) // 16) AS part, (i - 1) % (len(embedding) // 16) AS pos, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), v AS (SELECT vec_id, part, list(x ORDER BY pos) AS xs FROM comp GROUP BY ALL),
c0 AS (
  SELECT part, entry, xs FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64) USING (vec_id)
), {round0}, {round1}, {last}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256
FROM (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id) JOIN kept USING (vec_id)
"""
_ASSIGN_SQL = """a{t} AS (
  SELECT vec_id, part, min(CAST(d AS HUGEINT) * 256 + entry) // 256 AS d, CAST(min(CAST(d AS HUGEINT) * 256 + entry) % 256 AS INT) AS entry
  FROM (SELECT vec_id, part, entry, list_sum(list_transform(list_zip(v.xs, c.xs), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v JOIN c{t} AS c USING (part)) GROUP BY vec_id, part
)"""
_MEAN_SQL = """m{t} AS (
  SELECT part, entry, list(x ORDER BY pos) AS xs FROM (SELECT part, entry, pos, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{t} JOIN comp USING (vec_id, part) GROUP BY ALL) GROUP BY ALL
), c{n} AS (SELECT part, entry, coalesce(m{t}.xs, c{t}.xs) AS xs FROM c{t} LEFT JOIN m{t} USING (part, entry))"""
CODES_SQL = CODES_SQL.format(**{f"round{t}": _ASSIGN_SQL.format(t=t) + ", " + _MEAN_SQL.format(t=t, n=t + 1) for t in (0, 1)}, last=_ASSIGN_SQL.format(t=2))
