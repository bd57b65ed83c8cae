"""Vector codes against a plain k-means in Python integers, and against SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from agroplan.llm import queries, vector_codes

DATA = "/root/testdata/sf0.001"


def plain(rows, parts, entries, rounds, scale):
    """(id, code, error) of each kept row, and the last codebooks, without any bound."""
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = parts * max(1, -(-max(len(v) for _, v in kept) // parts))
    kept = sorted(((i, v + [0] * (width - len(v)), v) for i, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = width // parts
    cut = lambda v: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda v: [min(range(len(b)), key=lambda j: (gap(x, b[j]), j)) for x, b in zip(cut(v), books, strict=True)]
    for _ in range(rounds):
        codes = [assign(v) for _, v, _ in kept]
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), c in zip(kept, codes, strict=True) if c[p] == j]
                if own:
                    books[p] = [*books[p][:j], tuple(sum(x) // len(own) for x in zip(*own, strict=True)), *books[p][j + 1 :]]
    out = [(i, assign(v), v) for i, v, _ in kept]
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return [(i, "".join(f"{j:02x}" for j in c), sum(gap(x, b[j]) for x, b, j in zip(cut(v), books, c, strict=True))) for i, c, v in out], hashlib.sha256(flat.encode()).hexdigest()


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 8, 5), (2, 7, 2), (4, 3, 0), (3, 40, 3)])
def test_op13_plain(spark, parts, entries, rounds):
    draw = random.Random(parts * entries)
    rows = [(i, [draw.choice([0.5, 1.0, 2.0]) * round(draw.gauss(k % 5, 0.4), 2) for k in range(12)]) for i in range(200)]
    rows += [(i, list(rows[3][1])) for i in range(300, 340)]  # a group of copies
    rows += [(-5, [1.0] * 12), (-5, [0.5] * 12), (None, [0.25] * 12), (700, None), (701, [1.0, None] * 6), (702, [float("nan")] * 12), (703, [float("inf")] + [0.0] * 11), (704, []), (705, [1.5] * 5)]
    schema = "vec_id long, embedding array<float>, label int, code string, error long, ints array<int>, its int"
    frame = spark.createDataFrame([(i, v, 1, "x", 2, [3], 4) for i, v in rows], schema).repartition(5)
    coded, book = vector_codes.encode_vectors(frame, parts=parts, entries=entries, rounds=rounds)
    exact = [(r.vec_id, r.embedding) for r in frame.collect()]
    wanted, digest = plain(exact, parts, entries, rounds, 256)
    assert sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=key) == sorted(wanted, key=key)
    assert vector_codes.codebook_digest(book) == digest


def test_op13_bounds_spare_work(spark):
    draw = np.random.default_rng(5)
    centers = draw.normal(size=(16, 8)) * 40
    rows = [(i, [float(x) for x in centers[i % 16] + draw.normal(size=8)], None) for i in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    coded, _ = vector_codes.encode_vectors(frame, parts=2, entries=16, rounds=4)
    assert coded.agg({"rescans": "sum"}).first()[0] < 0.1 * 2000 * 2 * 4
    # the norm of the sum of an entry's steps is no more than the sum of their norms
    books = [draw.integers(-50, 50, size=(2, 6, 3)) for _ in range(5)]
    steps = sum(np.sqrt(((b - a) ** 2).sum(2)) for a, b in zip(books[:-1], books[1:], strict=True))
    assert (vector_codes.Codebooks(books).net[0] <= steps + 1e-9).all()


def test_op13_far_components_and_empty(spark):
    rows = [(1, [3e38, -3e38, 0.0, 1.0], "a"), (2, [1.0, 1.0, 1.0, 1.0], None), (3, [1.0, 1.0, 1.0, 1.0], None)]
    coded, _ = vector_codes.encode_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), parts=2, entries=1, rounds=1)
    out = {r.vec_id: r for r in vector_codes.with_label_errors(coded).collect()}
    assert out[2].label_error == out[3].label_error == 2 * out[2].error and out[1].error > 1 << 50
    none = spark.createDataFrame([], T.StructType.fromDDL("vec_id long, embedding array<float>, label int"))
    coded, book = vector_codes.encode_vectors(none)
    assert vector_codes.with_label_errors(coded).count() == 0 and book.size == 0


def test_op13_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    wanted = con.execute(vector_codes.CODES_SQL).fetchall()
    got = [tuple(r) for r in queries.op13_vector_codes(spark, DATA).collect()]
    assert sorted(got) == sorted(wanted)
