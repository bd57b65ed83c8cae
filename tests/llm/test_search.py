"""Ranked search against a plain scorer in Python, and against SQL."""

import collections
import math
import random
import re

import duckdb
import pytest

from agroplan.llm import lexical_search, queries

DATA = "/root/testdata/sf0.001"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    words = lambda t: PATTERN.findall((t or "").translate(LOWER))
    counts = [(i, collections.Counter(words(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            score = 0
            for t, times in collections.Counter(words(text)).items():
                if c[t]:
                    m = 100 - 75 + (75 * c.total() * n_docs) // length
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


@pytest.mark.parametrize(("block", "cells"), [(4_000_000, 1 << 20), (300, 7)])
def test_op11_plain(spark, monkeypatch, block, cells):
    monkeypatch.setattr(lexical_search, "BLOCK_CHARS", block)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    draw = random.Random(3)
    word = lambda: draw.choice("rose Lily fern moss OAK elm ash-tree hazel 7up über Éclair x".split())
    docs = [(i, " ".join(word() for _ in range(draw.randrange(1, 60)))) for i in range(150)]
    docs += [(i, docs[5][1]) for i in range(400, 440)]  # ties beyond k
    docs += [(900, None), (901, ""), (902, "!?"), (7, docs[8][1]), (-3, docs[5][1]), (None, docs[5][1]), (903, "rose " * 400_000 + "unique903")]
    items = [(1, docs[5][1]), (2, "ROSE fern, fern"), (3, None), (4, "!!"), (5, "nowhere"), (None, "über moss"), (6, "unique903 éclair Éclair"), (2, "ash tree oak")]
    frame = spark.createDataFrame([(i, t, "x", 5, "y") for i, t in docs], "doc_id long, text string, item string, score long, term string").repartition(5)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in lexical_search.search(frame, asked).collect()]
    known = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=known) == sorted(plain(docs, items, 10), key=known)


def test_op11_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "rose")], "item_id long, text string")
    assert lexical_search.search(docs, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(spark.createDataFrame([(1, "?"), (2, None)], "doc_id long, text string"), items).count() == 0


def test_op11_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    wanted = con.execute(lexical_search.SEARCH_SQL).fetchall()
    got = [tuple(r) for r in queries.op11_lexical_search(spark, DATA).collect()]
    assert sorted(got) == sorted(wanted) and len(wanted) > 100
