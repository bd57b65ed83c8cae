"""Ranked lexical search with the roles reversed: the items are indexed, the documents are streamed.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` after A-Z are
lower-cased, known by their bytes. For a block of items of bounded size at a time:

1. One pass over the texts counts every document's terms. It stores, for each document, its number of
   terms and the counts of those terms that the block's items use (:func:`term_counts`).
2. The stored counts give the corpus figures: documents with a term, all terms, documents of a term.
3. The block's inverted index (term -> items and how often they use it) is broadcast. Each task streams
   its documents' counts through it, adds up scores in 64-bit integers and keeps for each item a heap of
   the ``k`` best so far; a document enters only where it beats the heap's last one.
4. The tasks' heaps are merged: at most ``k`` rows for each item and task, ranked within the item.

The score is an integer form of the usual term-frequency saturation with length normalisation; see
:func:`weight` and :func:`contributions`.

Null and empty texts have no terms and are found by nothing; an item without terms finds nothing. Rows
that share a doc_id are documents of their own, as are rows that share an item_id items of their own (each with ranks
from 1); equal scores go by ascending doc_id, null ids last. Texts are counted in pieces of bounded size.
No documents or no items give no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import alnum_words, discard, release, written

#: Characters of items that are searched for at a time; this bounds what is broadcast.
BLOCK_CHARS = 4_000_000
#: Bytes of a text that are split into terms at a time.
PIECE_BYTES = 1 << 20
#: Documents times items whose scores are added up at a time.
CELLS = 1 << 20
_TO_TERMS = bytes(c if keep else 0x20 for c, keep in enumerate(alnum_words()))
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_TABLE = bytes(_TO_TERMS[_LOWER[c]] for c in range(256))


def terms(text: str | None) -> Counter:
    """Counts of a text's terms."""
    data, counts, at = (text or "").encode().translate(_TABLE), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of ``(item_id, text)`` with about ``BLOCK_CHARS`` characters each."""
    picked = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("text <> ''")
    chars = picked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(chars) // BLOCK_CHARS
    spread = picked.withColumn("block", F.floor(F.rand(0) * blocks)) if blocks > 1 else picked.withColumn("block", F.lit(0))
    stored = written(spread, "items")
    for b in range(blocks):
        yield [(r["item_id"], r["text"]) for r in stored.where(F.col("block") == b).orderBy("item_id", "text").collect()]
    discard(stored)


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, counts)``, written: each document's number of terms and its counts of the vocabulary's."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            sizes, found, counts, ends = [], [], [], [0]
            for text in batch.column(1):
                own = terms(text.as_py())
                sizes.append(own.total())
                hits = known.keys() & own.keys()
                found.extend(known[t] for t in hits)
                counts.extend(own[t] for t in hits)
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])
        release()

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(picked.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>"), "counts")


def corpus_figures(counts: DataFrame, vocabulary: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the number of documents of each of the vocabulary's terms."""

    def run(batches):
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=vocabulary)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    n, length = counts.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(vocabulary, dtype=np.int64)
    for r in counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most the block's terms
        df[r["term"]] = r["df"]
    return n, length, df


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Heaps:
    """For each item, the ``k`` best documents so far, smallest on top; ``floor`` is the least score that may enter."""

    def __init__(self, items: int, k: int):
        self.k, self.best, self.floor = k, [[] for _ in range(items)], np.ones(items, dtype=np.int64)

    def offer(self, ids: list, scores: np.ndarray) -> None:
        """Scores (documents, items) of the documents ``ids``."""
        least = self.floor
        if len(ids) > self.k:  # no more than the k best of these, and their ties
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        rows, columns = np.nonzero(scores >= least)
        for row, item, score in zip(rows.tolist(), columns.tolist(), scores[rows, columns].tolist(), strict=True):
            doc, heap = ids[row], self.best[item]
            entry = (score, doc is not None, -doc if doc is not None else 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[item] = heap[0][0]

    def rows(self):
        return [(item, score, -negated if known else None) for item, heap in enumerate(self.best) for score, known, negated in heap]


def best_of_block(counts: DataFrame, index: tuple[np.ndarray, ...], weights: np.ndarray, figures: tuple[int, int], items: int, k: int) -> DataFrame:
    """``(item, doc_id, score)``: the heaps of all tasks."""
    shared = counts.sparkSession.sparkContext.broadcast((index, weights))
    n_docs, length = figures

    def run(batches):
        (start, item, times), w = shared.value
        heaps, step = Heaps(items, k), max(1, CELLS // items)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                found, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "counts"))
                doc = np.repeat(np.arange(batch.num_rows), batch.column("terms").value_lengths().to_numpy())
                m = np.array([25 + 75 * n * n_docs // length for n in batch.column("n").to_pylist()], dtype=np.int64) if length else np.ones(batch.num_rows, np.int64)
                part = contributions(w[found], tf, m[doc])
                # each posting goes to the items of its term
                width = start[found + 1] - start[found]
                posting = np.repeat(np.arange(len(found)), width)
                place = np.arange(len(posting)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start[found], width)
                scores = np.zeros(batch.num_rows * items, dtype=np.int64)
                np.add.at(scores, doc[posting] * items + item[place], part[posting] * times[place])
                heaps.offer(batch.column("doc_id").to_pylist(), scores.reshape(-1, items))
        rows = heaps.rows()
        columns = [*zip(*rows, strict=True)] if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "score", "doc_id"])
        release()

    return counts.where("size(terms) > 0").mapInArrow(run, "item long, score long, doc_id long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of the highest score above 0 for each item."""
    spark, out = docs.sparkSession, None
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for block in item_blocks(items, item_id, item_text):
        own = [terms(text) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*own)))}
        if not vocabulary:
            continue
        uses = sorted((vocabulary[t], i, n) for i, c in enumerate(own) for t, n in c.items())
        term, item, times = (np.array(x, dtype=np.int64) for x in zip(*uses, strict=True))
        start = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        counts = term_counts(docs, vocabulary)
        n_docs, length, df = corpus_figures(counts, len(vocabulary))
        weights = np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64)
        found = best_of_block(counts, (start, item, times), weights, (n_docs, length), len(block), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item long, item_id {items.schema[item_id].dataType.simpleString()}")
        best = written(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        discard(counts)
        out = best if out is None else out.unionAll(best)
    empty = spark.createDataFrame([], f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long")
    return empty if out is None else out


#: DuckDB; doc_ids are distinct and not null there.
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
), sizes AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, corpus),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY rank <= 10
"""
