"""Benchmark decontamination on a distributed positional inverted index.

Words are what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds after A-Z are lower-cased. An item's
windows are its runs of ``window`` words (all of them, where it has fewer). Steps, for a block of
items of bounded size at a time:

1. Count, over all documents, how often each word of the items occurs.
2. Each window names its ``TERMS`` rarest places. Postings (term, document, positions) of the terms
   so named are written to the shared folder: the index.
3. For each window the list of its rarest term, moved by the term's place in the item, is
   intersected with those of the next rarest (:func:`phrase_candidates`). What is left are places
   where the item may begin; the documents' words are then compared with the item's, word by word.

:func:`proximity_matches` asks the same index for documents in which an item's rarest terms stand
near each other. Null and empty texts have no words; an item without words has no window; repeated
rows get equal results, ties between equally rare words go to the earlier place; a null item id counts as
the item ``null``; no documents or no items give no hits; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, as_bytes, steps, word_hashes, written

#: Rarest places that each window names.
TERMS = 3
#: Words of the items that are searched for at a time; this bounds what is broadcast.
BLOCK_WORDS = 1_000_000
#: Candidate lists that a join may broadcast: rows, and numbers in them (8 bytes each); more are shuffled.
SMALL_ROWS, SMALL_NUMBERS = 50_000, 4_000_000


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Blocks of ``(item ids, their words)`` with about ``BLOCK_WORDS`` words each."""
    picked = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = picked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(chars) // (4 * BLOCK_WORDS)
    for b in range(blocks):
        rows = picked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        words, bounds = word_hashes([r["text"].encode() for r in rows], alnum_words()) if rows else (np.empty(0, np.uint64), np.zeros(1, np.int64))
        found = [(r["item"], words[a:z]) for r, a, z in zip(rows, bounds[:-1], bounds[1:], strict=True) if z > a]
        if found:
            yield [i for i, _ in found], [w for _, w in found]


def _known(words: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that the sorted vocabulary has, and their numbers in it."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    place = np.flatnonzero(vocabulary[at] == words)
    return place, at[place]


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the vocabulary occurs in ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in steps(batches):
            words, _ = word_hashes(as_bytes(batch.column(0)), alnum_words())
            total += np.bincount(_known(words, shared.value)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(vocabulary), dtype=np.int64)
    out[rows["term"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def positional_index(docs: DataFrame, vocabulary: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """``(term, doc_id, positions)``: the written postings of the wanted numbers of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, wanted))

    def run(batches):
        known, want = shared.value
        keep = np.zeros(len(known), dtype=bool)
        keep[want] = True
        for batch in steps(batches):
            words, bounds = word_hashes(as_bytes(batch.column(1)), alnum_words())
            place, term = _known(words, known)
            place, term = place[keep[term]], term[keep[term]]
            doc = np.searchsorted(bounds, place, side="right") - 1
            order = np.lexsort((place, doc, term))
            place, term, doc = place[order], term[order], doc[order]
            if not len(term):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(term) != 0) | (np.diff(doc) != 0)]))
            positions = pa.ListArray.from_arrays(pa.array(np.concatenate([starts, [len(term)]]).astype(np.int32)), pa.array((place - bounds[doc]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(term[starts]), batch.column(0).take(pa.array(doc[starts])), positions], ["term", "doc_id", "positions"])

    return written(docs.select("doc_id", "text").mapInArrow(run, "term long, doc_id long, positions array<int>"), "index")


def rarest_places(terms: np.ndarray, counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """The distinct ``TERMS`` rarest places, rarest first, of the windows of an item."""
    rarity = counts[terms]
    width = min(window, len(terms))
    found = set()
    for start in range(len(terms) - width + 1):
        order = np.lexsort((np.arange(width), rarity[start : start + width])) + start
        found.add(tuple(order[:TERMS].tolist()))
    return sorted(found)


def phrase_candidates(index: DataFrame, probes: DataFrame) -> DataFrame:
    """``(doc_id, item, begin)``: where an item may begin, from probes ``(item, terms, places)``, rarest first."""

    def begins(i: int):
        return F.transform("positions", lambda p: p - F.col("places")[i])

    posted = index.select("term", "doc_id", "positions")
    found = probes.withColumn("term", F.col("terms")[0]).join(posted, "term").select("item", "terms", "places", "doc_id", begins(0).alias("begins"))
    for i in range(1, TERMS):
        more = F.size("terms") > i
        nxt = posted.withColumnsRenamed({"term": "t", "doc_id": "d"})
        met = found.where(more).join(nxt, (F.col("terms")[i] == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")))
        met = met.withColumn("begins", F.array_intersect("begins", begins(i))).where(F.size("begins") > 0)
        found = met.select(*found.columns).unionAll(found.where(~more))
    return found.select("doc_id", "item", F.explode("begins").alias("begin")).distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", terms: int = 2, slop: int = 10) -> DataFrame:
    """``(item_id, doc_id, begin)``: places where the item's rarest words lie within ``slop`` words of the rarest one.

    Of an item's words those count that occur in the corpus; ties go to the earlier word, an item without any is not found.
    """
    picked, out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), None
    spark = docs.sparkSession
    for names, words in item_blocks(items, item_id, item_text):
        vocabulary = np.unique(np.concatenate(words))
        counts = term_counts(picked, vocabulary)
        # words that occur nowhere in the corpus say nothing; equally rare ones go by their first place in the item
        rare = [sorted((t for t in dict.fromkeys(np.searchsorted(vocabulary, w).tolist()) if counts[t]), key=lambda t: counts[t])[:terms] for w in words]
        names, rare = [n for n, r in zip(names, rare, strict=True) if r], [r for r in rare if r]
        if not rare:
            continue
        index = positional_index(picked, vocabulary, np.unique(np.concatenate(rare)))
        asked = spark.createDataFrame([(n, r) for n, r in zip(names, rare, strict=True)], "item_id string, terms array<long>")
        found = asked.withColumn("term", F.col("terms")[0]).join(index, "term").select("item_id", "terms", "doc_id", "positions")
        for i in range(1, terms):
            more = F.size("terms") > i
            nxt = index.select(F.col("term").alias("t"), F.col("doc_id").alias("d"), F.col("positions").alias("other"))
            met = found.where(more).join(nxt, (F.col("terms")[i] == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")))
            met = met.withColumn("positions", F.filter("positions", lambda p: F.exists("other", lambda q: F.abs(p - q) <= slop))).where(F.size("positions") > 0)
            found = met.select(*found.columns).unionAll(found.where(~more))
        found = found.select("item_id", "doc_id", F.explode("positions").alias("begin"))
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], "item_id string, doc_id long, begin int")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items)`` for every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    candidates = None
    for names, words in item_blocks(items, item_id, item_text):
        vocabulary = np.unique(np.concatenate(words))
        counts = term_counts(docs, vocabulary)
        probes = []
        for number, own in enumerate(words):
            terms = np.searchsorted(vocabulary, own)
            probes += [(number, [int(terms[p]) for p in places], list(places)) for places in rarest_places(terms, counts, window)]
        index = positional_index(docs, vocabulary, np.unique([t for _, ts, _ in probes for t in ts]))
        found = phrase_candidates(index, spark.createDataFrame(probes, "item int, terms array<long>, places array<int>"))
        known = spark.createDataFrame([(i, n, w.view(np.int64).tolist()) for i, (n, w) in enumerate(zip(names, words, strict=True))], "item int, name string, words array<long>")
        found = found.groupBy("doc_id", "item").agg(F.collect_list("begin").alias("begins")).join(F.broadcast(known), "item")  # a block of items is bounded
        found = found.groupBy("doc_id").agg(F.collect_list(F.struct("name", "words", "begins")).alias("at"))
        candidates = found if candidates is None else candidates.unionAll(found)
    if candidates is None:
        candidates = spark.createDataFrame([], "doc_id long, at array<struct<name:string,words:array<bigint>,begins:array<int>>>")
    candidates = written(candidates.groupBy("doc_id").agg(F.flatten(F.collect_list("at")).alias("at")), "candidates")
    held = F.aggregate("at", F.lit(0), lambda n, x: n + F.size(x["words"]) + F.size(x["begins"]))
    rows, numbers = candidates.agg(F.count(F.lit(1)), F.coalesce(F.sum(held), F.lit(0))).first()
    small = rows <= SMALL_ROWS and numbers <= SMALL_NUMBERS
    candidates = candidates.withColumnRenamed("doc_id", "d")
    joined = docs.join(F.broadcast(candidates) if small else candidates, F.col("doc_id").eqNullSafe(F.col("d")), "left").select("doc_id", "text", "at")

    def judge(batches):
        for batch in steps(batches):
            words, bounds = word_hashes(as_bytes(batch.column(1)), alnum_words())
            rows = []
            for doc, at, a, z in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own, hit, names = words[a:z], np.zeros(z - a, dtype=bool), set()
                for place in at or ():
                    item = np.array(place["words"], dtype=np.int64).view(np.uint64)
                    width = min(window, len(item))
                    for begin in place["begins"]:
                        lo, hi = max(0, -begin), min(len(item), len(own) - begin)
                        same = np.concatenate([[0], np.cumsum(item[lo:hi] == own[begin + lo : begin + hi])])
                        full = np.flatnonzero(same[width:] - same[:-width] == width) + begin + lo
                        for i in range(width):
                            hit[full + i] = True
                        if len(full):
                            names.add(place["name"])
                found, n_hit = sorted(names), int(hit.sum())
                rows.append({"doc_id": doc, "n_words": z - a, "n_hit": n_hit, "n_items": len(found), "items_sha256": hashlib.sha256(",".join(found).encode()).hexdigest(), "contaminated": n_hit > 0, "items": found})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string()))])
    return joined.mapInArrow(judge, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>")
