"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of distinct 5-word shingles is at
least the threshold. Steps:

1. Each document's words are hashed in vectorised steps; its shingle set gets a 64-bit signature,
   and documents with equal sets are one class from then on.
2. Shingles are dealt out by hash. A shingle's document frequency is the number of classes that
   hold it; only shingles of two classes or more travel on, together with their frequency.
3. In each class the shingles are ordered from the rarest (those of one class come first; they
   cannot match). The prefix that must share ``l`` shingles with any partner has
   ``n - ceil(t n) + l`` of them. Each class lengthens its prefix as long as the estimated cost
   (postings read, plus candidates that share ``l`` of them times the cost of a verification) falls.
4. Candidates come from shared prefix shingles, must share ``min(l_a, l_b)`` shingles of the
   ``min(l_a, l_b)``-prefixes, and are verified on their whole shared sets.

Shingles are compared by more than 50 bits of hash (48 bits within one of the hash partitions).
Null or wordless texts have an empty set and link with nothing; fewer than ``n`` words are one
shingle; equal rows and ties give the same class; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, binary_array, list_array, mix, shuffle_partitions, space_words, steps, window_hashes, word_hashes, written
from .components import link_buckets

MAX_MATCHES = 4
#: Items from which on a bucket is crowded: its pairs are then told apart before they are counted.
CROWD = 16


def _sets(texts: list[bytes], n: int):
    """Sorted distinct shingle hashes of each text."""
    words, bounds = word_hashes(texts, space_words())
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = words[a:b]
        yield np.unique(window_hashes(own, n) if len(own) >= n else window_hashes(own, len(own)) if len(own) else own)


def _signature(shingles: np.ndarray) -> int:
    if not len(shingles):
        return 0
    total = int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + len(shingles)
    return int(mix(np.array([total & (2**64 - 1)], dtype=np.uint64)).view(np.int64)[0])


def shingle_classes(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(doc_id, signature, n_shingles)`` for every row."""

    def run(batches):
        for batch in steps(batches):
            sets = list(_sets(as_bytes(batch.column(1)), n))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_signature(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())], ["doc_id", "signature", "n_shingles"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, signature long, n_shingles long")


def shared_shingles(docs: DataFrame, text_col: str, n: int, partitions: int) -> DataFrame:
    """``(signature, shingles, frequencies)``: the shingles of each class that another class has too."""

    def deal(batches):
        for batch in steps(batches):
            seen: dict[int, np.ndarray] = {}
            for s in _sets(as_bytes(batch.column(0)), n):
                if len(s):
                    seen[_signature(s)] = s
            if not seen:
                continue
            owner = np.repeat(np.arange(len(seen)), [len(s) for s in seen.values()])
            tokens, signatures = np.concatenate(list(seen.values())), np.fromiter(seen, dtype=np.int64)
            part = ((tokens >> np.uint64(32)) % np.uint64(partitions)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, owner, tokens = part[order], owner[order], tokens[order]
            runs = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (np.diff(owner) != 0)]))
            counts = np.diff(np.concatenate([runs, [len(part)]]))
            cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(part) != 0])), [len(part)]])
            run_cuts = np.searchsorted(runs, cuts)
            packed = tokens.view(np.uint8).reshape(-1, 8)[:, :6]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts[:-1]].astype(np.int32)), list_array(signatures[owner[runs]], run_cuts), list_array(counts.astype(np.int32), run_cuts), binary_array(packed.reshape(-1), cuts * 6)],
                ["part", "signatures", "counts", "tokens"],
            )

    def match(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        signatures, counts = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("signatures", "counts"))
        raw = np.frombuffer(b"".join(table.column("tokens").to_pylist()), dtype=np.uint8).reshape(-1, 6)
        tokens = np.zeros((len(raw), 8), dtype=np.uint8)
        tokens[:, :6] = raw
        tokens = tokens.view(np.int64).reshape(-1)
        first = np.zeros(len(signatures), dtype=bool)
        first[np.unique(signatures, return_index=True)[1]] = True  # a class counts once, however many copies it has
        owner, keep = np.repeat(np.arange(len(signatures)), counts), np.repeat(first, counts)
        tokens, owner = tokens[keep], owner[keep]
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(tokens) != 0]))
        frequency = np.repeat(lengths := np.diff(np.concatenate([starts, [len(tokens)]])), lengths)
        shared = frequency > 1
        # with the part's number, the 48 bits that came along name the shingle
        named = mix(tokens[shared].view(np.uint64) + np.uint64(part) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        tokens, owner, frequency = named, owner[shared], frequency[shared]
        order = np.argsort(owner, kind="stable")
        tokens, owner, frequency = tokens[order], owner[order], frequency[order]
        cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])), [len(owner)]]) if len(owner) else np.zeros(1, dtype=np.int64)
        return pa.table({"signature": pa.array(signatures[owner[cuts[:-1]]] if len(owner) else np.empty(0, np.int64)), "shingles": list_array(tokens, cuts), "frequencies": list_array(frequency.astype(np.int32), cuts)})

    dealt = docs.select(F.col(text_col).alias("text")).mapInArrow(deal, "part int, signatures array<long>, counts array<int>, tokens binary")
    found = dealt.groupBy("part").applyInArrow(match, "signature long, shingles array<long>, frequencies array<int>")
    return found.groupBy("signature").agg(F.flatten(F.collect_list("shingles")).alias("shingles"), F.flatten(F.collect_list("frequencies")).alias("frequencies"))


def adaptive_prefixes(sets: DataFrame, percent: int, max_matches: int = MAX_MATCHES, verify_cost: float = 20.0) -> DataFrame:
    """``(bucket, item, n, m, matches, place)``: the prefix shingles of each class of ``(signature, n, shingles, frequencies)``.

    ``matches`` is the number that the class chose; ``m`` of its shingles are shared at all, and
    ``place`` is the shingle's among those, from the rarest.
    """

    def run(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for signature, n, tokens, frequencies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, frequencies = np.array(tokens, dtype=np.int64), np.array(frequencies, dtype=np.int64)
                order = np.lexsort((tokens, frequencies))
                tokens, frequencies = tokens[order], frequencies[order]
                need = -(-percent * n // 100)
                level = np.maximum(1, np.arange(n - len(tokens), n) - (n - need) + 1)
                costs = []
                for matches in range(1, min(max_matches, need) + 1):
                    read = int((frequencies[level <= matches] - 1).sum())
                    costs.append(read + verify_cost * (read // matches))
                matches = 1 + int(np.argmin(costs))
                inside = level <= matches
                rows[0].append(tokens[inside])
                rows[5].append(np.flatnonzero(inside))
                for i, x in ((1, signature), (2, n), (3, len(tokens)), (4, matches)):
                    rows[i].append(np.full(int(inside.sum()), x, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in rows], ["bucket", "item", "n", "m", "matches", "place"])

    return sets.select("signature", "n", "shingles", "frequencies").mapInArrow(run, "bucket long, item long, n long, m long, matches long, place long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; see the module's text."""
    spark = docs.sparkSession
    classes = written(shingle_classes(docs, id_col, text_col, n), "classes")
    sizes = classes.where("n_shingles > 0").groupBy("signature").agg(F.min("doc_id").alias("first_doc"), F.min("n_shingles").alias("n"))
    partitions = 2 * shuffle_partitions(spark)
    shared = shared_shingles(docs, text_col, n, partitions).join(sizes.select("signature", "n"), "signature")
    sets = written(shared.where(F.size("shingles") * 100 >= percent * F.col("n")), "sets")
    postings = written(adaptive_prefixes(sets, percent), "postings")

    # two sets need this much overlap, and have at most what both share with any other set
    need = f"{percent} * (n_a + n_b) <= {100 + percent} *"
    sizes_fit = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"

    def verify(pairs: DataFrame) -> DataFrame:
        one, two = (sets.select(F.col("signature").alias(k), F.col("n").alias(f"n{k}"), F.col("shingles").alias(f"s{k}")) for k in "ab")
        both = pairs.join(one, "a").join(two, "b").withColumn("c", F.size(F.array_intersect("sa", "sb")))
        return both.where(F.col("c") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")

    def cross(posted: DataFrame) -> DataFrame:
        # a bucket that items of two components share is open, so the open ones count all their matches
        sizes = posted.groupBy("bucket").agg((F.count(F.lit(1)) >= CROWD).alias("crowded"))
        placed = written(posted.select("bucket", "item", "component", "n", "m", "matches", "place").join(sizes, "bucket"), "open")
        # what both may match before this shingle and from it on; pairs that fail it fail altogether
        bound = f"{need} (least(place_a, place_b) + least(m_a - place_a, m_b - place_b))"

        def met(side: DataFrame, *more: str) -> DataFrame:
            one, two = (side.select("bucket", *(F.col(c).alias(f"{c}_{k}") for c in ("item", "component", "n", "m", "matches", "place", *more))) for k in "ab")
            return one.join(two, "bucket").where("item_a < item_b and component_a <> component_b").where(sizes_fit).where(bound)

        pair = [F.col("item_a").alias("a"), F.col("item_b").alias("b"), F.least("matches_a", "matches_b").alias("least")]
        few = met(placed.where("not crowded")).select(*pair, F.lit(1).alias("shared"))
        # crowded buckets: a pair comes from the first one of those that it shares
        crowds = placed.where("crowded")
        listed = crowds.join(crowds.groupBy("item").agg(F.collect_list("bucket").alias("crowds")), "item")
        both = F.array_intersect("crowds_a", "crowds_b")
        many = met(listed, "crowds").where(F.array_min(both) == F.col("bucket")).select(*pair, F.size(both).alias("shared"))
        counted = few.unionAll(many).groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("least").alias("least"))
        return verify(counted.where("shared >= least").select("a", "b"))

    groups = link_buckets(postings, verify, cross, "ngram", carry=("n", "m"), fits=f"{sizes_fit} and {need} least(m_a, m_b)")
    roots = sizes.join(groups.withColumnRenamed("node", "signature"), "signature", "left").withColumn("component", F.coalesce("component", "signature"))
    first = roots.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    known = roots.join(first, "component").select("signature", "component_id")
    return classes.join(known, "signature", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
