"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

A line is a ``\\n``-separated piece of a text with at least one word; its set holds the ``CHARS``
characters (UTF-16 units) that start at each position, blanks included; a shorter line is its own set.
Lines whose sets have a Jaccard similarity of ``percent`` / 100 or more are linked, and each connected
component of lines keeps one occurrence in the whole corpus: the first one in the document with the
smallest id.

Signatures are MinHash with one permutation: every shingle of the whole line is hashed once, falls into
one of ``BANDS`` x ``ROWS`` bins, and each bin keeps its least hash. Only hashes that can be minima are
looked at further: the least ``SAMPLE`` of a line's on average. A line with fewer shingles hashes them
under more seeds, so that its bins fill as well; one that repeats itself without blanks fills fewer and
is found less surely. Lines that agree in all bins of a band are candidates;
pairs that share no band are not found. Of the candidates, those whose similarity, estimated from
bitmaps of the same hashes, is ``SLACK`` below the threshold go, and the sets of the others are compared exactly, as 32-bit
hashes of their shingles. Equal lines always meet: a line is known by 64 bits of one hash and 32 of
another; lines of which only the first hash is equal stay as they are.

Null and empty texts have no lines; wordless lines stay; rows with the same id count as one document,
rows with a null id stay as they are and are not compared; ties go to the earlier line; an empty table
gives an empty one; other columns pass through :func:`dedup_lines` untouched, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import discard, shuffle_partitions, small_side, written
from .components import link_hubs

BANDS, ROWS, SAMPLE, CHARS = 20, 5, 200, 5
#: Words of the bitmap, its bits, and by how much of a hundred the similarity estimated from it may fall short.
WORDS, SLACK = 10, 10
BITS = 64 * WORDS
#: Items of a hub that one task compares with as many others, on average.
BLOCK = 1000


def text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, pos, line, item, check)`` for every line with a word; ``item`` and ``check`` are the line's hashes."""
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line")).where("doc_id is not null")
    return lines.where(F.ltrim("line", F.lit(" \t\x0b\x0c\r")) != "").withColumns({"item": F.xxhash64("line"), "check": F.hash("line")})


def _units(lines: DataFrame, *others: str) -> DataFrame:
    """``(item, units, n)``: a line's UTF-16 units in two bytes each, and the number of its shingles."""
    return lines.select("item", *others, F.encode("line", "UTF-16BE").alias("units")).withColumn("n", F.expr(f"greatest(shiftright(length(units), 1) - {CHARS - 1}, 1)"))


def line_signatures(lines: DataFrame) -> DataFrame:
    """``(item, n, band, bits, bucket)`` of the lines of ``(item, line)``, each item once, by band: about how many shingles, and a bitmap of those that the band comes from."""
    # a line that repeats its words has as many times fewer distinct shingles
    words = lines.withColumn("words", F.split("line", "[ \t]+"))
    fewer = F.expr("cast(greatest(cast(n as double) * size(array_distinct(words)) / size(words), 1) as int)")
    seeded = _units(words, "words").withColumn("fewer", fewer).drop("words").withColumn("seed", F.explode(F.expr(f"sequence(0, cast({SAMPLE} div fewer as int))")))
    # of the seed's hashes, those below the limit are looked at: SAMPLE of a line over all its seeds
    limited = seeded.withColumn("most", F.expr(f"cast(least(1D, {SAMPLE} / fewer - seed) * {2**31 - 1} as int)"))
    hashed = limited.withColumn("at", F.explode(F.expr("sequence(1, 2 * n - 1, 2)"))).selectExpr("item", "fewer", "most", f"hash(substring(units, at, {2 * CHARS}), seed) & {2**31 - 1} as h").where("h < most")
    row = f"h div {BANDS} % {ROWS}"
    # an empty bin stands at a number that no hash reaches
    least = [F.min(F.expr(f"if({row} = {i}, h, {2**31 - 1})")).alias(f"m{i}") for i in range(ROWS)]
    bits = F.expr(f"bit_or(shiftleft(1L, cast(h div {BANDS * ROWS} % 64 as int)))").alias("bits")
    minima = hashed.groupBy("item", F.col("fewer").alias("n"), F.expr(f"h % {BANDS}").alias("band")).agg(*least, bits)
    # 48 bits tell 30 GB of buckets apart but for some ten thousand pairs, which are compared like all others
    bucket = F.xxhash64("band", *(f"m{i}" for i in range(ROWS))).bitwiseAND(F.lit(2**48 - 1))
    return minima.select("item", "n", "band", "bits", bucket.alias("bucket"))


def line_sets(lines: DataFrame) -> DataFrame:
    """``(item, s)``: the distinct 32-bit hashes of each line's shingles."""
    # the units are named once as u: a column would be copied out of its row again for each shingle
    hashes = f"transform(array(units), u -> array_distinct(transform(sequence(1, 2 * n - 1, 2), i -> hash(substring(u, i, {2 * CHARS})))))[0] as s"
    return _units(lines).selectExpr("item", hashes)


def _same(one: DataFrame, two: DataFrame, key: list[str]) -> Column:
    return reduce(and_, (one[k] == two[k] for k in key))


def near_groups(seen: DataFrame, texts, percent: int) -> DataFrame:
    """``(item, component)`` of the lines of ``(item, line)`` that are linked with another one; ``texts(items)`` gives a few of them again."""
    signed = written(line_signatures(seen), "signatures")
    bits = [f"w{i}" for i in range(WORDS)]
    words = ["n", "marks", *bits]
    maps = signed.groupBy("item").agg(F.max("n").alias("n"), *(F.expr(f"bit_or(if(band % {WORDS} = {i}, bits, 0L))").alias(w) for i, w in enumerate(bits)))
    # how many hashes set so many of the bits, when some fell on the same one
    count = lambda taken: f"(-{BITS} * ln(1 - least({taken}, {BITS - 1}) / {BITS}))"
    marked = maps.select("item", "n", F.expr(count(" + ".join(f"bit_count({w})" for w in bits))).alias("marks"), *bits)
    # buckets of one item go; each (item, bucket) is dealt once, and a large bucket's window spills
    met = signed.select("item", "bucket").withColumn("mates", F.count(F.lit(1)).over(W.partitionBy("bucket"))).where("mates > 1")
    postings, bitmaps, verified = written(met, "met"), written(marked, "bitmaps"), []
    discard(signed)
    # of lines of unlike lengths, the longer one has the smaller share of its hashes, and so has what they share
    either = " + ".join(f"bit_count({w}_a | {w}_b)" for w in bits)
    shared = f"(marks_a + marks_b - {count(either)}) * greatest(n_a, n_b)"
    fits = f"{100 + percent - SLACK} * {shared} >= {percent - SLACK} * (marks_a * n_a + marks_b * n_b)"
    alike = F.expr(f"{100 + percent}L * size(array_intersect(s_a, s_b)) >= {percent}L * (size(s_a) + size(s_b))")

    def verify(pairs: DataFrame) -> DataFrame:
        discard(*verified)  # the links of the round before are written
        pairs = written(pairs, "pairs")
        items = pairs.select(F.col("a").alias("item")).unionAll(pairs.select(F.col("b").alias("item"))).distinct()
        sets = written(line_sets(texts(items).repartition(shuffle_partitions(pairs.sparkSession), "item")), "sets")
        verified[:] = [pairs, sets]
        return pairs.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b").where(alike).select("a", "b")

    def named(k: str) -> DataFrame:
        return bitmaps.select(*(F.col(c).alias(f"{c}_{k}") for c in ("item", *words)))

    def starred(pairs: DataFrame) -> DataFrame:
        """Of an item and its hub, few pairs for each item: bitmaps are fetched for the pairs, not for the postings."""
        met = pairs.select(F.col("a").alias("item_a"), F.col("b").alias("item_b")).join(named("a"), "item_a").join(named("b"), "item_b").where(fits)
        return verify(met.select(F.col("item_a").alias("a"), F.col("item_b").alias("b")))

    def cross(posted: DataFrame) -> DataFrame:
        """Of the buckets that are still mixed: many pairs, so that they are compared inside a join and only links leave it."""
        discard(*verified)
        # items of a bucket have its hub in common; a hub's items are dealt in blocks, each against each
        members = posted.select("hub", "item", "component").distinct()
        members = members.withColumn("blocks", F.expr(f"cast(count(*) over (partition by hub) div {BLOCK} + 1 as int)"))
        members = written(members.withColumn("block", F.expr("cast(pmod(item, blocks) as int)")).join(bitmaps, "item"), "members")

        def sides(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
            every = "explode(sequence(0, blocks - 1))"
            keys = {"a": ["hub", "block as i", f"{every} as j"], "b": ["hub", f"{every} as i", "block as j"]}
            return tuple(rows.selectExpr(*keys[k], *(f"{c} as {c}_{k}" for c in ("item", "component", *words, *columns))) for k in "ab")

        key = ["hub", "i", "j"]
        one, two = sides(members)
        met = one.join(two, (F.expr("item_a <> item_b and component_a <> component_b") & F.expr(fits)) & _same(one, two, key), "left_semi")
        near = written(met.select("hub", F.col("item_a").alias("item")).distinct(), "near")
        sets = written(line_sets(texts(near.select("item").distinct()).repartition(shuffle_partitions(posted.sparkSession), "item")), "sets")
        verified[:] = [members, near, sets]
        one, two = sides(members.join(near, ["hub", "item"], "left_semi").join(sets, "item"), "s")
        links = one.join(two, (F.expr("item_a < item_b and component_a <> component_b") & F.expr(fits) & alike) & _same(one, two, key))
        return links.select(F.col("item_a").alias("a"), F.col("item_b").alias("b")).distinct()

    groups = link_hubs(postings, starred, cross, "lines").withColumnRenamed("node", "item")
    discard(postings, bitmaps, *verified)
    return groups


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``(doc_id, removed)``: the positions (from 0) of the lines to remove, for documents that lose any."""
    lines = text_lines(docs, id_col, text_col)
    placed = written(lines.select("doc_id", "pos", "item", "check"), "lines")
    seen = placed.groupBy("item").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("times"), F.min("check").alias("lo"), F.max("check").alias("hi"))

    def texts(items: DataFrame) -> DataFrame:
        """A line of each item, from the first document that has it."""
        first = placed.join(small_side(written(items, "near")), "item", "left_semi").groupBy("item").agg(F.min(F.struct("doc_id", "pos")).alias("at"))
        places = written(first.select("item", "at.*"), "places")
        homes = small_side(written(places.select(F.col("doc_id").alias("__home")).distinct(), "homes"))
        there = text_lines(docs.join(homes, docs[id_col].cast("long") == F.col("__home"), "left_semi"), id_col, text_col).select("doc_id", "pos", "item", "line")
        return there.join(small_side(places), ["item", "doc_id", "pos"], "left_semi").groupBy("item").agg(F.first("line").alias("line"))

    groups = near_groups(lines.groupBy("item").agg(F.first("line").alias("line")), texts, percent)
    member = seen.where("lo = hi").join(groups, "item", "left").withColumn("component", F.coalesce("component", "item"))
    keepers = member.groupBy("component").agg(F.min("first_doc").alias("keeper"), F.sum("times").alias("times")).where("times > 1")
    known = member.join(keepers.select("component", "keeper"), "component").select("item", "component", "keeper")
    found = written(placed.join(small_side(written(known, "known")), "item").select("doc_id", "pos", "component", "keeper"), "found")
    stays = found.where("doc_id = keeper").groupBy("doc_id", "component").agg(F.min("pos").alias("pos"))
    gone = found.select("doc_id", "pos").join(stays.select("doc_id", "pos"), ["doc_id", "pos"], "left_anti")
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with the removed lines taken out of the text, and the columns ``n_lines`` and ``n_removed``."""
    gone = small_side(written(removed_lines(docs, id_col, text_col, percent), "removed"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    both = docs.select(row, F.split(F.col(text_col), "\n", -1).alias("lines"), F.col(id_col).cast("long").alias("id")).join(gone, F.col("id") == F.col("doc_id"), "left")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed")), lambda i: F.get("lines", i))
    text = F.when(F.col("removed").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join(left, "\n")).alias(text_col)
    counts = {"n_lines": F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("long"), "n_removed": F.coalesce(F.size("removed"), F.lit(0)).cast("long")}
    kept = [text if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in counts]
    return both.select(*kept, *(v.alias(k) for k, v in counts.items()))
