"""Quality rules as a ledger of failure bits, with DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are versions of "which bits count, and how many of them are forgiven", and are applied
to the ledger without reading a text again. Ablations count what each rule alone decides, from the
ledger's bit patterns and their numbers.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Null texts have no words and no lines; all counts are of
whole texts; there is no shuffle, so that hot keys and repeated rows do not matter; other columns
stay as they are, and a column with the name of a measurement is replaced; an empty table gives an empty
ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: bit, name, condition under which a document fails
RULES = [
    (0, "few_words", "n_words < 50"),
    (1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    (2, "short_words", "word_chars < 3 * n_words"),
    (3, "long_words", "word_chars > 10 * n_words"),
    (4, "symbols", "10 * n_symbols > n_words"),
    (5, "repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    (6, "upper_case", "2 * n_upper > word_chars"),
]
BASE = 0b11
#: version: (bits that count, failures forgiven)
POLICIES = {"base": (BASE, 0), "v1": (0b0011111, 0), "v2": (0b1111111, 0)}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: equal windows are neighbours once sorted."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.struct(F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("t"), i.alias("i")))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["t"] == x["t"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(F.sort_array(windows), lambda s: _let(repeated(s), covered)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements ``n_words .. n_upper``, all long and not null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    line_counts = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    measured = docs.withColumns(
        {
            "__words": counts,
            "__lines": line_counts,
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
        }
    )
    parts = {name: F.col(f"{of}.{name}").cast("long") for of, names in (("__words", ("n_words", "n_repeat_words")), ("__lines", ("n_lines", "n_dup_lines"))) for name in names}
    return measured.withColumns(parts).drop("__words", "__lines")


def ledger(docs: DataFrame, text_col: str = "text", rules=tuple(RULES)) -> DataFrame:
    """``docs`` with measurements and ``failed``, the bits of the rules that a document fails."""
    bits = sum((F.when(F.expr(condition), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")) for bit, _, condition in rules), F.lit(0).cast("long"))
    return measure(docs, text_col).withColumn("failed", bits)


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=tuple(RULES)) -> DataFrame:
    """The ledger without the texts, written to the shared folder: policies and ablations read it, not the texts."""
    kept = [id_col, "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words", "failed"]
    return written(ledger(docs, text_col, rules).select(*kept), "ledger")


def passes(policy: str | tuple[int, int]) -> Column:
    """Whether a ledger row passes a policy."""
    mask, forgiven = POLICIES[policy] if isinstance(policy, str) else policy
    return F.bit_count(F.col("failed").bitwiseAND(F.lit(mask).cast("long"))) <= forgiven


def ablations(kept: DataFrame, policy: str | tuple[int, int], rules=tuple(RULES)) -> DataFrame:
    """``(rule, n_failed, n_only)`` of a ledger: failures, and documents that would pass without the rule."""
    mask, forgiven = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = kept.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit")) for bit, name, _ in rules if mask >> bit & 1))
    one = patterns.select("bits", "n", F.inline(each))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    only = fails & (F.bit_count("bits") > forgiven) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("bit"))) <= forgiven)
    return one.groupBy("rule").agg(F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("n_failed"), F.coalesce(F.sum(F.when(only, F.col("n"))), F.lit(0)).alias("n_only"))


LEDGER_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents),
tri AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n
  FROM (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2))),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE n > 1) GROUP BY r),
m AS (
  SELECT d.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_upper
  FROM d LEFT JOIN rep ON d.r = rep.r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (word_chars < 3 * n_words)::INT + 8 * (word_chars > 10 * n_words)::INT
        + 16 * (10 * n_symbols > n_words)::INT + 32 * (100 * n_dup_lines > 40 * n_lines)::INT + 64 * (2 * n_upper > word_chars)::INT)::BIGINT AS failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_symbols > n_words) AS kept_v1,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
            OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines OR 2 * n_upper > word_chars) AS kept
FROM m
"""

#: Failures of each rule, and documents that pass policy v2 without it.
ABLATION_SQL = "WITH q AS (" + LEDGER_SQL + "), r(rule, bit) AS (VALUES " + ", ".join(f"('{name}', {1 << bit})" for bit, name, _ in RULES) + """)
SELECT rule, count(*) FILTER (failed & bit > 0) AS n_failed, count(*) FILTER (failed = bit) AS n_only FROM q, r GROUP BY rule"""
