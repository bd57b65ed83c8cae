"""URL filtering by rules that are indexed under their rarest literal token, with DataFrame functions only.

A rule is a host suffix with a path prefix and a verdict, or a bare word that blocks. Its literal
tokens are the runs of letters and digits that any fitting url holds whole; the rule is indexed
under the one that the fewest urls hold. A url's tokens fetch the rules indexed under them, and only
those rules' regular expressions run. A rule without a whole token is fetched by every url.

The rule list is the operator's parameter: up to ``MAX_RULES`` it is broadcast, a longer one is shuffled.
Urls are judged once however often they occur. Null urls and urls without ``://`` have an empty host and
path and are allowed; of equally long rules a blocking one wins; an empty table gives an empty one; other
columns pass through, and columns with the names of results are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
#: (host, path, verdict)
SITE_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
#: words that block where no site rule fits
WORD_RULES = ["ads", "adult", "bets", "casino", "malware", "phishing", "pills", "poker", "porn", "spam", "viagra", "warez"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    """A literal for the JVM's regular expressions."""
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def compiled(site_rules, word_rules) -> list[tuple]:
    """``(rule, verdict, size, regex, tokens)``; word rules have no size and lose against any site rule."""
    out = []
    for host, path, verdict in site_rules:
        ended = re.sub(r"[A-Za-z0-9]+$", "", path)  # a last run of the prefix may go on in the url
        tokens = sorted(set(re.findall(r"[a-z0-9]+", f"{host}{ended if path else ' '}".lower())))
        out.append((host + path, verdict, len(host) + len(path), rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(path) if path else '(?:/|$)'}", tokens))
    out += [(word, "block", -1, rf"(?i)(?:^|[^a-z0-9]){_quoted(word)}(?:[^a-z0-9]|$)", [word.lower()]) for word in word_rules]
    return out


def with_place(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host`` (A-Z lower-cased) and ``path``."""
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url_col), r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), _UPPER, _LOWER), "path": part(2)})


def judge_urls(pages: DataFrame, url_col: str = "url", site_rules=tuple(SITE_RULES), word_rules=tuple(WORD_RULES)) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (of a site, else null), ``word_rule`` and ``verdict``."""
    rules = compiled(site_rules, word_rules)
    small = F.broadcast if len(rules) <= MAX_RULES else lambda part: part  # a longer list is joined by shuffling
    spark = pages.sparkSession
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "id int, rule string, verdict string, size int, regex string, tokens array<string>")
    urls = with_place(pages.select(F.col(url_col).alias("__url")).where(F.col("__url").isNotNull()).distinct(), "__url")
    tokens = F.array_distinct(F.array_append(F.regexp_extract_all(F.lower(F.concat("host", F.lit(" "), "path")), F.lit("[a-z0-9]+"), F.lit(0)), F.lit("")))
    held = urls.select("__url", F.concat("host", "path").alias("target"), F.explode(tokens).alias("token"))
    rule_tokens = table.select("id", F.explode_outer("tokens").alias("token")).fillna("", ["token"])
    counts = held.join(small(rule_tokens.select("token").distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = rule_tokens.join(counts, "token", "left").groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
    index = table.drop("tokens").join(rarest, "id").withColumn("token", F.col("least.token")).drop("least", "id")
    fits = held.join(small(index), "token").where(F.expr("target rlike regex"))
    site = F.when(F.col("size") >= 0, F.struct(F.col("size"), F.col("rule"), F.col("verdict")))
    best = fits.groupBy("__url").agg(F.max_by(site, F.struct("size", F.when(F.col("verdict") == "block", 1).otherwise(0))).alias("site"), F.min(F.when(F.col("size") < 0, F.col("rule"))).alias("word_rule"))
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"), F.col(url_col).alias("url"))
    judged = with_place(rows.join(best, F.col("url") == F.col("__url"), "left"), "url")
    verdict = F.coalesce("site.verdict", F.when(F.col("word_rule").isNotNull(), "block").otherwise("allow"))
    found = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("site.rule"), "word_rule": F.col("word_rule"), "verdict": verdict}
    return judged.select(*(F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in found), *(v.alias(k) for k, v in found.items()))


URL_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM p),
r(rhost, rpath, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
b AS (
  SELECT h.page_id, h.host, h.path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(v, length(rhost || rpath)) AS v
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY h.page_id, h.host, h.path)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(lower(host || path), '(^|[^a-z0-9])(ads|adult|bets|casino|malware|phishing|pills|poker|porn|spam|viagra|warez)([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM b
"""
