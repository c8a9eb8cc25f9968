"""URL filters: pattern rules indexed by their rarest literal token.

Rules are a table: a name, a regular expression over host || path, the literal tokens (runs of ASCII letters and digits)
that every url it fits must hold, a verdict, and whether the rule is listed or one of the method's own.  One pass counts
in how many urls each of those tokens occurs; a rule is filed under its rarest token.  A url's tokens fetch candidate
rules by a join with that index, and only those run their expression.  A rule without any token is filed under the empty
token, which every url holds.

Both sides of the join grow as they like: Spark sends out the index where it is measured to be small, else both sides are
shuffled by token.  A url that many rows share runs its rules once for each row, under the number of its row, so no
url, host or rule is a hot key; tokens that are (com, www) are split by the skew join, and few rules are filed there.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

_TOKEN = r"[A-Za-z0-9]+"
RULE = "rule string, pattern string, tokens array<string>, verdict string, listed boolean"

#: The listed rules (host, path, verdict), in order.
LISTED = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Words of a host, between dots or hyphens, that the method itself blocks where no listed rule fits: a general list
#: of what corpora leave out (adult pages, gambling, drugs, piracy, junk mail).
OWN = (
    "adult", "adults", "bet", "bets", "betting", "blackjack", "casino", "casinos", "cialis", "cracked", "escort", "escorts", "gambling", "hentai", "jackpot", "keygen", "lottery", "milf", "nude",
    "nudes", "payday", "pharmacy", "pill", "pills", "poker", "porn", "porno", "roulette", "sex", "slots", "spam", "torrent", "torrents", "viagra", "warez", "webcam", "xxx",
)


def rule_of(host: str, path: str, verdict: str, listed: bool = True) -> tuple:
    """A row of the rule table that fits the host and its subdomains where the url's path starts with `path`."""
    sure = re.findall(_TOKEN, host) + re.findall(_TOKEN + r"(?![A-Za-z0-9]|$)", path)
    return host + path, rf"(?s)^(?:[^/]*\.)?{re.escape(host + path)}", list(dict.fromkeys(sure)), verdict, listed


def word_rule(word: str, verdict: str = "block") -> tuple:
    """A row for the method's own rules: a word of the host, not its last."""
    return word, rf"(?s)^(?:[^/]*[.-])?{re.escape(word)}[.-][^/]*", list(dict.fromkeys(re.findall(_TOKEN, word))), verdict, False


def rule_table(spark: SparkSession, rows: Iterable[tuple] | None = None) -> DataFrame:
    """Rules as a table; without rows the listed ones and the method's own."""
    rows = [*(rule_of(*r) for r in LISTED), *map(word_rule, OWN)] if rows is None else list(rows)
    return spark.createDataFrame(rows, RULE)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def tokens_of(canonical: Column) -> Column:
    """Distinct tokens, and the empty one."""
    return F.concat(F.array(F.lit("")), F.array_distinct(F.regexp_extract_all(canonical, F.lit(f"({_TOKEN})"), F.lit(1))))


def filed_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules with `token`, the one of theirs that the fewest urls (column canonical) hold; ties to the smaller."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    held = urls.select(F.explode(tokens_of(F.col("canonical"))).alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    each = rules.select("rule", "pattern", "verdict", "listed", F.explode_outer("tokens").alias("token")).join(held, "token", "left")
    rarest = F.min_by(F.coalesce("token", F.lit("")), F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("t")))
    return each.groupBy("rule", "pattern", "verdict", "listed").agg(rarest.alias("token"))


def filter_urls(pages: DataFrame, rules: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule and verdict of every url.

    Returns the id, host, path, rule (the longest listed rule that fits, then the smallest; else null) and verdict (its
    verdict; else that of the longest of the method's own rules that fits, allow if none does).  A null url, or one
    without ://, has an empty host and path.  Repeated rows come back as often as they came; other columns are ignored;
    an empty table, of urls or of rules, is none to worry about.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn("canonical", F.concat("host", "path"))
    urls = materialize(urls.withColumn("row", F.monotonically_increasing_id()), "url-rows")  # the written table keeps the numbers
    filed = materialize(filed_rules(urls, rules), "url-index")
    fetched = urls.select("row", "canonical", F.explode(tokens_of(F.col("canonical"))).alias("token")).join(filed, "token")
    fit = fetched.where(F.rlike("canonical", F.col("pattern")))
    # the longest name wins, then the smallest: among names of one length the least
    by = F.struct((-F.length("rule")).alias("n"), "rule")
    best = lambda listed, what: F.min_by(what, F.when(F.col("listed") == listed, by))
    found = fit.groupBy("row").agg(best(True, "rule").alias("rule"), F.coalesce(best(True, "verdict"), best(False, "verdict")).alias("verdict"))
    return urls.join(found, "row", "left").select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def op5_urlfilter(spark, sf_dir: str) -> DataFrame:
    """Every page's url."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_sql() -> str:
    longest = sorted(LISTED, key=lambda r: -len(r[0] + r[1]))
    rules = "\n".join(f"WHEN ('.' || host) LIKE '%.{h}' AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in longest)
    verdicts = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in LISTED)
    return rf"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages),
b AS (SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (SELECT *, CASE {rules} END AS rule FROM c)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN regexp_matches(host, '(?s)(^|[.-])({"|".join(OWN)})[.-]') THEN 'block' ELSE 'allow' END END AS verdict FROM d
"""
