"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern string in the usual filter-list notation:

* ``||host/path`` – the host or any of its subdomains, then the path's start;
* ``|`` at either end – the start or end of the address;
* ``*`` – any characters; ``^`` – one separator (not a letter, digit or
  ``_-.%``) or the end; everything else is literal.

It is matched against ``host + path`` (no scheme, query or fragment; host in
lower case).  Every whole literal token of a pattern (a run of ASCII letters
and digits closed on both sides) must occur in an address that matches, so one
of them suffices as index key: the one that occurs in the fewest addresses.  An
address's tokens fetch its candidate rules and only those run their regular
expressions.  Rules without a whole token are candidates for every address.

All of it is joins, aggregates and SQL functions; no Python runs on executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rules the index is marked for broadcasting; beyond, the join
#: shuffles both sides by token.
MAX_BROADCAST_RULES = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``tier`` 0 rules win over tier 1; within a tier the longest pattern wins
    (then the pattern that sorts last).  ``name`` is what a match reports."""

    pattern: str
    verdict: str
    tier: int = 0
    name: str | None = None


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule on a host, its subdomains and the start of the path."""
    return Rule(f"||{host}{path}", verdict, 0, f"{host}{path}")


#: The rules of the registered query (fixed values).
QUERY_RULES = [
    host_rule("org", "/", "allow"),
    host_rule("example.org", "/es/", "block"),
    host_rule("example.org", "/en/1", "block"),
    host_rule("com", "/fr/", "allow"),
    host_rule("com", "/de/", "block"),
]

#: The method's own rules, which decide where none of the above fits.
METHOD_RULES = [
    Rule("spam-farm.", "block", 1),
    Rule("/spam^", "block", 1),
    Rule("||casino.", "block", 1),
    Rule("/casino^", "block", 1),
    Rule("/adult^", "block", 1),
    Rule("||ads.", "block", 1),
    Rule("/doubleclick^", "block", 1),
    Rule("/wp-login.php|", "block", 1),
    Rule("/cgi-bin/", "block", 1),
    Rule(".exe|", "block", 1),
    Rule(".zip|", "block", 1),
    Rule("/wp-content/*.css|", "block", 1),
]


def to_regex(pattern: str) -> str:
    """The pattern as a Java regular expression to find in ``host + path``."""
    body, start, end = pattern, "", ""
    if body.startswith("||"):
        body, start = body[2:], r"^(?:[^/]*\.)?"
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], r"\z"
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\z)"}
    return "(?s)" + start + "".join(parts.get(c) or re.escape(c) for c in body) + end


def literal_tokens(pattern: str) -> list[str]:
    """The pattern's whole tokens: runs closed on both sides by something that
    is no letter or digit in every address that matches."""
    body, open_left, open_right = pattern, True, True
    if body.startswith("||"):
        body, open_left = body[2:], False
    elif body.startswith("|"):
        body, open_left = body[1:], False
    if body.endswith("|"):
        body, open_right = body[:-1], False
    found = []
    for m in re.finditer(TOKEN, body):
        left = open_left if m.start() == 0 else body[m.start() - 1] == "*"
        right = open_right if m.end() == len(body) else body[m.end()] == "*"
        if not left and not right:
            found.append(m.group())
    return sorted(set(found))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; path: from there up to ``?``, ``#`` or the end.  Both are empty
    for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """``(rule_id, name, verdict, tier, width, regex, tokens)``."""
    rows = [(i, r.name if r.name is not None else r.pattern, r.verdict, r.tier, len(r.pattern), to_regex(r.pattern),
             literal_tokens(r.pattern)) for i, r in enumerate(rules)]
    return spark.createDataFrame(
        rows, "rule_id int, name string, verdict string, tier int, width int, regex string, tokens array<string>")


def rule_index(addresses: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """One index token per rule, the one that the fewest addresses have; null
    for rules without a whole token.  Counts are over all addresses."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    wanted = F.broadcast(wanted) if small else wanted
    seen = addresses.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").count()
    of_rule = rules.select("rule_id", F.explode_outer("tokens").alias("token"))
    rank = F.struct(F.coalesce(F.col("count"), F.lit(0)).alias("n"), "token")
    best = of_rule.join(seen, "token", "left").groupBy("rule_id").agg(F.min(rank)["token"].alias("token"))
    return rules.drop("tokens").join(best, "rule_id")


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (columns of these names are
    replaced; all others stay).

    ``rule`` is the name of the tier-0 rule that fits, else null; ``verdict`` is
    the winning rule's of either tier, else ``default``.  Each different url is
    judged once, however many rows have it.  A null url, or one without ``://``,
    has empty host and path and gets the default.  No rules and no pages are
    fine; rows that repeat, with or without ids, each get their verdict.
    """
    spark = pages.sparkSession
    if url_col in ("host", "path", "rule", "verdict"):
        raise ValueError(f"the url column can't be called {url_col}")
    table, small = rule_table(spark, rules), len(rules) <= MAX_BROADCAST_RULES
    host, path = host_and_path(F.col("_url"))
    urls = pages.select(F.col(url_col).alias("_url")).where("_url IS NOT NULL").distinct()
    addresses = (urls.select("_url", F.concat(host, path).alias("address"))
                 .withColumn("tokens", F.array_distinct(F.regexp_extract_all("address", F.lit(TOKEN), F.lit(0)))))
    index = rule_index(addresses, table, small)
    index = index.withColumn("token", F.coalesce("token", F.concat(F.lit("*"), F.col("rule_id"))))
    index = F.broadcast(index) if small else index
    # Rules without a whole token get a key of their own, which every address has.
    always = [f"*{i}" for i, r in enumerate(rules) if not literal_tokens(r.pattern)]
    keys = F.concat("tokens", F.array(*map(F.lit, always))) if always else F.col("tokens")
    fetched = addresses.select("_url", "address", F.explode(keys).alias("token")).join(index, "token")
    hits = fetched.where(F.expr("address RLIKE regex"))
    best = F.max(F.struct((-F.col("tier")).alias("tier"), "width", "name", "verdict")).alias("__judged")
    judged = hits.groupBy("_url").agg(best)
    host, path = host_and_path(F.col(url_col))
    return (pages.drop("host", "path", "rule", "verdict")
            .join(judged.withColumnRenamed("_url", "__judged_url"), F.col(url_col) == F.col("__judged_url"), "left")
            .withColumn("host", host).withColumn("path", path)
            .withColumn("rule", F.when(F.col("__judged.tier") == 0, F.col("__judged.name")))
            .withColumn("verdict", F.coalesce(F.col("__judged.verdict"), F.lit(default)))
            .drop("__judged", "__judged_url"))


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, QUERY_RULES + METHOD_RULES).select("page_id", "host", "path", "rule", "verdict")


def _sql_rule(rule: Rule) -> str:
    quoted = to_regex(rule.pattern).replace("'", "''")
    name = "NULL" if rule.tier else "'" + rule.name + "'"
    return f"({rule.tier}, {len(rule.pattern)}, {name}, '{rule.verdict}', '{quoted}')"


ORACLE_SQL = """
WITH a AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM a
), rules(tier, width, name, verdict, regex) AS (VALUES {rules}
), hits AS (
  SELECT n, arg_max(struct_pack(name := rules.name, verdict := rules.verdict), (1 - tier) * 10000 + width) AS best
  FROM b JOIN rules ON regexp_matches(host || path, regex) GROUP BY n
)
SELECT page_id, host, path, best.name AS rule, coalesce(best.verdict, 'allow') AS verdict FROM b LEFT JOIN hits USING (n)
""".format(upper=UPPER, lower=LOWER, rules=", ".join(map(_sql_rule, QUERY_RULES + METHOD_RULES)))
