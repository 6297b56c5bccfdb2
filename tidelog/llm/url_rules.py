"""URL filter: pattern rules found by their rarest literal token.

A rule is a host and a path prefix with a verdict. It fits its host and every
subdomain, where the URL's path starts with the rule's. Each rule is compiled to
a regular expression and filed under one literal token that every fitting URL
must hold: the rarest of its host labels and whole path segments, counted over
all URLs. The tokens of a URL fetch the candidates; only those run their regular
expression. Of the fitting rules the longest wins, then the greatest text.

All of it is DataFrame functions. The token index is one row per token; it is
broadcast only when its measured size allows, else the join is salted. Every row
of a URL is brought together by a partial and a final aggregate, so neither a
frequent token nor a URL that fills a third of the table meets in one task.

Defined results: a null URL or one without `://` has an empty host and path and
no rule; a rule without any literal token is tried on every URL; repeated rows
come back as often as they came in; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, registered, table
from tidelog.session import Lookup

#: What a URL gets that no rule fits.
DEFAULT_VERDICT = "allow"

#: The rules of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

#: Filed under this, a rule is tried on every URL.
ANY = ""


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, verdict string")


def split_url(url):
    """Host and path columns of a URL."""
    host = ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(host: str, path: str, closed: str):
    """Distinct literal tokens; `closed` is the part of the path in whole segments."""
    return F.expr(
        f"array_distinct(concat("
        f"transform(filter(split({host}, '[.]'), t -> t <> ''), t -> concat('h:', t)),"
        f"transform(filter(split({closed}, '/'), t -> t <> ''), t -> concat('p:', t))))"
    )


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their text, regular expression and literal tokens."""
    quoted = "regexp_replace(concat(rule_host, rule_path), '([^A-Za-z0-9])', '\\\\\\\\$1')"
    return (
        rules.selectExpr(
            "concat(rule_host, rule_path) AS rule",
            f"concat('^(?:[^/]*\\\\.)?', {quoted}) AS pattern",
            "verdict AS rule_verdict",
            "rule_host",
            "rule_path",
            "regexp_replace(rule_path, '[^/]*$', '') AS closed",
        )
        .dropDuplicates(["rule"])
        .withColumn("literals", _tokens("rule_host", "rule_path", "closed"))
        .drop("rule_host", "rule_path", "closed")
    )


def token_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per token with the rules filed under it."""
    literals = rules.select("rule", F.explode("literals").alias("token"))
    counts = (
        Lookup(literals.select("token").distinct())
        .join(urls.select("page_id", F.explode("tokens").alias("token")), ["token"], "left_semi", spread=["page_id"])
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("rule")
        .agg(F.expr("min_by(token, struct(coalesce(n, 0L), token)) AS token"))
    )
    return (
        rules.join(rarest, "rule", "left")
        .withColumn("token", F.coalesce("token", F.lit(ANY)))
        .groupBy("token")
        .agg(F.expr("collect_list(struct(rule, pattern, rule_verdict)) AS filed"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, the deciding rule and the verdict of each page."""
    host, path = split_url(F.col("url"))
    urls = (
        pages.select("page_id", "url", host.alias("host"), path.alias("path"))
        .withColumn("tokens", _tokens("host", "path", "path"))
    )
    index = Lookup(token_index(urls, compiled(rules)))
    fetched = index.join(
        urls.select(
            "page_id",
            "url",
            "host",
            "path",
            F.explode(F.concat(F.array(F.lit(ANY)), "tokens")).alias("token"),
        ),
        ["token"],
        "left",
        spread=["page_id", "url"],
    )
    fitting = fetched.withColumn(
        "best",
        F.expr(
            "array_max(transform(filter(filed, r -> regexp_like(concat(host, path), r.pattern)),"
            " r -> struct(length(r.rule) AS size, r.rule AS rule, r.rule_verdict AS verdict)))"
        ),
    )
    return (
        fitting.groupBy("page_id", "url")
        .agg(
            F.first("host").alias("host"),
            F.first("path").alias("path"),
            F.max("best").alias("best"),
            F.sum(F.expr(f"CAST(token = '{ANY}' AS INT)")).alias("copies"),
        )
        .withColumn("copy", F.expr("explode(sequence(1L, copies))"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


SQL = """
WITH rules(rule_host, rule_path, action) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
urls AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT row_id, rule_host || rule_path AS rule, action FROM urls JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
best AS (
  SELECT row_id, rule, action FROM fits
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length(rule) DESC, rule DESC) = 1)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM urls LEFT JOIN best USING (row_id)
"""


@registered("op7_url_rules", SQL)
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark))
