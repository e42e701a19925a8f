"""URL filter: hashed host-suffix and path-prefix expressions joined with a rule list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm.common import table
from reviewtide.plans.storage import materialise

PREFIX_HEX = 8
DEFAULT_VERDICT = "allow"

#: The rules of the registered query: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def _digest(host: Column, path: Column) -> Column:
    """Full digest of an expression; its length keeps host and path apart."""
    return F.sha2(F.concat_ws(" ", F.char_length(host), host, path), 256)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) rows with digest and short prefix. Block wins among equal rules."""
    one = rules.filter("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path")
    found = one.agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    digest = _digest(F.col("host"), F.col("path"))
    return found.withColumn("digest", digest).withColumn("prefix", F.left("digest", F.lit(PREFIX_HEX)))


def _expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per (host, path, expression) that a rule of this list could equal.

    The host suffixes begin at each label, the path prefixes end where some rule's path does.
    Suffixes with more labels than any rule are not made, so a URL gives at most (labels of the
    longest rule host) x (distinct lengths of rule paths) rows, whatever its own length.
    """
    shape = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)).alias("labels"),
        F.sort_array(F.collect_set(F.char_length("path"))).alias("lengths"),
    ).first()
    lengths = F.array(*[F.lit(n) for n in shape["lengths"]]).cast("array<int>")
    parts = F.split("host", r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - F.lit(shape["labels"]) + 1)
    suffixes = F.transform(
        F.sequence(first, F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.char_length("path")), lambda n: F.left(F.col("path"), n)
    )
    hosts = urls.select("host", "path", F.explode(suffixes).alias("e_host"), prefixes.alias("prefixes"))
    return hosts.select("host", "path", "e_host", F.explode("prefixes").alias("e_path"))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host, path, rule and verdict of every row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest
    fitting rule wins, then the one with the longer host; without one the rule is null and the
    verdict ``allow``. Null, empty or scheme-less URLs have an empty host and path. Repeated
    rows and null keys are judged each. Other columns of ``pages`` are not read.

    Expressions are made once per distinct (host, path) and meet the rules by equi-join on
    eight hex digits of their SHA-256; the full digest confirms. Spark chooses how to join from
    the sizes; pages join with the matched (host, path) only, an exchange that skew handling
    splits when one URL is hot.
    """
    host, path = split_url(url)
    parsed = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))
    listed = hashed_rules(rules)
    made = _expressions(parsed.filter("host <> ''").distinct(), listed)
    digest = _digest(F.col("e_host"), F.col("e_path"))
    made = made.withColumn("e_digest", digest).withColumn("prefix", F.left("e_digest", F.lit(PREFIX_HEX)))
    right = listed.select("prefix", "digest", F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    hits = made.join(right, "prefix").filter("e_digest = digest")
    rule = F.concat("r_host", "r_path")
    rank = F.struct(F.char_length(rule).alias("n"), F.char_length("r_host").alias("h"), rule.alias("rule"), "verdict")
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    verdicts = materialise(best.select("host", "path", "best.rule", "best.verdict"), "url-verdicts")
    judged = parsed.join(verdicts, ["host", "path"], "left")
    verdict = F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")
    return judged.select(key, "host", "path", "rule", verdict)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLE_SQL = """
WITH parsed AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM parsed),
rules(r_host, r_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id
                            ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS place
  FROM cut JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM cut LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
"""
