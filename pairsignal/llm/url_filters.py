"""URL filters by host-suffix and path-prefix expressions (native).

A rule is (host, path, verdict) and fits an url whose host is the rule's host or lies under it, and
whose path starts with the rule's path.  Each distinct url is expanded into every host suffix times
every path prefix whose length some rule has, so a rule is found by equality alone: expressions
meet rules on the first four bytes of their SHA-256, the full digest and the text confirm, and the
longest rule wins (host and path together; at equal length the longer host, then ``block``).

The rule table may be large: nothing is broadcast by force.  Copies of a (page_id, url) row travel
as one row with their number.

Defined cases: a null url or one without ``://`` has empty host and path, which no rule fits (a
rule needs a host), and gets the default verdict; so does an url that no rule fits.  Rules with a
null or empty host never fit; a null path counts as empty.  Equal rules count once; where one rule
is given both verdicts, ``block`` wins.  Null page ids are kept, equal rows stay as many as they
are, an empty table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ascii_lower, literal_rows, table

# Fixed values of the registered query.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT = "allow"


def url_parts(url):
    """(host, path) columns of an url column."""
    # What follows the first "://"; later ones belong to the rest of the url.
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = ascii_lower(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digested(df: DataFrame) -> DataFrame:
    digest = F.sha2(F.col("expression"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, url, host, path, rule and verdict for every row of ``pages``."""
    rules = _digested(
        rules.filter(F.length("host") > 0)
        .select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"
        .withColumn("expression", F.concat("host", "path"))
    ).select(
        F.col("short").alias("r_short"), F.col("digest").alias("r_digest"), F.col("expression").alias("rule"),
        F.col("verdict").alias("r_verdict"), F.length("host").alias("r_host"),
    )
    # No more lengths than an url has characters.
    lengths = [r[0] for r in rules.select(F.length("rule") - F.col("r_host")).distinct().orderBy(1).collect()]

    urls = pages.groupBy("page_id", "url").agg(F.count("*").alias("copies"))
    host, path = url_parts(F.col("url"))
    urls = urls.withColumn("host", host).withColumn("path", path)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    expanded = urls.withColumn("suffix", F.explode(suffixes)) if lengths else urls.withColumn("suffix", F.lit(""))
    prefix = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit("")])
    expanded = _digested(
        expanded.withColumn("prefix", F.explode(prefix)).withColumn("expression", F.concat("suffix", "prefix"))
    )
    met = expanded.join(
        rules,
        (F.col("short") == F.col("r_short")) & (F.col("digest") == F.col("r_digest"))
        & (F.col("expression") == F.col("rule")) & (F.length("suffix") == F.col("r_host")),
        "left",
    )
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("size"), "r_host", F.col("r_verdict").alias("verdict"), "rule",
    ))).alias("best")
    return (
        met.groupBy("page_id", "url", "copies", "host", "path").agg(best)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    rules = literal_rows(spark, RULES, "host string,path string,verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a
  FROM pages
), urls AS (
  SELECT page_id,
         translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(r_host, r_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), met AS (
  SELECT page_id, host, path, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r_host || r_path) DESC NULLS LAST) AS k
  FROM urls LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM met WHERE k = 1
"""
