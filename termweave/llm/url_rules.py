"""URL rules by a sort-merge range join of canonical keys, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable

#: Rules of the query: (verdict, host and path); and the verdict where no rule fits.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
OTHERWISE = "allow"
#: Rows of urls, of some hundred bytes, that a join broadcasts at most.
BROADCAST_URLS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first :// up to / ? # or the end, with A-Z lower-cased; then up to ? # or the end.  Both empty without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(__url, locate('://', __url) + 3)"))
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(rest.substr(F.length(host) + 1, F.length(rest)), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot after it: the keys of a host and of its subdomains are those that start with its own."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def prefix_stacks(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """points (key), prefixes (prefix), both distinct: (key, stack) with the given prefixes of each key that has any, shortest first.

    Each prefix is the interval of keys that start with it; such intervals are nested or apart.  Keys and interval starts are
    sorted together over ranges of the keys and swept: the last start before a key brings the stack of intervals open there,
    and those that end before the key leave it.  What is open at the end of a range is carried into the next ones.
    """
    # What is open at each interval's own start: the prefixes that enclose it.
    spread = prefixes.select("prefix", F.explode(F.sequence(F.lit(1), F.length("prefix"))).alias("n")).select("prefix", F.expr("substring(prefix, 1, n)").alias("outer"))
    stacks = spread.join(prefixes.select(F.col("prefix").alias("outer")), "outer").groupBy("prefix").agg(F.array_sort(F.collect_set("outer")).alias("opened"))
    events = stacks.select(F.col("prefix").alias("key"), F.lit(0).alias("kind"), "opened").unionByName(points.select("key", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("opened")))
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swept = durable(events.repartitionByRange(parts, "key", "kind").sortWithinPartitions("key", "kind").withColumn("range", F.spark_partition_id()))
    # One row a range: the last start in it, and from there the last start in any range before.
    ends = swept.groupBy("range").agg(F.max_by("opened", F.when(F.col("kind") == 0, F.struct("key", "kind"))).alias("opened"))
    carry = ends.select(F.col("range").alias("carried_to"), F.last("opened", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    within = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = swept.withColumn("opened", F.last("opened", ignorenulls=True).over(within)).where("kind = 1")
    last = last.join(F.broadcast(carry), F.col("range") == F.col("carried_to"))  # as many rows as ranges
    key = F.col("key")
    return last.select("key", F.filter(F.coalesce("opened", "carried"), lambda p: F.startswith(key, p)).alias("stack")).where(F.size("stack") > 0)


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of pages.  rules: (verdict, rule) with rule as host and path, such as net/.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule wins, of two as long the one
    with the longer host.  Of repeated rules the least verdict counts (allow before block).  A null url, or one without ://, has
    an empty host and path, and no rule; as has a path that is empty, for rules whose path is not.  Repeated pages give repeated
    rows, an empty table none; urls of any length are judged whole; html and other columns are not read.
    """
    r = rules.where(F.col("rule").isNotNull()).groupBy("rule").agg(F.min("verdict").alias("verdict"))
    r = r.select("rule", "verdict", F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("rhost")).withColumn("rpath", F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    r = durable(r.select("rule", "verdict", host_key(F.col("rhost")).alias("rkey"), "rpath", F.length("rhost").alias("hlen")))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    host, path = split_url(F.col("__url"))
    p = p.select("page_id", host.alias("host"), path.alias("path"))
    # First sweep: hosts, each once; then, for each rule host above a page's host, its paths likewise.
    hosts = p.where("host <> ''").select("host").distinct().withColumn("key", host_key(F.col("host")))
    above = prefix_stacks(hosts.select("key").distinct(), r.select(F.col("rkey").alias("prefix")).distinct())
    above = hosts.join(above.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select(F.col("host").alias("h"), F.explode("stack").alias("rkey"))
    above = durable(above)
    urls = p.where("host <> ''").select("host", "path").distinct()
    mark = F.lit("\u0001")
    points = urls.join(above, F.col("host") == F.col("h")).select("host", "path", F.concat("rkey", mark, "path").alias("key"))
    found = prefix_stacks(points.select("key").distinct(), r.select(F.concat("rkey", mark, "rpath").alias("prefix")).distinct())
    found = found.select(F.col("key").alias("k"), F.get("stack", F.size("stack") - 1).alias("longest"))
    ruled = points.join(found, F.col("key") == F.col("k")).join(r.select("rule", "verdict", "hlen", F.concat("rkey", mark, "rpath").alias("rk")), F.col("longest") == F.col("rk"))
    best = ruled.groupBy(F.col("host").alias("bhost"), F.col("path").alias("bpath")).agg(F.max(F.struct(F.length("rule").alias("n"), "hlen", "rule", "verdict")).alias("best"))
    # Pages without a host have no rule: they are not joined, so that however many there are they never meet in one task.
    some = p.where("host <> ''")
    best = durable(best)
    # Few pages have a rule's host and path each; where they are many, adaptive execution splits a common url's rows.
    best = F.broadcast(best) if best.count() <= BROADCAST_URLS else best
    out = some.join(best, (F.col("host") == F.col("bhost")) & (F.col("path") == F.col("bpath")), "left").unionByName(p.where("host = ''"), allowMissingColumns=True)
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


#: The query's rows by DuckDB, with its rules.
SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN split_part(split_part(substr(url, position('://' IN url) + 3), '?', 1), '#', 1) ELSE '' END AS rest FROM pages
), u AS (
  SELECT page_id, split_part(coalesce(rest, ''), '/', 1) AS h, coalesce(rest, '') AS rest FROM p
), q AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(h) + 1) AS path FROM u
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), m AS (
  SELECT q.*, r.verdict, rhost || rpath AS rule,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS n
  FROM q LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
