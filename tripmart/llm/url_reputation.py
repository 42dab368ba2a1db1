"""URL filter by rules and empirical-Bayes host reputation.

A list of rules (host and path prefix) allows or blocks urls. The pages that
a rule judges are labelled outcomes; from them every host gets a reputation,
which judges the pages that no rule fits. Outcomes are counted by host,
registered domain and suffix. Each level's share of bad pages is a
beta-binomial posterior whose prior mean is the posterior mean of the level
above, and whose prior strength is estimated from the spread of that level's
own counts (method of moments). A host is blocked when the lower bound of its
posterior exceeds LIMIT, so that a few bad pages alone block no host.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.operators.joins import bounded_broadcast

#: (verdict, host, path): a rule fits its host and all subdomains, below its path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Suffixes of two labels below which domains are registered.
SUFFIXES = ["ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "net.au", "org.uk"]
#: Block when mean - WIDTH standard deviations of the posterior exceeds LIMIT.
LIMIT, WIDTH = 0.5, 1.645
#: Limits of the intra-class correlation, from which prior strengths follow.
LEAST, MOST = 0.001, 0.999
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict: the longest fitting rule, or null.

    One hash join for each number of labels that rule hosts have: a url is
    looked up by its host's last labels, and its path is compared with the
    rules of that host only. The rule table is as large as the caller's list.
    Rules alike in host and path: block wins.
    """
    host, path = parts(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    by_host = defaultdict(set)
    for verdict, rule_host, start in rules:
        by_host[rule_host].add((len(rule_host) + len(start), verdict, rule_host + start, start))
    hits = []
    for k in sorted({h.count(".") + 1 for h in by_host}):
        rows = [(h, sorted(found, reverse=True)) for h, found in by_host.items() if h.count(".") + 1 == k]
        table = pages.sparkSession.createDataFrame(rows, f"tail_{k} string, rules_{k} array<struct<size: int, "
                                                         "verdict: string, rule: string, start: string>>")
        out = out.withColumn(f"tail_{k}", F.substring_index("host", ".", -k))
        out = out.join(bounded_broadcast(table, rows=len(rows)), f"tail_{k}", "left")
        hits.append(F.get(F.filter(f"rules_{k}", lambda r: F.col("path").startswith(r["start"])), F.lit(0)))
    none = F.lit(None).cast("struct<size: int, verdict: string, rule: string, start: string>")
    best = F.array_max(F.array(none, *hits))
    return (out.withColumn("best", best)
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix; an address of numbers is its own domain, below no suffix."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    address = bare.rlike(r"^[0-9.]+$") | bare.startswith("[")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(SUFFIXES)
    suffix = F.when(address, "").when(long, two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(address, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(level: DataFrame) -> float:
    """Prior strength of a level from its counts n, bad and prior means.

    The Pearson statistic of binomial counts around their means has one
    expected unit for each group, and (n - 1) times the correlation more.
    """
    p = F.col("prior")
    square = (F.col("bad") - F.col("n") * p) * (F.col("bad") - F.col("n") * p) / (F.col("n") * p * (1 - p))
    row = level.where("n > 0").agg(F.sum(square).alias("x"), F.count("*").alias("groups"),
                                   F.sum(F.col("n") - 1).alias("free")).first()
    rho = 0.5 if not row["free"] else min(MOST, max(LEAST, (row["x"] - row["groups"]) / row["free"]))
    return round((1 - rho) / rho, 6)


def _shrunk(strength: float) -> Column:
    return (F.lit(strength) * F.col("prior") + F.col("bad")) / (F.lit(strength) + F.col("n"))


def reputations(outcomes: DataFrame) -> DataFrame:
    """host, n, bad, mean, bound: reputation of every host.

    ``outcomes``: host, bad (boolean; null where a page has no label). A row
    is one outcome, repeated or not. ``mean`` and ``bound`` are the posterior
    mean and lower bound of the share of bad pages. Without any label every
    host stands at one half. An empty table has no hosts. Counts are summed
    in each task before they are shuffled; a host of any size is one row.
    """
    domain, suffix = domain_and_suffix(F.col("host"))
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    hosts = stored(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("bad"))
                   .withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = stored(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts)
    root = suffixes.agg(*counts).first()
    top = ((root["bad"] or 0) + 1) / ((root["n"] or 0) + 2)
    suffixes = stored(suffixes.withColumn("prior", F.lit(top)), "suffixes")
    above = suffixes.select("suffix", _shrunk(_strength(suffixes)).alias("prior"))
    domains = domains.join(bounded_broadcast(above), "suffix")
    above = domains.select("domain", "suffix", _shrunk(_strength(domains)).alias("prior"))
    hosts = hosts.join(bounded_broadcast(above), ["domain", "suffix"])
    m = _strength(hosts)
    a, b = F.lit(m) * F.col("prior") + F.col("bad"), F.lit(m) * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select("host", "n", "bad", (a / (a + b)).alias("mean"), (a / (a + b) - WIDTH * deviation).alias("bound"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], outcomes: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, mean, bound: one row a page.

    ``pages``: page_id, url; other columns are ignored, so clashing names do
    no harm. ``outcomes`` (host, bad) holds labelled pages; without it the
    pages that a rule judges are the labels, blocked ones the bad ones. The
    verdict is the rule's, else block where the host's bound exceeds LIMIT,
    else allow. Null urls and urls without ``://`` have an empty host, judged
    like any other. Repeated rows are judged, and counted, each. An empty
    table gives no rows.
    """
    found = ruled(pages, rules)
    if outcomes is None:
        outcomes = found.select("host", (F.col("verdict") == "block").alias("bad"))
    else:
        outcomes = outcomes.select("host", "bad").unionByName(
            found.select("host", F.lit(None).cast("boolean").alias("bad")))
    known = stored(reputations(outcomes).select("host", "mean", "bound"), "reputations")
    by_method = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return (found.join(bounded_broadcast(known), "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"),
                    "mean", "bound"))


def op11_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _sql_level(child: str, parent: str, key: str) -> str:
    """CTEs of a level's prior means and strength, and of its posterior means."""
    return f"""{child}_prior AS (
  SELECT c.*, p.mean AS prior FROM {child} c JOIN {parent} p ON {key}
), {child}_rho AS (
  SELECT CASE WHEN coalesce(sum(n - 1), 0) = 0 THEN 0.5::DOUBLE ELSE least({MOST}::DOUBLE, greatest({LEAST}::DOUBLE,
    (sum((bad - n * prior) * (bad - n * prior) / (n * prior * (1 - prior))) - count(*)) / sum(n - 1))) END AS rho
  FROM {child}_prior WHERE n > 0
), {child}_mean AS (
  SELECT *, (m * prior + bad) / (m + n) AS mean
  FROM {child}_prior, (SELECT round((1 - rho) / rho, 6) AS m FROM {child}_rho)
)"""


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
_SUFFIX_ROWS = ", ".join(f"'{s}'" for s in SUFFIXES)
OP11_SQL = f"""
WITH urls AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT r, h || p AS rule, v AS verdict,
    row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, v DESC, h || p DESC) AS place
  FROM urls JOIN (VALUES {_RULE_ROWS}) AS rules(v, h, p)
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), ruled AS (
  SELECT u.*, f.rule, f.verdict FROM urls u LEFT JOIN fits f ON u.r = f.r AND f.place = 1
), bare AS (
  SELECT host, count(verdict) AS n, count(*) FILTER (WHERE verdict = 'block') AS bad,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare
  FROM ruled GROUP BY host
), labels_of AS (
  SELECT *, string_split(bare, '.') AS l, regexp_matches(bare, '^[0-9.]+$') OR starts_with(bare, '[') AS address,
    array_to_string(string_split(bare, '.')[-2:], '.') AS two FROM bare
), host AS (
  SELECT host, n, bad,
    CASE WHEN address THEN bare WHEN two IN ({_SUFFIX_ROWS}) THEN array_to_string(l[-3:], '.') ELSE two END AS domain,
    CASE WHEN address THEN '' WHEN two IN ({_SUFFIX_ROWS}) THEN two ELSE l[-1] END AS suffix
  FROM labels_of
), domain AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM host GROUP BY ALL),
suffix AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM domain GROUP BY ALL),
root AS (SELECT (coalesce(sum(bad), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2)::DOUBLE AS mean FROM suffix),
{_sql_level('suffix', 'root', 'true')},
{_sql_level('domain', 'suffix_mean', 'c.suffix = p.suffix')},
{_sql_level('host', 'domain_mean', 'c.domain = p.domain AND c.suffix = p.suffix')},
posterior AS (
  SELECT host, m * prior + bad AS a, m * (1 - prior) + n - bad AS b FROM host_mean
), bound AS (
  SELECT host, a / (a + b) - {WIDTH}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM posterior
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN bound USING (host)
"""
