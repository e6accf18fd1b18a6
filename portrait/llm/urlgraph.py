"""URL filters with link-graph propagation.

Rules (host, path, verdict) decide the urls they fit.  For all others the
host decides: trust flows along links from hosts with allowed urls
(personalised PageRank), distrust flows against the links from hosts with
blocked urls, and a host is blocked where distrust exceeds trust by more than
``threshold``.

A host's seed is the share of its urls that the rules allow or block.  A
score is x = (1 - damping) * seed + damping * sum of what its neighbours pass
on, each dividing its score evenly among its links.  Links are the distinct
pairs of hosts in the pages' ``href`` attributes.  All steps are joins and
partial aggregations on hosts; page urls meet the blocked hosts once.  Both
kinds of score run through one join a turn, and a checkpoint cuts the lineage
every ``CUT_TURNS`` turns.

Defined cases: null urls and urls without ``://`` have an empty host and path
(no rule, never a seed or an end of a link, verdict allow); null html has no
links; a host whose urls no rule fits and that no score reaches is allowed;
repeated pages count each (links once); equal rules are one, of several rules
of the same length the first in order of their text wins; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import cut, lower_ascii, table, written

CUT_TURNS = 5
HREF = r"""(?i)<a\s[^<>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    """(rule_host, place, path, text, verdict) of the distinct rules; ``place``
    puts the rule first that wins: the longest, then the first by text."""
    rows = [(r.host, -len(r.text), r.path, r.text, r.verdict) for r in sorted(set(rules), key=lambda r: (r.text, r.verdict))]
    return spark.createDataFrame(rows, "rule_host string, place int, path string, text string, verdict string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each host its rules, and those of the domains that it
    is in, the winning ones first.  A host meets the rules by its suffixes (one
    for each label), so any number of rules costs one join on hosts."""
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("host", F.explode(suffix).alias("rule_host")).join(rules, "rule_host")
    return met.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "text", "verdict", "path"))).alias("rules"))


def fitting_rule(path: Column, rules: Column) -> Column:
    """The first of a host's rules whose path fits, as struct (text, verdict);
    null if none."""
    fits = F.filter(rules, lambda r: F.startswith(path, r["path"]))
    return F.get(F.transform(fits, lambda r: F.struct(r["text"].alias("text"), r["verdict"].alias("verdict"))), F.lit(0))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct (src, dst): hosts of pages and of the absolute links in them,
    without links of a host to itself."""
    target = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF), F.lit(1)))
    found = pages.select(url_host(F.col(url_col)).alias("src"), target.alias("link"))
    # a link without a scheme has the page's
    whole = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    return found.select("src", url_host(whole).alias("dst")).where("src <> dst AND src <> '' AND dst <> ''").distinct()


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85, turns: int = 20) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches.  ``seeds``:
    (host, trust, distrust); ``links``: distinct (src, dst)."""
    kinds = [("trust", "src", "dst"), ("distrust", "dst", "src")]
    seed = None
    flow = None
    for kind, a, b in kinds:
        part = seeds.where(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", F.col(kind).alias("seed"))
        degree = links.groupBy(F.col(a).alias("host")).agg(F.count("*").alias("degree"))
        step = links.select(F.col(a).alias("host"), F.col(b).alias("to")).join(degree, "host").select(F.lit(kind).alias("kind"), "host", "to", (F.lit(damping) / F.col("degree")).alias("weight"))
        seed = part if seed is None else seed.union(part)
        flow = step if flow is None else flow.union(step)
    start = cut(seed.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score")))
    flow = cut(flow)
    score = start
    if not flow.isEmpty():
        for turn in range(1, turns + 1):
            moved = flow.join(score, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("weight") * F.col("score")).alias("score"))
            score = moved.union(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
            if turn % CUT_TURNS == 0:
                score = cut(score)
    value = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return score.groupBy("host").agg(value("trust"), value("distrust"))


def judge_urls(pages: DataFrame, rules: list[UrlRule] | DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               damping: float = 0.85, turns: int = 20, threshold: float = 0.075) -> DataFrame:
    """(id_col, host, path, rule, verdict) of every page.  ``rules``: a list,
    or a table as ``rule_table`` makes it."""
    at = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    known = host_rules(at.select("host").where("host <> ''").distinct(), rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules))
    # written, as the blocked hosts below
    ruled = at.join(written(known), "host", "left").withColumn("fit", fitting_rule(F.col("path"), F.col("rules"))).drop("rules")
    share = lambda verdict: F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == verdict).cast("double"))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(cut(seeds), cut(host_links(pages, url_col, html_col)), damping, turns)
    # written: where both sides of the join are plain reads, Spark can split the
    # pages of one large host (or broadcast the blocked hosts, if they are few)
    blocked = written(scores.where(F.col("distrust") - F.col("trust") > threshold).select("host", F.lit(True).alias("bad")))
    met = ruled.join(blocked, "host", "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("bad"), "block").otherwise("allow"))
    return met.select(id_col, "host", "path", F.col("fit.text").alias("rule"), verdict.alias("verdict"))


OP2_RULES = [UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"), UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow")]


def op2_urlgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), OP2_RULES)


def op2_sql(damping: float = 0.85, turns: int = 20, threshold: float = 0.075) -> str:
    host = "translate(coalesce(regexp_extract({0}, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    fit = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{{r.verdict}}}{r.text}'"
        for r in sorted(OP2_RULES, key=lambda r: (-len(r.text), r.text)))
    steps = "".join(f""",
s{k} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (
    SELECT f.kind, f.dst AS host, f.weight * s.score AS score FROM flow f JOIN s{k - 1} s ON f.kind = s.kind AND f.host = s.host
    UNION ALL SELECT kind, host, score FROM s0) GROUP BY ALL)""" for k in range(1, turns + 1))
    return f"""
WITH urls AS (
    SELECT page_id, {host('url')} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
ruled AS (SELECT *, CASE {fit} END AS fit FROM urls),
links AS (
    SELECT DISTINCT src, dst FROM (
        SELECT host AS src, {host("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END")} AS dst
        FROM (SELECT host, unnest(regexp_extract_all(html, '{HREF.replace("'", "''")}', 1)) AS link FROM urls))
    WHERE src <> dst AND src <> '' AND dst <> ''),
seeds AS (
    SELECT host, avg(CASE WHEN fit LIKE '{{allow}}%' THEN 1.0::DOUBLE ELSE 0 END) AS trust, avg(CASE WHEN fit LIKE '{{block}}%' THEN 1.0::DOUBLE ELSE 0 END) AS distrust
    FROM ruled WHERE host <> '' GROUP BY host),
flow AS MATERIALIZED (
    SELECT 'trust' AS kind, src AS host, dst, {damping}::DOUBLE / count(*) OVER (PARTITION BY src) AS weight FROM links
    UNION ALL SELECT 'distrust', dst, src, {damping}::DOUBLE / count(*) OVER (PARTITION BY dst) FROM links),
s0 AS MATERIALIZED (
    SELECT 'trust' AS kind, host, (1 - {damping}::DOUBLE) * trust AS score FROM seeds WHERE trust > 0
    UNION ALL SELECT 'distrust', host, (1 - {damping}::DOUBLE) * distrust FROM seeds WHERE distrust > 0){steps},
blocked AS (
    SELECT host FROM s{turns} GROUP BY host
    HAVING sum(CASE WHEN kind = 'distrust' THEN score ELSE 0 END) - sum(CASE WHEN kind = 'trust' THEN score ELSE 0 END) > {threshold})
SELECT r.page_id, r.host, r.path, substr(r.fit, 8) AS rule,
       CASE WHEN r.fit IS NOT NULL THEN substr(r.fit, 2, 5) WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN blocked b ON r.host = b.host
"""


OP2_SQL = op2_sql()
