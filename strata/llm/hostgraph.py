"""URL filter: rules first, trust and distrust over the link graph else.

Rules (allow or block a host, its subdomains and a path prefix) judge the urls
that they fit. All other urls are judged by their host. Hosts whose pages the
rules allow are trusted seeds, hosts whose pages they block are distrusted
seeds, each by the share of its pages. Trust follows the links between hosts
(personalised PageRank from the trusted seeds), distrust runs against them
from the blocked seeds: who links to a blocked host is suspect. A host is
blocked when its distrust reaches the threshold and exceeds its trust.

Only DataFrame functions. Scores are whole numbers (SCALE is one seed's full
mass), so sums do not depend on their order and SQL gives the same bits. Links
are reduced to distinct host pairs before any join, in the tasks that read the
pages; each round joins the ranks of the hosts, one row each, to these pairs
and is written to the shared folder, so lineage never grows. Page bodies are
read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

SCALE = 10_000_000  # mass of a seed whose pages are all allowed, or all blocked
DAMPING = 85  # per cent of a host's mass that goes on along links
ROUNDS = 10
THRESHOLD = 500_000  # distrust that blocks a host: a third of the mass a full seed keeps
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A link to another host: an attribute with an absolute or protocol-relative url.
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^\s/?#"'<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_name(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits (of equal rules the first), else null. A
    rule without a path fits every path."""
    found = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.lit(r.name))
        for r in sorted(rules, key=lambda r: -len(r.name))
    ]
    return F.coalesce(*found, F.lit(None).cast("string")) if found else F.lit(None).cast("string")


def _rule_verdict(rules: Sequence[Rule], name: Column) -> Column:
    first = {r.name: r.verdict for r in reversed(sorted(rules, key=lambda r: -len(r.name)))}
    verdict = F.lit(None).cast("string")
    for rule, given in first.items():
        verdict = F.when(name == rule, F.lit(given)).otherwise(verdict)
    return verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct ``src, dst`` host pairs of the links of ``pages`` (``url,
    html``), without links of a host to itself."""
    links = pages.select(
        host_of(F.col("`url`")).alias("src"), F.explode(F.regexp_extract_all(F.col("`html`"), F.lit(LINK), 1)).alias("to")
    )
    ends = links.select("src", F.translate("to", UPPER, LOWER).alias("dst"))
    return ends.where("src <> '' and src <> dst").distinct()


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """``host, trust, distrust`` of every host reached: ``seeds`` (``host,
    trust, distrust``) are the restart masses; trust follows the links,
    distrust their reverse. A host's mass is shared evenly among its links,
    rounded down; what a host without links would pass on is gone."""
    if links.isEmpty():
        steps = None
    else:
        both = links.select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(True).alias("forward")).union(
            links.select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(False).alias("forward"))
        )
        degree = both.groupBy("host", "forward").agg(F.count("*").alias("k"))
        steps = written(both.join(degree, ["host", "forward"]), "host-steps")
    start = seeds.select(
        "host", F.expr(f"trust * {100 - damping} div 100").alias("trust"), F.expr(f"distrust * {100 - damping} div 100").alias("distrust")
    )
    start = written(start.where("trust > 0 or distrust > 0"), "host-ranks")
    ranks = start
    for _ in range(rounds if steps is not None else 0):
        mass = F.when(F.col("forward"), F.col("trust")).otherwise(F.col("distrust"))
        share = steps.join(ranks, "host").withColumn("mass", mass).where("mass > 0").select(
            F.col("to").alias("host"), "forward", F.expr(f"{damping} * mass div (100 * k)").alias("share")
        )
        passed = share.select(
            "host",
            F.when(F.col("forward"), F.col("share")).otherwise(F.lit(0)).alias("trust"),
            F.when(F.col("forward"), F.lit(0)).otherwise(F.col("share")).alias("distrust"),
        )
        ranks = written(
            start.union(passed).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")),
            "host-ranks",
        )
    return ranks


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    rounds: int = ROUNDS,
    damping: int = DAMPING,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of
    ``pages`` (``page_id, url, html``).

    A url that is null or has no ``://`` has an empty host and path; no rule
    fits it and the graph does not know it: it is allowed, with trust and
    distrust 0. A null or empty html has no links. A path that is empty starts
    with no rule's path but an empty one. Every row is judged, repeated rows and
    null ids too. An empty table gives no rows. Extra columns are ignored.
    """
    url = F.col("`url`").cast("string")
    host, path = host_of(url), path_of(url)
    named = pages.select(
        F.col("`page_id`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), rule_name(rules, host, path).alias("rule")
    )
    named = named.withColumn("by_rule", _rule_verdict(rules, F.col("rule")))
    share = lambda verdict: F.expr(f"{SCALE} * count_if(by_rule = '{verdict}') div count(*)")
    seeds = named.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    links = written(host_links(pages.select(url.alias("url"), F.col("`html`").cast("string").alias("html"))), "host-links")
    scores = propagate(links, seeds, rounds, damping).select(F.col("host").alias("known"), "trust", "distrust")
    # one row per host against many pages: a broadcast while the written table
    # is small, else a merge join that splits a host with many pages
    judged = named.join(scores, F.col("host") == F.col("known"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    graph = F.when((distrust >= threshold) & (distrust > trust), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", graph).alias("verdict"),
        trust.cast("long").alias("trust"), distrust.cast("long").alias("distrust"),
    )


def oracle(pages: str, rules: Sequence[Rule] = RULES, rounds: int = ROUNDS) -> str:
    """The same in SQL: one CTE per round."""
    lower = f"translate(%s, '{UPPER}', '{LOWER}')"
    by_length = sorted(rules, key=lambda r: -len(r.name))
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'" for r in by_length
    )
    verdicts = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in by_length)
    link = LINK.replace("'", "''")
    parts = [
        f"""u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM {pages})""",
        f"""p AS (SELECT page_id, html, coalesce({lower % "regexp_extract(rest, '^([^/?#]*)', 1)"}, '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u)""",
        f"n AS (SELECT *, CASE {fits} END AS rule FROM p)",
        f"j AS (SELECT *, CASE rule {verdicts} END AS by_rule FROM n)",
        f"""l AS (SELECT DISTINCT src, dst FROM (SELECT src, {lower % "target"} AS dst FROM (
                 SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS target FROM p)) WHERE src <> '' AND src <> dst)""",
        """s AS (SELECT src AS host, dst AS "to", true AS forward FROM l UNION ALL SELECT dst, src, false FROM l)""",
        """d AS (SELECT *, count(*) OVER (PARTITION BY host, forward) AS k FROM s)""",
        f"""r0 AS (SELECT host, {SCALE} * count_if(by_rule = 'allow') // count(*) * {100 - DAMPING} // 100 AS trust,
                  {SCALE} * count_if(by_rule = 'block') // count(*) * {100 - DAMPING} // 100 AS distrust
                  FROM j WHERE host <> '' GROUP BY host)""",
    ]
    for i in range(rounds):
        parts.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT host, sum(trust)::BIGINT AS trust, sum(distrust)::BIGINT AS distrust FROM (
              SELECT host, trust, distrust FROM r0 UNION ALL
              SELECT d."to", CASE WHEN forward THEN {DAMPING} * trust // (100 * k) ELSE 0 END,
                     CASE WHEN forward THEN 0 ELSE {DAMPING} * distrust // (100 * k) END
              FROM d JOIN r{i} USING (host)) GROUP BY host)"""
        )
    return f"""WITH {", ".join(parts)}
      SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN coalesce(distrust, 0) >= {THRESHOLD}
                 AND coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
             coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
      FROM j LEFT JOIN r{rounds} USING (host)"""
