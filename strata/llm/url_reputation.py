"""URL filter (1): empirical-Bayes host reputation.

Labelled page outcomes (good or not) are counted per host.  Each level of the
name shrinks to the level above through a beta-binomial prior: suffix to the
whole, registered domain to its suffix, host to its domain.  The strength of a
level's prior is estimated from how much its members differ beyond binomial
noise (method of moments).  A host passes if the lower bound of its posterior
(mean minus ``z`` standard deviations) reaches ``least_good``; hosts without
labels stand on the prior of their domain.  Explicit rules go before that.

Native: DataFrame functions only.  Labels are joined on the page, counted per
host with map-side combining, and the small host table is joined back with an
ordinary join, which AQE broadcasts when small and splits when a host is hot.

Defined cases: a null url, or one without ``://``, has empty host and path and
is judged as host ``''``; repeated pages are each judged; a page's labels all
count, for every row of that page; null outcomes and null page ids count for
nothing; an empty label table leaves every host at the neutral prior.  Columns
of ``pages`` other than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    verdict: str  # 'allow' or 'block'
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed by the contract of the query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
#: Suffixes of two labels under which names are registered; others have one.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
LEAST_GOOD = 0.6
Z = 1.64
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 2.0, 1000.0


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # longer ones override
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _levels(host: Column, suffixes: Sequence[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    two = F.substring_index(host, ".", -2)
    wide = two.isin(*suffixes) if suffixes else F.lit(False)
    suffix = F.when(wide, two).otherwise(F.substring_index(host, ".", -1))
    return F.when(wide, F.substring_index(host, ".", -3)).otherwise(two), suffix


def _shrink(counts: DataFrame, key: str, mean: str, out: str) -> DataFrame:
    """Posterior of ``key``'s rows (n, k) under a beta prior at ``mean``: adds
    ``out`` (mean) and ``strength`` (weight of prior and data together)."""
    m, n, k = F.col(mean), F.col("n").cast("double"), F.col("k").cast("double")
    excess = F.sum((k - n * m) * (k - n * m) - n * m * (1 - m))
    room = F.sum(n * (n - 1) * m * (1 - m))
    rho = F.when(room > 0, excess / room).otherwise(F.lit(0.0))
    prior = counts.agg(F.least(F.greatest(1 / F.greatest(rho, F.lit(1e-9)) - 1, F.lit(WEAKEST)),
                               F.lit(STRONGEST)).alias("s"))
    s = F.coalesce(F.col("s"), F.lit(STRONGEST))
    return (counts.crossJoin(F.broadcast(prior))  # one row
            .withColumn(out, (s * m + k) / (s + n)).withColumn("strength", s + n).drop("s"))


def host_reputation(hosts: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``(host, n, k)`` -> host, n, k, mean, bound: the three-level posterior."""
    domain, suffix = _levels(F.col("host"), suffixes)
    h = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    d = h.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    x = d.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    top = x.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("top"))
    x = _shrink(x.crossJoin(F.broadcast(top)), "suffix", "top", "suffix_mean").select("suffix", "suffix_mean")
    d = _shrink(d.join(x, "suffix"), "domain", "suffix_mean", "domain_mean").select("domain", "domain_mean")
    h = _shrink(h.join(d, "domain"), "host", "domain_mean", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    return h.select("host", "n", "k", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def url_verdicts(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES,
                 least_good: float = LEAST_GOOD) -> DataFrame:
    """``outcomes(page_id, good)``: labelled pages, good 0 or 1.  One row per
    page: page_id, host, path, rule, verdict, n_labelled, mean, bound."""
    host, path = parse_url(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = (outcomes.filter("page_id is not null and good is not null").groupBy("page_id")
            .agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("k")))
    hosts = (p.join(seen, "page_id", "left").groupBy("host")
             .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")))
    text, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") >= least_good, F.lit("allow")).otherwise(F.lit("block"))
    return (p.join(host_reputation(hosts), "host")
            .select("page_id", "host", "path", text.alias("rule"),
                    F.coalesce(verdict, method).alias("verdict"), F.col("n").alias("n_labelled"), "mean", "bound"))


def query(spark, sf_dir: str) -> DataFrame:
    """All pages; a page is good if its label has quality 1 and is not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"),
                             ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    return (url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"), outcomes)
            .select("page_id", "host", "path", "rule", "verdict", "n_labelled"))


def _shrink_sql(name: str, source: str, mean: str, out: str) -> str:
    return f"""{name}_s AS (SELECT least(greatest(1 / greatest(CASE WHEN sum(n * (n - 1.0) * {mean} * (1 - {mean})) > 0
  THEN sum((k - n * {mean}) * (k - n * {mean}) - n * {mean} * (1 - {mean})) / sum(n * (n - 1.0) * {mean} * (1 - {mean}))
  ELSE 0 END, 1e-9) - 1, {WEAKEST}), {STRONGEST}) AS s FROM {source}),
{name} AS (SELECT t.*, (s * {mean} + k) / (s + n) AS {out}, s + n AS strength FROM {source} t, {name}_s)"""


def _sql() -> str:
    wide = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
    longest = sorted(RULES, key=lambda r: -len(r.text))

    def case(value) -> str:
        return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
                                  f" THEN '{value(r)}'" for r in longest) + " END"
    return f"""
WITH rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
seen AS (SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS k
         FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, coalesce(sum(k), 0) AS k, string_split(host, '.') AS l
          FROM parsed LEFT JOIN seen USING (page_id) GROUP BY host),
tails AS (SELECT host, n, k, l, array_to_string(l[-2:], '.') AS two FROM hosts),
named AS (SELECT host, n, k, CASE WHEN two IN ({wide}) THEN array_to_string(l[-3:], '.') ELSE two END AS domain,
          CASE WHEN two IN ({wide}) THEN two ELSE l[-1] END AS suffix FROM tails),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM named GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
suffixes0 AS (SELECT t.*, (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) FROM suffixes) AS top FROM suffixes t),
{_shrink_sql("x", "suffixes0", "top", "suffix_mean")},
domains0 AS (SELECT d.*, suffix_mean FROM domains d JOIN x USING (suffix)),
{_shrink_sql("d", "domains0", "suffix_mean", "domain_mean")},
hosts0 AS (SELECT h.*, domain_mean FROM named h JOIN d USING (domain)),
{_shrink_sql("h", "hosts0", "domain_mean", "mean")}
SELECT page_id, host, path, {case(lambda r: r.text)} AS rule,
  coalesce({case(lambda r: r.verdict)},
           CASE WHEN mean - {Z} * sqrt(mean * (1 - mean) / (strength + 1)) >= {LEAST_GOOD} THEN 'allow' ELSE 'block' END) AS verdict,
  h.n AS n_labelled
FROM parsed JOIN h USING (host)"""


QUERIES = {"op1_url_reputation": query}
ORACLE = {"op1_url_reputation": _sql()}
