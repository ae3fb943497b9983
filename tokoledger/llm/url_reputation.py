"""URL filter: fixed rules first, then empirical-Bayes host reputation.

Labelled pages are outcomes of their host. A host's rate of bad pages is shrunk
through beta-binomial priors: the host's towards its registered domain's, the
domain's towards its suffix's, the suffix's towards the rate of all pages. The
strength of the prior at each level comes from the overdispersion of that level's
counts. A page is blocked if the lower posterior bound of its host's rate
exceeds the threshold. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_SECOND = r"(?:(?:ac|co|com|edu|gov|net|org)\.[a-z][a-z])"   # suffixes of two labels
SUFFIX = rf"(?:^|\.)({_SECOND}|[^.]+)$"
DOMAIN = rf"(?:^|\.)([^.]+\.(?:{_SECOND}|[^.]+))$"
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
THRESHOLD = 0.3        # largest bad rate that is allowed
Z = 1.645              # bound: mean less so many posterior deviations
LEAST_RHO, MOST_RHO = 0.001, 0.5   # overdispersion, so a prior weighs 1 to 999 pages


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null; of equally long ones the smaller."""
    tests = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        tests.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*tests, F.lit(None).cast("string")) if tests else F.lit(None).cast("string")


def _rates(counts: DataFrame, above: str | None, level: str, mean: float) -> DataFrame:
    """Posterior of each row of counts (level, n, bad, prior = mean of the level above)."""
    s = counts.agg(
        F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("n") * F.col("bad")), F.sum(F.col("bad") * F.col("bad"))
    ).first()  # four numbers
    n, nn, nb, bb = (float(x or 0) for x in s)
    rho = ((bb - 2 * mean * nb + mean * mean * nn) / (mean * (1 - mean)) - n) / (nn - n) if nn > n else MOST_RHO
    rho = min(MOST_RHO, max(LEAST_RHO, rho))
    k = 1 / rho - 1
    return (
        counts.withColumn(f"{level}_weight", F.col("n") + F.lit(k))
        .withColumn(f"{level}_rate", (F.col("bad") + F.lit(k) * F.col("prior")) / F.col(f"{level}_weight"))
        .drop("n", "bad", "prior")
    )


def url_reputation(pages: DataFrame, labels: DataFrame, rules=RULES, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict,
    and of the host bad_rate (posterior mean) and bad_rate_bound, to six digits.

    ``labels`` (doc_id, quality, toxic): a label is an outcome of the page with that
    id, bad if toxic is 1 or quality is 0; a label that is null in both columns does
    not count, and each repeated label or page does. A null url, or one without
    ``://``, has empty host and path and no rule; such pages are one host. A null
    page_id has no label. Hosts without labels have their domain's rate. With no
    label at all every rate is one half. Other columns are not read.
    """
    seen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    outcomes = (
        labels.where("quality is not null or toxic is not null")
        .select(F.col("doc_id").cast("long").alias("page_id"), F.expr("coalesce(toxic = 1, false) or coalesce(quality = 0, false)").cast("long").alias("bad"))
        .groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    )
    bare = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    domain, suffix = F.regexp_extract("site", DOMAIN, 1), F.regexp_extract("site", SUFFIX, 1)
    hosts = (
        seen.join(outcomes, "page_id", "left").groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("site", bare)
        .withColumns({"domain": F.when(domain != "", domain).otherwise(F.col("site")), "suffix": suffix})
    )
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()  # two numbers
    mean = (float(total[1] or 0) + 0.5) / (float(total[0] or 0) + 1)
    of = lambda level: hosts.groupBy(*level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = _rates(of(["suffix"]).withColumn("prior", F.lit(mean)), None, "suffix", mean)
    domains = _rates(of(["suffix", "domain"]).join(suffixes, "suffix").withColumn("prior", F.col("suffix_rate")), "suffix", "domain", mean)
    rated = _rates(hosts.join(domains.select("domain", "suffix", "domain_rate"), ["suffix", "domain"]).withColumn("prior", F.col("domain_rate")), "domain", "host", mean)
    deviation = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("host_weight") + 1))
    judged = rated.select("host", F.col("host_rate").alias("rate"), (F.col("host_rate") - F.lit(z) * deviation).alias("bound"))
    action = F.create_map(*[F.lit(x) for a, r in rules for x in (r, a)]) if rules else None
    own = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    return (
        seen.join(judged, "host").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
        .select(
            "page_id", "host", "path", "rule", (F.coalesce(action[F.col("rule")], own) if rules else own).alias("verdict"),
            F.round("rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_rate_bound"),
        )
    )


def oracle(rules=RULES, threshold: float = THRESHOLD, z: float = Z) -> str:
    """DuckDB SQL for the same rows."""
    cases = []
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        cases.append((f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}')", rule, action))
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in cases)
    verdict = " ".join(f"WHEN rule = '{name}' THEN '{action}'" for _, name, action in cases)
    k = lambda t: (
        f"(SELECT 1 / least({MOST_RHO}, greatest({LEAST_RHO}, CASE WHEN sum(n * n) > sum(n) THEN ((sum(bad * bad)::DOUBLE - 2 * any_value(m) * sum(n * bad)::DOUBLE"
        f" + any_value(m) * any_value(m) * sum(n * n)::DOUBLE) / (any_value(m) * (1 - any_value(m))) - sum(n)::DOUBLE) / (sum(n * n)::DOUBLE - sum(n)::DOUBLE)"
        f" ELSE {MOST_RHO} END)) - 1 FROM {t}, mean)"
    )
    return f"""
WITH seen AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
outcomes AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END)::BIGINT AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(bad), 0)::BIGINT AS bad FROM seen LEFT JOIN outcomes USING (page_id) GROUP BY host),
sites AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM counted),
hosts AS (
  SELECT host, n, bad, coalesce(nullif(regexp_extract(site, '{DOMAIN}', 1), ''), site) AS domain, regexp_extract(site, '{SUFFIX}', 1) AS suffix FROM sites),
mean AS (SELECT (coalesce(sum(bad), 0)::DOUBLE + 0.5::DOUBLE) / (coalesce(sum(n), 0)::DOUBLE + 1) AS m FROM hosts),
by_suffix AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY suffix),
by_domain AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY suffix, domain),
k AS (SELECT {k('by_suffix')}::DOUBLE AS ks, {k('by_domain')}::DOUBLE AS kd, {k('hosts')}::DOUBLE AS kh),
suffixes AS (SELECT suffix, (bad + ks * m) / (n + ks) AS suffix_rate FROM by_suffix, k, mean),
domains AS (SELECT suffix, domain, (bad + kd * suffix_rate) / (n + kd) AS domain_rate FROM by_domain JOIN suffixes USING (suffix), k),
rated AS (SELECT host, (bad + kh * domain_rate) / (n + kh) AS rate, n + kh AS weight FROM hosts JOIN domains USING (suffix, domain), k),
judged AS (SELECT host, rate, rate - {z}::DOUBLE * sqrt(rate * (1 - rate) / (weight + 1)) AS bound FROM rated),
ruled AS (SELECT page_id, host, path, CASE {rule} END AS rule FROM seen)
SELECT page_id, host, path, rule, CASE {verdict} WHEN bound > {threshold} THEN 'block' ELSE 'allow' END AS verdict,
       round(rate, 6) AS bad_rate, round(bound, 6) AS bad_rate_bound
FROM ruled JOIN judged USING (host)
"""
