"""URL filter: host and path rules first, then the reputation of the host.

Rules (``host/path``) fit their host and all its subdomains where the url's path starts with
the rule's; the longest fitting rule gives the verdict.

A page that no rule fits is judged by its host's share of bad pages, by empirical Bayes. Hosts
have few labelled pages, so their counts are shrunk through a chain of beta-binomial priors:
all pages -> public suffix -> registered domain -> host. At each level

    mean = (bad + strength * mean of the level above) / (labelled + strength)

and ``strength`` (the prior's pseudo-pages) is fitted to the table itself, once per level, from how
much children of one parent differ beyond binomial noise: with the mean squares between and
within children, rho = (MSB - MSW) / (MSB + (n0 - 1) MSW) and strength = 1 / rho - 1, between 1
and 1,000 (``strength`` where the level cannot tell). The host's posterior is
Beta(bad + strength * m, good + strength * (1 - m)), m being its domain's mean. A page goes
when the lower posterior bound, mean - z * sd, is over ``max_bad``: a host of few pages keeps
the benefit of the doubt, a host without labelled pages is its domain's.

Pages carry no labels of their own, so the query takes each page's outcome from its html
(``outcome``); ``judge`` takes any outcome column (1 bad, 0 good, null not labelled).

Plan: one aggregate by host (partial sums, so a host with a third of all pages is one row per
task); all further work is on hosts; one join of the pages with their host's row, which Spark
broadcasts if its real size allows and splits if skewed. Everything is Spark expressions.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule
and shares the reputation of the empty host; a null outcome is not labelled; without any
labelled page every page is allowed; repeated rows are separate pages; a null id is kept; other
columns pass through ``judge`` unless named as its results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptally.llm import base as B

# The rules of the query.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
# Labels that belong to the public suffix in front of a two-letter country label.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
# What is not read of a page, and the marks that junk is full of.
UNREAD = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>"
MARKS = "[^#*$%|]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE = "://([^/?#]*)([^?#]*)"
RESULTS = ["host", "path", "rule", "bad_mean", "bad_bound", "verdict"]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PLACE, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PLACE, 2), F.lit(""))


def site_of(host: Column) -> Column:
    """The host without user, port and last dot."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"(?::[0-9]*)?$|\.(?::[0-9]*)?$", "")


def _split_site(site: Column) -> Column:
    """struct<domain, suffix>: the registered domain and the public suffix; an address is its own domain."""
    labels = F.split(site, r"\.")
    last = lambda k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), F.lit(k)), ".")
    deep = (F.length(F.element_at(labels, -1)) == 2) & F.coalesce(
        F.try_element_at(labels, F.lit(-2)).isin(SECOND_LEVEL), F.lit(False)) & (F.size(labels) > 2)
    alone = F.rlike(site, F.lit(r"^[0-9.]*$|:")) | (F.size(labels) < 2)
    return F.struct(F.when(alone, site).when(deep, last(3)).otherwise(last(2)).alias("domain"),
                    F.when(alone, F.lit("")).when(deep, last(2)).otherwise(last(1)).alias("suffix"))


def outcome(html: Column, max_marks: float = 0.1, min_words: int = 5) -> Column:
    """1 if marks (``#*$%|``) are over ``max_marks`` of the words in the page's visible text, 0 if
    not, null for a page of fewer than ``min_words`` words."""
    seen = F.regexp_replace(html, UNREAD, " ")

    def verdict(t):
        words = F.size(F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
        marks = F.length(F.regexp_replace(t, MARKS, ""))
        return B.let(words, lambda w: F.when(w >= min_words, (marks > w * max_marks).cast("int")))
    return F.when(html.isNotNull(), B.let(seen, verdict))


def host_rules(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host, rules: array<struct<path, rule, verdict>>, the longest rule first."""
    given = [F.struct(F.lit(r.partition("/")[0]).alias("rule_host"), F.lit(r[r.find("/"):] if "/" in r else "").alias("path"),
                      F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules]
    if not given:
        return hosts.select("host", F.lit(None).cast("array<struct<path:string,rule:string,verdict:string>>").alias("rules"))
    table = hosts.sparkSession.range(1).select(F.inline(F.array(*given)))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    found = (hosts.where("host != ''").select("host", F.explode(ends).alias("rule_host")).join(table, "rule_host")
             .groupBy("host").agg(F.collect_set(F.struct(
                 (-F.length("rule")).alias("order"), (F.col("verdict") != "block").alias("mild"), "rule", "path",
                 "verdict")).alias("rules")))
    return found.select("host", F.array_sort("rules").alias("rules"))


def _spread(level: DataFrame, child: list[str], parent: list[str], name: str) -> DataFrame:
    """One row: what the fit of a level's strength needs, over its labelled children."""
    kids = level.groupBy(*parent, *child).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    above = kids.groupBy(*parent).agg(F.sum("n").alias("pn"), F.sum("bad").alias("pbad"),
                                      F.sum(F.pow("n", F.lit(2.0))).alias("squares"))
    both = kids.join(above, parent)
    share, of = F.col("bad") / F.col("n"), F.col("pbad") / F.col("pn")
    return both.agg(
        F.lit(name).alias("level"), F.count("*").alias("k"), F.sum(F.col("n") / F.col("pn")).alias("parents"),
        F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(share - of, F.lit(2.0))).alias("ssb"),
        F.sum(F.col("n") * share * (1 - share)).alias("ssw"),
        F.sum(F.col("n") / F.col("pn") * F.col("squares") / F.col("pn")).alias("squares"))


def strengths(sites: DataFrame, default: float) -> dict[str, float]:
    """Pseudo-pages of the prior at each level (three rows come to the driver)."""
    rows = _spread(sites, ["suffix"], ["root"], "suffix").unionByName(
        _spread(sites, ["domain"], ["suffix"], "domain")).unionByName(
        _spread(sites, ["site"], ["suffix", "domain"], "host")).collect()
    out = {}
    for r in rows:
        between, within = r.k - round(r.parents or 0), (r.n or 0) - r.k
        out[r.level] = default
        if between > 0 and within > 0:
            msb, msw, n0 = r.ssb / between, r.ssw / within, (r.n - r.squares) / between
            whole = msb + (n0 - 1) * msw
            rho = (msb - msw) / whole if whole > 0 else 0.0
            out[r.level] = min(max(1 / rho - 1, 1.0), 1000.0) if rho > 0 else 1000.0
    return out


def reputation(hosts: DataFrame, strength: float = 10.0, z: float = 1.645) -> DataFrame:
    """host, bad_mean, bad_bound from (host, n labelled pages, bad ones)."""
    sites = hosts.select("host", site_of(F.col("host")).alias("site"), "n", "bad")
    sites = sites.groupBy("site").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    sites = B.materialise(sites.withColumn("at", _split_site(F.col("site"))).select(
        "site", "at.*", F.lit("").alias("root"), "n", "bad"), "sites")
    s = strengths(sites, strength)
    total = sites.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total.bad or 0) + 0.5) / ((total.n or 0) + 1)
    posterior = lambda above, at: (F.col("bad") + s[at] * above) / (F.col("n") + s[at])
    of = lambda *keys: sites.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = of("suffix").select("suffix", posterior(F.lit(mean), "suffix").alias("m_suffix"))
    domains = of("suffix", "domain").join(suffixes, "suffix").select(
        "suffix", "domain", posterior(F.col("m_suffix"), "domain").alias("m_domain"))
    a = F.col("bad") + s["host"] * F.col("m_domain")
    b = F.col("n") - F.col("bad") + s["host"] * (1 - F.col("m_domain"))
    known = sites.join(domains, ["suffix", "domain"]).select("site", a.alias("a"), b.alias("b"))
    size = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    known = known.select("site", (F.col("a") / size).alias("bad_mean"), (F.col("a") / size - z * sd).alias("bad_bound"))
    return hosts.select("host", site_of(F.col("host")).alias("site")).join(known, "site").drop("site")


def judge(pages: DataFrame, url_col: str = "url", outcome_col: Column | str = "outcome",
          rules: list[tuple[str, str]] = (), max_bad: float = 0.2, strength: float = 10.0,
          z: float = 1.645) -> DataFrame:
    """pages with host, path, rule, bad_mean, bad_bound (of the host) and verdict.

    Pages without any labelled outcome in the whole table have a prior of one half and no
    evidence; they are allowed."""
    url = F.col(url_col).cast("string")
    label = F.col(outcome_col) if isinstance(outcome_col, str) else outcome_col
    hosts = pages.select(host_of(url).alias("host"), label.cast("long").alias("o")).groupBy("host").agg(
        F.count("o").alias("n"), F.coalesce(F.sum("o"), F.lit(0)).alias("bad"))
    hosts = B.materialise(hosts, "hosts")
    labelled = bool(hosts.agg(F.sum("n").alias("n")).first().n)
    known = reputation(hosts, strength, z).join(host_rules(hosts, list(rules)), "host", "left").select(
        F.col("host").alias("__host"), "bad_mean", "bad_bound", F.col("rules").alias("__rules"))
    kept = pages.drop(*RESULTS).withColumns({"host": host_of(url), "path": path_of(url)})
    fits = F.get(F.filter("__rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    bad = (F.col("bad_bound") > max_bad) & F.lit(labelled)
    out = kept.join(known, F.col("host") == F.col("__host")).withColumn("__fit", fits)
    return out.withColumns({"rule": F.col("__fit")["rule"], "verdict": F.coalesce(
        F.col("__fit")["verdict"], F.when(bad, "block").otherwise("allow"))}).select(*kept.columns, *RESULTS[2:])


def keep(pages: DataFrame, **params) -> DataFrame:
    """The pages that are allowed, with their own columns."""
    return judge(pages, **params).where("verdict = 'allow'").select(*pages.columns)


def digest(judged: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The query's columns from judge()."""
    return judged.select(F.col(id_col).alias("page_id"), "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
with p as (
  select page_id, html,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
seen as (
  select *, regexp_replace(html, '<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'gsi') as t from p),
told as (
  select page_id, host, path,
    case when len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= 5 then
      (length(regexp_replace(t, '[^#*$%|]', '', 'g')) > 0.1::double * len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')))::int
    end as o
  from seen),
site as (
  select regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:[0-9]*)?$', '') as site, count(o) as n,
    coalesce(sum(o), 0) as bad
  from told group by 1),
parts as (
  select *, string_split(site, '.') as l,
    (regexp_matches(site, '^[0-9.]*$|:') or len(string_split(site, '.')) < 2) as alone from site),
deep as (
  select *, (len(l) > 2 and length(l[-1]) = 2 and l[-2] in ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')) as d from parts),
s as (
  select site, n, bad,
    case when alone then site when d then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end as domain,
    case when alone then '' when d then array_to_string(l[-2:], '.') else l[-1] end as suffix
  from deep),
kids as (
  select 'suffix' as level, suffix as kid, '' as parent, sum(n) as n, sum(bad) as bad from s group by suffix
  union all select 'domain', domain, suffix, sum(n), sum(bad) from s group by domain, suffix
  union all select 'host', site, suffix || ' ' || domain, n, bad from s),
lab as (
  select *, sum(n) over w as pn, sum(bad) over w as pbad from kids where n > 0 window w as (partition by level, parent)),
fit as (
  select level, count(*) - count(distinct parent) as df, sum(n) - count(*) as wf,
    sum(n * (bad / n - pbad / pn) ** 2) as ssb, sum(n * (bad / n) * (1 - bad / n)) as ssw,
    (sum(n) - sum(n * n / pn)) as eff
  from lab group by level),
ms as (
  select level, ssb / df as msb, ssw / wf as msw, eff / df as n0 from fit where df > 0 and wf > 0),
rho as (
  select level, case when msb + (n0 - 1) * msw > 0 then (msb - msw) / (msb + (n0 - 1) * msw) else 0 end as r from ms),
strength as (
  select v.level, coalesce(case when r > 0 then least(greatest(1 / r - 1, 1), 1000) when r is not null then 1000 end, 10) as k
  from (values ('suffix'), ('domain'), ('host')) v(level) left join rho using (level)),
k as (
  select max(k) filter (level = 'suffix') as k1, max(k) filter (level = 'domain') as k2,
    max(k) filter (level = 'host') as k3 from strength),
root as (select (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) as m, coalesce(sum(n), 0) as total from s),
m1 as (select suffix, (sum(bad) + k1 * m) / (sum(n) + k1) as m1 from s, k, root group by suffix, k1, m),
m2 as (
  select domain, suffix, (sum(bad) + k2 * m1) / (sum(n) + k2) as m2 from s join m1 using (suffix), k group by domain, suffix, k2, m1),
post as (
  select site, bad + k3 * m2 as a, n - bad + k3 * (1 - m2) as b from s join m2 using (domain, suffix), k),
bound as (
  select site, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) as low from post),
rules(verdict, rule, rh, rp) as (
  values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
    ('block', 'net/fr/', 'net', '/fr/')),
places as (select distinct host, path from told),
fits as (
  select host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from places join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
  where host <> '' group by host, path)
select page_id, t.host, t.path, f.rule,
  coalesce(f.verdict, case when low > 0.2 and total > 0 then 'block' else 'allow' end) as verdict
from told t join bound b on regexp_replace(regexp_replace(t.host, '^.*@', ''), '\.?(:[0-9]*)?$', '') = b.site
  left join fits f on f.host = t.host and f.path = t.path, root
"""
