"""URL filter: fixed rules first, then empirical-Bayes host reputation, in Spark functions only.

A rule (action, host, path) fits its host and all subdomains where the url's path starts with the
rule's; of several the longest (host and path together) wins.  Pages that no rule fits are judged by
what is known of their host.  Labelled page outcomes (bad or not) are counted by host, registered
domain and suffix.  On each level a beta-binomial prior says how far rates of siblings differ: its
strength comes from the moments of their counts, its mean from the level above.  So a host's rate
is shrunk towards its domain's, which is shrunk towards its suffix's, and that towards the rate of
all pages; what a unit itself contributed is taken out of the level above before that serves as its
prior.  A host is blocked where the lower bound of its posterior rate exceeds ``BLOCK_RATE``.
Hosts that were never labelled are judged by the same formula, from their domain and suffix.

Pages are read for their ids and urls only; counts are combined before the shuffle.  Known hosts are
joined back by keys: where Spark doesn't find their table small enough to send to every task, it
splits a host that holds a third of all pages over several tasks.

Null urls and urls without ``://`` have an empty host and path, which is a host like any other; an
empty host is its own domain and suffix.  Hosts of any length are taken whole.  Repeated pages and
repeated outcomes of one id each count: a page is bad if any of its outcomes is.  Null ids have no
outcome.  With no outcome at all nothing is blocked but by rules.  An empty table gives no row.
Columns to keep that bear the name of a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import read
from rosterloom.session import cut_lineage

#: (action, host, path); the query's rules.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Rules become one column expression, so a list is bounded.
MOST_RULES = 1000
#: Suffixes of two labels under which names are registered; all others have one label.
SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au",
            "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "edu.au", "gov.uk", "net.au",
            "ne.jp", "or.jp", "org.au", "org.uk"]
#: A host is blocked where its rate of bad pages lies above this, by so many standard deviations.
BLOCK_RATE, DEVIATIONS = 0.5, 1.645
#: Bounds of a prior's strength, in pages; the upper one also stands where rates don't differ.
WEAKEST, STRONGEST = 1.0, 1000.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ["host", "path", "rule", "verdict", "host_labelled", "host_bad"]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The winning rule as text and its action; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    if len(ordered) > MOST_RULES:
        raise ValueError(f"{len(ordered)} rules; a list has {MOST_RULES} at most")
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in reversed(ordered):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        action = F.when(fits, F.lit(kind)).otherwise(action)
    return text, action


def domain_of(host: Column, suffixes: list[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix; addresses and hosts of one label are their own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    suffix = F.when(two.isin(suffixes), two).otherwise(F.substring_index(bare, ".", -1))
    address = bare.rlike(r"^[0-9.]+$") | bare.startswith("[")
    domain = F.when(two.isin(suffixes), F.substring_index(bare, ".", -3)).otherwise(two)
    return F.when(address, bare).otherwise(domain), F.when(address, F.lit("")).otherwise(suffix)


def strength(units: DataFrame) -> float:
    """Strength (alpha + beta) of the beta prior of units with n pages, k of them bad.

    The correlation inside units is estimated from the variance between and within them.
    """
    n, k = F.col("n"), F.col("k")
    m, total, bad, squares, own = units.where("n > 0").agg(
        F.count("*"), F.sum("n"), F.sum("k"), F.sum(n * n), F.sum(k * k / n)).first()
    if m < 2 or total <= m:
        return STRONGEST
    between = (own - bad * bad / total) / (m - 1)
    within = (bad - own) / (total - m)
    usual = (total - squares / total) / (m - 1)
    whole = between + (usual - 1) * within
    if whole <= 0 or between - within <= whole / (1 + STRONGEST):
        return STRONGEST
    return max(WEAKEST, whole / (between - within) - 1)


def reputations(hosts: DataFrame, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """(host, n, k, rate, bound): posterior mean and lower bound of each host's bad rate.

    ``hosts`` has one row a host: its labelled pages n, and k bad ones among them.
    """
    domain, suffix = domain_of(F.col("host"), suffixes)
    hosts = cut_lineage(hosts.select("host", "n", "k", domain.alias("domain"),
                                     suffix.alias("suffix")))
    domains = cut_lineage(hosts.groupBy("suffix", "domain").agg(
        F.sum("n").alias("dn"), F.sum("k").alias("dk")))
    tops = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    n, k = tops.agg(F.coalesce(F.sum("sn"), F.lit(0)), F.coalesce(F.sum("sk"), F.lit(0))).first()
    of_suffix, of_domain, of_host = (strength(x) for x in (
        tops.select(F.col("sn").alias("n"), F.col("sk").alias("k")),
        domains.select(F.col("dn").alias("n"), F.col("dk").alias("k")), hosts))
    col = F.col
    top = (n - col("sn"), k - col("sk"))
    rest_of_suffix = (col("sn") - col("dn"), col("sk") - col("dk"))
    rest_of_domain = (col("dn") - col("n"), col("dk") - col("k"))
    mean = (top[1] + 1) / (top[0] + 2)
    mean = (of_suffix * mean + rest_of_suffix[1]) / (of_suffix + rest_of_suffix[0])
    mean = (of_domain * mean + rest_of_domain[1]) / (of_domain + rest_of_domain[0])
    size = of_host + col("n")
    rate = (of_host * mean + col("k")) / size
    return (hosts.join(domains, ["suffix", "domain"]).join(tops, "suffix")
            .withColumn("rate", rate)
            .withColumn("bound", col("rate") - DEVIATIONS * F.sqrt(
                col("rate") * (1 - col("rate")) / (size + 1)))
            .select("host", "n", "k", "rate", "bound"))


def judged(pages: DataFrame, outcomes: DataFrame, keep: list[str], url: str = "url",
           id_column: str = "page_id", rules: Iterable[tuple[str, str, str]] = RULES,
           block_rate: float = BLOCK_RATE) -> DataFrame:
    """The kept columns of every page with host, path, rule, verdict and the host's counts.

    ``outcomes`` has (id, bad): labelled pages by id.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    seen = outcomes.where("id is not null and bad is not null").groupBy("id").agg(
        F.max("bad").alias("bad"))
    labelled = pages.select(F.col(id_column).alias("id"), host.alias("host")).join(seen, "id")
    counts = labelled.groupBy("host").agg(F.count("*").alias("n"),
                                          F.count_if("bad").alias("k"))
    hosts = pages.select(host.alias("host")).distinct().join(counts, "host", "left").select(
        "host", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.coalesce("k", F.lit(0)).cast("long").alias("k"))
    known = cut_lineage(reputations(hosts))
    # Hosts that nobody labelled and that are not blocked need no row: the rest says so.
    told = known.where((F.col("bound") > block_rate) | (F.col("n") > 0)).select(
        "host", F.col("n").alias("host_labelled"), F.col("k").alias("host_bad"),
        (F.col("bound") > block_rate).alias("__blocked"))
    kept = [c for c in keep if c not in RESULT]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    text, action = ruled(F.col("host"), F.col("path"), rules)
    return rows.join(told, "host", "left").select(
        *kept, "host", "path", text.alias("rule"),
        F.coalesce(action, F.when(F.coalesce("__blocked", F.lit(False)), "block")
                   .otherwise("allow")).alias("verdict"),
        F.coalesce("host_labelled", F.lit(0)).cast("long").alias("host_labelled"),
        F.coalesce("host_bad", F.lit(0)).cast("long").alias("host_bad"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """A page's outcome is the label of the document with its id: bad if of low quality or toxic."""
    return labels.where("quality is not null or toxic is not null").select(
        F.col("doc_id").alias("id"),
        (F.coalesce(F.col("quality") == 0, F.lit(False))
         | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))


def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    labels = read(spark, folder, "labels", "doc_id", "quality", "toxic")
    return judged(read(spark, folder, "pages", "page_id", "url"), page_outcomes(labels),
                  ["page_id"])


def oracle(rules: Iterable[tuple[str, str, str]] = RULES) -> str:
    """The query as DuckDB SQL."""
    values = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in rules)
    two = ", ".join(f"'{s}'" for s in SUFFIXES)

    def fitted(name: str, units: str, n: str, k: str) -> str:
        return f"""{name} as (
  select case when m < 2 or t <= m then {STRONGEST}
              when w <= 0 or b - i <= w / (1 + {STRONGEST}) then {STRONGEST}
              else greatest({WEAKEST}, w / (b - i) - 1) end as s
  from (select *, b + ((t - sq / t) / (m - 1) - 1) * i as w
    from (select *, (own - k * k / t) / nullif(m - 1, 0) as b, (k - own) / nullif(t - m, 0) as i
      from (select count(*)::double as m, sum({n})::double as t, sum({k})::double as k,
                   sum({n} * {n})::double as sq, sum({k} * {k} / {n}::double) as own
            from {units} where {n} > 0))))"""

    return f"""
with rules(action, host, path) as (values {values}),
urls as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}',
                            '{LOWER}') as host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path from pages),
outcomes as (
  select doc_id as id, bool_or(coalesce(quality = 0, false) or coalesce(toxic = 1, false)) as bad
  from labels where doc_id is not null and (quality is not null or toxic is not null) group by 1),
bare as (
  select host, count(id) as n, count(*) filter (bad) as k,
         regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare
  from urls left join outcomes on page_id = id group by host),
parts as (select *, string_split(bare, '.') as p,
                 array_to_string(string_split(bare, '.')[-2:], '.') as two,
                 regexp_matches(bare, '^[0-9.]+$') or starts_with(bare, '[') as address from bare),
hosts as (
  select host, n, k,
    case when address then bare when two in ({two}) then array_to_string(p[-3:], '.')
         else two end as domain,
    case when address then '' when two in ({two}) then two else p[-1] end as suffix from parts),
domains as (select suffix, domain, sum(n) as dn, sum(k) as dk from hosts group by 1, 2),
tops as (select suffix, sum(dn) as sn, sum(dk) as sk from domains group by 1),
everything as (select sum(sn) as tn, sum(sk) as tk from tops),
{fitted("of_suffix", "tops", "sn", "sk")},
{fitted("of_domain", "domains", "dn", "dk")},
{fitted("of_host", "hosts", "n", "k")},
rated as (
  select host, n, k, c.s + n as size,
    (c.s * ((b.s * ((a.s * ((tk - sk + 1)::double / (tn - sn + 2)) + sk - dk) / (a.s + sn - dn))
      + dk - k) / (b.s + dn - n)) + k) / (c.s + n) as rate
  from hosts join domains using (suffix, domain) join tops using (suffix), everything,
       of_suffix a, of_domain b, of_host c),
ranked as (
  select host, path, r_host || r_path as rule, action from (
    select u.host, u.path, r.host as r_host, r.path as r_path, r.action,
      row_number() over (partition by u.host, u.path order by length(r.host || r.path) desc,
                         length(r.host) desc, r.action <> 'block') as place
    from (select distinct host, path from urls) u join rules r
      on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path))
  where place = 1)
select page_id, u.host, u.path, r.rule, coalesce(r.action, case
    when rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (size + 1)) > {BLOCK_RATE} then 'block'
    else 'allow' end) as verdict, n::bigint as host_labelled, k::bigint as host_bad
from urls u join rated using (host) left join ranked r on u.host = r.host and u.path = r.path
"""
