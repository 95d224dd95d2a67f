"""URL filters as a temporal list join.

List entries are dated events: on a day a host is added to a list or removed
from it. Per list and host the events become validity intervals, and an as-of
join looks every capture up among the entries active when it was fetched. A
capture matches an entry of its host or of any parent domain.

Captures are looked up once per distinct (host, fetch time), so a host with a
third of all pages costs a few rows in the join with the lists; the verdicts
come back by a plain equi-join, which Spark may split where it is skewed.

Defined results: a URL without a host (null, empty, no scheme) and a capture
without a fetch time match nothing. Events without list, host or day are
ignored; of events of one list, host and day the removal wins. Repeated
captures get one verdict each; empty lists block nothing; an empty table gives
an empty result. Extra columns of captures pass through ``filter_urls``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import query, read


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and trailing dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#\\]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))
    return F.when(host != "", host)


def parents(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
                       lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def validity(events: DataFrame) -> DataFrame:
    """Intervals [since, until) in which a host is on a list, from events (list, host, day, action).

    ``until`` is null while the entry stands; ``action`` is "add" or "remove".
    """
    clean = events.filter("list is not null and host is not null and day is not null and action in ('add', 'remove')")
    # Of one day's events the removal wins; an add to what is on the list already changes nothing.
    clean = clean.groupBy("list", F.lower("host").alias("host"), "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "host").orderBy("day")
    changed = clean.withColumn("last", F.lag("action").over(order)).filter("last is null or last != action")
    return (changed.withColumn("until", F.lead("day").over(order)).filter("action = 'add'")
            .select("list", "host", F.col("day").alias("since"), "until"))


def filter_urls(captures: DataFrame, events: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Every capture as the struct ``row``, with host, blocked, and the lists that block it (sorted)."""
    rows = captures.select(F.struct("*").alias("row"), host_of(F.col(url_col)).alias("host"), F.col(time_col).alias("fetched"))
    asked = rows.filter("host is not null and fetched is not null").select("host", "fetched").distinct()
    asked = asked.select("host", "fetched", F.explode(parents("host")).alias("domain"))
    entries = validity(events).withColumnRenamed("host", "domain")
    hits = (asked.join(entries, "domain").filter("since <= fetched and (until is null or fetched < until)")
            .groupBy("host", "fetched").agg(F.array_sort(F.collect_set("list")).alias("lists")))
    return rows.join(hits, ["host", "fetched"], "left").select(
        "row", "host", F.col("lists").isNotNull().alias("blocked"), F.coalesce("lists", F.array().cast("array<string>")).alias("lists"))


def derived_events(pages: DataFrame) -> DataFrame:
    """List events for half of the hosts and domains of ``pages``: added, then for some removed, then added again."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    names = hosts.select(F.explode(parents("host")).alias("host")).distinct()
    number = F.conv(F.substring(F.md5("host"), 1, 4), 16, 10).cast("int")
    day = lambda n: F.date_add(F.to_date(F.lit("2024-01-01")), n)
    lists = names.withColumn("n", number).filter("n % 4 < 2").withColumn("list", F.when(F.col("n") % 2 == 0, "spam").otherwise("adult"))
    return (lists.select("list", "host", F.explode(F.array(
        F.struct(day(F.col("n") % 200).alias("day"), F.lit("add").alias("action")),
        F.struct(day(F.col("n") % 200 + 60).alias("day"), F.when(F.col("n") % 3 > 0, "remove").otherwise("add").alias("action")),
        F.struct(day(F.col("n") % 200 + 120).alias("day"), F.lit("add").alias("action")))).alias("e"))
        .select("list", "host", "e.*"))


ORACLE = r"""
with h as (
  select page_id, url, date '2024-01-01' + (page_id % 366)::int as fetched,
         nullif(lower(regexp_replace(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#\\]*)', 1), '^.*@', ''), '\.?(:[0-9]*)?$', '')), '') as host
  from pages),
p as (
  select distinct host, array_to_string(l[i:], '.') as domain
  from (select host, string_split(host, '.') as l, unnest(range(1, greatest(2, len(string_split(host, '.'))))) as i
        from (select distinct host from h where host is not null))),
n as (select domain, ('0x' || substr(md5(domain), 1, 4))::int as n from (select distinct domain from p)),
e as (
  select domain, case when n % 2 = 0 then 'spam' else 'adult' end as list, unnest([n % 200, n % 200 + 60, n % 200 + 120]) as d,
         unnest(['add', case when n % 3 > 0 then 'remove' else 'add' end, 'add']) as action
  from n where n % 4 < 2),
v as (select h.page_id, e.list, max_by(action, d) as state
      from h join p using (host) join e using (domain) where date '2024-01-01' + d::int <= fetched group by h.page_id, e.list, e.domain),
b as (select page_id, string_agg(distinct list, ',' order by list) as lists from v where state = 'add' group by page_id)
select page_id, host, fetched, lists is not null as blocked, coalesce(lists, '') as lists from h left join b using (page_id)
"""


@query("op8_url_filter", oracle=ORACLE)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: is its host or a parent domain on a list on the day it was fetched?"""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.to_date(F.lit("2024-01-01")), F.pmod("page_id", F.lit(366)).cast("int"))
    found = filter_urls(pages.withColumn("fetched", fetched), derived_events(pages))
    return found.select("row.page_id", "host", "row.fetched", "blocked", F.array_join("lists", ",").alias("lists"))
