"""Operator 5, URL filters: dated list entries become validity intervals, matched to captures by an as-of join.

DataFrame operations only.  A list's history of ``add`` and ``remove`` entries per domain is turned into intervals
[valid_from, valid_to) with a window per (list, domain); at any moment a domain has at most one interval of a list.
Captures are first reduced to distinct (host, moment) pairs, so a hot host costs the as-of join no more than its
moments, and the verdicts are joined back to all captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslab.functions.text import free_names

FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host of an http(s) URL without user, port and final dot; null where there is none."""
    raw = F.regexp_extract(F.lower(url.cast("string")), r"^[ \t]*https?://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"^.*@", ""), r":[0-9]*$", ""), r"\.$", "")
    return F.when(F.length(host) > 0, host)


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains with at least two labels (only itself for a single label)."""
    parts = F.split(host, r"\.")
    n = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, domain, valid_from, valid_to) for which a domain is on a list.

    ``entries``: list_name, domain, entry_date, action (``add`` or ``remove``).  Several entries of one day count
    as ``add`` if any of them is; entries lacking a value, or with another action, say nothing and are left out;
    repeated entries change nothing.
    """
    day = (entries.filter(F.col("action").isin("add", "remove"))
           .groupBy(F.col("list_name"), F.lower("domain").alias("domain"),
                    F.col("entry_date").cast("date").alias("valid_from"))
           .agg(F.max(F.col("action") == "add").alias("on"))
           .filter("list_name is not null and domain is not null and valid_from is not null"))
    following = Window.partitionBy("list_name", "domain").orderBy("valid_from")
    return (day.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(following), F.lit(FOREVER).cast("date")))
            .filter("on").select("list_name", "domain", "valid_from", "valid_to"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetch_date") -> DataFrame:
    """``captures`` with host, blocked, n_lists and first_list (smallest name) as of the day of the fetch.

    Every row of ``captures`` stays, with all its columns; columns of these four names are replaced.  A null or
    unusable URL, or a null day, matches no list; repeated rows get equal verdicts; ties between lists are listed
    by name.
    """
    new = ["host", "blocked", "n_lists", "first_list"]
    rows = captures.drop(*[c for c in captures.columns if c.lower() in new and c not in (url, fetched)])
    day, m_host, m_day, m_domain = free_names(captures, "day", "m_host", "m_day", "m_domain")
    rows = rows.withColumns({"host": host_of(F.col(url)), day: F.col(fetched).cast("date")})
    moments = rows.select(F.col("host").alias(m_host), F.col(day).alias(m_day)).distinct()
    hits = (moments.filter(F.col(m_host).isNotNull() & F.col(m_day).isNotNull())
            .withColumn(m_domain, F.explode(host_suffixes(F.col(m_host))))
            .join(validity_intervals(entries), (F.col(m_domain) == F.col("domain"))
                  & (F.col(m_day) >= F.col("valid_from")) & (F.col(m_day) < F.col("valid_to")))
            .groupBy(m_host, m_day)
            .agg(F.countDistinct("list_name").alias("n_lists"), F.min("list_name").alias("first_list")))
    return (rows.join(hits, (F.col("host") == F.col(m_host)) & (F.col(day) == F.col(m_day)), "left")
            .withColumns({"n_lists": F.coalesce("n_lists", F.lit(0).cast("long")),
                          "blocked": F.col("n_lists").isNotNull()})
            .drop(m_host, m_day, day))
