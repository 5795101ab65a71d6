"""URL filters whose lists change over time.

Dated entries (listed or lifted, per host or path) become validity intervals. An as-of join finds,
for each capture and each name under which an entry could cover it, the interval that holds at
fetch time: its host and every parent domain, and the host with each prefix of its path.

Defined cases. An entry counts from its time on, up to the next entry of the same list and name;
of several at one time, the lifting one counts. Entries without list, name or time are ignored, and
so are repeated ones. A capture without URL or time is covered by nothing. Hosts are compared in
lower case without port and a dot at the end. Repeated captures are judged each. Other columns stay;
columns of the output names are replaced. Empty tables give empty tables, or captures without hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import saved


def host(url: Column) -> Column:
    bare = F.regexp_replace(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.lower(F.regexp_extract(bare, r"(?s)^(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::\d*)?(?:[/?#].*)?$", 1))


def path(url: Column) -> Column:
    """From the first slash, without query and fragment."""
    bare = F.regexp_replace(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_extract(bare, r"(?s)^[^/?#]*(/[^?#]*)?", 1)


def names(url: Column) -> Column:
    """All names under which an entry covers the URL, distinct."""
    labels, steps = F.split(host(url), r"\."), F.split(path(url), "/")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))),
        lambda k: F.concat(host(url), F.array_join(F.slice(steps, F.lit(1), k), "/")))
    return F.array_distinct(F.filter(
        F.concat(domains, F.when(F.size(steps) > 1, prefixes).otherwise(F.array())), lambda n: n != ""))


def validity(entries: DataFrame) -> DataFrame:
    """(list, name, since, until) of the times an entry holds, from (list, name, changed, listed).

    Entries of one time are one, so the window over a name holds its changes only.
    """
    known = entries.where("list IS NOT NULL AND name IS NOT NULL AND changed IS NOT NULL").groupBy("list", "name", "changed").agg(
        F.min(F.coalesce("listed", F.lit(False))).alias("listed"))
    by_name = Window.partitionBy("list", "name").orderBy("changed")
    changes = known.withColumn("before", F.lag("listed").over(by_name)).where(
        F.col("before").isNull() | (F.col("before") != F.col("listed")))
    return (
        changes.withColumn("until", F.lead("changed").over(by_name)).where("listed")
        .select("list", "name", F.col("changed").alias("since"), "until")
    )


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", time: str = "fetched") -> DataFrame:
    """``captures`` with ``hits``, the sorted distinct (list, name) that hold at fetch time, and ``blocked``.

    Captures of one name are joined with its intervals. These are written first, so their true
    size is known: they are broadcast where small, and beyond that the adaptive planner
    splits the captures of a hot host. Captures themselves are joined back by URL and time.
    """
    base = captures.drop("hits", "blocked")
    intervals = saved(validity(entries), "intervals")
    # What is judged is a URL at a time; captures of one URL at one time are judged once.
    asked = base.select(F.col(url).alias("__url"), F.col(time).alias("__time")).where(
        "__url IS NOT NULL AND __time IS NOT NULL").distinct()
    asked = asked.select("__url", "__time", F.explode(names(F.col("__url"))).alias("name"))
    held = asked.join(intervals, "name").where(
        (F.col("__time") >= F.col("since")) & (F.col("until").isNull() | (F.col("__time") < F.col("until"))))
    hits = held.groupBy("__url", "__time").agg(F.array_sort(F.collect_set(F.struct("list", "name"))).alias("hits"))
    none = F.array().cast("array<struct<list: string, name: string>>")
    found = base.join(hits, (base[url] == F.col("__url")) & (base[time] == F.col("__time")), "left")
    return found.drop("__url", "__time").withColumn("hits", F.coalesce("hits", none)).withColumn(
        "blocked", F.size("hits") > 0)
