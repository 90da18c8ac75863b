"""URL filter lists that change over time.

Dated list entries (a key added or removed on a day) become validity intervals, and each capture is
judged by the entries in force on the day it was fetched. Keys are a whole address without query
("u:host/path") or a host with all its names ("h:example.com" also covers "a.example.com"). Of the
entries in force the most specific decides; at equal length, blocking wins.

The as-of join runs on distinct (key, day) pairs, not on captures: a host with a third of all pages
is a few hundred pairs, and its pages are then spread over the days when they fetch their verdict.

An address that is null or has no host matches nothing and is allowed. Captures without a day match
nothing. Several entries for a key on one day: a removal comes last. Rows stay separate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, ADDRESS, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, ADDRESS, 2)


def keys(url: Column) -> Column:
    """``key, names, whole`` of everything an entry for this address could be listed under."""
    names = F.split(host(url), r"\.")
    count = F.size(names)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), count - 1)),
        lambda i: F.struct(
            F.concat(F.lit("h:"), F.array_join(F.slice(names, i, count), ".")).alias("key"),
            (count - i + 1).alias("names"), F.lit(0).alias("whole"),
        ),
    )
    address = F.struct(
        F.concat(F.lit("u:"), host(url), path(url)).alias("key"), count.alias("names"), F.lit(1).alias("whole")
    )
    return F.when(host(url) != "", F.concat(suffixes, F.array(address)))


def validity(entries: DataFrame) -> DataFrame:
    """``key, verdict, valid_from, valid_to`` (end excluded) from ``key, verdict, action, listed_on``.

    An entry holds from its day to the next entry for the same key and verdict.
    """
    order = Window.partitionBy("key", "verdict").orderBy("listed_on", F.col("action") == "remove")
    ends = F.coalesce(F.lead("listed_on").over(order), F.to_date(F.lit(FOREVER)))
    spans = entries.where("key IS NOT NULL AND listed_on IS NOT NULL").distinct().withColumn("valid_to", ends)
    return spans.where("action = 'add' AND valid_to > listed_on").select(
        "key", "verdict", F.col("listed_on").alias("valid_from"), "valid_to"
    )


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, fetched_on, verdict, key, valid_from`` for captures ``page_id, url, fetched_on``."""
    given = captures.select("page_id", "url", "fetched_on", F.monotonically_increasing_id().alias("row"))
    asked = given.select("row", "page_id", "url", "fetched_on", F.explode_outer(keys(F.col("url"))).alias("k")).select(
        "row", "page_id", "url", "fetched_on", "k.*"
    )
    pairs = captures.select("fetched_on", F.explode(keys(F.col("url"))).alias("k")).select("k.key", "fetched_on").distinct()
    in_force = pairs.join(validity(entries), "key").where(
        (F.col("fetched_on") >= F.col("valid_from")) & (F.col("fetched_on") < F.col("valid_to"))
    )
    stronger = F.struct((F.col("verdict") == "block").alias("blocks"), "verdict", "valid_from")
    in_force = in_force.groupBy("key", "fetched_on").agg(F.max(stronger).alias("entry"))
    found = asked.join(in_force, ["key", "fetched_on"], "left")
    best = F.max(F.when(F.col("entry").isNotNull(), F.struct("whole", "names", "key", "entry"))).alias("best")
    judged = found.groupBy("row", "page_id", "url", "fetched_on").agg(best)
    return judged.select(
        "page_id", "url", "fetched_on",
        F.coalesce("best.entry.verdict", F.lit("allow")).alias("verdict"),
        F.col("best.key").alias("key"), F.col("best.entry.valid_from").alias("valid_from"),
    )
