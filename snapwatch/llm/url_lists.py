"""URL filters by dated lists: every capture is judged by the entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user, port and final dot; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def lookup_keys(url: Column) -> Column:
    """Entries that may name a URL, the least specific first: its domains from two labels on, its host with each
    beginning of its path. A host of one label is its own only domain."""
    labels = F.split(host_of(url), r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.greatest(count - 1, F.lit(1)), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(labels, i, count), ".")
    )
    parts = F.array_remove(F.split(path_of(url), "/"), "")
    paths = F.when(
        F.size(parts) > 0,
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(host_of(url)) > 0, F.concat(domains, paths)).otherwise(F.array().cast("array<string>"))


def entry_of(entry: Column) -> Column:
    """An entry without blanks around it, scheme, final dot of its host and needless slashes, its host in lower case.

    What follows the first slash is a path and keeps its capitals. A path belongs to its host alone: ``ex.org/ads``
    covers ``ex.org/ads/x`` and not ``www.ex.org/ads``, while ``ex.org`` covers all its hosts.
    """
    plain = F.regexp_replace(F.trim(entry), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.substring_index(plain, "/", 1)
    path = F.regexp_replace(F.regexp_replace(F.substr(plain, F.length(host) + 1), "/+", "/"), "/$", "")
    return F.concat(F.lower(F.regexp_replace(host, r"\.$", "")), path)


def validity_intervals(changes: DataFrame) -> DataFrame:
    """``entry, verdict, valid_from, valid_to`` from the changes (entry, verdict, at) of a list.

    A change sets what an entry says from then on: ``block``, ``allow``, or NULL once it is taken off. It holds until
    the entry's next change, or without end (NULL). Of several changes of an entry at one time ``allow`` wins, then
    ``block``. Changes without an entry or a time are left out; repeated changes don't matter.
    """
    rank = F.when(F.col("verdict") == "allow", 2).when(F.col("verdict") == "block", 1).otherwise(0)
    per_time = (
        changes.where("at IS NOT NULL")
        .select(entry_of(F.col("entry")).alias("entry"), "at", "verdict")
        .where("entry <> ''")
        .groupBy("entry", "at")
        .agg(F.max(F.struct(rank.alias("rank"), "verdict"))["verdict"].alias("verdict"))
    )
    history = Window.partitionBy("entry").orderBy("at")
    spans = per_time.select("entry", "verdict", F.col("at").alias("valid_from"), F.lead("at").over(history).alias("valid_to"))
    return spans.where(F.col("verdict").isin("block", "allow"))


def judge_captures(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``page_id, url, fetched_at, host, blocked, n_active, entry, listed_at``, one row per row of ``captures``.

    Every distinct (url, fetched_at) is joined as of its time to the entries it could be named by. The most specific
    active entry decides, of equal ones ``allow``; ``entry`` and ``listed_at`` say which and since when, ``n_active`` how
    many were active. A capture that no active entry names, with a NULL or odd URL or without a time, is not
    blocked. Repeated rows are judged alike; empty tables give no rows, an empty list blocks nothing.

    Only what an entry names is kept by the join on the entry, which Spark splits where a host has a great part of
    the captures; an entry's intervals don't overlap, so a capture meets one of them at most.
    """
    chosen = captures.select("page_id", "url", "fetched_at")
    asked = chosen.where("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct()
    asked = asked.select("url", "fetched_at", F.posexplode(lookup_keys(F.col("url"))).alias("depth", "entry"))
    active = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    met = asked.join(validity_intervals(changes), "entry").where(active)
    best = F.max(F.struct("depth", (F.col("verdict") == "allow").alias("allow"), "entry", "valid_from"))
    verdicts = met.groupBy("url", "fetched_at").agg(best.alias("best"), F.count("*").alias("n_active"))
    return chosen.join(verdicts, ["url", "fetched_at"], "left").select(
        "page_id",
        "url",
        "fetched_at",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(~F.col("best.allow"), F.lit(False)).alias("blocked"),
        F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"),
        F.col("best.entry").alias("entry"),
        F.col("best.valid_from").alias("listed_at"),
    )
