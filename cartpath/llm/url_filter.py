"""URL filters from dated lists: which entries were active when a page was fetched.

List entries change over time. Each change of an entry opens or closes a validity interval; a capture
asks all entries that could match its URL (its host, the parent domains, path prefixes) and takes those
whose interval holds its fetch time. DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """The lower-case host; empty where there is none, or no URL."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def intervals(changes: DataFrame) -> DataFrame:
    """Validity intervals of list entries: list_name, entry, active_from, active_to (exclusive; null is open).

    ``changes`` holds list_name, entry, changed_on and is_active. Repeated changes count once; of changes
    of one day, activation wins. Rows with a null entry or day are left out.
    """
    days = (
        changes.where("entry IS NOT NULL AND changed_on IS NOT NULL")
        .groupBy("list_name", "entry", "changed_on")
        .agg(F.max(F.coalesce("is_active", F.lit(False))).alias("is_active"))
    )
    following = F.lead("changed_on").over(Window.partitionBy("list_name", "entry").orderBy("changed_on"))
    return days.withColumn("active_to", following).where("is_active").select("list_name", "entry", F.col("changed_on").alias("active_from"), "active_to")


def lookups(url_host: Column, url_path: Column) -> Column:
    """What entries can match: the host, its parents of two labels or more, and the host with each path prefix that ends at a slash."""
    labels = F.split(url_host, r"\.")
    count = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, count), "."))
    parts = F.split(url_path, "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(url_host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))
    )
    return F.when(url_host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, F.slice(prefixes, 1, F.size(parts) - 1))))


def filter_captures(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_on and more) with ``host``, ``blocked``, ``list_name`` and ``n_entries``.

    ``list_name`` is the first in order of the lists with an active entry, ``n_entries`` the number of
    active entries. Equal url and day are looked up once and joined back, so hot pages cost one lookup and
    repeated rows all stay. A null url or day matches nothing. Added columns replace columns of their name.
    """
    names = [n for n in captures.columns if n not in ("host", "blocked", "list_name", "n_entries")]
    source = captures.select(*names)
    asked = source.groupBy("url", "fetched_on").agg(F.lit(1).alias("_one")).where("url IS NOT NULL AND fetched_on IS NOT NULL")
    keys = asked.select("url", "fetched_on", F.explode(lookups(host(F.col("url")), path(F.col("url")))).alias("entry"))
    valid = intervals(changes)
    active = (F.col("fetched_on") >= F.col("active_from")) & (F.col("active_to").isNull() | (F.col("fetched_on") < F.col("active_to")))
    hits = keys.join(valid, "entry").where(active)
    verdicts = hits.groupBy(F.col("url").alias("_url"), F.col("fetched_on").alias("_day")).agg(
        F.min("list_name").alias("list_name"), F.count("*").alias("n_entries")
    )
    joined = source.join(verdicts, (source["url"] == verdicts["_url"]) & (source["fetched_on"] == verdicts["_day"]), "left")
    return joined.select(
        *(source[n] for n in names),
        host(source["url"]).alias("host"),
        F.col("n_entries").isNotNull().alias("blocked"),
        "list_name",
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
    )


def _number(text: Column, at: int, digits: int) -> Column:
    """A number from hexadecimal digits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, digits), 16, 10).cast("int")


def derived_changes(pages: DataFrame) -> DataFrame:
    """Dated list changes derived from the hosts and path prefixes that occur in ``pages``.

    A quarter of the hosts, an eighth of the parent domains and of the first path prefixes are listed on a
    day of 2024 that their md5 tells; two thirds of these are delisted 30 to 93 days later, and half of
    them listed again after 60 more days.
    """
    seen = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).where("host <> ''")
    prefix = F.concat(F.col("host"), F.regexp_extract("path", r"^(/[^/]+/)", 1))
    kinds = F.array(
        F.struct(F.lit("hosts").alias("kind"), F.col("host").alias("entry"), F.lit(4).alias("one_in")),
        F.struct(F.lit("domains").alias("kind"), F.regexp_replace("host", r"^[^.]+\.", "").alias("entry"), F.lit(8).alias("one_in")),
        F.struct(F.lit("prefixes").alias("kind"), prefix.alias("entry"), F.lit(8).alias("one_in")),
    )
    named = seen.select(F.explode(kinds).alias("k")).select("k.*").where("kind <> 'prefixes' OR entry LIKE '%/'").distinct()
    text = F.concat("kind", F.lit(":"), "entry")
    listed = named.where(_number(text, 1, 4) % F.col("one_in") == 0)
    first = F.date_add(F.lit("2024-01-01").cast("date"), _number(text, 5, 3) % 300)
    gone = F.date_add(first, 30 + _number(text, 8, 2) % 64)
    category = F.concat("kind", F.lit("-"), F.element_at(F.array(F.lit("adult"), F.lit("ads"), F.lit("malware")), _number(text, 10, 3) % 3 + 1))
    change = F.array(
        F.struct(first.alias("changed_on"), F.lit(True).alias("is_active")),
        F.struct(F.when(_number(text, 13, 3) % 3 != 0, gone).alias("changed_on"), F.lit(False).alias("is_active")),
        F.struct(F.when(_number(text, 13, 3) % 3 == 1, F.date_add(gone, 60)).alias("changed_on"), F.lit(True).alias("is_active")),
    )
    return listed.select(category.alias("list_name"), "entry", F.explode(change).alias("c")).select("list_name", "entry", "c.*").where("changed_on IS NOT NULL")


def dated_captures(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with a fetch day of 2024 told by the page id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))
