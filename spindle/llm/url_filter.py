"""URL filters with dated lists, by a temporal join.

List entries are dated: from a day on, a pattern (a host, or a host with the beginning of
a path) is blocked, allowed, or no longer listed. The last entry of a pattern on a day
counts; an entry is valid from its day until the pattern's next one. Every capture is
held against the entries valid on the day it was fetched: it looks up its host, the
host's parent domains and each beginning of its path, the longest matching pattern
decides (a longer host before a longer path), and a capture with none is allowed. Entries
are read like captures: without scheme, user, port, leading ``www.``, query, fragment and
closing slash, in lower case.

Only built-in functions. Equal captures (same address, same day) are judged once. A
pattern's history is bounded by days, so the window over it is too; the lookup joins many
captures of one host with that host's few intervals, and Spark splits a hot host's side.

Defined cases: a null or hostless address matches nothing and is allowed; a null day
matches no interval; entries with a null or empty pattern or a null day are void; of
contradicting entries of a pattern and day the strictest counts (block, allow, none);
repeated captures are all returned; empty tables give empty results or an empty list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spindle.llm.common import saved

#: What an entry can do, the strictest first.
ACTIONS = ("block", "allow", "none")


def host_of(url: Column) -> Column:
    """The host in lower case, without user (up to the last ``@``), port, leading ``www.`` or
    closing dot; an address in brackets whole."""
    h = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                 r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]*)", 1))
    return F.regexp_replace(h, r"^www\.|\.$", "")


def path_of(url: Column) -> Column:
    """The path, without query and fragment; at least ``/``."""
    p = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)", 1)
    return F.when(p == "", "/").otherwise(p)


def lookup_keys(host: Column, path: Column, depth: int) -> Column:
    """Patterns that would cover the address, longest first: for the host and each parent
    domain of two labels or more, the beginnings of the path of up to ``depth`` parts (of the
    deepest pattern listed) and the bare host."""
    # numeric addresses have no parent domains
    labels = F.when(host.rlike(r"^(\[.*|[0-9]+(\.[0-9]+){3})$"), F.array(host)).otherwise(F.split(host, r"\."))
    n = F.size(labels)
    hosts = F.when(host == "", F.array().cast("array<string>")).when(n < 2, F.array(host)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                    lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")))
    steps = F.slice(F.filter(F.split(path, "/"), lambda s: s != ""), 1, depth)
    starts = F.transform(F.reverse(F.sequence(F.lit(0), F.size(steps))),
                         lambda i: F.when(i == 0, F.lit("")).otherwise(
                             F.concat(F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))))
    return F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda s: F.concat(h, s))))


def pattern_of(entry: Column) -> Column:
    """A listed pattern in the form of lookup keys: its host and path as a capture's, with or
    without a scheme, and no closing or repeated slashes."""
    listed = F.trim(entry)
    address = F.when(listed.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"), listed).otherwise(F.concat(F.lit("//"), listed))
    host = host_of(address)
    steps = F.filter(F.split(F.lower(path_of(address)), "/"), lambda s: s != "")
    return F.when(host == "", "").otherwise(F.array_join(F.concat(F.array(host), steps), "/"))


def validity(entries: DataFrame) -> DataFrame:
    """``pattern, action, valid_from, valid_to`` (exclusive, null: still valid) from rows
    ``pattern, action, listed_on``; only intervals that block or allow."""
    strict = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    daily = (entries.withColumn("pattern", pattern_of(F.col("pattern")))
             .where((F.col("pattern") != "") & F.col("listed_on").isNotNull() & (strict > 0))
             .groupBy("pattern", "listed_on").agg(F.min(strict).alias("strict")))
    after = F.lead("listed_on").over(W.partitionBy("pattern").orderBy("listed_on"))
    return (daily.withColumn("valid_to", after)
            .select("pattern", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("strict").cast("int")).alias("action"),
                    F.col("listed_on").alias("valid_from"), "valid_to")
            .where(F.col("action") != "none"))


def filter_captures(captures: DataFrame, entries: DataFrame, url_col: str = "url",
                    day_col: str = "fetched_on") -> DataFrame:
    """All rows and columns of ``captures`` plus ``host``, ``n_matches`` (valid entries that
    cover the address), ``pattern``, ``listed_on`` (of the entry that decides) and ``blocked``."""
    own = [c for c in captures.columns if c.lower() not in ("host", "n_matches", "pattern", "listed_on", "blocked")]
    url, day = F.col(url_col), F.col(day_col)
    # written, so that Spark knows the size and can split a hot host's captures from its intervals
    v = saved(validity(entries), "url-validity")
    depth = v.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    asked = (captures.select(url.alias("u"), day.alias("d")).distinct()
             .select("u", "d", F.posexplode(lookup_keys(host_of(F.col("u")), F.lower(path_of(F.col("u"))), depth))
                     .alias("place", "key")))
    hits = saved(asked.join(v, (F.col("key") == F.col("pattern")) & (F.col("d") >= F.col("valid_from"))
                       & (F.col("valid_to").isNull() | (F.col("d") < F.col("valid_to"))))
            .groupBy("u", "d").agg(F.count("*").alias("n_matches"),
                                   F.min(F.struct("place", "pattern", "valid_from", "action")).alias("best")), "url-hits")
    return (captures.select(*own)
            .join(hits, (url == F.col("u")) & (day == F.col("d")), "left")
            .select(*own, host_of(url).alias("host"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
                    F.col("best.pattern").alias("pattern"), F.col("best.valid_from").alias("listed_on"),
                    F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked")))
