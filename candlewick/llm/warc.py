"""Not-modified revisits of web archives, resolved against full responses.

A server's 304 answer is archived as a ``revisit`` record without a body.
``resolve_revisits`` finds, by an as-of join on the canonical URL, the
latest earlier full response, checks the validators and merges the headers:

* strictly earlier: a response of the same second does not count; of several
  at one time the one with the largest record id does;
* entity tags are compared weakly (``W/`` dropped); without a tag on both
  sides, Last-Modified must agree; a revisit without any validator that the
  response has as well is not resolved;
* headers of the 304 replace the stored ones of that name, but for those
  that describe the body or the connection.

The as-of join is two-level, so a URL that holds a third of all records is
split by time: the last response of each (URL, day) is a pre-aggregated
table over whose days a value is carried forward, and inside a day a window
looks back, falling back on what was carried in.

Null URL or time: the record matches nothing, and a revisit with it is
``no_earlier_response``.  Repeated rows stay.  An empty table gives an empty
table.  The input columns are named by arguments and renamed at once, so
others cannot clash; they are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Header names that a 304 must not change.
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that do not name another page.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid"
BUCKET_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` or a default port, path without a
    trailing slash, sorted query without tracking parameters, no scheme and
    no fragment."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(rf"^(?i:{TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def parse_headers(block: Column) -> Column:
    """Header block (``Name: value`` lines) as a map with lower-case names;
    of repeated names the last line counts."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^:\s]+:"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.regexp_extract(x, r"^([^:]+):", 1)).alias("name"),
                                                  F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(
        F.filter(pairs, lambda p: p["name"] == n), -1)["value"]))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame, record_id: str = "record_id", kind: str = "kind", url: str = "url",
                     time: str = "time", headers: str = "headers", bucket: int = BUCKET_SECONDS) -> DataFrame:
    """One row per record of kind ``revisit``: record_id, url_key, time,
    status, response_id, response_time, headers (map).

    ``kind`` is ``response`` or ``revisit`` (others are left out), ``time`` a
    timestamp, ``headers`` a raw header block.  ``status``: ``resolved``,
    ``validator_mismatch``, ``no_validator``, ``no_earlier_response``.
    """
    c = F.col
    rows = records.where(c(kind).isin("response", "revisit")).select(
        c(record_id).alias("_id"), (c(kind) == "response").alias("_full"), canonical_url(c(url)).alias("_key"),
        c(time).alias("_t"), parse_headers(c(headers)).alias("_h"))
    rows = rows.withColumn("_day", F.floor(F.unix_timestamp("_t") / bucket))
    full = F.when(c("_full"), F.struct("_t", "_id", F.to_json("_h").alias("h")))
    last = F.max(full)      # by time, then record id
    by_day = (rows.where(c("_full") & c("_key").isNotNull() & c("_t").isNotNull())
              .groupBy("_key", "_day").agg(last.alias("_last")))
    days = by_day.unionByName(rows.where(~c("_full") & c("_key").isNotNull() & c("_t").isNotNull()).select("_key", "_day").distinct(),
                              allowMissingColumns=True).groupBy("_key", "_day").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("_key", "_day", F.max("_last").over(before).alias("_carried"))
    # at one time revisits come first, so they do not see the responses of that second
    inside = (Window.partitionBy("_key", "_day").orderBy("_t", "_full", "_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    seen = rows.where(c("_key").isNotNull() & c("_t").isNotNull()).withColumn("_near", F.max(full).over(inside)).where(~c("_full"))
    joined = seen.join(carried, ["_key", "_day"], "left")
    lost = rows.where(~c("_full") & (c("_key").isNull() | c("_t").isNull()))
    out = joined.unionByName(lost, allowMissingColumns=True).withColumn("_r", F.coalesce("_near", "_carried"))
    out = out.withColumn("_old", F.from_json("_r.h", "map<string,string>"))
    new, old = c("_h"), c("_old")
    tags = _tag(new).isNotNull() & _tag(old).isNotNull()
    dates = new["last-modified"].isNotNull() & old["last-modified"].isNotNull()
    status = (F.when(c("_r").isNull(), "no_earlier_response")
              .when(tags, F.when(_tag(new) == _tag(old), "resolved").otherwise("validator_mismatch"))
              .when(dates, F.when(new["last-modified"] == old["last-modified"], "resolved").otherwise("validator_mismatch"))
              .otherwise("no_validator"))
    changes = F.map_filter(new, lambda k, _: ~k.isin(*NOT_MERGED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(changes, k)), changes)
    return out.withColumn("status", status).select(
        c("_id").alias("record_id"), c("_key").alias("url_key"), c("_t").alias("time"), "status",
        F.when(c("status") == "resolved", c("_r._id")).alias("response_id"),
        F.when(c("status") == "resolved", c("_r._t")).alias("response_time"),
        F.when(c("status") == "resolved", merged).alias("headers"))
