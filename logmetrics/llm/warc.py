"""Not-modified revisits resolved against earlier full responses.

A revisit record says that a page had not changed and holds no body. It is joined to
the latest earlier full response of the same canonical URL, and then their validators
are compared: the strong or weak entity tag if both have one, else the modification
time. If they differ the revisit is reported as changed and gets no body, even if an
older response would agree. The resolved record takes the response's body and headers, with those headers that a
not-modified answer may carry replaced by the revisit's.

One URL may have a large share of all records. Its time is cut into ranges, a window
runs inside (URL, range), and one row per range carries the last response of each
range over to the next, so no task gets a whole URL.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers that a not-modified answer brings up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
SPAN_SECONDS = 86_400
CAPTURE = "record_id bigint, url string, ts timestamp, status int, headers map<string,string>, digest string"


def canonical_url(url: Column) -> Column:
    """A URL without what does not change the page.

    Scheme and host in lower case, without ``www.``, default port, user, fragment and
    a last slash; path as it is; parameters sorted, without session and tracking
    ones; http and https are one. Null stays null, text without a host is trimmed only.
    """
    text = F.trim(url)
    parts = F.regexp_extract(text, r"^(?i:https?)://(?:[^/?#@]*@)?(?:(?i:www)\.)?([^/?#]+)", 1)
    host = F.regexp_replace(F.lower(parts), r"(:80|:443|\.)+$", "")
    rest = F.regexp_replace(F.regexp_replace(text, r"^(?i:https?)://[^/?#]*", ""), r"#.*$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/+$", "")
    pairs = F.filter(
        F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~F.lower(p).rlike(r"^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sid|ref)="),
    )
    query = F.array_join(F.array_sort(pairs), "&")
    return F.when(parts == "", text).otherwise(F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case the last in order counts."""
    ordered = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(ordered, lambda e: F.lower(e["key"]))
    last = F.filter(F.transform(ordered, lambda e, i: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), i.alias("i"))),
                    lambda e: F.array_position(F.slice(names, e["i"] + 2, F.size(names)), e["key"]) == 0)
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve_revisits(records: DataFrame, span_seconds: int = SPAN_SECONDS) -> DataFrame:
    """Every revisit (status 304) with the response it stands for.

    ``records`` has ``record_id``, ``url``, ``ts``, ``status``, ``headers`` and ``digest`` (of the
    body). Full responses have status 200. Per revisit come ``record_id``, ``url_key``
    (canonical), ``ts``, ``response_id``, ``digest`` and ``headers`` (merged) and ``outcome``:

    * ``resolved``: the latest response before it agrees with its validators;
    * ``changed``: that response does not (another body was meant), nothing is merged;
    * ``unvalidated``: neither side names a validator that both have; taken as resolved;
    * ``orphan``: no response of the URL before it.

    A response at the same time counts as earlier; of several at one time that with the
    greatest id. Repeated records count once each. Revisits without URL or time are
    orphans; responses without these, and records of any other status, are passed
    over. Extra columns do not pass. ``ts`` and ids may repeat. No records give none.
    """
    named = records.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "status", _lower_keys(F.col("headers")).alias("headers"), "digest"
    ).filter(F.col("status").isin(200, 304))
    placed = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    lost = named.filter((F.col("status") == 304) & ~F.coalesce(placed, F.lit(False)))
    at = named.filter(placed).withColumn("span", F.floor(F.unix_timestamp("ts") / span_seconds))
    body = F.when(F.col("status") == 200, F.struct("ts", "record_id", "digest", "headers"))
    cut = at.select("url_key", "span", "ts", "record_id", "status", "headers", body.alias("body"))
    # Responses before revisits of the same time; maps cannot be compared, so the last one seen is taken in order.
    inside = Window.partitionBy("url_key", "span").orderBy("ts", F.col("status"), "record_id")
    last = F.last("body", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    per_span = (
        cut.filter("status = 200").groupBy("url_key", "span")
        .agg(F.max_by("body", F.struct("ts", "record_id")).alias("own"))
    )
    spans = cut.groupBy("url_key", "span").agg(F.max(F.col("status") == 304).alias("asks"))
    earlier = Window.partitionBy("url_key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.join(per_span, ["url_key", "span"], "left").select(
        "url_key", "span", F.last("own", ignorenulls=True).over(earlier).alias("carried"), "asks"
    ).filter("asks").drop("asks")
    found = (
        cut.withColumn("here", last).filter("status = 304").join(carried, ["url_key", "span"])
        .select("record_id", "url_key", "ts", "headers", F.coalesce("here", "carried").alias("response"))
    )
    lost = lost.select("record_id", "url_key", "ts", "headers", F.lit(None).cast(found.schema["response"].dataType).alias("response"))
    return _merged(found.unionByName(lost))


def _merged(found: DataFrame) -> DataFrame:
    own, theirs = (lambda h: F.col("headers")[h]), (lambda h: F.col("response.headers")[h])
    tags = own("etag").isNotNull() & theirs("etag").isNotNull()
    times = own("last-modified").isNotNull() & theirs("last-modified").isNotNull()
    agrees = F.when(tags, _weak(own("etag")) == _weak(theirs("etag"))).when(times, own("last-modified") == theirs("last-modified"))
    outcome = (
        F.when(F.col("response").isNull(), "orphan").when(agrees.isNull(), "unvalidated").when(agrees, "resolved").otherwise("changed")
    )
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter("response.headers", lambda k, v: ~F.map_contains_key(updates, k))
    ok = F.col("outcome").isin("resolved", "unvalidated")
    return (
        found.withColumn("outcome", outcome)
        .select(
            "record_id", "url_key", "ts", F.when(ok, F.col("response.record_id")).alias("response_id"),
            F.when(ok, F.col("response.digest")).alias("digest"), F.when(ok, F.map_concat(kept, updates)).alias("headers"), "outcome",
        )
    )
