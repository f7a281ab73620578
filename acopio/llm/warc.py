"""Not-modified revisits of a web archive, resolved to the response that they stand for.

A revisit record says that a page had not changed since an earlier full response, which it
does not repeat. Each is joined, as of its time, to the latest earlier full response of the
same canonical URL; the validators are compared, and the headers that a not-modified answer
may update are merged over those of the response.

A URL may hold a large part of all records. So a record is first looked for in its own
bucket of time, and each bucket is told the last response before it: no task holds more than
one bucket of one URL, or one row for each bucket of one URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acopio.session import stage

#: Headers that a 304 answer may carry to update the stored response (RFC 9110, 15.4.5).
MAY_UPDATE = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that name no page.
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid|ref|sessionid|phpsessid|jsessionid"

BUCKET_SECONDS = 86_400

SCHEMA = ["record_id", "url", "captured_at", "kind", "status", "etag", "last_modified", "headers"]


def canonical_url(url: Column) -> Column:
    """The key that forms of one address share.

    Lower-cased host without ``www.`` or ``m.`` and default port; no scheme, fragment, tracking
    parameters, index file or last slash; parameters in order. A null url has none.
    """
    bare = F.regexp_replace(F.regexp_replace(F.btrim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^(www|m)\\.", "")
    path = F.regexp_extract(bare, "^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/(index|default)\\.(html?|php|aspx?)$", "/"), "/+$", "")
    query = F.regexp_extract(bare, "^[^?]*\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.lower(x).rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _is_response() -> Column:
    return (F.col("kind") == "response") & (F.col("status") == 200)


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every revisit with the response it stands for.

    ``records`` has the columns of ``SCHEMA``: record_id, url, captured_at (timestamp), kind
    (``response`` or ``revisit``), status, etag, last_modified and headers (map of lower-case
    names). Columns returned: record_id, url_key, captured_at, verdict, response_id,
    response_at and headers.

    verdict: ``resolved`` (a validator agrees and none differs), ``unvalidated`` (no validator
    on both sides), ``changed`` (a validator differs), ``orphan`` (no earlier response).
    Strong and weak etags are compared weakly; if both have an etag, last_modified is not
    looked at. Only resolved and unvalidated revisits get merged headers: those of the
    response, with ``MAY_UPDATE`` ones of the revisit over them; others have null headers.
    Earlier means an earlier time; of equally late responses the largest record_id counts, null
    last, and of equal ones any, but its id, validators and headers are those of one record. A
    null or repeated record_id is nothing special otherwise: each record stands for itself, and
    a response without an id gives a null response_id with its response_at and verdict.
    A null url or time can't be placed: such revisits are orphans, such responses are not
    used. Revisits given twice are resolved twice; an empty table gives no rows; other
    columns are not looked at.
    """
    # numbered and written once: the number tells records apart, whatever their ids are
    records = records.select(
        F.monotonically_increasing_id().alias("record"), "record_id", "captured_at", canonical_url(F.col("url")).alias("url_key"),
        _is_response().alias("full"), (F.col("kind") == "revisit").alias("revisit"),
        F.floor(F.unix_micros("captured_at") / (bucket_seconds * 1_000_000)).alias("bucket"), "etag", "last_modified", "headers",
    ).where("full or revisit")
    records = stage(records, "captures")
    placeable = records.where("url_key is not null and captured_at is not null")
    # of the responses of one moment one is enough, and revisits of a moment have one answer
    best = F.max(F.when(F.col("full"), F.struct("record_id", "record"))).alias("best")
    moments = placeable.groupBy("url_key", "bucket", "captured_at").agg(best, F.max("revisit").alias("asked"))
    response = F.when(F.col("best").isNotNull(), F.struct("captured_at", F.col("best.record_id").alias("id"), F.col("best.record").alias("record")))
    before = Window.partitionBy("url_key", "bucket").orderBy("captured_at").rowsBetween(Window.unboundedPreceding, -1)
    own = moments.withColumn("own", F.last(response, ignorenulls=True).over(before)).where("asked")
    ends = moments.groupBy("url_key", "bucket").agg(F.max(response).alias("end"))
    earlier = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.last("end", ignorenulls=True).over(earlier)).drop("end")
    found = own.join(carried, ["url_key", "bucket"]).select("url_key", "captured_at", F.coalesce("own", "carried").alias("hit")).where("hit is not null")
    matched = (
        records.where("revisit")
        .select("record_id", "url_key", "captured_at", "etag", "last_modified", "headers")
        .join(found, ["url_key", "captured_at"], "left")
        .withColumns({"response": F.col("hit.record"), "response_id": F.col("hit.id"), "response_at": F.col("hit.captured_at")})
        .drop("hit")
    )
    full = records.where("full").select(F.col("record").alias("response"), F.col("etag").alias("_etag"), F.col("last_modified").alias("_last"), F.col("headers").alias("_headers"))
    both = matched.join(full, "response", "left")
    return both.select("record_id", "url_key", "captured_at", _verdict().alias("verdict"), "response_id", "response_at", F.when(_verdict().isin("resolved", "unvalidated"), _merged()).alias("headers"))


def _verdict() -> Column:
    weak = [F.regexp_replace(F.col(c), "^W/", "") for c in ("etag", "_etag")]
    return (
        F.when(F.col("response").isNull(), "orphan")
        .when(weak[0].isNotNull() & weak[1].isNotNull(), F.when(weak[0] == weak[1], "resolved").otherwise("changed"))
        .when(F.col("last_modified").isNotNull() & F.col("_last").isNotNull(), F.when(F.col("last_modified") == F.col("_last"), "resolved").otherwise("changed"))
        .otherwise("unvalidated")
    )


def _merged() -> Column:
    new = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*MAY_UPDATE))
    old = F.map_filter(F.coalesce("_headers", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(old, new)
