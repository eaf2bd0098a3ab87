"""Resolution of not-modified revisits in WARC records.

A revisit (status 304) carries no payload.  It is resolved by an as-of join on the canonical URL
to the latest strictly earlier full response (status 200; of equal times the larger record id).
The validators must agree: entity tags by weak comparison where both records have one, else
Last-Modified where both have it.  Then the permitted headers of the revisit replace the stored
ones: all but those that describe the message body or the connection.

The join keeps no URL's history in one task.  Records are range-partitioned by (URL, time, id) and
written with their partition number; a window over (URL, partition) finds the earlier response
within the partition, and a window over one row per (URL, partition) carries the last response
over from the partitions before.

Edge cases: a null or empty url has no canonical form, and its revisits stay unresolved; a null
time is earlier than nothing and follows nothing; null headers are no headers; header names match
in any case (of names that repeat the last one in order counts); repeated revisits are resolved
each on its own, one row for each; responses that agree in record id, canonical URL and time are
one response, with the largest headers and payload of these (in that order, null smallest); other statuses are neither; empty tables give empty results; extra columns are
left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import opaque
from .common import Scratch

#: Header fields that a 304 response may not replace (body metadata, connection).
KEPT_FROM_RESPONSE = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                      "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that do not name a resource.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|ref|sessionid|phpsessid|jsessionid|sid)(=|$)"


def canonical_url(url: Column) -> Column:
    """host[:port]/path[?query]: no scheme, user, ``www.``, default port, fragment, trailing slash or
    tracking parameters; the host in lower case, parameters sorted."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    secure = F.lower(u).startswith("https://")
    rest = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    before = F.regexp_extract(rest, r"^([^?]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_extract(before, r"^([^/]*)", 1), "^.*@", ""))
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    host = F.when(secure, F.regexp_replace(host, ":443$", "")).otherwise(F.regexp_replace(host, ":80$", ""))
    path = F.regexp_replace(F.regexp_extract(before, r"^[^/]*(.*)$", 1), "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    out = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))
    return F.when(host != "", out)


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case only, the last in order."""
    e = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value")))
    e = F.array_sort(e)
    return F.map_from_entries(F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.greatest(F.size(e), F.lit(1))), lambda y: y["key"] == x["key"])))


def merge_headers(stored: Column, revisit: Column) -> Column:
    new = F.map_filter(revisit, lambda k, v: ~k.isin(*KEPT_FROM_RESPONSE))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(new, k)), new)


def resolve(records: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row for each revisit in ``records`` (record_id, url, ts, status, headers, payload).

    revisit_id, canonical, ts, response_id (the latest earlier response, matching or not), verdict
    (resolved, mismatch, no_validator, no_response), and of resolved ones headers and payload.
    """
    scratch = scratch or Scratch(records.sparkSession)
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = F.col("status") == 200
    light = records.where(F.col("status").isin(200, 304)).select(
        canonical_url(F.col("url")).alias("canonical"), "ts", "record_id", full.alias("full"), lower_names(F.col("headers")).alias("headers"))
    alone = light.where("canonical is null or ts is null")
    dealt = light.where("canonical is not null and ts is not null").repartitionByRange(n, "canonical", "ts", "full", "record_id")
    rows = scratch.write(dealt.withColumn("part", F.spark_partition_id()), "records")
    # revisits sort before responses of the same time, which are not earlier
    one = F.when(F.col("full"), F.struct("record_id", F.col("ts").alias("at")))
    within = Window.partitionBy("canonical", "part").orderBy("ts", "full", "record_id")
    last = rows.where("full").groupBy("canonical", "part").agg(F.max(F.struct("ts", "record_id")).alias("l")).select("canonical", "part", F.col("l.record_id").alias("record_id"), F.col("l.ts").alias("ts"))
    ends = rows.groupBy("canonical", "part").agg(F.max("full").alias("any")).join(last, ["canonical", "part"], "left")
    earlier = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("before", F.last(F.when(F.col("any"), F.struct("record_id", F.col("ts").alias("at"))), ignorenulls=True).over(earlier)).select("canonical", "part", "before")
    found = (rows.withColumn("here", F.last(one, ignorenulls=True).over(within)).where("not full").drop("full")
             .join(carry, ["canonical", "part"], "left")
             .withColumn("response_id", F.coalesce("here.record_id", "before.record_id")).withColumn("at", F.when(F.col("here.record_id").isNotNull(), F.col("here.at")).otherwise(F.col("before.at"))).drop("here", "before", "part"))
    found = found.unionAll(alone.where("not full").select("canonical", "ts", "record_id", "headers", F.lit(None).cast(light.schema["record_id"].dataType).alias("response_id"), F.lit(None).cast(light.schema["ts"].dataType).alias("at")))
    # copies of a response are one row before they meet the revisits
    entries = F.array_sort(F.map_entries(lower_names(F.col("headers"))))
    stored = (records.where(full & F.col("record_id").isNotNull()).select(F.col("record_id").alias("response_id"), canonical_url(F.col("url")).alias("canonical"), F.col("ts").alias("at"), F.struct(entries.alias("h"), F.col("payload").alias("p")).alias("r"))
              .groupBy("response_id", "canonical", "at").agg(F.max("r").alias("r"))
              .select("response_id", "canonical", "at", F.map_from_entries("r.h").alias("stored"), F.col("r.p").alias("payload")))
    # an exchange of its own, so that the revisits of one response can be split
    out = found.withColumnRenamed("record_id", "revisit_id").join(opaque(stored, ["response_id", "canonical", "at"]), ["response_id", "canonical", "at"], "left")
    tag = lambda h: F.regexp_replace(F.try_element_at(h, F.lit("etag")), "^W/", "")
    since = lambda h: F.try_element_at(h, F.lit("last-modified"))
    a, b, c, d = tag(F.col("stored")), tag(F.col("headers")), since(F.col("stored")), since(F.col("headers"))
    agrees = F.when(a.isNotNull() & b.isNotNull(), a == b).when(c.isNotNull() & d.isNotNull(), c == d)
    verdict = F.when(F.col("response_id").isNull(), "no_response").when(agrees.isNull(), "no_validator").when(agrees, "resolved").otherwise("mismatch")
    good = F.col("verdict") == "resolved"
    return out.withColumn("verdict", verdict).select(
        "revisit_id", "canonical", "ts", "response_id", "verdict",
        F.when(good, merge_headers(F.col("stored"), F.col("headers"))).alias("headers"), F.when(good, F.col("payload")).alias("payload"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """WARC-like records made of every page: a full response, and a revisit some time later or earlier.

    Times, validators and header fields follow from the page's id and html alone.
    """
    h = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(h), 1, 16), F.lit('"'))
    i = F.coalesce(F.col("page_id"), F.lit(0))
    kind = F.pmod(i, F.lit(5))
    modified = F.concat(F.lit("day "), (i % 400).cast("string"))
    response = F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length(h).cast("string"), F.lit("ETag"), tag,
                            F.lit("Last-Modified"), modified, F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Date"), i.cast("string"))
    validator = (F.when(kind == 0, F.create_map(F.lit("ETag"), tag)).when(kind == 1, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag)))
                 .when(kind == 2, F.create_map(F.lit("Last-Modified"), modified)).when(kind == 3, F.create_map(F.lit("ETag"), F.lit('"stale"')))
                 .otherwise(F.create_map().cast("map<string,string>")))
    revisit = F.map_concat(validator, F.create_map(F.lit("Date"), (i + 100).cast("string"), F.lit("Content-Length"), F.lit("0"), F.lit("Expires"), F.lit("later")))
    rows = F.array(
        F.struct((2 * F.col("page_id")).alias("record_id"), (10 * i).alias("ts"), F.lit(200).alias("status"), response.alias("headers"), F.col("html").alias("payload")),
        F.struct((2 * F.col("page_id") + 1).alias("record_id"), (10 * i + F.when(i % 7 == 0, -5).otherwise(1005)).alias("ts"), F.lit(304).alias("status"), revisit.alias("headers"), F.lit(None).cast("string").alias("payload")))
    return pages.select("url", F.explode(rows).alias("r")).select("r.record_id", "url", "r.ts", "r.status", "r.headers", "r.payload")
