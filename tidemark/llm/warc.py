"""Not-modified revisits: each is joined to the latest earlier full response of its address.

A capture has an id, an address, a time, a type (``response`` or ``revisit``), a status and a map of
headers with lower-case names. A revisit with status 304 says that the payload had not changed. It is
resolved by the latest response with status 200 of the same canonical address that is strictly
earlier (of several at one time, that with the greatest id), provided that the validators agree:
entity tags by weak comparison, else the times of last modification. The result then has that
response's headers, replaced by those that a 304 is permitted to replace.

The join is as-of without pairs. Times are cut into segments; the last response per address and
segment is aggregated and carried over later segments, of which an address has as many as the clock
allows; inside a segment a running maximum gives the last one. So an address with a great share of
all captures is spread over its segments. Payloads do not take part: they are joined by id at the
end, if wanted.

Null headers are none; a null address, time or id finds nothing (``no_response``); repeated captures
each give a row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.urls import canonical

#: The headers that a 304 response updates.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
SEGMENT_SECONDS = 3600

RESOLVED, MISMATCH, UNVERIFIED, NO_RESPONSE = "resolved", "mismatch", "unverified", "no_response"


def header(headers: Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name))


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def merged(old: Column, new: Column) -> Column:
    """``old`` with the permitted headers of ``new`` put in place of its own."""
    fresh = F.map_filter(new, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)


def verdict(response: Column, headers: Column) -> Column:
    """Whether the revisit's validators agree with those of the response."""
    old = response["headers"]
    tag, old_tag = weak(header(headers, "etag")), weak(header(old, "etag"))
    time, old_time = header(headers, "last-modified"), header(old, "last-modified")
    return (
        F.when(response.isNull(), NO_RESPONSE)
        .when(tag.isNotNull() & old_tag.isNotNull(), F.when(tag == old_tag, RESOLVED).otherwise(MISMATCH))
        .when(time.isNotNull() & old_time.isNotNull(), F.when(time == old_time, RESOLVED).otherwise(MISMATCH))
        .otherwise(UNVERIFIED)
    )


def resolve_revisits(captures: DataFrame, segment_seconds: int = SEGMENT_SECONDS) -> DataFrame:
    """One row per 304 revisit: id, address, the response it refers to, verdict, headers.

    ``captures``: capture_id bigint, url string, captured_at timestamp, type string, status int,
    headers map<string, string>. ``headers`` of the result are merged where the verdict is
    ``resolved``, else the revisit's own.
    """
    none = F.create_map().cast("map<string,string>")
    rows = captures.select(
        F.col("capture_id").cast("bigint").alias("capture_id"), canonical(F.col("url")).alias("address"),
        F.unix_micros("captured_at").alias("at"), (F.col("type") == "revisit").alias("revisit"),
        "status", F.coalesce("headers", none).alias("headers"),
    )
    segment = F.floor(F.col("at") / F.lit(segment_seconds * 1_000_000)).cast("bigint")
    wanted = rows.filter("(revisit AND status = 304) OR (NOT revisit AND status = 200 AND address IS NOT NULL AND at IS NOT NULL)")
    cut = wanted.withColumn("segment", segment).withColumn(
        "response", F.when(~F.col("revisit"), F.struct("at", "capture_id", "headers"))
    )
    # Maps cannot be compared, so the latest response is first found by time and id alone.
    place = F.when(~F.col("revisit"), F.struct("at", "capture_id"))
    last = cut.filter("NOT revisit").groupBy("address", "segment").agg(F.max(place).alias("last"))
    present = cut.filter("revisit").select("address", "segment").distinct()
    earlier = Window.partitionBy("address").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last.join(present, ["address", "segment"], "full")
        .withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
        .filter("carried IS NOT NULL")
        .select("address", "segment", "carried")
    )
    inside = Window.partitionBy("address", "segment").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = cut.withColumn("inside", F.max(place).over(inside)).filter("revisit")
    placed = found.join(carried, ["address", "segment"], "left").select(
        "capture_id", "address", "headers", F.coalesce("inside", "carried").alias("p")
    )
    responses = cut.filter("NOT revisit").select(
        F.col("address").alias("r_address"), F.col("at").alias("r_at"), F.col("capture_id").alias("r_id"),
        F.col("headers").alias("r_headers"),
    ).dropDuplicates(["r_address", "r_at", "r_id"])
    joined = placed.join(
        responses,
        (F.col("address") == F.col("r_address")) & (F.col("p.at") == F.col("r_at")) & (F.col("p.capture_id") == F.col("r_id")),
        "left",
    )
    response = F.when(F.col("r_id").isNotNull(), F.struct(F.col("r_headers").alias("headers")))
    judged = joined.withColumn("verdict", verdict(response, F.col("headers")))
    return judged.select(
        "capture_id", "address", F.col("r_id").alias("refers_to"), "verdict",
        F.when(F.col("verdict") == RESOLVED, merged(F.col("r_headers"), F.col("headers")))
        .otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, payloads: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """Add the payload of the response that a resolved revisit refers to; null for the others."""
    own = payloads.select(F.col(id_col).cast("bigint").alias("__id"), F.col(payload_col).alias("payload"))
    use = F.when(F.col("verdict") == RESOLVED, F.col("refers_to"))
    return resolved.withColumn("__use", use).join(own, F.col("__use") == F.col("__id"), "left").drop("__use", "__id")


def header_lines(headers: Column) -> Column:
    pairs = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(pairs), "\n")
