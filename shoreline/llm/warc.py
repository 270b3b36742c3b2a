"""Resolution of not-modified revisits in web archives.

A revisit record stands for a page that had not changed: it has no body, only validators.
Each is resolved by an as-of join on its canonical URL to the latest earlier full response,
whose body it shares if the validators agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.base import stored

#: Headers that a 304 response may bring up to date (RFC 9111, section 3.2, leaves these to it).
UPDATED_BY_REVISIT = ("age", "cache-control", "date", "expires", "last-modified", "vary", "warning")

RECORDS = "record_id long, kind string, url string, at timestamp, headers map<string,string>, digest string"


def canonical_url(url: Column) -> Column:
    """Scheme-free URL: lower-case host without ``www.`` or ``m.``, default port and fragment,
    tracking parameters and trailing slashes dropped."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(?:www|m)\.", "")
    path = F.regexp_replace(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?]*", "")
    path = F.regexp_replace(path, r"(?<=[?&])(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*&?", "")
    return F.concat(host, F.regexp_replace(path, r"[?&]+$|/+(?=\?|$)", ""))


def resolve_revisits(records: DataFrame, slices: int = 64) -> DataFrame:
    """Every revisit with the response it refers to, if there is one.

    Takes record_id, kind ('response' or 'revisit'; other kinds are ignored), url, at,
    headers (lower-case names) and digest; other columns are ignored. Returns, per revisit:
    record_id, canonical, at, response_id (the latest response of the same canonical URL that
    is strictly earlier; of several at one time the one with the largest record_id), status
    and headers. The status is

    - ``missing``: no earlier response (headers are the revisit's own);
    - ``unchecked``: neither digest nor etag nor last-modified is on both sides;
    - ``mismatch``: the first of these that is on both sides differs (weak etags compare
      without their ``W/``; headers are the revisit's own);
    - ``resolved``: it agrees.

    Headers of unchecked and resolved revisits are the response's, with those that a 304 may
    update taken from the revisit. Records with a null time are ignored as responses and
    missing as revisits; a null or empty URL never matches. Repeated rows are kept. An empty
    table gives an empty one.

    A URL may hold any share of the records. Time is cut into slices; responses are first
    combined to the latest of each URL and slice, and a URL's few slices are carried forward.
    Inside a slice only its own records are sorted. The records, which carry no bodies, are
    written once to the shared folder.
    """
    given = stored(records.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical"), "at", "headers", "digest")
                   .filter(F.col("kind").isin("response", "revisit")), "revisits")
    limits = given.agg(F.min("at"), F.max("at")).collect()[0]
    first = F.lit(limits[0]).cast("timestamp")
    width = F.lit(max(1.0, ((limits[1] - limits[0]).total_seconds() + 1) / slices) if limits[0] else 1.0)
    usable = F.col("at").isNotNull() & (F.col("canonical") != "")
    sliced = given.withColumn("_slice", F.floor((F.unix_micros("at") - F.unix_micros(first)) / 1e6 / width))
    sliced = sliced.withColumn("_spread", F.when(usable, F.lit(0)).otherwise(F.pmod(F.xxhash64("record_id"), F.lit(1024)).cast("int")))
    full = F.when(usable & (F.col("kind") == "response"), F.struct("at", "record_id", "headers", "digest"))

    last = sliced.filter(usable & (F.col("kind") == "response")).groupBy("canonical", "_slice").agg(
        F.max_by(F.struct("at", "record_id", "headers", "digest"), F.struct("at", "record_id")).alias("_last"))
    carried = last.select(F.lit("carried").alias("kind"), "canonical", "_slice", "_last")
    marks = sliced.filter(usable & (F.col("kind") == "revisit")).select("canonical", "_slice").distinct().select(
        F.lit("needed").alias("kind"), "canonical", "_slice", F.lit(None).cast(last.schema["_last"].dataType).alias("_last"))
    order = Window.partitionBy("canonical").orderBy("_slice", F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    before = carried.unionByName(marks).withColumn("_before", F.last("_last", ignorenulls=True).over(order)).filter(
        F.col("kind") == "needed").select("canonical", "_slice", "_before")

    # responses of the same time come after the revisits, so that only strictly earlier ones are seen
    inside = Window.partitionBy("canonical", "_slice", "_spread").orderBy(
        "at", F.when(F.col("kind") == "revisit", 0).otherwise(1), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    within = sliced.withColumn("_within", F.last(full, ignorenulls=True).over(inside)).filter(F.col("kind") == "revisit")
    joined = within.join(before, ["canonical", "_slice"], "left").withColumn(
        "_from", F.when(usable, F.coalesce("_within", "_before")))

    etag = [F.regexp_replace(h["etag"], "^W/", "") for h in (F.col("headers"), F.col("_from.headers"))]
    modified = [h["last-modified"] for h in (F.col("headers"), F.col("_from.headers"))]
    agrees = F.coalesce(F.col("digest") == F.col("_from.digest"), etag[0] == etag[1], modified[0] == modified[1])
    status = (F.when(F.col("_from").isNull(), "missing").when(agrees.isNull(), "unchecked").when(agrees, "resolved").otherwise("mismatch"))
    own = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    base = F.coalesce("_from.headers", F.create_map().cast("map<string,string>"))
    updates = F.map_filter(own, lambda k, v: k.isin(*UPDATED_BY_REVISIT))
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.coalesce(F.array_contains(F.map_keys(updates), k), F.lit(False))), updates)
    return joined.withColumn("_status", status).select(
        "record_id", "canonical", "at", F.col("_from.record_id").alias("response_id"), F.col("_status").alias("status"),
        F.when(F.col("_status").isin("resolved", "unchecked"), merged).otherwise(own).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as sorted ``name=value`` lines; a name with a null value stands alone."""
    lines = F.transform(F.map_entries(headers), lambda e: F.coalesce(F.concat(e["key"], F.lit("="), e["value"]), e["key"]))
    return F.array_join(F.array_sort(lines), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """Archive records made of a table of pages (page_id, url, html).

    Each page is a full response at a time given by its id, and is asked for again twice: soon
    after under a varied address, and later with a validator that may be stale.
    Bodies stay in the pages; a record carries the digest alone.
    """
    digest = F.sha1(F.coalesce("html", F.lit("")))
    page = F.col("page_id")
    time = F.timestamp_seconds(F.lit(1_600_000_000) + page * 60)

    def headers(**values: Column) -> Column:
        return F.create_map(*[x for name, v in values.items() for x in (F.lit(name.replace("_", "-")), v)])

    plain = headers(content_type=F.lit("text/html"), etag=F.concat(F.lit('"'), F.substring("_digest", 1, 12), F.lit('"')),
                    date=time.cast("string"), content_length=F.length(F.coalesce("html", F.lit(""))).cast("string"))
    soon = headers(etag=F.concat(F.lit('W/"'), F.substring("_digest", 1, 12), F.lit('"')), date=(time + F.expr("INTERVAL 30 SECONDS")).cast("string"),
                   set_cookie=F.lit("a=1"))
    stale = F.when(F.pmod(page, F.lit(3)) == 0, F.lit('"stale"')).otherwise(F.concat(F.lit('"'), F.substring("_digest", 1, 12), F.lit('"')))
    later = headers(etag=stale, date=(time + F.expr("INTERVAL 30 DAYS")).cast("string"), cache_control=F.lit("max-age=60"))
    varied = F.concat(F.regexp_replace(F.coalesce("url", F.lit("")), r"#.*$", ""), F.lit("#again"))

    def record(shift: int, kind: str, url: Column, at: Column, head: Column, body: Column) -> Column:
        return F.struct((page * 3 + shift).alias("record_id"), F.lit(kind).alias("kind"), url.alias("url"), at.alias("at"),
                        head.alias("headers"), body.alias("digest"))

    none = F.lit(None).cast("string")
    return pages.select("page_id", "url", "html").withColumn("_digest", digest).select(F.inline(F.array(
        record(0, "response", F.col("url"), time, plain, F.col("_digest")),
        record(1, "revisit", varied, time + F.expr("INTERVAL 30 SECONDS"), soon, F.col("_digest")),
        record(2, "revisit", F.col("url"), time + F.expr("INTERVAL 30 DAYS"), later, none))))
