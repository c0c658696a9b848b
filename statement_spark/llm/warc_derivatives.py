"""Derived WARC records: every response gives a metadata record and a plain-text conversion record.

Both refer to the response by its record id and carry its target, date and payload digest, the metadata record also its
own source headers. Digests are labelled sha1 in base32 over the block as written; record ids are derived from the
response's id and the record type, so that running a job again gives the same records.

A null body is an empty one: its records have empty texts and the digest of no bytes. A null target or id leaves its
header out; without an id the response is named by its target and body digest. Repeated responses give repeated records.
Bodies are whole; nothing is shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from statement_spark.llm.page_text import read_page

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NO_DATE = "1970-01-01T00:00:00Z"
PAGE = "struct<plain:string,title:string,lang:string,charset:string,links:array<string>>"


def page_parts(html: Column) -> Column:
    """Plain text, title, language, character set and links of each page; a null is an empty page."""
    kind = pa.struct([("plain", pa.string()), ("title", pa.string()), ("lang", pa.string()), ("charset", pa.string()), ("links", pa.list_(pa.string()))])

    @F.arrow_udf(returnType=PAGE)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            pages = [read_page(v.as_py() or b"") for v in batch]
            texts = [pa.array([p[f.name] for p in pages], pa.binary()).cast(pa.string()) for f in list(kind)[:-1]]
            links = pa.array([[u.decode() for u in p["links"]] for p in pages], kind.field("links").type)
            yield pa.StructArray.from_arrays([*texts, links], fields=list(kind))

    return read.asNondeterministic()(html.cast("binary"))


def sha1_hex(body: Column) -> Column:
    return F.sha1(F.encode(body, "UTF-8"))


def labelled(hexes: str) -> Column:
    """A column of sha1 hex digits as labelled base32; five hex digits make four base32 digits."""
    chars = []
    for group in range(8):
        number = F.conv(F.substring(F.col(hexes), 5 * group + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(F.lit("sha1:"), *chars)


def record_id(*parts: Column) -> Column:
    """A urn:uuid out of the parts' digest."""
    h = F.md5(F.concat_ws("|", *parts))
    cuts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def derive(responses: DataFrame, target: str = "url", body: str = "html", response_id: str | None = None,
           date: str | None = None, headers: str | None = None, key: str | None = None) -> DataFrame:
    """Two rows for every response: warc_type, record_id, refers_to, target_uri, date, content_type, content_length,
    block_digest, payload_digest (of the response's body), header and block; and `key`'s column first, if named.

    `response_id`, `date` and `headers` (map<string,string>) name columns, if the responses have them."""
    html = F.coalesce(F.col(body).cast("string"), F.lit(""))
    uri = F.col(target).cast("string")
    base = responses.select(
        *([F.col(key).alias("_key")] if key else []), uri.alias("uri"), html.alias("html"),
        (F.col(date).cast("string") if date else F.lit(NO_DATE)).alias("date"),
        F.coalesce(F.col(headers) if headers else F.lit(None), F.create_map().cast("map<string,string>")).alias("headers"),
        (F.col(response_id) if response_id else F.lit(None)).cast("string").alias("given"),
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("own"),
    ).withColumn("payload_sha", sha1_hex(F.col("html"))).withColumn("payload", labelled("payload_sha"))
    source = base.withColumn("source", F.coalesce("given", record_id(F.lit("response"), F.col("own"), F.col("uri"), F.col("payload"))))
    source = source.withColumn("page", page_parts(F.col("html")))
    kept = F.array_sort(F.map_keys("headers"))
    fields = F.concat(
        *[_line(name, F.nullif(F.col(f"page.{name}"), F.lit(""))) for name in ("title", "lang", "charset")],
        F.array_join(F.transform(kept, lambda k: F.concat(F.lit("source-header: "), k, F.lit(": "), F.coalesce(F.col("headers")[k], F.lit("")), F.lit("\r\n"))), ""),
        F.array_join(F.transform("page.links", lambda u: F.concat(F.lit("outlink: "), u, F.lit("\r\n"))), ""),
    )

    def record(kind: str, content: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), F.lit(content).alias("content_type"), block.alias("block"))

    both = source.withColumn("r", F.explode(F.array(
        record("metadata", "application/warc-fields", fields), record("conversion", "text/plain; charset=utf-8", F.col("page.plain")))))
    hashed = both.withColumn("block_sha", sha1_hex(F.col("r.block")))  # a column of its own: hashed once
    sized = hashed.select(
        *(["_key"] if key else []), "r.*", "uri", "date", "payload", "source",
        record_id(F.col("r.warc_type"), F.col("source")).alias("record_id"),
        F.octet_length("r.block").cast("bigint").alias("content_length"), labelled("block_sha").alias("block_digest"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("warc_type")), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Refers-To", F.col("source")), _line("WARC-Target-URI", F.col("uri")), _line("WARC-Date", F.col("date")),
        _line("WARC-Payload-Digest", F.col("payload")), _line("WARC-Block-Digest", F.col("block_digest")),
        _line("Content-Type", F.col("content_type")), _line("Content-Length", F.col("content_length").cast("string")))
    return sized.select(
        *([F.col("_key").alias(key)] if key else []), "warc_type", "record_id", F.col("source").alias("refers_to"), F.col("uri").alias("target_uri"),
        "date", "content_type", "content_length", "block_digest", F.col("payload").alias("payload_digest"), header.alias("header"), "block")


def serialized(records: DataFrame) -> DataFrame:
    """`records` with `record`, the bytes of each as a WARC file holds them."""
    return records.withColumn("record", F.encode(F.concat("header", F.lit("\r\n"), "block", F.lit("\r\n\r\n")), "UTF-8"))
