"""WARC archives: writing captures and assembling them again.

A capture is written as three records: request, response (or revisit) and
metadata; request and metadata name the response as concurrent to them. Reading
parses records by their Content-Length, so payloads may hold anything, then
joins requests and metadata to responses through the concurrent-to identifiers
in whichever direction they point, and emits one nested row per capture."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daypanel.llm import common

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN_TYPES = ("response", "revisit")

REVISIT_FROM = 1000
RECORDS_PER_FILE = 4096
COPIES = 4096  # of a repeated page, numbered in one go
CAPTURED = "2024-01-01T00:00:00Z"


def _uuid(*parts: Column) -> Column:
    name = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                    F.lit(">"))


def _record(kind: str | Column, record_id: Column, content_type: str, block: Column, *headers: Column) -> Column:
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
             F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {CAPTURED}"), *headers,
             F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    # concat_ws leaves out headers that are null.
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(RECORD_END), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                   revisit_from: int = REVISIT_FROM, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "gzip") -> None:
    """One capture per page, as archive files of at most ``records_per_file``
    captures each below ``path``.

    Of pages with equal payloads of at least ``revisit_from`` bytes, the one with
    the largest page_id holds the payload, of several with this id the one with the
    largest url; the others are revisits that refer to it. A null html is an empty payload, a null url has no target, and a null
    page_id never holds a payload that a page with an id has too. Pages that
    repeat in every column are captures of their own, with ids of their own, and
    the first of them counts as the largest. Other columns are not read."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    hashed = F.unhex(F.sha2("payload", 256))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.concat_ws("\n", *(F.coalesce(F.hex(c), F.lit("null")) for c in (
        F.col("page_id").cast("string").cast("binary"), F.col("url").cast("binary"), hashed))), 256)))
    # What differs between rows, once each, without the payloads.
    keys = common.durable(rows.groupBy("key").agg(
        F.count("*").alias("n"), F.first("page_id").alias("page_id"), F.first("url").alias("url"),
        F.first(F.when(F.octet_length("payload") >= revisit_from, hashed)).alias("same")))
    holders = (keys.filter(F.col("same").isNotNull()).groupBy("same")
               .agg(F.sum("n").alias("copies"), F.max(F.struct("page_id", "url")).alias("h"))
               .filter("copies > 1 and h.page_id is not null")
               .select(F.col("same").alias("h_same"), F.col("h.page_id").alias("h_id"), F.col("h.url").alias("h_url")))
    # Only keys that repeat or whose payload has a holder need looking up.
    known = (common.salted_lookup(keys, "same", "key", holders, "h_same").filter("n > 1 or h_id is not null")
             .select(F.col("key").alias("k_key"), "n", "h_id", "h_url"))
    repeated = known.filter("n > 1")
    if not keys.filter("n > 1").limit(1).count():
        rows = rows.join(known, F.col("key") == F.col("k_key"), "left").withColumn("copy", F.lit(0).cast("long"))
    else:
        # Rows that repeat are alike, so one of each is read and written n times;
        # its copies are numbered in blocks that are dealt out before they grow.
        single = rows.join(known, F.col("key") == F.col("k_key"), "left").filter("coalesce(n, 1) = 1")
        one = (rows.join(repeated.select("k_key"), F.col("key") == F.col("k_key"), "left_semi")
               .dropDuplicates(["key"]).withColumnRenamed("key", "o_key"))
        blocks = repeated.withColumn("block", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES).cast("long"))))
        copies = (blocks.repartition("k_key", "block").withColumn("copy", F.explode(F.sequence(
            F.col("block") * COPIES, F.least(F.col("n"), (F.col("block") + 1) * COPIES) - 1))))
        many = common.salted_lookup(copies, "k_key", "copy", one, "o_key")
        columns = ["page_id", "url", "payload", "h_id", "h_url", "copy"]
        rows = single.withColumn("copy", F.lit(0).cast("long")).select(columns).unionByName(many.select(columns))

    holds = F.col("page_id").eqNullSafe(F.col("h_id")) & F.col("url").eqNullSafe(F.col("h_url")) & (F.col("copy") == 0)
    revisit = F.col("h_id").isNotNull() & ~holds
    digest = F.sha1(F.col("payload").cast("binary"))
    uri = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "")
    first = _uuid(F.lit("main"), F.col("page_id"), F.col("url"), digest)
    own = F.when(F.col("copy") == 0, first).otherwise(_uuid(F.lit("copy"), first, F.col("copy")))
    holder = _uuid(F.lit("main"), F.col("h_id"), F.col("h_url"), digest)
    target = _header("WARC-Target-URI", uri)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(RECORD_END))
    request = _record("request", _uuid(F.lit("request"), own), "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")),
                      target, _header("WARC-Concurrent-To", own))
    main = _record(F.when(revisit, "revisit").otherwise("response"), own, "application/http; msgtype=response",
                   F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))), target,
                   _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
                   F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
                   F.when(revisit, _header("WARC-Refers-To", holder)))
    metadata = _record("metadata", _uuid(F.lit("metadata"), own), "application/warc-fields",
                       F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                F.lit(CRLF)), target, _header("WARC-Concurrent-To", own))
    # The writer ends each row with what ends a record.
    (rows.select(F.concat_ws(RECORD_END, request, main, metadata).alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers by lower-case name, block) of each record of an archive, plain or
    compressed. Blocks are cut by Content-Length alone."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 16)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        length = int(headers["content-length"][0])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the archive ends within a record")
        yield headers, block


_RECORDS = ("record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, "
            "warc_date string, declared_digest string, payload_bytes long, payload_sha1 string, "
            "fields map<string,string>, payload binary")


def read_records(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``. payload_bytes and
    payload_sha1 come from the bytes themselves and are null for revisits, which
    have none. With ``payload=False`` the payloads stay behind."""
    common.ship()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _RECORDS.replace("map<string,string>", "map").split(", ")]
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.string(),
                 pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds,
                                                                              strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parse_archive(content.as_py()):
                    one = lambda name: headers.get(name, [None])[0]  # noqa: E731, B023
                    kind, body, fields = one("warc-type"), None, None
                    if kind == "metadata":
                        fields = [tuple(map(str.strip, line.split(":", 1)))
                                  for line in block.decode("utf-8", "replace").splitlines() if ":" in line]
                        fields = list(dict(fields).items())
                    elif kind == "response":
                        body = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
                    rows.append((one("warc-record-id"), kind, headers.get("warc-concurrent-to", []),
                                 one("warc-refers-to"), one("warc-target-uri"), one("warc-date"),
                                 one("warc-payload-digest"), None if body is None else len(body),
                                 None if body is None else hashlib.sha1(body).hexdigest(), fields,
                                 body if payload else None))
                    held += len(body or b"") if payload else 0
                    if len(rows) >= 1000 or held >= 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, _RECORDS)


def assemble(records: DataFrame, *, payload: bool = True) -> DataFrame:
    """One nested row per capture: capture_id, record_type, target_uri, warc_date,
    payload_bytes, payload_sha1, refers_to, requests, metadata and, unless it is
    left out, payload.

    A request or metadata record belongs to the response (or revisit) that it
    names as concurrent, that names it, or that a request it names belongs to. A
    revisit's payload_bytes and payload_sha1 are those of the record it refers
    to, or the digest it declares where that record is missing. Records that
    repeat an id are one record; a capture without request or metadata has empty
    lists; requests and metadata without a response give no row. The records
    without their payloads are written out once, as the joins read them often;
    payloads move only to their captures, at the end."""
    slim = common.durable(records.drop("payload").dropDuplicates(["record_id"]))
    mains = slim.filter(F.col("record_type").isin(*MAIN_TYPES))
    others = slim.filter(F.col("record_type").isin("request", "metadata"))
    named = (others.select(F.col("record_id").alias("other"), F.explode("concurrent_to").alias("to"))
             .unionByName(mains.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("to"))))
    ids = mains.select(F.col("record_id").alias("main"))
    direct = named.join(ids, F.col("to") == F.col("main")).select("other", "main")
    through = (named.join(direct.select(F.col("other").alias("request"), F.col("main").alias("main")),
                          F.col("to") == F.col("request")).select("other", "main"))
    links = direct.unionByName(through).distinct()
    parts = (others.join(links, F.col("record_id") == F.col("other"))
             .select("main", "record_type", F.struct("record_id", "target_uri", "warc_date", "fields").alias("part"))
             .groupBy("main").agg(
                 F.collect_list(F.when(F.col("record_type") == "request", F.col("part"))).alias("requests"),
                 F.collect_list(F.when(F.col("record_type") == "metadata", F.col("part"))).alias("metadata")))
    full = mains.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("r_id"), F.col("payload_bytes").alias("r_bytes"), F.col("payload_sha1").alias("r_sha1"))
    declared = F.regexp_extract("declared_digest", "^sha1:(.*)$", 1)
    held = common.salted_lookup(mains, "refers_to", "record_id", full, "r_id")
    captures = (held.join(parts, F.col("record_id") == F.col("main"), "left")
                .select(F.col("record_id").alias("capture_id"), "record_type", "target_uri", "warc_date",
                        F.coalesce("payload_bytes", "r_bytes").alias("payload_bytes"),
                        F.coalesce("payload_sha1", "r_sha1", declared).alias("payload_sha1"), "refers_to",
                        F.coalesce("requests", F.array()).alias("requests"),
                        F.coalesce("metadata", F.array()).alias("metadata")))
    if not payload:
        return captures
    payloads = (records.filter(F.col("payload").isNotNull()).dropDuplicates(["record_id"])
                .select(F.col("record_id").alias("p_id"), "payload"))
    return captures.join(payloads, F.col("capture_id") == F.col("p_id"), "left").drop("p_id")
