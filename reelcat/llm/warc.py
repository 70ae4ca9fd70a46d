"""WARC: write transactions as archives, read archives back, assemble one nested row per capture.

A transaction is a request, a response (or a revisit of an equal payload) and a metadata
record; request and metadata name the response in ``WARC-Concurrent-To``. Spark's text
writer lays the records down as plain WARC/1.1 files: each row is a record without its
closing blank lines, which are the line separator.

Reading goes by ``Content-Length`` alone, so payloads may hold anything. Archives are
read whole by task (``binaryFile``): keep them to the usual gigabyte at most; the writer
makes files of about ``file_bytes``. Plain and gzip archives are read.

Nulls: a null payload is empty, a null url is written without target, a null id without
page-id. Equal payloads: the smallest id is the response (null ids are largest), and rows
that repeat it in full are responses too. An empty table writes and reads no records.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.llm.common import table, whole
from reelcat.session import stage_table, staging_path

CRLF = "\r\n"
END = CRLF * 2
DATE = "2024-01-01T00:00:00Z"  # the transactions' date, where the table has none
#: Sizes of pages written together differ by less than this factor; up to CLASS ** LEAST_CLASS bytes all are one class.
CLASS, LEAST_CLASS, OWN_LINES = 4, 7, 3 << 10
RECORDS = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
           "content_type string, payload_digest string, length bigint, http_head bigint, block binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, without prefix: five hex digits give four base-32 ones."""
    digits = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("\n", *parts)), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record's text; headers that are null are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_from: int = 0, file_bytes: int = 32 << 20) -> None:
    """Write the pages' transactions under ``path``. Payloads of at least ``revisit_from`` bytes are written once.

    Pages are written by size class, each with as many records a file as ``file_bytes`` hold of its
    largest pages: no archive is larger, but for one of a single page that is.
    """
    df = pages.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), whole(F.col(f"`{payload}`")).alias("body"))
    df = df.withColumns({"digest": base32_sha1(F.col("body")), "n": F.octet_length("body").cast("long"), "content": F.sha2("body", 256)})
    # Only payloads met more than once, with the id of their response: staged, so that its size is known to the join.
    same = df.where(F.col("n") >= revisit_from).groupBy(F.col("content").alias("s_content"))
    same = stage_table(same.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"), "warc-equal")
    df = df.join(same, F.col("content") == F.col("s_content"), "left")
    revisit = F.coalesce(F.col("first") != F.coalesce("id", F.lit((1 << 63) - 1)), F.lit(False))
    df = df.withColumn("revisit", revisit).withColumn("of", F.when(F.col("revisit"), F.col("first")))
    plain = lambda c: F.translate(c, CRLF, "")  # noqa: E731  a header is one line
    name = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    df = df.withColumns({"target": plain(F.col("url")), "rid": _uuid(name(F.col("id")), F.col("digest"), name(F.when(F.col("revisit"), F.col("url"))))})
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    target = ("WARC-Target-URI", F.col("target"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{END}"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body")))
    fields = F.concat_ws(CRLF, F.concat(F.lit("page-id: "), F.col("id").cast("string")), F.concat(F.lit("payload-length: "), F.col("n").cast("string")),
                         F.concat(F.lit("refers-to-page: "), F.col("of").cast("string")))
    asked = F.concat(F.lit("GET "), F.coalesce(F.replace(F.regexp_replace("target", "^[a-z]+://[^/]*", ""), F.lit(" "), F.lit("%20")), F.lit("/")),
                     F.lit(f" HTTP/1.1{CRLF}Host: "), F.regexp_extract(F.coalesce("target", F.lit("")), "^[a-z]+://([^/]*)", 1), F.lit(END))
    own = lambda what: ("WARC-Record-ID", _uuid(F.lit(what), F.col("rid")))
    with_it = ("WARC-Concurrent-To", F.col("rid"))
    refers = ("WARC-Refers-To", F.when(F.col("revisit"), _uuid(name(F.col("of")), F.col("digest"), name(F.lit(None)))))
    profile = ("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    http_type = lambda what: ("Content-Type", F.lit(f"application/http;msgtype={what}"))
    records = F.array(
        _record(F.lit("request"), [own("request"), with_it, target, http_type("request")], asked),
        _record(kind, [("WARC-Record-ID", F.col("rid")), target, refers, profile, digest, http_type("response")], http),
        _record(F.lit("metadata"), [own("metadata"), with_it, target, ("Content-Type", F.lit("application/warc-fields"))], fields),
    )
    # what a page's three records take at most, as a power of CLASS: the payload, the URL in five places, the other lines
    size = F.when(F.col("revisit"), 0).otherwise(F.col("n")) + 5 * F.coalesce(F.octet_length("url"), F.lit(0)) + OWN_LINES
    df = df.withColumn("class", F.greatest(F.ceil(F.ln(size) / math.log(CLASS)), F.lit(LEAST_CLASS)).cast("int"))
    classes = sorted(r[0] for r in df.select("class").distinct().collect()) or [LEAST_CLASS]  # a few small numbers
    for k in classes:
        lines = df.where(F.col("class") == k).select(F.explode(records).alias("value"))
        pages_a_file = max(1, file_bytes // CLASS**k)
        lines.write.mode("append").option("lineSep", END).option("maxRecordsPerFile", 3 * pages_a_file).text(path)


def _whole_bytes(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:  # a member after the other
        one = zlib.decompressobj(31)
        out.append(one.decompress(content))
        content = one.unused_data
    return b"".join(out)


def parse_records(content: bytes):
    """The records of one archive, in order, by their Content-Length; raises ValueError at a broken one."""
    data, at = _whole_bytes(content), 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in data[at:end].decode("utf-8").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            head[k.strip().lower()] = v.strip()
        n = int(head["content-length"])
        if end + 4 + n > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield head, data[end + 4 : end + 4 + n]
        at = end + 4 + n


def _read(batches):
    names = ("warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "content-type", "warc-payload-digest")
    for batch in batches:
        for i in range(batch.num_rows):
            rows, n_bytes = [], 0
            for head, block in parse_records(batch["content"][i].as_py()):
                http = head.get("content-type", "").startswith("application/http")
                rows.append((*[head.get(x) for x in names], len(block), block.find(b"\r\n\r\n") + 4 if http else 0, block))
                n_bytes += len(block)
                if n_bytes > 4 << 20 or len(rows) >= 4096:
                    yield _batch(rows)
                    rows, n_bytes = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = [pa.string()] * 8 + [pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record of all archives under ``path`` (RECORDS)."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (response or revisit) and metadata joined by concurrent-to.

    A record without ``WARC-Concurrent-To`` leads its transaction. Captures written more
    than once (the same response id) come out as often. Records of other types, and
    requests or metadata whose response is missing, make no capture.
    """
    lead = F.col("type").isin("response", "revisit")
    rec = F.struct("type", "record_id", "refers_to", "target_uri", "date", "content_type", "payload_digest", "length", "http_head", "block")
    first = lambda cond: F.first(F.when(cond, rec), ignorenulls=True)
    joined = records.where(lead | F.col("type").isin("request", "metadata")).groupBy(F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        first(F.col("type") == "request").alias("request"), first(lead).alias("response"), first(F.col("type") == "metadata").alias("metadata"),
        F.sum(lead.cast("int")).alias("times"))
    return joined.where("response IS NOT NULL").withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "nth")


def payload_of(record: str = "") -> Column:
    """What follows the HTTP head of a record's block."""
    at = f"{record}." if record else ""
    return F.substr(F.col(f"{at}block"), F.col(f"{at}http_head").cast("int") + 1)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = read_archives(spark, path)
    # The digest of a payload is taken when its record is read; only digests are shuffled.
    http = F.col("type") == "response"
    body = payload_of()
    records = records.withColumns({
        "payload_digest": F.when(http, F.concat(F.lit("sha1:"), base32_sha1(body))).otherwise(F.col("payload_digest")),
        "length": F.when(http, F.octet_length(body).cast("long")).otherwise(F.col("length")),
    }).withColumn("block", F.when(F.col("type") == "metadata", F.col("block")))
    field = lambda name: F.nullif(F.regexp_extract(F.col("metadata.block").cast("string"), rf"(?m)^{name}: (-?\d+)", 1), F.lit("")).cast("long")
    captures = assemble(records)
    return captures.select(
        field("page-id").alias("page_id"),
        F.when(F.col("response.type") == "response", F.col("response.length")).otherwise(field("payload-length")).alias("payload_bytes"),
        F.regexp_replace("response.payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("response.type").alias("record_type"), field("refers-to-page").alias("refers_to"))


#: DuckDB's SHA-1 is hexadecimal; its base32 is spelled out here.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p),
x AS (SELECT *, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform(range(0, 4), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 5 * i::INT + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT, 1)), '')), '') AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM x
"""
