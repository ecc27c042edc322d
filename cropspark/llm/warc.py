"""WARC archives: write pages as records, read archives back, put segmented records together.

Writing. Each page gives one record. Of pages with equal payloads of `REVISIT_BYTES` or more,
the one with the largest id is a response and the others are revisits of it. The HTTP body is
sent in chunked framing. A block longer than `SEGMENT` bytes is split into a first record and
continuation records. The files are written by Spark's text writer with the line separator
that ends a WARC record, so they are archives on any file system Spark can write, each one
gzip member, and `RECORDS` a file bound their size.

Reading. Files are parsed record by record by their stated lengths. Records that are whole are
decoded where they are; only segments are shuffled, grouped by the id of the record they
continue, put in order of segment number, checked against the stated total length, and then
decoded. A group holds the segments of one record. With `regroup` whole records take the same way,
as their own only segment: one scan of the archives, and all blocks shuffled.

Defined results: null html is an empty payload; a null url is an empty target; equal rows and
repeated page ids each give a record of their own (record ids are unique per row); a page
without an id never leads; segments may lie in any file and order, and may be repeated (a whole record that is repeated gives a
row each time, with `regroup` one row); a record with a missing segment or a wrong total length is
returned with `complete` false and no payload; records without an id are never put together; text
that isn't a record is skipped up to the next one; an empty table writes an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropspark.llm.frames import stored

REVISIT_BYTES = 1000
SEGMENT = 1 << 12
CHUNK = 1 << 11
RECORDS = 1000
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"

_PARSED = (
    "record_id string, warc_type string, page_id bigint, target_uri string, digest string, refers_to bigint, "
    "segment_number bigint, origin_id string, total_length bigint, block binary"
)


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    """`body` in HTTP chunked transfer framing."""
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes | None:
    """The body in chunked framing, None if the framing is broken."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(framed[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        part = framed[end + 2 : end + 2 + size]
        if len(part) < size or framed[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        out.append(part)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes | None:
    """The decoded body of an HTTP response block; a block without an HTTP head is its own body."""
    if not block.startswith(b"HTTP/"):
        return block
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body


def _record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _page_records(row: dict) -> Iterator[bytes]:
    record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{row['nonce']}/{row['page_id']}").urn
    uri = re.sub(r"\s", "%20", row["url"] or "")
    sha1 = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    fields = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{sha1}", "Page-ID": row["page_id"]}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if row["leader"] is not None and row["leader"] != row["page_id"]:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record("revisit", record_id, {**fields, "WARC-Profile": profile, "Refers-To-Page-ID": row["leader"]}, head + b"\r\n")
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked((row["html"] or "").encode("utf-8", "surrogatepass"))
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    if len(parts) > 1:
        fields["WARC-Segment-Number"] = 1
    yield _record("response", record_id, fields, parts[0])
    for n, part in enumerate(parts[1:], 2):
        own = {"WARC-Segment-Origin-ID": f"<{record_id}>", "WARC-Segment-Number": n}
        if n == len(parts):
            own["WARC-Segment-Total-Length"] = len(block)
        yield _record("continuation", f"{record_id}:{n}", own, part)


def _serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            records = [r for row in batch.slice(at, 200).to_pylist() for r in _page_records(row)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row of `pages` into archives below `path`."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.sha1(payload).alias("digest")
    )
    size = F.octet_length(payload)
    leaders = (
        pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.sha1(payload).alias("digest"), size.alias("size"))
        .filter(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("leader"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "leader")
    )
    joined = rows.join(leaders, "digest", "left").withColumn("nonce", F.monotonically_increasing_id())
    records = joined.mapInArrow(_serialise, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"-?\d{1,18}", value) else None


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each whole record of an archive."""
    at = content.find(b"WARC/1.")
    while at >= 0:
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = _number(fields.get("content-length"))
        if size is None or size < 0 or end + 4 + size > len(content):
            at = content.find(b"WARC/1.", at + 1)
            continue
        yield fields, content[end + 4 : end + 4 + size]
        at = content.find(b"WARC/1.", end + 4 + size)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    digest = fields.get("warc-payload-digest", "")
    try:
        digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
    except ValueError:
        digest = None
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    return (
        bare("warc-record-id"), fields.get("warc-type"), _number(fields.get("page-id")), fields.get("warc-target-uri"), digest,
        _number(fields.get("refers-to-page-id")), _number(fields.get("warc-segment-number")), bare("warc-segment-origin-id"),
        _number(fields.get("warc-segment-total-length")), block,
    )


def _parsed(batches: Iterator[pa.RecordBatch], segments: bool | None) -> Iterator[pa.RecordBatch]:
    """Segments as they are, or whole records decoded; None: all, whole ones as their only segment."""
    names = [x.split()[0] for x in _PARSED.split(", ")]
    kinds = [pa.int64() if " bigint" in x else pa.binary() if " binary" in x else pa.string() for x in _PARSED.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            data = content.as_py()
            for fields, block in parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                row = _row(fields, block)
                whole = row[6] is None
                if segments is None:
                    rows.append((*row[:6], 1, row[7], len(block), block) if whole else row)
                elif segments != whole:
                    rows.append((*row[:-1], payload_of(block)) if whole else row)
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("block")
        blocks = (x.as_py() for x in batch.column(at))
        payloads = pa.array([payload_of(x) if x is not None else None for x in blocks], pa.binary())
        yield batch.set_column(at, "block", payloads)


def read_records(spark: SparkSession, path: str, regroup: bool = False) -> DataFrame:
    """(record_id, warc_type, page_id, target_uri, digest, refers_to, payload, complete) per record."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInArrow(lambda batches: _parsed(batches, None if regroup else True), _PARSED)
    first = F.col("segment_number") == 1

    def of_first(name: str):
        return F.max(F.when(first, F.col(name))).alias(name)

    unnamed = F.concat(F.lit("#"), F.sha2("block", 256))
    joined = parts.groupBy(F.coalesce("origin_id", "record_id", unnamed).alias("key")).agg(
        *[of_first(c) for c in ("warc_type", "page_id", "target_uri", "digest", "refers_to")],
        F.max("total_length").alias("total_length"),
        F.array_sort(F.collect_set(F.struct("segment_number", "block"))).alias("parts"),
    )
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    numbers = F.transform("parts", lambda p: p["segment_number"])
    in_order = numbers == F.sequence(F.lit(1).cast("bigint"), F.size("parts").cast("bigint"))
    put = joined.withColumn("block", block).withColumn("record_id", F.when(~F.col("key").startswith("#"), F.col("key")))
    put = put.withColumn("block", F.when(in_order & (F.octet_length("block") == F.col("total_length")), F.col("block")))
    fields = ["record_id", "warc_type", "page_id", "target_uri", "digest", "refers_to", "block"]
    schema = ", ".join(x for x in _PARSED.split(", ") if x.split()[0] in fields)
    records = put.select(*fields).mapInArrow(_decoded, schema)
    if not regroup:
        whole = files.mapInArrow(lambda batches: _parsed(batches, False), _PARSED)
        records = whole.select(*fields).unionByName(records)
    return records.withColumn("complete", F.col("block").isNotNull()).withColumnRenamed("block", "payload")


def page_payloads(records: DataFrame) -> DataFrame:
    """Per page record: payload size and digest of the full payload, its type, what it revisits.

    Sizes and digests are written once, so the archives are not parsed again for the join.
    """
    size = F.octet_length("payload").cast("bigint").alias("payload_bytes")
    records = stored(records.select("page_id", "warc_type", "refers_to", "digest", size, F.sha1("payload").alias("payload_digest")), "digests")
    own = records.filter("warc_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "warc_type")
    led = own.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = records.filter("warc_type = 'revisit'").select("page_id", "refers_to", "digest").join(led, ["refers_to", "digest"], "left")
    return own.select(
        "page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to")
    ).unionByName(
        revisits.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    )
