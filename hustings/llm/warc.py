"""Web archives: pages written as WARC records with segmentation, and read back by reassembling the segments.

An archive is a folder of gzip files, one per writing task, each a sequence of WARC 1.1 records.  Spark's text source does
the reading: the version line that starts every record is the separator, so records stream and no file is held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm.tables import own_columns, slices, stored, text_of
from hustings.operators.skew import lookup, spread_join
from hustings.session import fresh_path

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SEGMENT, CHUNK, LEAST_REVISIT = 32 * 1024, 8 * 1024, 100
OUTPUT = 8 << 20


def before_character(data: bytes, at: int, least: int) -> int:
    """``at`` or the last place before it where a UTF-8 character starts; at least ``least + 1``."""
    while at < len(data) and at > least + 1 and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def cuts(data: bytes, most: int) -> Iterator[bytes]:
    """``data`` in pieces of at most ``most`` bytes, no character divided."""
    start = 0
    while start < len(data):
        end = before_character(data, min(start + most, len(data)), start)
        yield data[start:end]
        start = end


def chunked(payload: bytes, most: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing.  A chunk also ends inside every version line that the payload holds, so
    that no record holds one."""
    mark = VERSION.encode()
    parts = payload.split(mark)
    parts = [(mark[4:] if i else b"") + p + (mark[:4] if i < len(parts) - 1 else b"") for i, p in enumerate(parts)]
    framed = [b"%x\r\n%s\r\n" % (len(c), c) for part in parts for c in cuts(part, most)]
    return b"".join(framed) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        at = line + 2
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def record(headers: Iterable[tuple[str, object]], block: bytes) -> str:
    """One record without the two line ends that follow it; headers without a value are left out."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return f"{VERSION}{lines}Content-Length: {len(block)}\r\n\r\n{block.decode()}"


def identifier(*parts: str) -> str:
    h = hashlib.md5("\x1f".join(parts).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


# Printable ASCII but the sign that begins an escape.
PLAIN = "".join(map(chr, range(33, 127))).replace("%", "")


def records(own: str, page_id: str | None, url: str | None, html: str, refers_to: str | None, segment: int) -> Iterator[str]:
    """All records of one page: a revisit, a response, or a response with its continuations."""
    payload = html.encode()
    uri = None if url is None else quote(url, safe=PLAIN + "%")
    common = [
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"),
        ("Page-ID", None if page_id is None else quote(page_id, safe=PLAIN)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        revisit = [("WARC-Type", "revisit"), *common, ("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
        yield record(revisit, HTTP)
        return
    block = HTTP + chunked(payload)
    pieces = list(cuts(block, segment))
    yield record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1 if len(pieces) > 1 else None)], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", identifier(own, str(number))),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", uri),
            ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None),
        ]
        yield record(headers, piece)


def writer(segment: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for own, page_id, url, html, refers_to, times in zip(*[c.to_pylist() for c in batch.columns]):
                for copy in range(times):
                    name = identifier(own, "copy", str(copy)) if copy else own
                    for text in records(name, page_id, url, html, refers_to, segment):
                        out.append(text)
                        held += len(text)
                    if held > OUTPUT:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return write


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    segment: int = SEGMENT,
    least_revisit: int = LEAST_REVISIT,
) -> None:
    """Write a record per row of ``pages`` to the new folder ``path``.

    A null page counts as empty.  Of pages with equal bytes, at least ``least_revisit`` of them, those with the smallest id
    (an id before none) are responses and the others revisit the first of these.  Blocks above ``segment`` bytes are continued
    in further records.  Rows equal in id, address and page have a record each, numbered in its identifier; they are written
    by one task, which holds the page once.
    """
    rows = own_columns(pages, page_id=page_id, url=url, html=html)
    digest = F.sha2(text_of("html"), 256)
    name = F.md5(F.to_json(F.struct("page_id", "url", digest.alias("d")), {"ignoreNullFields": "false"}))
    uuid = F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        F.lit(">"),
    )
    named = rows.select(uuid.alias("own"), "page_id", "url", text_of("html").alias("html"), digest.alias("digest"))
    slim = stored(
        named.groupBy("own").agg(
            F.first("page_id").alias("page_id"), F.first("digest").alias("digest"), F.max(F.octet_length("html")).alias("size"), F.count(F.lit(1)).alias("times")
        ),
        "records",
    )
    repeated = slim.where("times > 1").select("own", "times", F.col("times").alias("_n"))
    single = named.withColumn("times", F.lit(1).cast("bigint"))
    if not repeated.isEmpty():
        counted = lookup(named, repeated, ["own"], ["digest"])
        several = counted.where("times is not null").dropDuplicates(["own"])
        single = counted.where("times is null").withColumn("times", F.lit(1).cast("bigint")).unionByName(several)
    large = slim.where(F.col("size") >= least_revisit)
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "own"))
    groups = large.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("_n"))
    joined = spread_join(single, groups, ["digest"], ["own"])
    ready = joined.select(
        "own",
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "html",
        F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first.own")).alias("refers_to"),
        "times",
    )
    lines = ready.mapInArrow(writer(segment), "value string")
    lines.write.option("compression", "gzip").option("lineSep", END).text(path)


FIELDS = [
    ("record_id", pa.string()),
    ("record_type", pa.string()),
    ("page_id", pa.string()),
    ("url", pa.string()),
    ("refers_to", pa.string()),
    ("digest", pa.string()),
    ("origin", pa.string()),
    ("number", pa.int32()),
    ("total", pa.int64()),
    ("block", pa.binary()),
    ("problem", pa.string()),
]
RECORD = "record_id string, record_type string, page_id string, url string, refers_to string, digest string, origin string, number int, total bigint, block binary, problem string"


def parsed(data: bytes) -> dict:
    head, _, rest = data.partition(END.encode())
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if "page-id" in fields:
        fields["page-id"] = unquote(fields["page-id"])

    def whole(name: str) -> int | None:
        value = fields.get(name, "")
        return int(value) if value.isdigit() else None

    length = whole("content-length")
    problem = None
    if length is None or "warc-record-id" not in fields or "warc-type" not in fields:
        problem = "header"
    elif len(rest) < length or rest[length:] != END.encode():
        problem = "length"
    digest = fields.get("warc-payload-digest")
    number = whole("warc-segment-number")
    own = fields.get("warc-record-id")
    return {
        "record_id": own,
        "record_type": fields.get("warc-type"),
        "page_id": fields.get("page-id"),
        "url": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "digest": digest.removeprefix("sha256:") if digest else None,
        "origin": fields.get("warc-segment-origin-id") or (own if number else None),
        "number": number,
        "total": whole("warc-segment-total-length"),
        "block": rest[:length] if length is not None else rest,
        "problem": problem,
    }


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [parsed(value) for value in batch.column(0).to_pylist()]
        for a, b in slices([len(r["block"]) for r in found], OUTPUT):
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[name] for r in found[a:b]], kind) for name, kind in FIELDS], names=[name for name, _ in FIELDS]
            )


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response, None if its framing is broken."""
    head, found, body = block.partition(END.encode())
    if not found:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``…, block, problem`` to ``…, payload, payload_bytes, payload_digest, problem``; revisits have no payload."""
    for batch in batches:
        at = {name: i for i, name in enumerate(batch.schema.names)}
        kinds = batch.column(at["record_type"]).to_pylist()
        told = batch.column(at["digest"]).to_pylist()
        blocks = batch.column(at["block"]).to_pylist()
        problems = batch.column(at["problem"]).to_pylist()
        payloads = [None if k == "revisit" or p else payload_of(b) for k, b, p in zip(kinds, blocks, problems)]
        digests = [None if p is None else hashlib.sha256(p).hexdigest() for p in payloads]
        for i, (kind, payload) in enumerate(zip(kinds, payloads)):
            if problems[i] is None and kind != "revisit":
                problems[i] = "framing" if payload is None else "digest" if told[i] not in (None, digests[i]) else None
        for a, b in slices([len(p or b"") for p in payloads], OUTPUT):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(at[name]) for name in ("record_id", "record_type", "page_id", "url", "refers_to", "digest")],
                    pa.array(payloads[a:b], pa.binary()),
                    pa.array([None if p is None else len(p) for p in payloads[a:b]], pa.int64()),
                    pa.array(digests[a:b], pa.string()),
                    pa.array(problems[a:b], pa.string()),
                ],
                names=["record_id", "record_type", "page_id", "url", "refers_to", "digest", "payload", "payload_bytes", "payload_digest", "problem"],
            )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``record_id, record_type, page_id, url, refers_to, digest, payload, payload_bytes, payload_digest, problem``.

    Continuation records are grouped by their origin identifier, ordered by segment number, checked for gaps and against
    the total length, and joined before the chunked framing is taken off.  Segments repeated word for word count once.
    ``problem`` names what is wrong with a record (``header, length, segments, framing, digest``), else null; such rows are
    reported, never dropped.  Repeated unsegmented records stay as often as they stand.
    """
    text = spark.read.text(path, lineSep=VERSION).where("value != ''")
    found = text.select(F.col("value").cast("binary")).mapInArrow(parse, RECORD)
    whole = found.where("number is null").drop("origin", "number", "total")
    segment = F.struct("number", "total", "block")
    parts = (
        found.where("number is not null")
        .groupBy("origin")
        .agg(
            F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
            *[F.max(c).alias(c) for c in ("page_id", "url", "refers_to", "digest", "problem")],
            F.array_sort(F.collect_set(segment)).alias("parts"),
        )
    )
    last = F.element_at("parts", -1)
    complete = (
        F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))
    ) & F.coalesce(last["total"] == F.octet_length("block"), F.lit(False))
    joined = (
        parts.withColumn("block", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["block"])))
        .withColumn("problem", F.coalesce("problem", F.when(~complete, F.lit("segments"))))
        .withColumnRenamed("origin", "record_id")
        .select(whole.columns)
    )
    schema = "record_id string, record_type string, page_id string, url string, refers_to string, digest string, payload binary, payload_bytes bigint, payload_digest string, problem string"
    return whole.unionByName(joined).mapInArrow(decode, schema)


def resolved(records_read: DataFrame) -> DataFrame:
    """Records without payloads, written once, so the archive is read once; revisits get size, digest and page of the response
    they refer to.  A record that an archive holds twice, under one identifier, counts once.

    A revisit whose response is missing has problem ``refers_to``.
    """
    small = stored(records_read.drop("payload", "url").distinct(), "records")
    responses = small.where("record_type = 'response'")
    target = responses.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest")
    )
    joined = spread_join(small.where("record_type = 'revisit'"), target, ["refers_to"], ["record_id"])
    missing = F.col("to_bytes").isNull() | (F.col("to_digest") != F.col("digest"))
    revisits = joined.select(
        "page_id",
        F.col("to_bytes").alias("payload_bytes"),
        F.col("to_digest").alias("payload_digest"),
        "record_type",
        F.col("to_page").alias("refers_to"),
        F.coalesce("problem", F.when(missing, F.lit("refers_to"))).alias("problem"),
    )
    plain = small.where("record_type is null or record_type != 'revisit'")
    return plain.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to"), "problem"
    ).unionByName(revisits)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, problem`` of ``pages`` written and read again.

    Rows equal in id, address and page give as many rows, responses if their id is the smallest of those with their payload.
    Null pages are empty payloads; a null id stays null, also in ``refers_to``, an id of text comes back as it was.  No rows
    give no rows; further columns are not looked at.
    """
    path = fresh_path(pages.sparkSession, "archive")
    write_archive(pages, path, page_id, url, html, **options)
    kind = own_columns(pages, page_id=page_id).schema["page_id"].dataType
    read = resolved(read_archive(pages.sparkSession, path))
    return read.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
