"""WARC archives of pages: writing with revisits, reading, and assembly of transactions.

A page becomes three records: the response (or a revisit, if an earlier page has the same payload), the request and a
metadata record, the last two concurrent to the first.  Each record is a gzip member of its own, as WARC readers expect,
and files are cut by bytes.  Spark's text writer writes them: a member ends with the high byte of its length, which is 0
below 16 MB (larger ones get an empty member behind them), so that this byte is the line separator.  Reading walks each
file member by member, and by the lengths in the headers, so that no payload can be mistaken for a header.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, meet, new_path, small_batches

END = "\r\n"
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 100
#: Compressed bytes of a file, but for its last page; readers take a file as a whole.
FILE_BYTES = 64 << 20
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "declared_digest string, content_type string, http_head string, payload_bytes long, payload_digest string, content binary"
)
_NAMES = [f.split()[0] for f in RECORD.split(", ")]


def _clean(column: Column) -> Column:
    """No header value may hold a line end."""
    return F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"[\r\n]", " ")


def _record(kind: Column, record_id: Column, uri: Column, content_type: str, block: Column, *more: Column, date: str) -> Column:
    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        *more,
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(END, *head), F.lit(END * 2), block)


def _urn(role: str, page_id: Column, uri: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.lit(role), F.coalesce(page_id.cast("string"), F.lit("null")), uri, digest))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte, and the volume of its task that it goes to."""
    volume = filled = 0
    for batch in batches:
        held, volumes, size = [], [], 0
        for page in batch["records"].to_pylist():
            if filled >= FILE_BYTES:
                volume, filled = volume + 1, 0
            for record in page:
                make = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = make.compress(record + b"\r\n\r\n") + make.flush()
                if member[-1]:
                    make = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member += make.flush()
                held.append(member[:-1])
                volumes.append(volume)
                filled, size = filled + len(member), size + len(member)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(volumes, pa.int32()), pa.array(held, pa.binary())], ["volume", "value"])
                held, volumes, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(volumes, pa.int32()), pa.array(held, pa.binary())], ["volume", "value"])


def write_archives(pages: DataFrame, path: str, url: str = "url", html: str = "html", page_id: str = "page_id", date: str = "2024-01-01T00:00:00Z", least_bytes: int = LEAST_BYTES) -> None:
    """Write the pages as WARC files.  Null html is an empty payload, a null url an empty one.

    Of pages whose payloads are equal and have at least ``least_bytes`` bytes, the one with the least id holds the payload
    and the others refer to it.  Payloads are compared by SHA-256 and length, and only digests are shuffled.  Rows that are
    equal in id, url and payload are one capture, whose metadata say how many rows it stands for.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), _clean(F.col(url)).alias("uri"), body.alias("body"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
    thin = keep(rows.drop("body"), "payloads")
    same = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "digest", "uri"))
    often = keep(thin.groupBy(same.alias("same")).agg(F.count("*").alias("rows")).filter("rows > 1"), "repeated-pages")
    if often.isEmpty():
        rows = rows.withColumn("rows", F.lit(1).cast("long"))
    else:
        keyed = rows.withColumn("same", same)
        once = keyed.join(often, "same", "left_anti").withColumn("rows", F.lit(1).cast("long"))
        rows = once.unionByName(keyed.join(often, "same", "left_semi").dropDuplicates(["same"]).join(often, "same")).drop("same")
    first = thin.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("uri", F.struct("page_id", "uri")).alias("first_uri"), F.count("*").alias("n"))
    joined = meet(rows, keep(first.filter("n > 1"), "digests"), ["digest"], "n", "left")
    revisit = F.coalesce((F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    joined = joined.withColumn("revisit", revisit)
    uri, digest = F.col("uri"), F.col("digest")
    own = _urn("capture", F.col("page_id"), uri, digest)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    declared = F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest)
    refers = F.concat(F.lit("WARC-Refers-To: "), _urn("capture", F.col("first"), F.col("first_uri"), digest))
    capture = F.when(
        F.col("revisit"), _record(F.lit("revisit"), own, uri, "application/http; msgtype=response", http, declared, refers, F.lit(f"WARC-Profile: {PROFILE}"), date=date)
    ).otherwise(_record(F.lit("response"), own, uri, "application/http; msgtype=response", F.concat(http, F.col("body")), declared, date=date))
    with_it = F.concat(F.lit("WARC-Concurrent-To: "), own)
    host = F.coalesce(F.try_parse_url(uri, F.lit("HOST")), F.lit(""))
    request = _record(F.lit("request"), _urn("request", F.col("page_id"), uri, digest), uri, "application/http; msgtype=request", F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END * 2)), with_it, date=date)
    fields = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f"{END}rows: "), F.col("rows").cast("string"), F.lit(END))
    metadata = _record(F.lit("metadata"), _urn("metadata", F.col("page_id"), uri, digest), uri, "application/warc-fields", fields, with_it, date=date)
    records = joined.select(F.array(*[r.cast("binary") for r in (request, capture, metadata)]).alias("records"))
    packed = records.mapInArrow(_pack, "volume int, value binary")
    packed.select("volume", F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").partitionBy("volume").text(path)


def members(data: memoryview) -> Iterator[bytes]:
    """The members of a gzip file one after another, or a plain file whole."""
    if bytes(data[:2]) != b"\x1f\x8b":
        yield bytes(data)
        return
    at = 0
    while at < len(data):
        one, parts, step = zlib.decompressobj(31), [], 1 << 16
        while not one.eof and at < len(data):
            parts.append(one.decompress(data[at : at + step]))
            at += min(step, len(data) - at) - len(one.unused_data)
        if not one.eof:
            raise ValueError("the file ends inside a gzip member")
        yield b"".join(parts)


def walk(data: bytes, with_content: bool) -> Iterator[tuple]:
    """The records of a file or member; one that ends inside a record, or has something else between records, is refused."""
    at, size = 0, len(data)
    while at < size:
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : max(end, at)].decode("utf-8", "replace").split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            head.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda name: head.get(name, [None])[0]  # noqa: E731, B023
        begin = end + 4
        length = int(one("content-length") or 0)
        block = data[begin : begin + length]
        if len(block) < length or data[begin + length : begin + length + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is torn")
        at = begin + length + 4
        http, payload = None, block
        if (one("content-type") or "").startswith("application/http"):
            cut = block.find(b"\r\n\r\n")
            if cut < 0:  # a head without a payload
                cut = len(block)
            http, payload = block[:cut].decode("utf-8", "replace"), block[cut + 4 :]
        declared = one("warc-payload-digest")
        if one("warc-type") == "revisit":  # the payload is the referred record's
            total = next((int(x.partition(":")[2]) for x in (http or "").split(END) if x.lower().startswith("content-length:")), None)
            digest = declared.removeprefix("sha256:") if declared else None
        else:
            total, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if one("warc-type") == "response" and declared and declared.startswith("sha256:") and declared != f"sha256:{digest}":
                raise ValueError(f"the payload of {one('warc-record-id')} differs from its digest")
        small = one("warc-type") == "metadata"
        yield one("warc-record-id"), one("warc-type"), head.get("warc-concurrent-to", []), one("warc-refers-to"), one("warc-target-uri"), one("warc-date"), declared, one("content-type"), http, total, digest, payload if with_content or small else None


def read_archives(spark, path: str, with_content: bool = True) -> DataFrame:
    """All records of the files below ``path``; without content only metadata records keep theirs."""
    small_batches(spark)
    schema = RECORD

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 6, pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch["content"]:
                held, size = [], 0
                for member in members(memoryview(content.as_buffer())):
                    for row in walk(member, with_content):
                        held.append(row)
                        size += len(row[-1] or b"")
                        if len(held) >= 2000 or size > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], _NAMES)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], _NAMES)

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content").mapInArrow(read, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: ``capture_id, response, request, metadata``.

    Responses, revisits and resources are captures.  Another record belongs to the capture that it is concurrent to, that
    is concurrent to it, or that a record which it is concurrent to belongs to.  Records without a capture are left out;
    of several of one kind the one with the least id is taken.
    """
    rows = records.withColumn("anchor", F.col("type").isin("response", "revisit", "resource"))
    pairs = rows.select("anchor", "record_id", F.explode("concurrent_to").alias("to"))
    edges = pairs.filter("not anchor").select("record_id", "to").union(pairs.filter("anchor").select(F.col("to").alias("record_id"), F.col("record_id").alias("to")))
    via = edges.select(F.col("record_id").alias("to"), F.col("to").alias("next"))
    belongs = edges.join(via, "to", "left").select("record_id", F.coalesce("next", "to").alias("capture_id"))
    belongs = belongs.groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    body = [c for c in records.columns if c != "record_id"]
    anchors = rows.filter("anchor").select(F.col("record_id").alias("capture_id"), F.col("record_id"), *body)
    others = rows.filter("not anchor").join(belongs, "record_id").select("capture_id", "record_id", *body)
    nested = F.struct("record_id", *body)
    part = lambda test, name: F.min_by(F.when(test, nested), F.when(test, F.col("record_id"))).alias(name)
    kind = F.col("type")
    grouped = anchors.union(others).groupBy("capture_id").agg(part(kind.isin("response", "revisit", "resource"), "response"), part(kind == "request", "request"), part(kind == "metadata", "metadata"))
    return grouped.filter("response is not null")


def page_captures(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of captures that ``write_archives`` wrote."""
    page = F.nullif(F.regexp_extract(F.col("metadata.content").cast("string"), r"page-id: (\S*)", 1), F.lit("")).cast("long")
    times = F.greatest(F.lit(1), F.coalesce(F.regexp_extract(F.col("metadata.content").cast("string"), r"rows: ([0-9]+)", 1).try_cast("int"), F.lit(1)))
    rows = captures.select("capture_id", page.alias("page_id"), F.explode(F.sequence(F.lit(1), times)).alias("_row"), "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("to"))
    stored = rows.filter("record_type = 'response' and _row = 1").select(F.col("capture_id").alias("to"), F.col("page_id").alias("refers_to"))
    direct = rows.filter("to is null").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    # A record that many refer to is met by a broadcast.
    counts = keep(rows.filter("to is not null").groupBy("to").agg(F.count("*").alias("n")).join(stored, "to", "left"), "referred")
    return direct.union(meet(rows.filter("to is not null"), counts, ["to"], "n", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def archive_pages(pages: DataFrame, path: str, **columns) -> DataFrame:
    """Write ``pages``, read the files back and return one row for each row written.

    Null or empty html has an empty payload; payloads of any length that a row can hold are stored whole.  Rows that are
    equal in id, url and html are one capture that comes back as often as there were rows; rows of one id that differ are
    captures of their own, and a null id is a page of its own.  An empty table gives no rows; other columns are not read,
    so their names can't clash.
    """
    write_archives(pages, path, **columns)
    thin = [c for c in _NAMES if c not in ("http_head", "content_type", "date")]
    records = keep(read_archives(pages.sparkSession, path, with_content=False).select(*thin), "records")  # each file is walked once
    return page_captures(keep(assemble(records), "captures"))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_path(spark, "warc"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN strlen(body) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 100 AND page_id <> first THEN first END AS refers_to
FROM p
"""
