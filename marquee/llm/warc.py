"""Legacy ARC archives to WARC: write, convert, read back.

An ARC record is one header line, whose fields depend on the version, and as many bytes as
the line declares. Conversion reads that line, cuts the payload by its length and makes of
both a WARC record: an identifier that follows from the content, a W3C date, a type and
digests. Records whose payload is already there become revisits.

Archives are plain files, many records each, written by Spark's text writer with the
record's end as the line end. Reading goes by the declared lengths alone, so a payload may
hold anything.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.joins import lookup_join
from marquee.session import new_folder

#: Field names of an ARC header line by version, in the order they stand there.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "file", "length"),
}
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT = 100
END = "\r\n\r\n"
CRAWLED = "20260101000000"

_RESPONSE = "response"
_REVISIT = "revisit"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def arc_records(df: DataFrame, key_col: str, url_col: str, payload: Column, version: int = 1,
                date: str = CRAWLED) -> DataFrame:
    """``key`` and ``arc``, one ARC record of each row: header line, payload, line feed.

    Blanks and control characters of a url are percent-encoded, since blanks part the fields.
    A missing url is a dash. A missing payload is an empty one.
    """
    body = F.coalesce(payload, F.lit("").cast("binary"))
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("-")), r"[\x00-\x20\x7F]", "%20")
    values = {
        "url": F.when(url == "", F.lit("-")).otherwise(url), "ip": F.lit("0.0.0.0"), "date": F.lit(date),
        "type": F.lit("text/html"), "status": F.lit("200"), "checksum": F.md5(body), "location": F.lit("-"),
        "offset": F.lit("0"), "file": F.lit("-"), "length": F.octet_length(body).cast("string"),
    }
    line = F.concat_ws(" ", *[values[f] for f in ARC_FIELDS[version]])
    record = F.concat(F.encode(F.concat(line, F.lit("\n")), "UTF-8"), body, F.lit("\n").cast("binary"))
    return df.select(F.col(key_col).alias("key"), record.alias("arc"))


def parse_arc(record: bytes) -> dict[str, str | bytes]:
    """The header fields and the payload of one ARC record, told by the number of fields."""
    line, _, rest = record.partition(b"\n")
    parts = line.decode("utf-8", "replace").rstrip("\r").split(" ")
    for names in ARC_FIELDS.values():
        if len(parts) == len(names):
            found: dict[str, str | bytes] = dict(zip(names, parts))
            size = int(found["length"])
            if len(rest) < size:
                raise ValueError(f"an ARC record declares {size} bytes and has {len(rest)}")
            found["payload"] = rest[:size]
            return found
    raise ValueError(f"no ARC version has {len(parts)} fields")


def warc_date(date: str) -> str:
    """An ARC date of 14 digits, or its leading part, as WARC writes it."""
    digits = (date + "00000101000000"[len(date):])[:14]
    return datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(key: str, digest: str) -> str:
    """An identifier that is the same whenever the same record is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {digest}')}>"


_PARSED = "key {key}, url string, ip string, date string, type string, digest string, record_id string, payload binary"


def convert(arcs: DataFrame) -> DataFrame:
    """What WARC needs of each ARC record: its fields, digest, identifier and payload."""
    kind = arcs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, columns = batch.column("key"), [[] for _ in range(7)]
            for key, record in zip(keys.to_pylist(), batch.column("arc").to_pylist()):
                arc = parse_arc(record)
                digest = hashlib.sha256(arc["payload"]).hexdigest()
                row = (arc["url"], arc["ip"], warc_date(arc["date"]), arc["type"], digest,
                       record_id(f"{key} {arc['url']}", digest), arc["payload"])
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.string()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["key", "url", "ip", "date", "type", "digest", "record_id", "payload"])

    return arcs.mapInArrow(run, _PARSED.format(key=kind))


def revisits(records: DataFrame) -> DataFrame:
    """The records that repeat the payload of one with a smaller key, with that one's key, identifier, url and date.

    Only digests and identifiers are shuffled for it. A payload that very many records share
    is counted before the shuffle and joined in split partitions.
    """
    narrow = records.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("key").isNotNull()).select(
        "digest", F.struct("key", "record_id", "url", "date").alias("own"))
    firsts = narrow.groupBy("digest").agg(F.min("own").alias("first"))
    return lookup_join(narrow, firsts, "digest").where("first.key < own.key").select(
        F.col("own.record_id").alias("record_id"), "first").distinct()


def warc_records(records: DataFrame, again: DataFrame) -> DataFrame:
    """``record``, the bytes of each WARC record without the four that end it, as text for the writer.

    A response's block is an HTTP head and the payload, a revisit's the head alone.
    """
    joined = records.join(again, "record_id", "left")
    revisit = F.col("first").isNotNull()
    http = F.encode(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), F.col("type"), F.lit(END)), "UTF-8")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    joined = joined.withColumn("block", block)
    fields = [
        ("WARC-Type", F.when(revisit, F.lit(_REVISIT)).otherwise(F.lit(_RESPONSE))),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-IP-Address", F.col("ip")),
        ("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        ("WARC-Source-Key", F.col("key").cast("string")),
        ("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        ("WARC-Refers-To", F.col("first.record_id")),
        ("WARC-Refers-To-Target-URI", F.col("first.url")),
        ("WARC-Refers-To-Date", F.col("first.date")),
        ("WARC-Refers-To-Source-Key", F.col("first.key").cast("string")),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    ]
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[
        F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in fields])
    whole = F.concat(F.encode(F.concat(head, F.lit(END)), "UTF-8"), F.col("block"))
    return joined.select(whole.cast("string").alias("record"))


def write_archives(records: DataFrame, path: str, codec: str = "gzip", per_file: int = 20_000) -> None:
    """Write record bytes as archive files of at most ``per_file`` records."""
    (records.write.option("lineSep", END).option("compression", codec)
     .option("maxRecordsPerFile", per_file).text(path))


def _chunks(data: bytes) -> Iterator[bytes]:
    """An archive's bytes, unpacked piece by piece if they are packed; packed members may follow each other."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    rest = data
    while rest:
        unpack = zlib.decompressobj(31)
        for at in range(0, len(rest), 1 << 20):
            yield unpack.decompress(rest[at : at + (1 << 20)])
            if unpack.eof:
                rest = unpack.unused_data + rest[at + (1 << 20):]
                break
        else:
            return


def split_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each WARC record of an archive, in order, by declared lengths."""
    held = bytearray()
    want = None
    for chunk in _chunks(data):
        held += chunk
        at = 0
        while True:
            if want is None:
                stop = held.find(b"\r\n\r\n", at)
                if stop < 0:
                    break
                lines = bytes(held[at:stop]).decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
                headers = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
                want, at = int(headers["content-length"]), stop + 4
            if len(held) < at + want + 4:
                break
            yield headers, bytes(held[at : at + want])
            at, want = at + want + 4, None
        del held[:at]
    if held or want is not None:
        raise ValueError("an archive ends within a record")


_READ = ("key string, record_type string, record_id string, url string, date string, payload_bytes bigint, "
         "payload_digest string, refers_to string, payload binary")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives of a folder. A block that is not what its digest says raises.

    ``payload_bytes`` and ``payload_digest`` are the full payload's, for revisits too.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _READ.split(", ")]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for data in batch.column("content"):
                rows, size = [], 0
                for headers, block in split_archive(data.as_py()):
                    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
                    block = block.partition(END.encode())[2]
                    if kind == _RESPONSE and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"the block of {headers['warc-record-id']} is not what its digest says")
                    rows.append((headers.get("warc-source-key"), kind, headers["warc-record-id"], headers["warc-target-uri"],
                                 headers["warc-date"], int(headers["warc-payload-length"]), digest,
                                 headers.get("warc-refers-to-source-key"), block if payloads else None))
                    size += len(block)
                    if size > 8 << 20 or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, _READ)


def round_trip(df: DataFrame, key_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               version: int = 1, path: str | None = None) -> DataFrame:
    """Write every row as an ARC record, convert all to WARC archives and read those back.

    One row per row: ``key_col``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``. A null page is an empty payload. Of equal payloads of ``MIN_REVISIT`` bytes
    and more the smallest key's is the response; rows that share key and payload are responses
    alike. A row with a null key is a response to which nothing refers.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, "warc")
    records = convert(arc_records(df, key_col, url_col, F.col(html_col).cast("binary"), version))
    write_archives(warc_records(records, revisits(records)), path)
    kind = df.schema[key_col].dataType
    return read_archives(spark, path, payloads=False).select(
        F.col("key").cast(kind).alias(key_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
