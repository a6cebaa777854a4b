"""WARC archives: monolithic gzip files, their normalised form with a member per record, and reads by offset."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.shared import stored

END = "\r\n\r\n"
READ_BYTES = 1 << 20
# Compressed bytes of an archive that one task reads by offset.
SLICE_BYTES = 16 << 20
INDEX = "archive string, offset bigint, length bigint, record_id string, record_type string, target_uri string, payload_digest string, refers_to string"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds `payload_bytes`, `payload_digest`, `first_id`: of equal payloads of `min_bytes` or more, the smallest page_id.

    The counts are combined before the shuffle; the join back is one that Spark splits where a payload is frequent.
    """
    body = F.coalesce("html", F.lit(""))
    told = pages.select("page_id", "url", body.alias("html"), F.octet_length(body).cast("bigint").alias("payload_bytes"), base32_sha1(F.encode(body, "UTF-8")).alias("payload_digest"))
    same = ["payload_digest", "payload_bytes"]
    firsts = told.where(F.col("payload_bytes") >= min_bytes).groupBy(*same).agg(F.min("page_id").alias("first_id"))
    return told.join(firsts, same, "left")


def write_monolithic(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2025-01-01T00:00:00Z") -> None:
    """Writes `pages (page_id, url, html)` as WARC files that are one gzip stream each, by Spark's text writer.

    A record's end mark is the writer's line end, so Spark compresses and commits the files like any other.
    A payload is an HTTP response's body; a revisit holds only the HTTP header, with the length of the full payload.
    A null html is an empty payload; a null url is left out; a page without an id gets the record id `<urn:page:>`.
    """
    revisit = F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull())
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    told = with_revisits(pages, min_bytes).withColumns({"revisit": revisit, "http": http})
    held = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("payload_bytes"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")), F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), name("first_id"))),
        F.when(F.col("revisit"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), held.cast("string")),
    )
    record = F.concat(header, F.lit(END), F.col("http"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    told.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", END).text(folder)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"file://{rest}" if colon and scheme == "file" and not rest.startswith("//") else uri)


def inflated(stream: object) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in bounded parts."""
    unzip = zlib.decompressobj(31)
    while data := stream.read(READ_BYTES):
        while data:
            if unzip.eof:
                unzip = zlib.decompressobj(31)
            yield unzip.decompress(data, READ_BYTES)
            data = unzip.unconsumed_tail or unzip.unused_data
    if not unzip.eof:
        raise ValueError("the gzip stream ends early")


def records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (names in lower case), header bytes and block of every record."""
    held, need, fields, head = bytearray(), 0, None, b""
    mark = END.encode()
    for part in parts:
        held += part
        while len(held) >= need:
            if fields is None:
                at = held.find(mark)
                if at < 0:
                    break
                head = bytes(held[:at])
                lines = head.decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
                fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                need = at + 4 + int(fields["content-length"]) + 4
            else:
                yield fields, head, bytes(held[len(head) + 4 : need - 4])
                del held[:need]
                fields, need = None, 0
    if held:
        raise ValueError("the archive ends inside a record")


def _normalised(batches: Iterator[pa.RecordBatch], out: str, level: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            target, folder = _open(out)
            name = posixpath.basename(path).removesuffix(".txt.gz").removesuffix(".gz") + ".warc.gz"
            target.create_dir(folder, recursive=True)
            draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
            rows, offset = [], 0
            source, at = _open(path)
            with source.open_input_file(at) as stream, target.open_output_stream(draft) as sink:
                for fields, head, block in records(inflated(stream)):
                    zipped = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = zipped.compress(head + END.encode() + block + END.encode()) + zipped.flush()
                    sink.write(member)
                    wanted = ("warc-record-id", "warc-type", "warc-target-uri", "warc-payload-digest", "warc-refers-to")
                    rows.append((f"{out}/{name}", offset, len(member), *(fields.get(f) for f in wanted)))
                    offset += len(member)
                    if len(rows) == 8192:
                        yield _index(rows)
                        rows = []
            # Only a complete file gets its name, so a task that runs twice does no harm.
            target.move(draft, f"{folder}/{name}")
            yield _index(rows)


def _index(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def normalise(spark: SparkSession, folder: str, out: str, level: int = 6) -> DataFrame:
    """Rewrites the gzip archives of a folder with every record as its own member, and returns the sidecar index.

    Each file is inflated once, as a stream, in one task: a gzip stream can't be entered in the middle. The
    results can, at the index's offsets. Tasks hold one record at a time. Cut-off or damaged archives fail. `folder` and `out` are
    reached with pyarrow's file systems. The index is a Parquet table in the shared folder.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    return stored(paths.mapInArrow(partial(_normalised, out=out, level=level), INDEX), "warc-index")


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _fetched(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORD.split(", ")]
    opened, stream = None, None
    for batch in batches:
        rows = []
        for archive, offset, length in zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length")), strict=True):
            if archive != opened:
                source, at = _open(archive)
                opened, stream = archive, source.open_input_file(at)
            raw = zlib.decompress(stream.read_at(length, offset), 31)
            for fields, _, block in records(iter([raw])):
                http, _, payload = block.partition(END.encode())
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(dict(line.lower().split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"content-length"])
                kind = fields["warc-type"]
                if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"{fields['warc-record-id']} in {archive} is damaged")
                rows.append((_page(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, kind, _page(fields.get("warc-refers-to")), payload if payloads else None))
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that an index names, each inflated alone; payloads of responses are checked against their digests.

    Returns `page_id`, `url`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`, `payload` (empty for revisits; null without `payloads`).
    A large archive is read by many tasks, in slices.
    """
    spread = index.repartition("archive", F.expr(f"offset div {SLICE_BYTES}")).sortWithinPartitions("archive", "offset")
    return spread.select("archive", "offset", "length").mapInArrow(partial(_fetched, payloads=payloads), RECORD)
