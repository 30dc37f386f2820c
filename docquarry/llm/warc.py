"""WARC archives in Zstandard: a dictionary frame, then one frame per record.

An archive starts with a skippable frame that holds the compression dictionary;
every record is a frame of its own with its content size and checksum. Payloads that
occur before, by SHA-256, become revisit records without a payload.

Spark deals the records out, each task writes its archives to the shared folder and
reports them in a manifest; only archives of committed tasks are in the manifest, so
a task that runs twice leaves an unread file and no repeated record. Reading takes
archives as (path, content) rows, such as Spark's binaryFile source gives.

Defined results: a null payload is an empty one; a null page_id is kept and never the
response of another record unless all records of that payload lack an id; rows that
repeat the smallest page_id of a payload are all responses; line breaks and other
control characters in a url are percent-encoded; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.joins import broadcast_if_small
from docquarry.sources.shared import materialise, new_path

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
RESPONSE_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload binary,"
    " payload_bytes long, payload_digest string"
)


class ArchiveError(ValueError):
    """An archive breaks the format; the message names the archive and the offset."""


# ---------------------------------------------------------------- one record


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _plain(url: str | None) -> str:
    """A url that is safe in a header line."""
    return "".join(
        c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in (url or "")
    )


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool) -> bytes:
    """One WARC record, headers and block, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if is_revisit else payload)
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"Content-Type: {RESPONSE_TYPE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, f"WARC-Target-URI: {_plain(url)}")
    if is_revisit:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, first: str, where: str) -> dict[str, str]:
    lines = raw.decode("utf-8", "strict").split("\r\n")
    if not lines[0].startswith(first):
        raise ArchiveError(f"{where}: expected {first}, found {lines[0][:40]!r}")
    found: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"{where}: bad header line {line[:60]!r}")
        found[name.lower()] = value.strip()
    return found


def parse_record(raw: bytes, where: str) -> tuple:
    """The fields of RECORD, after checking headers, lengths and digests."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    if not blank:
        raise ArchiveError(f"{where}: the headers do not end")
    fields = _headers(head, VERSION, where)
    try:
        kind, length = fields["warc-type"], int(fields["content-length"])
        page_id = _page_id(fields["warc-record-id"])
        algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    except (KeyError, ValueError) as error:
        raise ArchiveError(f"{where}: missing or bad header {error}") from None
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: Content-Length {length}, block has {len(rest) - 4} bytes")
    http, blank, payload = rest[:length].partition(b"\r\n\r\n")
    if not blank:
        raise ArchiveError(f"{where}: the HTTP headers do not end")
    told = int(_headers(http, "HTTP/", where).get("content-length", -1))
    if kind == "response":
        if told != len(payload):
            raise ArchiveError(f"{where}: HTTP length {told}, payload has {len(payload)} bytes")
        if algorithm != "sha256" or hashlib.sha256(payload).hexdigest() != digest:
            raise ArchiveError(f"{where}: the payload does not have its digest")
        refers_to = None
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields or told < 0:
            raise ArchiveError(f"{where}: bad revisit record")
        refers_to, payload = _page_id(fields["warc-refers-to"]), None
    else:
        raise ArchiveError(f"{where}: unknown record type {kind!r}")
    return page_id, fields.get("warc-target-uri"), kind, refers_to, payload, told, digest


# ---------------------------------------------------------------- one archive


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary


def frame_end(data: memoryview, start: int, where: str) -> int:
    """Offset after the frame that starts here, from its header and block sizes."""
    if len(data) < start + 6 or struct.unpack_from("<I", data, start)[0] != FRAME_MAGIC:
        raise ArchiveError(f"{where}: no frame")
    flags = data[start + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    at = start + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3]
    at += (single, 2, 4, 8)[flags >> 6]
    last = False
    while not last:
        if at + 3 > len(data):
            raise ArchiveError(f"{where}: the frame is cut off")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        if kind == 3:
            raise ArchiveError(f"{where}: reserved block type")
        at += 3 + (1 if kind == 1 else size)
    at += 4 * checksum
    if at > len(data):
        raise ArchiveError(f"{where}: the frame is cut off")
    return at


def read_archive(content: bytes, name: str) -> Iterator[tuple]:
    """All records of an archive, one frame each."""
    import zstandard

    data, at, dictionary = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE_MAGIC:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        if at > len(data):
            raise ArchiveError(f"{name}: the dictionary is cut off")
        raw = bytes(data[8:at])
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # it may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        where = f"{name} at {at}"
        end = frame_end(data, at, where)
        frame = data[at:end]
        try:
            size = zstandard.frame_content_size(frame)
            raw = reader.decompress(frame) if size >= 0 else b"".join(reader.read_to_iter(bytes(frame)))
        except zstandard.ZstdError as error:
            raise ArchiveError(f"{where}: {error}") from None
        yield parse_record(raw, where)
        at = end


# ---------------------------------------------------------------- Spark


def train_dictionary(pages: DataFrame, sample: int = 400, size: int = 32_768) -> bytes:
    """A dictionary from a bounded sample: about ``sample`` distinct payloads of 100 bytes or
    more, chosen by their hash, 8 KiB of each. Empty where that is too little to train on."""
    import zstandard

    share = sample / max(1, pages.count())
    draw = F.pmod(F.xxhash64("html", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    drawn = pages.filter((draw < share) & (F.octet_length("html") >= 100))
    head = F.substring(F.encode("html", "UTF-8"), 1, 8192).alias("head")
    # copies are drawn together and combine in their tasks
    rows = drawn.select(F.sha2("html", 256).alias("digest"), head).dropDuplicates(["digest"]).collect()
    try:
        heads = [bytes(row.head) for row in sorted(rows)]
        return zstandard.train_dictionary(size, heads).as_bytes()
    except zstandard.ZstdError:
        return b""


def plan_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, refers_to, is_revisit).

    Payloads of fewer than ``least`` bytes are always responses.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)}
    )
    # one small row per payload that has several pages; hot payloads combine map-side
    again = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    joined = rows.join(broadcast_if_small(again), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumns(
        {"refers_to": F.when(revisit, F.col("first")), "is_revisit": revisit}
    ).drop("first")


def write_archives(
    records: DataFrame, folder: str, dictionary: bytes, level: int = 3, most: int = 16 << 20
) -> DataFrame:
    """Write ``records`` (as from plan_records) to archives under ``folder``; returns
    the manifest (path, records, bytes), a written table. A task starts another
    archive after ``most`` compressed bytes."""

    def write(batches):
        import pyarrow.fs
        import zstandard

        target, root = pyarrow.fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
        parts, held, count, made = [], 0, 0, []

        def close():
            nonlocal parts, held, count
            name = f"{uuid.uuid4().hex}.warc.zst"
            with target.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(dictionary_frame(dictionary))
                for part in parts:
                    out.write(part)
            made.append((name, count, held))
            parts, held, count = [], 0, 0

        names = ("page_id", "url", "payload", "digest", "refers_to", "is_revisit")
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in names]
            for row in zip(*columns):
                parts.append(writer.compress(record_bytes(*row)))
                held += len(parts[-1])
                count += 1
                if held >= most:
                    close()
        if parts:
            close()
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in made],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return materialise(records.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records (see RECORD) of the archives given as rows (path, content)."""

    def read(batches):
        fields = ("page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest")
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string())
        schema = pa.schema(list(zip(fields, kinds)))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], schema=schema
            )

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for row in read_archive(content.as_py(), path.as_py()):
                    rows.append(row)
                    held += len(row[4] or b"")
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select("path", "content").mapInArrow(read, RECORD)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write all pages (page_id, url, html); returns the manifest and the folder."""
    folder = folder or new_path(spark, "warc")
    if folder.startswith("/"):
        folder = f"file://{folder}"
    records = plan_records(pages)
    dictionary = train_dictionary(pages)
    return write_archives(records, folder, dictionary), folder


def open_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The archives of the manifest as (path, content); other files are not read."""
    if manifest.isEmpty():
        return spark.createDataFrame([], "path string, content binary")
    files = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    listed = manifest.select(F.col("path").alias("name"))
    return files.join(broadcast_if_small(listed), name == F.col("name"), "left_semi").select(
        "path", "content"
    )
