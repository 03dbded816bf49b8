"""WARC archives in Zstandard frames: writer and reader.

An archive starts with a skippable frame that holds a Zstandard dictionary;
after it comes one frame per record.  The reader loads the dictionary from
that frame, finds each frame's end by its block headers, decodes one frame per
record, and validates version, headers, lengths and digests.  Archives of other
writers are read too: frames of unknown size, skippable frames between records,
repeated and folded headers, records of any type.

Each task writes its own archives (about ``ARCHIVE_BYTES`` each, with a
dictionary trained on their first records) straight to the shared folder;
names are new for every attempt, and the stored manifest lists those of the
attempts that counted, so a lost or repeated task leaves no false record.
Equal payloads of at least ``min_bytes`` are stored once: the record with the
largest id is a response and the others revisit it.

Defined results: a null payload is empty; null and repeated ids are kept row
by row (rows that tie on the largest id are all responses; a null id revisits
if any copy has an id); a null address gives a record without one; an empty
table gives an empty result; extra columns are ignored.  A record that isn't valid is
a row with its error; ``checked`` makes it, or a missing record, a ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import batch_rows, read_table, small_batches, stored
from corpusflow.llm.registry import query
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.session import shared_path

# Fixed values of the formats.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
RAW_DICT_MAGIC = 0xEC30A437
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", VERSION)
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICT_BYTES = 16 << 10
MAX_BROADCAST_REVISITS = 200_000


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return VERSION + b"\r\n" + head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def page_record(rid: int | None, url: str | None, payload: bytes, size: int, sha1_hex: str, refers_to: int | None, revisit: bool) -> bytes:
    """One response, or one revisit that carries the headers alone."""
    heads = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if rid is None else rid}>"), ("WARC-Date", DATE)]
    if url is not None:
        heads.append(("WARC-Target-URI", _clean(url)))
    heads.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()))
    if revisit:
        heads += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    heads.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(heads, http if revisit else http + payload)


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or none (empty) where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def dict_frame(raw: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(raw) if raw else b""
    return struct.pack("<II", DICT_MAGIC, len(packed)) + packed


def load_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame and where the records start."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICT_MAGIC:
        return None, 0
    n = struct.unpack_from("<I", data, 4)[0]
    if 8 + n > len(data):
        raise ValueError("dictionary frame is cut off")
    raw = bytes(data[8:8 + n])
    if raw[:4] == struct.pack("<I", FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    if not raw:
        return None, 8 + n
    if raw[:4] != struct.pack("<I", RAW_DICT_MAGIC):
        raise ValueError("no dictionary in the leading frame")
    return zstandard.ZstdCompressionDict(raw), 8 + n


def frame_end(data: memoryview, at: int) -> int:
    """End of the frame that starts at ``at``, by its header and block headers."""
    if len(data) < at + 6 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError("no frame")
    desc = data[at + 4]
    single = desc >> 5 & 1
    p = at + 5 + (not single) + (0, 1, 2, 4)[desc & 3] + ((1 if single else 0), 2, 4, 8)[desc >> 6]
    while True:
        if p + 3 > len(data):
            raise ValueError("frame is cut off")
        head = data[p] | data[p + 1] << 8 | data[p + 2] << 16
        p += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            p += 4 * (desc >> 2 & 1)
            if p > len(data):
                raise ValueError("frame is cut off")
            return p


def _decoded(unzip: zstandard.ZstdDecompressor, frame: memoryview) -> bytes:
    """One whole frame, also one that a streaming writer made and that doesn't tell its size."""
    out = unzip.decompressobj()
    record = out.decompress(frame)
    if not out.eof:
        raise ValueError("frame is cut off")
    return record


def parse(record: bytes) -> dict:
    """Headers and block of one record; raises ValueError where it isn't valid.  Of a
    repeated header the first value counts; lines that start with a blank go on with the last one."""
    end = record.find(b"\r\n\r\n")
    lines = record[:max(end, 0)].split(b"\r\n")
    if end < 0 or lines[0] not in VERSIONS:
        raise ValueError("version line")
    pairs: list[list[str]] = []
    for line in lines[1:]:
        text = line.decode("utf-8")
        if pairs and text[:1] in (" ", "\t"):
            pairs[-1][1] += " " + text.strip()
            continue
        name, sep, value = text.partition(":")
        if not sep or not name.strip():
            raise ValueError("header line")
        pairs.append([name.strip().lower(), value.strip()])
    heads = dict(reversed(pairs))
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in heads:
            raise ValueError(f"no {name}")
        if len({value for other, value in pairs if other == name}) > 1:
            raise ValueError(f"several {name}")
    size = heads["content-length"]
    if not (size.isascii() and size.isdigit()) or len(record) != end + 4 + int(size) + 4 or record[-4:] != b"\r\n\r\n":
        raise ValueError("content length")
    block = record[end + 4:-4]
    given = _sha1(heads.get("warc-block-digest"))
    if given and hashlib.sha1(block).hexdigest() != given:
        raise ValueError("block differs from its digest")
    return heads | {"block": block}


def _sha1(value: str | None) -> str | None:
    """Hex form of a SHA-1 header value in base 32 or 16; none for other algorithms."""
    algorithm, _, digest = (value or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    digest = digest.strip()
    if len(digest) == 40:
        return bytes.fromhex(digest).hex()
    if len(digest) != 32:
        raise ValueError("payload digest")
    return base64.b32decode(digest, casefold=True).hex()


def _page_id(urn: str) -> int | None:
    """The id in one of this writer's record names; none for other writers' names."""
    digits = urn[10:-1] if urn.startswith("<urn:page:") and urn.endswith(">") else ""
    return int(digits) if digits.removeprefix("-").isdecimal() else None


def _payload(heads: dict) -> tuple[bytes, int | None, bool]:
    """(payload, the length its HTTP header tells, whether that header may be held against it)."""
    block = heads["block"]
    if not heads.get("content-type", "").lower().startswith("application/http"):
        return block, None, False
    http, sep, payload = block.partition(b"\r\n\r\n")
    fields = [(name.strip().lower(), value.strip()) for name, _, value in (x.partition(b":") for x in http.split(b"\r\n")[1:])]
    sizes = {value for name, value in fields if name == b"content-length"}
    if not sep or len(sizes) > 1 or not all(value.isdigit() for value in sizes):
        raise ValueError("http block")
    coded = any(name == b"transfer-encoding" for name, _ in fields)
    return payload, int(sizes.pop()) if sizes else None, not coded and "warc-truncated" not in heads


def page_row(heads: dict) -> tuple:
    """(id, payload bytes, hex digest, type, refers to, payload, record name, address, name referred to).

    A response is held against its HTTP length and payload digest unless it is sent in
    chunks or marked as truncated; a revisit's length and digest are those it tells of the
    payload.  Records of further types are rows of their own type."""
    kind = heads["warc-type"].lower()
    payload, told, whole = _payload(heads)
    digest = _sha1(heads.get("warc-payload-digest"))
    names = heads["warc-record-id"], heads.get("warc-target-uri"), heads.get("warc-refers-to")
    if kind == "revisit":
        return _page_id(names[0]), told, digest, kind, _page_id(names[2] or ""), payload, *names
    own = hashlib.sha1(payload).hexdigest()
    if kind == "response" and whole and (told not in (None, len(payload)) or digest not in (None, own)):
        raise ValueError("payload differs from its length or digest")
    return _page_id(names[0]), len(payload), own, kind, None, payload, *names


def read_archive(data: bytes):
    """Yields (row, None) or (None, error) per record after the archive's own."""
    view = memoryview(data).cast("B")
    try:
        known, at = load_dictionary(view)
    except (ValueError, zstandard.ZstdError) as e:
        yield None, str(e)
        return
    unzip = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(view):
        try:
            if len(view) >= at + 8 and struct.unpack_from("<I", view, at)[0] in SKIPPABLE:
                at += 8 + struct.unpack_from("<I", view, at + 4)[0]
                if at > len(view):
                    raise ValueError("skippable frame is cut off")
                continue
            end = frame_end(view, at)
        except ValueError as e:  # the next record can't be found
            yield None, str(e)
            return
        try:
            heads = parse(_decoded(unzip, view[at:end]))
            if heads["warc-type"].lower() != "warcinfo":
                yield page_row(heads), None
        except (ValueError, zstandard.ZstdError) as e:
            yield None, str(e)
        at = end


def _writer(folder: str):
    def run(batches):
        from pyarrow import fs
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        out = zipper = None
        size, count, name, waiting, waiting_bytes = 0, 0, "", [], 0

        def opened():
            nonlocal out, zipper, size, count, name, waiting, waiting_bytes
            name = f"part-{uuid.uuid4().hex}.warc.zst"
            raw = dictionary(waiting)
            zipper = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdCompressor(level=3)
            out = store.open_output_stream(f"{top}/{name}", compression=None)
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            size = count = 0
            for piece in (dict_frame(raw), zipper.compress(info)):
                out.write(piece)
                size += len(piece)
            held, waiting, waiting_bytes = waiting, [], 0
            for r in held:
                put(r)

        def put(record):
            nonlocal size, count
            piece = zipper.compress(record)
            out.write(piece)
            size += len(piece)
            count += 1

        def closed():
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pydict({"name": [name], "records": [count], "bytes": [size]})

        for b in batches:
            ids, urls, pages, sizes, digests, refers, marks = (b.column(i) for i in range(7))
            for i in range(b.num_rows):
                revisit = marks[i].as_py()
                payload = b"" if revisit else (pages[i].as_py() or "").encode()
                record = page_record(ids[i].as_py(), urls[i].as_py(), payload, sizes[i].as_py(), digests[i].as_py(), refers[i].as_py(), revisit)
                if out is None:
                    waiting.append(record)
                    waiting_bytes += len(record)
                    if waiting_bytes >= SAMPLE_BYTES:
                        opened()
                else:
                    put(record)
                if out is not None and size >= ARCHIVE_BYTES:
                    yield closed()
        if waiting:
            opened()
        if out is not None:
            yield closed()
    return run


def write_archives(pages: DataFrame, *, key: str, url: str, payload: str, min_bytes: int = 1000) -> tuple[str, DataFrame]:
    """Write all rows as records; the archives' folder and the stored manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    # narrow rows only; the map-side combine makes one row per digest and task
    copies = rows.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
    copies = copies.filter("n > 1 and refers_to is not null").select("digest", "refers_to")
    revisits = stored(rows.filter(F.col("size") >= min_bytes).select("id", "digest").join(copies, "digest")
                      .filter("id is null or id <> refers_to").select(F.coalesce("id", F.lit(0)).alias("id0"), F.col("id").isNull().alias("no_id"), "digest", "refers_to").distinct(), "warc-revisits")
    found = (rows.withColumns({"id0": F.coalesce("id", F.lit(0)), "no_id": F.col("id").isNull()})
             .join(broadcast_if_small(revisits, MAX_BROADCAST_REVISITS), ["id0", "no_id", "digest"], "left"))
    folder = shared_path(spark, "warc")
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file://" + folder[5:]
    is_revisit = F.col("refers_to").isNotNull()
    written = found.select("id", "url", F.when(~is_revisit, F.col("html")).alias("html"), "size", "digest", "refers_to", is_revisit.alias("revisit"))
    manifest = stored(written.mapInArrow(_writer(folder), "name string, records long, bytes long"), "warc-manifest")
    return folder, manifest


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "record_id string, target_uri string, refers_to_id string, archive string, error string")


def _reader(batches):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string()]
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    for b in batches:
        for i in range(b.num_rows):
            name, rows = b.column(0)[i].as_py(), []
            for row, error in read_archive(b.column(1)[i].as_buffer()):
                rows.append((*((*row[:5], *row[6:]) if row else (None,) * 8), name, error))  # the payload stays behind
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_folder(spark: SparkSession, folder: str, pattern: str = "*.warc.zst") -> DataFrame:
    """One row per record of all archives of a folder, whoever wrote them; ``error`` says what isn't
    valid.  Archives stay where they are read; the narrow rows are stored."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    with batch_rows(spark, 4):  # whole archives: a few at a time
        return stored(files.mapInArrow(_reader, READ_SCHEMA), "warc-records")


def read_archives(folder: str, manifest: DataFrame) -> DataFrame:
    """Rows of the archives that the manifest lists, those of lost or repeated attempts left out."""
    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], READ_SCHEMA)
    listed = broadcast_if_small(manifest.select(F.col("name").alias("archive")))
    return read_folder(spark, folder).join(listed, "archive", "left_semi").select(*(x.split()[0] for x in READ_SCHEMA.split(", ")))


def checked(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """``rows``, or a ValueError that names archives with invalid records or other numbers of them than written."""
    got = rows.groupBy("archive").agg(F.count("*").alias("n"), F.min("error").alias("error"))
    wrong = manifest.join(got, manifest["name"] == got["archive"], "left").filter("error is not null or n is null or n <> records")
    named = [f"{r.name}: {r.n or 0} of {r.records} records, {r.error}" for r in wrong.limit(5).collect()]
    if named:
        raise ValueError("; ".join(named))
    return rows


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q
"""


@query("op2_warc", WARC_SQL)
def op2_warc(spark, sf_dir):
    folder, manifest = write_archives(read_table(spark, sf_dir, "pages"), key="page_id", url="url", payload="html")
    rows = checked(read_archives(folder, manifest), manifest)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
