"""WARC records in seekable Zstandard bundles.

Pages become WARC/1.1 records. Records with equal payloads are found by digest: the one with the
smallest id is a response, the others are revisits without a payload. Each bundle is a file of
independent Zstandard frames of about ``FRAME_BYTES`` of records, ended by a seek table in a
skippable frame (the seekable format), so that a frame can be read on its own. The index maps each
record to its bundle, frame and place inside the frame.

Bundles are written by the tasks straight to a shared folder, under a name of their attempt; the index
names only those of attempts that succeeded, so a task run twice leaves a file that nobody reads.

Defined results: a null payload is empty, and equal to other empty ones. Payloads of fewer than
``min_bytes`` bytes are responses each. Of rows with the same id and payload one is the response and the
others revisit it. Null ids and addresses are written as "-". Empty tables give no bundle. A payload longer than a
frame has a frame of its own.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planact.llm.common import col
from planact.session import scratch_path, stage

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 25
LEVEL = 3
# Fixed values of the seekable format.
_SKIPPABLE_MAGIC, _SEEK_TABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, record_type string, bundle string, frame int, frame_at long, frame_size int, at int, size int"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _file_system(path: str):
    """The file system of a folder and the folder's name in it; plain paths are local."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return pyarrow.fs.LocalFileSystem(), path


def record(page_id, url, kind: str, refers_to, digest: str, size: int, payload: bytes) -> bytes:
    """One WARC record. The length of the full payload stands in a header, as a revisit has none."""
    def name(i):
        return "-" if i is None else str(i)

    heads = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name(page_id)}>",
        f"WARC-Target-URI: {'-' if url is None else ' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        heads += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{name(refers_to)}>",
        ]
    body = payload if kind == "response" else b""
    heads.append(f"Content-Length: {len(body)}")
    return "\r\n".join(heads).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, body, place behind the record) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    heads = dict(x.split(": ", 1) for x in lines[1:])
    body_at = end + 4
    body_end = body_at + int(heads["Content-Length"])
    if data[body_end : body_end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end where its length says")
    return heads, data[body_at:body_end], body_end + 4


class BundleWriter:
    """Frames into one open file; ``close`` adds the seek table."""

    def __init__(self, out):
        import zstandard

        self.out, self.at, self.frames, self.buffer = out, 0, [], bytearray()
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, place in it); the frame is written once it is full."""
        if self.buffer and len(self.buffer) + len(data) > FRAME_BYTES:
            self.flush()
        place = len(self.frames), len(self.buffer)
        self.buffer += data
        return place

    def flush(self) -> None:
        packed = self.compressor.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((self.at, len(packed), len(self.buffer)))
        self.at += len(packed)
        self.buffer.clear()

    def close(self) -> None:
        if self.buffer:
            self.flush()
        table = b"".join(struct.pack("<II", packed, plain) for _, packed, plain in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, _SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", _SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(place, packed size, plain size) of every frame, read from the end of an open bundle."""
    file.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEK_TABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(size - 9 - 8 * frames)
    entries, at = struct.iter_unpack("<II", file.read(8 * frames)), 0
    out = []
    for packed, plain in entries:
        out.append((at, packed, plain))
        at += packed
    return out


def _write(folder: str):
    def run(frames):
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        writer, name, held = None, None, []

        def index():
            rows = []
            for page_id, kind, frame, at, size in held:
                frame_at, packed, _ = writer.frames[frame]
                rows.append((page_id, kind, name, frame, frame_at, packed, at, size))
            table = pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")])
            table["page_id"] = table["page_id"].astype("Int64")
            return table

        for frame in frames:
            ids = frame["page_id"].astype("Int64")
            refers = frame["refers_to"].astype("Int64")
            for i, (url, kind, digest, size, payload) in enumerate(
                zip(frame["url"], frame["record_type"], frame["hex"], frame["payload_bytes"], frame["payload"])
            ):
                page_id = None if ids.isna().iat[i] else int(ids.iat[i])
                to = None if refers.isna().iat[i] else int(refers.iat[i])
                data = record(page_id, url, kind, to, base32_digest(digest), int(size), b"" if payload is None else bytes(payload))
                if writer is None:
                    name, held = f"bundle-{uuid.uuid4().hex}.warc.zst", []
                    writer = BundleWriter(fs.open_output_stream(f"{base}/{name}", compression=None))
                held.append((page_id, kind, *writer.add(data), len(data)))
                if writer.at + len(writer.buffer) >= BUNDLE_BYTES:
                    writer.close()
                    yield index()
                    writer = None
        if writer is not None:
            writer.close()
            yield index()

    return run


def with_kinds(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, hex, payload_bytes, record_type, refers_to)."""
    payload = F.coalesce(col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"), payload.alias("payload"),
        F.monotonically_increasing_id().alias("row_no"),
    ).withColumns({"hex": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    # Only digests that occur again go to the join; counts and minima are partial before the shuffle.
    # Row numbers matter only where rows share the smallest id, so a response never depends on them.
    again = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("hex", "page_id")
        .agg(F.count("*").alias("n"), F.min("row_no").alias("row_no"))
        .groupBy("hex")
        .agg(F.sum("n").alias("rows"), F.min(F.struct("page_id", "n", "row_no")).alias("first"))
        .where("rows > 1")
        .select("hex", "first")
    )
    joined = rows.join(stage(again, "repeated-payloads"), "hex", "left")
    tied = (F.col("first.n") > 1) & (F.col("row_no") > F.col("first.row_no"))
    later = F.col("first").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("first.page_id")) | tied)
    revisits = joined.withColumn("record_type", F.when(later, "revisit").otherwise("response"))
    return revisits.select(
        "page_id", "url", F.when(later, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "hex", "payload_bytes",
        "record_type", F.when(later, F.col("first.page_id")).alias("refers_to"),
    )


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write all pages to bundles below ``folder``; the index, one row per record."""
    rows = with_kinds(pages, id_col, url_col, payload_col, min_bytes)
    return stage(rows.mapInPandas(_write(folder), INDEX), "warc-index")


def _read(folder: str):
    def run(frames):
        import zstandard

        fs, base = _file_system(folder)
        plain = zstandard.ZstdDecompressor()
        for frame in frames:
            for name in frame["bundle"]:
                path = f"{base}/{name}"
                size = fs.get_file_info(path).size
                with fs.open_input_file(path) as file:
                    for at, packed, whole in seek_table(file, size):
                        file.seek(at)
                        data = plain.decompress(file.read(packed), max_output_size=whole)
                        rows, place = [], 0
                        while place < len(data):
                            heads, body, place = parse(data, place)
                            rows.append(_row(heads, body))
                        out = pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD.split(", ")] + ["payload"])
                        out["page_id"], out["refers_to"] = out["page_id"].astype("Int64"), out["refers_to"].astype("Int64")
                        yield out

    return run


def _row(heads: dict[str, str], body: bytes):
    def number(name):
        text = heads.get(name, "<urn:page:->")[len("<urn:page:") : -1]
        return None if text == "-" else int(text)

    url, kind, size = heads["WARC-Target-URI"], heads["WARC-Type"], int(heads["X-Payload-Length"])
    digest = heads["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (base32_digest(hashlib.sha1(body).hexdigest()), len(body)) != (digest, size):
        raise ValueError(f"the payload of {heads['WARC-Record-ID']} is not what its record says")
    return (
        number("WARC-Record-ID"), None if url == "-" else url, kind, number("WARC-Refers-To"), digest, size,
        body if kind == "response" else None,
    )


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that the index names, frame by frame."""
    names = index.select("bundle").distinct()
    return names.mapInPandas(_read(folder), RECORD + ", payload binary")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows given, each read at its own place: one frame, nothing else of the bundle."""

    def run(frames):
        import zstandard

        fs, base = _file_system(folder)
        plain = zstandard.ZstdDecompressor()
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                with fs.open_input_file(f"{base}/{r.bundle}") as file:
                    file.seek(int(r.frame_at))
                    data = plain.decompress(file.read(int(r.frame_size)))
                heads, body, _ = parse(data, int(r.at))
                rows.append(_row(heads, body))
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD.split(", ")] + ["payload"])
            out["page_id"], out["refers_to"] = out["page_id"].astype("Int64"), out["refers_to"].astype("Int64")
            yield out

    return index.mapInPandas(run, RECORD + ", payload binary")


def archived(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` to bundles and read the records back; payload digests are checked on the way.

    (page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload): a revisit's payload is null.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder, **columns), folder)
