"""Web pages as Zstandard-compressed WARC archives, written and read back.

An archive file starts with a skippable frame that holds the Zstandard dictionary of the file; every record is a frame of
its own. Of records with equal payloads of at least `least` bytes, the one with the largest id is a response and the
others revisit it.

Defined results: a null html is an empty payload. A null url leaves the target out. A null id is written without id, its
record is a response and takes no part in the comparison. Rows that repeat the largest id with the same payload are all
responses. No rows: no file, and reading returns no rows. Other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import join_by_group, query, stored, table
from tidemark.session import scratch_path

# Fixed values of the two formats.
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Records and bytes of a file that its dictionary is trained on, and the size of the dictionary.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 64, 1 << 20, 16 << 10
#: A file is closed once it has so many bytes.
FILE_BYTES = 32 << 20

ARCHIVED = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


class BadArchive(ValueError):
    """An archive that breaks the format, or the lengths and digests that its records state."""


def with_record_types(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload, record_type and refers_to of every page."""
    pages = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    long_enough = (F.length("payload") >= least) & F.col("page_id").isNotNull()
    pages = pages.withColumn("digest", F.when(long_enough, F.sha1("payload")))
    ids = stored(pages.where("digest IS NOT NULL").select("page_id", "digest"), "digests")
    copies = ids.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    pages = join_by_group(pages, stored(copies, "copies"), "digest", "n", ids.count())
    revisit = F.col("last") > F.col("page_id")
    return pages.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, least: int = 1000) -> None:
    """Writes page_id, url and html of `pages` to .warc.zst files below `folder`.

    `folder` lies in a store that all executors reach (a shared file system, or one that pyarrow can open). A task that
    runs again writes the same files again: records are sorted, and a file gets its name once it is complete.
    """
    records = with_record_types(pages, least).sortWithinPartitions("page_id", "url", F.sha1("payload"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open_store(folder)
        store.create_dir(root, recursive=True)
        part, files, batch, size = TaskContext.get().partitionId(), 0, [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                batch.append(_record(row))
                size += len(batch[-1])
                if size >= FILE_BYTES:
                    _write_file(store, f"{root}/part-{part:06d}-{files:04d}.warc.zst", batch)
                    files, batch, size = files + 1, [], 0
        if batch:
            _write_file(store, f"{root}/part-{part:06d}-{files:04d}.warc.zst", batch)
            files += 1
        yield pd.DataFrame({"files": [files]})

    records.mapInPandas(write, "files long").agg(F.sum("files")).collect()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives below `folder`; a damaged archive raises BadArchive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ARCHIVED.split(", ")]
        for frame in frames:
            for content in frame["content"]:
                rows, size = [], 0
                for record in records_of(content):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size > FILE_BYTES:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    return files.mapInPandas(read, ARCHIVED)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The decoded records of one archive file, a frame each."""
    view, at = memoryview(archive), 0
    if len(view) < 8:
        raise BadArchive("the archive is shorter than a frame's head")
    magic, size = struct.unpack_from("<II", view)
    dictionary = None
    if magic == DICTIONARY_MAGIC:
        at = 8 + size
        if at > len(view):
            raise BadArchive("the dictionary is cut off")
        content = bytes(view[8:at])
        if content.startswith(FRAME_MAGIC):
            content = zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 27)
        dictionary = zstandard.ZstdCompressionDict(content)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        if at + 8 <= len(view) and struct.unpack_from("<I", view, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        step, reader, parts = 1 << 14, decoder.decompressobj(), []
        try:
            while not reader.eof:
                if at >= len(view):
                    raise BadArchive("the last frame is cut off")
                given = view[at : at + step]
                parts.append(reader.decompress(given))
                at += len(given) - len(reader.unused_data)
        except zstandard.ZstdError as e:
            raise BadArchive(f"a frame can't be decoded: {e}") from e
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of a record whose lengths and digests hold."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != VERSION:
        raise BadArchive("a record has no WARC head")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadArchive(f"a line of a head has no name: {line[:80]}")
        fields[name.strip().lower()] = value.strip()
    try:
        length, full = int(fields["content-length"]), int(fields["x-payload-length"])
        kind, digest = fields["warc-type"], _unpack_digest(fields["warc-payload-digest"])
        number, refers = _number(fields["warc-record-id"]), _number(fields.get("warc-refers-to", ""))
    except (KeyError, ValueError) as e:
        raise BadArchive(f"a head lacks a field or has a wrong one: {e}") from e
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise BadArchive("a record's length isn't the one stated")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != full or hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive("a payload isn't the one stated")
    elif kind != "revisit" or length or refers is None:
        raise BadArchive(f"a record of type {kind} isn't as it should be")
    url = fields.get("warc-target-uri")
    return number, None if url is None else unquote(url), payload, full, digest, kind, refers


def _record(row) -> bytes:
    number = None if pd.isna(row.page_id) else int(row.page_id)
    revisit, payload = row.record_type == "revisit", row.payload
    block = b"" if revisit else HTTP_HEAD + payload
    fields = {
        "WARC-Type": row.record_type,
        "WARC-Record-ID": f"<urn:page:{'' if number is None else number}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if row.url is not None:
        fields["WARC-Target-URI"] = quote(row.url, safe="!#$&'()*+,/:;=?@[]~")
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{int(row.refers_to)}>"}
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields.items())])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _unpack_digest(text: str) -> str:
    kind, _, value = text.partition(":")
    if kind != "sha1":
        raise ValueError(text)
    return base64.b32decode(value).hex()


def _number(uri: str) -> int | None:
    text = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    sample, size = [], 0
    for record in records[:SAMPLE_RECORDS]:
        sample.append(record[: SAMPLE_BYTES - size])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:  # too few records to train on: they are the dictionary themselves
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write_file(store: fs.FileSystem, path: str, records: list[bytes]) -> None:
    dictionary = _dictionary(records)
    content = dictionary.as_bytes()
    encoder = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        for record in records:
            out.write(encoder.compress(record))
    store.move(draft, path)


def _open_store(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


@query("op5_warc")
def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    write_archives(table(spark, sf, "pages"), folder)
    found = read_archives(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
