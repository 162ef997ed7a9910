"""WARC archives of Zstandard frames, a record each, with a dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import datetime
import hashlib
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import unused_name
from terrace.llm.shared_files import NewFile, open_file

#: Fixed values of the format: the magic number of the skippable frame that holds the dictionary.
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"

#: An archive's dictionary is built from its first records, so many bytes of them, and has so many bytes.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 1 << 30

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long, bytes long"
RECORDS = (
    "record_id string, record_type string, url string, payload binary, payload_bytes long,"
    " payload_digest string, refers_to string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(text: str) -> str:
    """A header's value on one line: what would end the line is escaped, as in a URL."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(identity: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """The bytes of a ``response``, or of a ``revisit`` (whose block is empty) where it refers to another."""
    block = payload if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{_header(identity)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{_header(refers_to)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"not a WARC record of {length} bytes: {head[:200]!r}")
    revisit = fields["WARC-Type"] == "revisit"
    payload, digest = rest[:length], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and base32_sha1(payload) != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    name = lambda key: _plain(fields[key][len("<urn:page:") : -1]) if key in fields else None
    return {
        "record_id": name("WARC-Record-ID"),
        "record_type": fields["WARC-Type"],
        "url": _plain(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "payload": None if revisit else payload,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "refers_to": name("WARC-Refers-To"),
    }


class ArchiveWriter:
    """Writes one archive; its first records wait, within ``SAMPLE_BYTES``, for the dictionary made from them."""

    def __init__(self, folder: str):
        self.file, self.records, self.sample, self.held = NewFile(folder, ".warc.zst"), 0, [], 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compressor:
            self.file.write(self.compressor.compress(data))
            return
        self.sample.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        trained = None
        if len(self.sample) >= 8:
            size = min(DICTIONARY_BYTES, max(1024, self.held // 16))
            try:  # fixed parameters: the search for better ones takes longer than all compression
                pieces = [x[:SAMPLE_BYTES // 8] for x in self.sample]
                trained = zstandard.train_dictionary(size, pieces, k=256, d=8)
            except zstandard.ZstdError:  # too little or too uniform data for a dictionary
                trained = None
        if trained:
            frame = trained.as_bytes()
            self.file.write(DICTIONARY_FRAME + len(frame).to_bytes(4, "little") + frame)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        for data in self.sample:
            self.file.write(self.compressor.compress(data))
        self.sample = []

    def close(self) -> tuple[str, int, int]:
        if not self.compressor:
            self._start()
        self.file.close()
        return self.file.uri, self.records, self.file.written


def read_records(uri: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive one after another, in memory for one record and one chunk."""
    with open_file(uri) as file:
        data = file.read(8)
        known = None
        if data[:4] == DICTIONARY_FRAME:
            known = zstandard.ZstdCompressionDict(file.read(int.from_bytes(data[4:], "little")))
            data = b""
        decompressor = zstandard.ZstdDecompressor(dict_data=known)
        while data or (data := file.read(chunk)):
            frame, parts = decompressor.decompressobj(), []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data
                    break
                if not (data := file.read(chunk)):
                    raise ValueError(f"{uri} ends within a record")
            yield b"".join(parts)


def _digest(payload: Column) -> Column:
    return F.unhex(F.sha1(F.coalesce(payload, F.lit(b""))))


def with_revisits(df: DataFrame, key: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to``: of rows with equal payloads of ``least_bytes`` or more, the largest key; null for
    rows of that key itself (so for repeated rows of it), for smaller payloads, and for null keys. A null payload
    is an empty one.

    The largest keys are combined before the shuffle, so that a payload that a third of the rows share is one
    row per task there. Rows meet them in a join that adaptive execution splits where one payload is hot.
    """
    digest, first, at = (unused_name(df, n) for n in ("digest", "first_key", "at"))
    known = df.withColumn(digest, _digest(F.col(payload)))
    firsts = (
        known.where(F.coalesce(F.octet_length(payload), F.lit(0)) >= least_bytes)
        .groupBy(F.col(digest).alias(at))
        .agg(F.max(key).alias(first))
    )
    return (
        known.join(firsts.hint("merge"), F.col(digest) == F.col(at), "left")
        .withColumn("refers_to", F.when(F.col(first) != F.col(key), F.col(first)))
        .drop(digest, first, at)
    )


def write_archives(df: DataFrame, folder: str, key: str, url: str, payload: str) -> DataFrame:
    """Writes a record per row (``key``, ``url``, binary ``payload``, ``refers_to``), and gives a row per archive.

    Each task writes archives of its own, one after another at ``ARCHIVE_BYTES``. They are named in the rows
    returned, and only those count: keep the rows, in a table, before using the archives. A null key is the
    empty identity, a null payload an empty one, and a null URL leaves its header out. An empty table writes
    no archive; repeated rows are a record each; other columns are not archived.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive, done = None, []
        date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for batch in batches:
            for identity, target, data, other in batch.itertuples(index=False, name=None):
                archive = archive or ArchiveWriter(folder)
                archive.add(record(identity, target, data, other, date))
                if archive.file.written >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    rows = df.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit(b"")).alias("payload"),
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    return rows.mapInPandas(write, MANIFEST)


def read_archives(manifest: DataFrame, tasks: int, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives that a manifest names, each archive read by one task in a stream."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["archive"]:
                held, size = [], 0
                for data in read_records(uri):
                    held.append(parse(data))
                    size += len(data) if with_payload else 0
                    if not with_payload:
                        held[-1]["payload"] = None
                    if len(held) >= 2000 or size >= 8 << 20:
                        yield pd.DataFrame(held)
                        held, size = [], 0
                if held:
                    yield pd.DataFrame(held)

    names = manifest.select("archive").repartition(tasks, "archive")
    return names.mapInPandas(read, RECORDS)
