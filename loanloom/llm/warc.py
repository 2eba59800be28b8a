"""WARC archives: one gzip stream per file, normalised to one member per record.

Three passes over files of bounded size, each a task per file: write records
into monolithic streams, inflate every stream once and rewrite its records as
members of their own with a sidecar offset index, and read single records back
by their offsets. Payloads are streamed; a task holds one record at a time.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.shared import attempt_name, folder, opened, stored

#: Payloads shorter than this are always written whole.
LEAST_REVISIT = 100
#: Bytes of records in one archive, about.
FILE_BYTES = 32 << 20
#: Repeated payloads whose keys are broadcast at most (about 50 bytes each).
BROADCAST_PAYLOADS = 200_000
LEVEL = 3
_CHUNK = 1 << 18
_DATE = "2000-01-01T00:00:00Z"


# --- records ----------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, size: int, digest: str) -> bytes:
    """One WARC record; a revisit has no block of its own."""
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": "".join(c for c in url or "" if c >= " "),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(size),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": "0" if revisit else str(size),
    }
    if revisit:
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header, block and raw bytes of every record of an inflated stream."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record starts with {line[:40]!r}")
        raw, head = [line], {}
        while (line := stream.readline()).strip():
            raw.append(line)
            name, _, value = line.decode().partition(":")
            head[name.strip()] = value.strip()
        raw.append(line)
        block = stream.read(int(head["Content-Length"]))
        tail = stream.read(4)
        if len(block) != int(head["Content-Length"]) or tail != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield head, block, b"".join([*raw, block, tail])


class Inflated(io.RawIOBase):
    """A gzip file's content, inflated in pieces; further members follow on."""

    def __init__(self, source):
        self.source, self.left, self.out = source, b"", b""
        self.inflate = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.out:
            if self.inflate.eof:
                self.left = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
            data = self.left or self.source.read(_CHUNK)
            self.left = b""
            if not data:
                return 0
            self.out = self.inflate.decompress(data, _CHUNK)
            self.left = self.inflate.unconsumed_tail
            if self.inflate.eof and not self.left:
                self.left, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        n = min(len(buffer), len(self.out))
        buffer[:n], self.out = self.out[:n], self.out[n:]
        return n


def _page(uri: str) -> int | None:
    text = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


# --- passes -----------------------------------------------------------------


def decided(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, size, digest, refers_to`` of every page.

    ``refers_to`` is the response of a revisit, else null. Of equal payloads of
    at least ``least`` bytes the smallest page_id is the response (all rows that
    repeat it are); null ids come after all others.
    """
    payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))
    long = rows.filter(F.col("size") >= least)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select(F.col("digest").alias("same"), "first"), "repeated-payloads")
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_PAYLOADS else repeated
    joined = rows.join(side, (F.col("digest") == F.col("same")) & (F.col("size") >= least), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "payload", "size", "digest", refers.alias("refers_to"))


def _write(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    out = squeeze = uri = None
    size = count = 0

    def closed() -> pa.RecordBatch:
        out.write(squeeze.flush())
        out.close()
        return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([count])], names=["uri", "records"])

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "size", "digest", "refers_to")]
        for i in range(batch.num_rows):
            page, url, payload, length, digest, refers = (c[i].as_py() for c in columns)
            if out is None:
                uri = f"{root}/{attempt_name('pages', '.gz')}"
                system, path = opened(uri)
                out, squeeze, size, count = system.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
            data = record(page, url, payload, refers, refers is not None, length, digest)
            out.write(squeeze.compress(data))
            size, count = size + len(data), count + 1
            if size >= FILE_BYTES:
                yield closed()
                out = None
    if out is not None:
        yield closed()


def write_monolithic(rows: DataFrame) -> DataFrame:
    """Archives of one gzip stream each; their ``uri`` and number of ``records``."""
    root = folder(rows.sparkSession, "warc-streams")
    return stored(rows.mapInArrow(lambda b: _write(b, root), "uri string, records long"), "warc-streams-list")


INDEX = "uri string, offset long, length long, page_id long, record_type string, payload_digest string"


def _normalise(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source in batch.column("uri").to_pylist():
            uri = f"{root}/{attempt_name('pages', '.warc.gz')}"
            system, path = opened(uri)
            rows, offset = [], 0
            from_system, from_path = opened(source)
            with from_system.open_input_stream(from_path, compression=None) as stream, system.open_output_stream(path, compression=None) as out:
                for head, _, raw in parse(io.BufferedReader(Inflated(stream), _CHUNK)):
                    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = squeeze.compress(raw) + squeeze.flush()
                    out.write(member)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    rows.append((uri, offset, len(member), _page(head["WARC-Record-ID"]), head["WARC-Type"], digest))
                    offset += len(member)
            with system.open_output_stream(f"{path}.idx", compression=None) as out:
                for row in rows:
                    out.write((" ".join(map(str, row[1:])) + "\n").encode())
            for a in range(0, len(rows), 10_000):
                part = list(zip(*rows[a : a + 10_000], strict=True))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                arrays = [pa.array(x, k) for x, k in zip(part, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["uri", "offset", "length", "page_id", "record_type", "payload_digest"]
                )


def normalise(files: DataFrame) -> DataFrame:
    """Rewrite monolithic archives record by record; the offset index as a table.

    Beside every new archive lies the same index as text (``.idx``).
    """
    root = folder(files.sparkSession, "warc-members")
    spread = files.select("uri").repartition(max(1, files.count()))
    return stored(spread.mapInArrow(lambda b: _normalise(b, root), INDEX), "warc-index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            system, path = opened(uri)
            with system.open_input_stream(f"{path}.idx", compression=None) as lines:
                index = [line.split() for line in lines.read().decode().splitlines()]
            rows = []
            with system.open_input_file(path) as file:
                for offset, length, *_ in index:
                    raw = zlib.decompress(file.read_at(int(length), int(offset)), 31)
                    ((head, block, _),) = parse(io.BytesIO(raw))
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if head["WARC-Type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"{uri}: the payload at {offset} does not have its digest")
                    refers = head.get("WARC-Refers-To")
                    rows.append(
                        (_page(head["WARC-Record-ID"]), int(head["WARC-Payload-Length"]), digest, head["WARC-Type"], refers and _page(refers))
                    )
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            for a in range(0, len(rows), 10_000):
                part = zip(*rows[a : a + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(part, kinds, strict=True)], names=names)


def read_back(index: DataFrame) -> DataFrame:
    """Every record of the archives, fetched by its offset and checked against its digest."""
    files = stored(index.select("uri").distinct(), "warc-files")
    spread = files.repartition(max(1, files.count()))
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInArrow(_read, kinds)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages, normalise the archives and read every record back.

    A null html is an empty payload, a null url an empty one; an empty table
    gives no archive and no rows; extra columns play no part.
    """
    return read_back(normalise(write_monolithic(decided(pages))))
