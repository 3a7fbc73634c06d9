"""WARC archives: capture, normalise, read back.

``capture`` writes each partition's pages as records of monolithic gzip archives (one gzip stream
over many records, the form that cannot be read at an offset) and returns a row per record.
``decide`` finds equal payloads among all records. ``normalise`` inflates every archive once as a
stream, rewrites each record as a gzip member of its own (a revisit without its payload where the
decision says so) and writes a sidecar index: per line of JSON a record's offset, length, id, type
and digest. ``read`` goes through the index and reads each member by itself.

Files go to the shared folder under names that follow from the partition, so a task that runs
again replaces its files by equal ones. An archive is closed at ``archive_bytes`` of raw records;
no task holds more than one record and one archive's decisions.

A revisit keeps the HTTP head, whose Content-Length is the size of the full payload.

Defined results: a null payload is empty; a null URL gives no WARC-Target-URI, and control or
blank characters of a URL are percent-encoded. Of equal payloads of ``min_bytes`` or more the
largest page id is the response (null ids last, of a repeated id the first in file order); the
others refer to it. No pages give no archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.llm import files
from kardex.llm.common import shared_path, shuffle_partitions, slices, stage

ARCHIVE_BYTES = 128 << 20
END = b"\r\n\r\n"
GZIP = 31  # zlib's window setting for a gzip stream
RECORDS = "path string, nth long, page_id long, payload_digest string, payload_bytes long"
RECORDS_SCHEMA = pa.schema([("path", pa.string()), ("nth", pa.int64()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def head(fields: list[tuple[str, str]], first: str) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields), "", ""]).encode()


def record(kind: str, page: int | None, url: str | None, block: bytes, payload_digest: str, refers: int | None = None,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return head(fields, "WARC/1.1") + block + END


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(text: str) -> int | None:
    value = text[len("<urn:page:"):-1]
    return None if value == "none" else int(value)


def http_head(size: int) -> bytes:
    return head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], "HTTP/1.1 200 OK")


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:] if x)


def inflate(source: BinaryIO, size: int = 1 << 20) -> Iterator[bytes]:
    """The plain bytes of a gzip stream (of any number of members), piece by piece."""
    d = zlib.decompressobj(GZIP)
    while raw := source.read(size):
        while raw:
            plain = d.decompress(raw, 4 * size)
            if plain:
                yield plain
            raw = d.unconsumed_tail
            if d.eof:
                raw, d = d.unused_data, zlib.decompressobj(GZIP)
    if plain := d.flush():
        yield plain


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a plain stream; holds one record at a time."""
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while need(1):
        seen = 0
        while (at := held.find(END, seen)) < 0:
            seen = max(0, len(held) - 3)
            if not need(len(held) + 1):
                raise ValueError("archive ends within a record's head")
        fields = parse_head(bytes(held[:at]))
        start, size = at + 4, int(fields["Content-Length"])
        if not need(start + size + 4):
            raise ValueError("archive ends within a record's block")
        yield fields, bytes(held[start:start + size])
        del held[:start + size + 4]


def capture(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES, page_id: str = "page_id",
            url: str = "url", payload: str = "html") -> DataFrame:
    """Write one response record per page into monolithic gzip archives; a staged row per record."""
    folder = folder or shared_path(pages.sparkSession, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt, source, part = TaskContext.get().partitionId(), uuid.uuid4().hex, Pages(batches), 0
        while source.more():
            path, written = f"{folder}/mono/{task:06d}-{part:05d}.warc.gz", []

            def write(out: BinaryIO) -> None:
                squeeze, size = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
                while size < archive_bytes and source.more():
                    page, address, text = source.take()
                    body = text.encode()
                    sha = digest(body)
                    raw = record("response", page, address, http_head(len(body)) + body, sha)
                    out.write(squeeze.compress(raw))
                    written.append((path, len(written), page, sha, len(body)))
                    size += len(raw)
                out.write(squeeze.flush())

            files.write_whole(path, write, attempt)
            part += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*written), RECORDS_SCHEMA)], schema=RECORDS_SCHEMA)

    return stage(rows.mapInArrow(run, RECORDS), "records")


class Pages:
    """Rows of Arrow batches one by one, with a look whether another follows."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (row for b in slices(batches, "payload", 4 << 20) for row in zip(*(c.to_pylist() for c in b.columns)))
        self.next = next(self.rows, None)

    def more(self) -> bool:
        return self.next is not None

    def take(self) -> tuple:
        row, self.next = self.next, next(self.rows, None)
        return row


def decide(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per record ``refers_to`` and ``revisit``: payloads that occur more than once are aggregated
    first (a hot payload is one row per task then) and staged, so that the join has two plain
    sides, which the engine may broadcast or, for a hot payload, split."""
    # Of a repeated page id the first place wins: the maximum is over ids, the minimum over places.
    groups = (records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "page_id")
              .agg(F.min(F.struct("path", "nth")).alias("at"), F.count("*").alias("n"))
              .groupBy("payload_digest").agg(F.max_by(F.struct("page_id", "at"), F.struct(F.col("page_id").isNotNull(), "page_id")).alias("best"), F.sum("n").alias("n"))
              .where("n > 1").select("payload_digest", F.col("best.page_id").alias("best_id"), F.col("best.at.path").alias("best_path"), F.col("best.at.nth").alias("best_nth")))
    joined = records.join(stage(groups, "payloads"), "payload_digest", "left")
    revisit = F.col("best_path").isNotNull() & ~((F.col("path") == F.col("best_path")) & (F.col("nth") == F.col("best_nth"))) & (F.col("payload_bytes") >= min_bytes)
    return joined.select("path", "nth", revisit.alias("revisit"), F.when(revisit, F.col("best_id")).alias("refers_to"))


FILES = "path string, index string, n long"
FILES_SCHEMA = pa.schema([("path", pa.string()), ("index", pa.string()), ("n", pa.int64())])


def normalise(decisions: DataFrame) -> DataFrame:
    """Rewrite every archive that ``decisions`` names; a staged row per normalised archive."""
    spark = decisions.sparkSession
    sent = decisions.repartition(4 * shuffle_partitions(spark), "path").sortWithinPartitions("path", "nth")

    def rewrite(path: str, plan: list[tuple[bool, int | None]]) -> pa.RecordBatch:
        target = path.replace("/mono/", "/members/")
        index, attempt = [], uuid.uuid4().hex

        def write(out: BinaryIO) -> None:
            offset = 0
            with files.open_stream(path) as source:
                for nth, (fields, block) in enumerate(records_of(inflate(source))):
                    revisit, refers = plan[nth]
                    page, sha = page_of(fields["WARC-Record-ID"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = "revisit" if revisit else "response"
                    if revisit:
                        block = block[:block.index(END) + 4]
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                    member = squeeze.compress(record(kind, page, fields.get("WARC-Target-URI"), block, sha, refers, fields["WARC-Date"])) + squeeze.flush()
                    out.write(member)
                    index.append({"offset": offset, "length": len(member), "id": fields["WARC-Record-ID"], "type": kind, "digest": sha})
                    offset += len(member)
            if len(index) != len(plan):
                raise ValueError(f"{path} has {len(index)} records, not {len(plan)}")

        files.write_whole(target, write, attempt)
        files.write_whole(f"{target}.idx", lambda out: out.write("".join(json.dumps(x) + "\n" for x in index).encode()), attempt)
        return pa.RecordBatch.from_pylist([{"path": target, "index": f"{target}.idx", "n": len(index)}], FILES_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, plan = None, []
        for b in batches:
            for p, revisit, refers in zip(*(b.column(c).to_pylist() for c in ("path", "revisit", "refers_to"))):
                if p != path:
                    if plan:
                        yield rewrite(path, plan)
                    path, plan = p, []
                plan.append((revisit, refers))
        if plan:
            yield rewrite(path, plan)

    return stage(sent.mapInArrow(run, FILES), "archives")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record of the normalised archives, each member found by the sidecar index and read
    by itself; the digest of a response is computed from the payload that was read."""
    spark = archives.sparkSession
    schema = READ + (", payload string" if with_payload else "")

    def one(fields: dict[str, str], block: bytes) -> dict:
        at = block.index(END) + 4
        kind, size = fields["WARC-Type"], int(parse_head(block[:at])["Content-Length"])
        sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (digest(block[at:]) != sha or len(block) - at != size):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        refers = fields.get("WARC-Refers-To")
        row = {"page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": sha,
               "record_type": kind, "refers_to": page_of(refers) if refers else None}
        return row | ({"payload": block[at:].decode() if kind == "response" else None} if with_payload else {})

    names = [x.split()[0] for x in schema.split(", ")]
    types = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, index in zip(b.column("path").to_pylist(), b.column("index").to_pylist()):
                rows: list[dict] = []
                entries = map(json.loads, files.read_whole(index).decode().splitlines())
                with files.open_at(path) as source:
                    for e in entries:
                        source.seek(e["offset"])
                        rows += [one(*r) for r in records_of(iter([zlib.decompress(source.read(e["length"]), GZIP)]))]
                        if len(rows) >= (100 if with_payload else 5000):
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, types)

    return archives.repartition(4 * shuffle_partitions(spark), "path").mapInArrow(run, schema)
