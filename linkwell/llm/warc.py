"""WARC archives: writing, normalizing whole-file gzip streams, reading by an offset index.

A whole-file gzip archive can only be read from its start. The normalizer
inflates such a stream once, rewrites every record as a gzip member of its own
and writes a sidecar index of offsets, so any record can be read by itself. On
the way it turns records whose payload another record holds into revisits.

Files are written by tasks below a shared folder, named by task attempt, so an
attempt that is run again or in parallel never touches another's file; only
files named in committed rows are read. An archive is closed when it has taken
``archive_bytes``, so no task holds more than one record and no list of records
is longer than an archive. A record holds the payload whole.

Defined cases: a null payload is empty; a null address becomes the record's own
name; characters that a header can't hold are percent-encoded. Repeated rows are
records of their own; of repeated ids with equal payloads the one first by
archive and position is the response. A null id is greater than all others. No
rows give no archives. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwell.llm.common import batches_of, text_of
from linkwell.session import scratch_path, stage

ARCHIVE_BYTES = 64 << 20
LEAST_REVISIT_BYTES = 100
DRAFT_LEVEL, FINAL_LEVEL = 1, 4
MOST_TASKS = 10_000
DATE = "1970-01-01T00:00:00Z"
BLOCK = 1 << 17
# Record types and the profile of revisits.
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes

    def to_bytes(self) -> bytes:
        head = "".join(f"{k}: {v}\r\n" for k, v in {**self.headers, "Content-Length": len(self.block)}.items())
        return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + self.block + b"\r\n\r\n"

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return _headers(head), payload


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    return {k.strip(): v.strip() for k, v in pairs}


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def response(page_id: int | None, url: str | None, payload: bytes, date: str = DATE) -> Record:
    name = record_name(page_id)
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else name.strip("<>")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return Record(
        {
            "WARC-Type": RESPONSE, "WARC-Record-ID": name, "WARC-Date": date, "WARC-Target-URI": target,
            "WARC-Payload-Digest": f"sha256:{hashlib.sha256(payload).hexdigest()}",
            "Content-Type": "application/http; msgtype=response",
        },
        http.encode() + payload,
    )


def revisit(record: Record, of: int | None) -> Record:
    """The record without its payload, referring to the response that holds it."""
    head, _, _ = record.block.partition(b"\r\n\r\n")
    changed = {"WARC-Type": REVISIT, "WARC-Refers-To": record_name(of), "WARC-Profile": PROFILE}
    return Record({**record.headers, **changed}, head + b"\r\n\r\n")


def inflate(stream) -> Iterator[bytes]:
    """Inflated blocks of a gzip stream of one member or more."""
    machine, block = zlib.decompressobj(31), b""
    while block or (block := stream.read(BLOCK)):
        yield machine.decompress(block)
        block = b""
        if machine.eof:
            block = machine.unused_data
            machine = zlib.decompressobj(31)


def read_records(blocks: Iterator[bytes]) -> Iterator[Record]:
    """Records of an inflated archive, one at a time."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(blocks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        seen = 0
        while (end := held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                if held:
                    raise ValueError("the archive ends within a record")
                return
        headers = _headers(bytes(held[:end]))
        size = int(headers.pop("Content-Length"))
        if not fill(end + 8 + size):
            raise ValueError("the archive ends within a record")
        yield Record(headers, bytes(held[end + 4 : end + 4 + size]))
        del held[: end + 8 + size]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:", uri):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def _task_name() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def write_drafts(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as responses into whole-file gzip archives; a row for each record, staged."""
    rows = pages.select("page_id", "url", text_of("html").alias("html"))
    schema = pa.schema([
        ("archive", pa.string()), ("ordinal", pa.int64()), ("page_id", pa.int64()), ("bytes", pa.int64()),
        ("digest", pa.string()),
    ])

    def records(batches):
        number, out, machine, taken, at, name = 0, None, None, 0, 0, ""
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{folder}/draft-{_task_name()}-{number:04d}.warc.gz"
                    system, path = _place(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                    machine = zlib.compressobj(DRAFT_LEVEL, zlib.DEFLATED, 31)
                payload = html.encode("utf-8")
                record = response(page_id, url, payload)
                data = record.to_bytes()
                out.write(machine.compress(data))
                yield name, at, page_id, len(payload), record.headers["WARC-Payload-Digest"][7:]
                taken, at = taken + len(data), at + 1
                if taken >= archive_bytes:
                    out.write(machine.flush())
                    out.close()
                    number, out, taken, at = number + 1, None, 0, 0
        if out is not None:
            out.write(machine.flush())
            out.close()

    done = rows.mapInArrow(lambda b: batches_of(records(b), schema), "archive string, ordinal long, page_id long, bytes long, digest string")
    return stage(done, "drafts")


def choose_revisits(records: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Archive and ordinal of the records whose payload an earlier one holds, and that one's id."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "ordinal")
    large = records.filter(F.col("bytes") >= least_bytes)
    first = large.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = large.withColumn("order", order).join(first, "digest").filter("order != first")
    return repeats.select("archive", "ordinal", F.col("first.page_id").alias("refers_to"))


def _dealt(archives: DataFrame) -> DataFrame:
    """One archive to a task, or a few where there are very many: adaptive execution sees only short rows of names."""
    return archives.repartition(min(max(1, archives.count()), MOST_TASKS), "archive")


def normalize(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a member for each record; a row for each new archive, staged.

    ``archives`` has ``archive`` and ``revisits``, an array of ordinals and the
    ids they refer to, no longer than the archive.
    """
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])

    def rewritten(batches):
        for batch in batches:
            for draft, revisits in zip(*(c.to_pylist() for c in batch.columns)):
                changes = {r["ordinal"]: r["refers_to"] for r in revisits or []}
                name = f"{folder}/archive-{draft.rpartition('/')[2].split('.')[0]}-{TaskContext.get().taskAttemptId()}"
                source, source_path = _place(draft)
                system, path = _place(name)
                offset, n = 0, 0
                with (
                    source.open_input_stream(source_path, compression=None) as stream,
                    system.open_output_stream(path + ".warc.gz", compression=None) as out,
                    system.open_output_stream(path + ".idx") as index,
                ):
                    for n, record in enumerate(read_records(inflate(stream)), 1):
                        if n - 1 in changes:
                            record = revisit(record, changes[n - 1])
                        machine = zlib.compressobj(FINAL_LEVEL, zlib.DEFLATED, 31)
                        member = machine.compress(record.to_bytes()) + machine.flush()
                        out.write(member)
                        entry = {"offset": offset, "length": len(member), "id": record.headers["WARC-Record-ID"]}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset += len(member)
                yield name + ".warc.gz", name + ".idx", n

    done = _dealt(archives).select("archive", "revisits").mapInArrow(
        lambda b: batches_of(rewritten(b), schema), "archive string, index string, records long"
    )
    return stage(done, "archives")


def read_back(archives: DataFrame) -> DataFrame:
    """A row for each record of normalized archives, each read by its offset and inflated by itself. Counts the archives."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()),
    ])

    def records(batches):
        for batch in batches:
            for name, index in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _place(name)
                _, index_path = _place(index)
                with system.open_input_file(path) as archive, system.open_input_stream(index_path) as lines:
                    for line in lines.read().splitlines():
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        data = zlib.decompress(archive.read(entry["length"]), 31)
                        (record,) = read_records(iter([data]))
                        yield _described(record) + (name, entry["offset"])

    return _dealt(archives).select("archive", "index").mapInArrow(
        lambda b: batches_of(records(b), schema),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, "
        "offset long",
    )


def _described(record: Record) -> tuple:
    http, payload = record.http
    digest = record.headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, of = record.headers["WARC-Type"], record.headers.get("WARC-Refers-To")
    if kind == RESPONSE and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload and digest of {record.headers['WARC-Record-ID']} differ")
    return page_of(record.headers["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, of and page_of(of)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and return the table of normalized archives. Runs jobs."""
    folder = folder or scratch_path(spark, "warc")
    drafts = write_drafts(pages, folder, archive_bytes)
    found = choose_revisits(drafts).groupBy("archive").agg(F.collect_list(F.struct("ordinal", "refers_to")).alias("revisits"))
    return normalize(stage(drafts.select("archive").distinct().join(found, "archive", "left"), "revisits"), folder)
