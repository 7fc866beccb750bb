"""WARC archives: a writer with revisit records and a reader that salvages damaged archives.

Writing: every task writes gzip members, one record each, to files of bounded size below a folder
that the cluster shares.  File names carry the attempt's own random name; only the files that a
finished task reports are read again, so a task that runs twice does no harm.

Reading: each archive is read by one task, record after record.  A record must pass its checks: a
complete gzip member or version line, a readable header, ``Content-Length`` bytes, the end mark, and
the block digest.  After a failed check the reader looks for the next gzip member or version line
that starts a valid record and goes on from there; the bytes between are one quarantined gap.

A member may hold many records.  A record that fails inside a sound member costs itself alone: the
reader goes on at the next version line of the inflated bytes, and the gap says where in them it lies.
Of a member that does not inflate to its end, or whose checksum differs, the records before the damage
that prove themselves by a block digest are given out; the archive is searched on from the byte where
the last of them was complete.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelex.llm.common import qualified, saved, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Compressed bytes after which the writer begins another archive.
FILE_BYTES = 16 << 20
LEVEL = 3
#: Compressed bytes handed to the decompressor at a time.
STEP = 1 << 14
VERSION = b"WARC/1.1\r\n"
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SINGLE = frozenset(["warc-type", "warc-record-id", "warc-date", "content-length"])
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
LINE = re.compile(rb"WARC/1\.[01]\r\n")
#: Archive bytes that one task of the reader is to read.
TASK_BYTES = 64 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", identifier or "")
    return int(found[1]) if found else None


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record.  A revisit keeps the header of the response, whose length is the payload's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url) if url is not None else ""),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    header = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + header + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def mark_revisits(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Add ``first_id`` (null unless the row revisits another) and ``revisit``.

    Of rows with equal payloads of at least ``least_bytes``, those with the smallest id are
    responses (ids that repeat are all stored), a row without an id only where no row has one.
    Payloads are equal when their SHA-1 is.
    """
    raw = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.withColumns(
        {"payload": raw, "digest": F.sha1(raw), "salt": F.pmod(F.xxhash64(id_col), F.lit(16))}
    )
    groups = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min(id_col).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("of", "first", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part"))
    )
    # Copies of one payload may be a third of all rows: they meet their group in sixteen parts.
    joined = rows.join(
        groups, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("part")), "left"
    )
    revisit = F.col("of").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("first"))
    return joined.withColumn("revisit", revisit).withColumn("first_id", F.when(revisit, F.col("first")))


def write(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record per row below ``folder``; the result lists the archives and their records."""
    folder = qualified(pages.sparkSession, folder)
    needed = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
    )
    marked = mark_revisits(needed, "page_id", "html", least_bytes).select(
        "page_id", "url", "payload", "first_id", "revisit"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name, sink, size, records = "", None, 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for page_id, url, payload, first, revisit in zip(*columns, strict=True):
                if sink is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                data = member(record(page_id, url, payload, first, revisit))
                sink.write(data)
                size += len(data)
                records += 1
                if size >= file_bytes:
                    sink.close()
                    done.append((name, size, records))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((name, size, records))
        if done:
            names, sizes, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"archive": list(names), "bytes": list(sizes), "records": list(counts)}
            )

    return saved(marked.mapInArrow(run, "archive string, bytes long, records long"), "warc-list")


@dataclass
class Record:
    kind: str
    fields: dict[str, str]
    block: bytes
    start: int
    end: int


@dataclass
class Gap:
    """Quarantined bytes of the archive; inside a sound member, which bytes of its inflated content."""

    start: int
    end: int
    reason: str
    inner_start: int | None = None
    inner_end: int | None = None


class Damaged(Exception):
    pass


@dataclass
class Salvage:
    """All records of one archive's bytes, and the gaps between them."""

    data: bytes
    gaps: list[Gap] = field(default_factory=list)

    def records(self) -> Iterator[Record]:
        at, size = 0, len(self.data)
        lost, reason = None, ""
        while at < size:
            try:
                found, end, failed = self._at(at)
            except Damaged as damage:
                if lost is None:
                    lost, reason = at, str(damage)
                nearby = START.search(self.data, at + 1)
                at = nearby.start() if nearby else size
                continue
            if lost is not None:
                self.gaps.append(Gap(lost, at, reason))
                lost = None
            yield from found
            at = end
            if failed:
                lost, reason = at, failed
                nearby = START.search(self.data, at)
                at = nearby.start() if nearby else size
        if lost is not None:
            self.gaps.append(Gap(lost, size, reason))

    def _at(self, at: int) -> tuple[list[Record], int, str]:
        """The records of the gzip member, or the plain record, that begins here; where the bytes
        that hold them end; and what is wrong with the member, if anything is."""
        if not self.data.startswith(MEMBER, at):
            one, end = parse(self.data, at)
            return [Record(one.kind, one.fields, one.block, at, end)], end, ""
        plain, end, failed = inflate(self.data, at)
        found, gaps = [], []
        inner, lost, why = 0, None, ""
        while inner < len(plain):
            try:
                one, after = parse(plain, inner)
                if failed and "warc-block-digest" not in one.fields:
                    raise Damaged("no digest in a damaged member")
            except Damaged as damage:
                if lost is None:
                    lost, why = inner, str(damage)
                nearby = LINE.search(plain, inner + 1)
                inner = nearby.start() if nearby else len(plain)
                continue
            if lost is not None:
                gaps.append((lost, inner, why))
                lost = None
            found.append(one)
            inner = after
        if not found:
            raise Damaged(failed or why or "empty member")
        if failed:
            end = reached(self.data, at, found[-1].end)
        elif lost is not None:
            gaps.append((lost, len(plain), why))
        self.gaps += [Gap(at, end, text, first, last) for first, last, text in gaps]
        return [Record(r.kind, r.fields, r.block, at, end) for r in found], end, failed


def inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at this place holds, as far as it inflates, where it ends, and what is
    wrong with it."""
    unpack, plain, end = zlib.decompressobj(31), bytearray(), at
    while not unpack.eof and end < len(data):
        piece, before = data[end : end + STEP], unpack.copy()
        try:
            plain += unpack.decompress(piece)
        except zlib.error as error:
            # A failed call gives nothing out: the bytes before the damage come one by one.
            for i in range(len(piece)):
                try:
                    plain += before.decompress(piece[i : i + 1])
                except zlib.error:
                    break
            return bytes(plain), end, f"member: {error}"
        end += len(piece) - len(unpack.unused_data)
    return bytes(plain), end, "" if unpack.eof else "member is cut off"


def reached(data: bytes, at: int, size: int) -> int:
    """Where the member at this place has given out ``size`` bytes; it inflates that far."""
    unpack, got, end = zlib.decompressobj(31), 0, at
    while got < size and end < len(data):
        before = unpack.copy()
        try:
            made = len(unpack.decompress(data[end : end + STEP]))
        except zlib.error:
            made = size
        if got + made >= size:
            while got < size and end < len(data):
                got += len(before.decompress(data[end : end + 1]))
                end += 1
            break
        got, end = got + made, min(end + STEP, len(data))
    return end


def parse(data: bytes, at: int) -> tuple[Record, int]:
    """The plain record at this place and where it ends."""
    if not START.match(data, at) or data.startswith(MEMBER, at):
        raise Damaged("no version line")
    head = data.find(END, at)
    if head < 0:
        raise Damaged("header is cut off")
    fields = {}
    for line in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without colon")
        if name.lower() in SINGLE and name.lower() in fields:
            raise Damaged("header repeats a field, as if it ran into another one")
        fields[name.lower()] = value.strip()
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    start = head + len(END)
    block, end = data[start : start + int(length)], start + int(length)
    if data[end : end + 4] != END:
        raise Damaged("no end mark")
    digest = fields.get("warc-block-digest")
    if digest and digest != f"sha1:{base32_sha1(block)}":
        raise Damaged("block digest differs")
    return Record(fields.get("warc-type", ""), fields, block, at, end + 4), end + 4


def payload_of(one: Record) -> tuple[int, str, bytes | None]:
    """Length and digest of the full payload, and the payload itself where the record holds it."""
    head, _, body = one.block.partition(END)
    length = re.search(rb"(?im)^content-length: *(\d+)", head)
    digest = one.fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if one.kind == "revisit":
        return int(length[1]) if length else 0, digest, None
    return len(body), base32_sha1(body), body


SCHEMA = (
    "archive string, kind string, page_id long, url string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary, start long, end long, reason string, inner_start long, "
    "inner_end long"
)


def read(spark: SparkSession, folder: str, archives: DataFrame | None = None) -> DataFrame:
    """Records and gaps of archives below ``folder``, of those that ``archives`` lists (archive, bytes).

    Columns: archive, kind (response, revisit, gap, or what the record calls itself), page_id, url,
    payload_bytes, payload_digest, refers_to, payload, start, end, reason; for a gap inside a sound
    member inner_start and inner_end, its place in the inflated bytes.  An archive is read whole by
    one task, so writers should bound their size.  Damaged bytes are never dropped silently: each gap
    is a row.  The list stays a table: its names are dealt over the tasks, which open them.
    """
    if archives is None:
        files = spark.read.format("binaryFile").load(folder).select("path", "content")
        return files.mapInArrow(
            lambda batches: _read((
                (path.rpartition("/")[2], content.as_buffer().to_pybytes())
                for batch in batches
                for path, content in zip(
                    batch.column("path").to_pylist(), batch.column("content"), strict=True
                )
            )),
            SCHEMA,
        )
    place = qualified(spark, folder)
    total = archives.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        fs, path = pafs.FileSystem.from_uri(place)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    content = source.read()
                yield name, content

    return archives.select("archive").repartition(tasks).mapInArrow(
        lambda batches: _read(opened(batches)), SCHEMA
    )


def _read(archives: Iterator[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
    for name, content in archives:
        salvage, rows, held = Salvage(content), [], 0
        for one in salvage.records():
            size, digest, payload = payload_of(one)
            rows.append(
                (name, one.kind, page_of(one.fields.get("warc-record-id")),
                 one.fields.get("warc-target-uri") or None, size, digest,
                 page_of(one.fields.get("warc-refers-to")), payload, one.start, one.end,
                 None, None, None)
            )
            held += len(payload or b"") + 200
            if held > 8 << 20:
                yield _batch(rows)
                rows, held = [], 0
        rows += [(name, "gap", None, None, None, None, None, None, g.start, g.end, g.reason,
                  g.inner_start, g.inner_end) for g in salvage.gaps]
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ("archive", "kind", "page_id", "url", "payload_bytes", "payload_digest", "refers_to",
             "payload", "start", "end", "reason", "inner_start", "inner_end")
    arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as archives and read the archives back."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    return read(spark, folder, write(pages, folder, **options))
