"""Exact deduplication by Grace hashing.

1. Every task of the scan resolves the copies inside windows of bounded size, so a text that fills a
   third of the table leaves each window as one row.
2. One text of each window and class goes to the partition of its digest (level 0 of the hash
   partitioning, Spark's shuffle).
3. A partition fills an open-addressing table that compares complete contents.  If the distinct
   contents outgrow ``table_bytes``, all records go to sixteen spill files by the next four bits of
   the digest, and each file is treated the same way.  The files lie in the folder that the cluster
   shares, under a name of the running attempt, and go when the partition is done.
4. The verdicts return to the rows by the window's representative, never by the hot digest.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgelex.llm.common import giving_back, saved, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct contents that one table holds before its records are spilled.
TABLE_BYTES = 64 << 20
#: Contents that a scanning task looks at together.
WINDOW_BYTES = 16 << 20
FAN_OUT_BITS = 4
SPILLED = pa.schema(
    [("digest", pa.binary()), ("uid", pa.int64()), ("best_uid", pa.int64()), ("id", pa.int64()),
     ("size", pa.int64()), ("content", pa.large_binary())]
)


def spill_schema(row_type: pa.DataType | None) -> pa.Schema:
    """Spilled records; ``row`` holds a record's other columns where these are carried along."""
    return SPILLED.append(pa.field("row", row_type or pa.null()))


def normalised(text: bytes | None) -> bytes:
    """Only A to Z change; null counts as empty."""
    return b"" if text is None else text.lower()


def digest_of(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


class ContentTable:
    """Open addressing with linear probing; two entries are equal when their contents are."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.codes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, digest: bytes, content: bytes) -> int:
        """The number of the content's entry, a new one if it is not there yet."""
        code = int.from_bytes(digest[-8:], "little")
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) >= 0:
            if self.codes[entry] == code and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.codes)
        self.codes.append(code)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.codes) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, code in enumerate(self.codes):
            at = code & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def better(a: tuple, b: tuple) -> tuple:
    """Of two rows (id, uid) the one that stays: larger id, null last, then the earlier row."""
    if (a[0] is None) != (b[0] is None):
        return b if a[0] is None else a
    if a[0] != b[0]:
        return a if a[0] > b[0] else b
    return a if a[1] <= b[1] else b


def _resolve(rows: pa.Table, text_col: str | None) -> pa.Table:
    """The window's rows with their digest, their class's best row and, on that row, its size.

    With ``text_col`` the content is that field of ``row``, and only the best rows come back.
    """
    table, best, size, member, digests = ContentTable(), [], [], [], []
    uids, ids = rows["uid"].to_pylist(), rows["id"].to_pylist()
    if text_col is None:
        texts = rows["content"]
    else:
        texts = pa.chunked_array([c.field(text_col) for c in rows["row"].chunks]).cast(pa.binary())
    for uid, key, text in zip(uids, ids, texts, strict=True):
        content = normalised(text.as_py())
        digest = digest_of(content)
        entry = table.find(digest, content)
        if entry == len(best):
            best.append((key, uid))
            size.append(0)
        best[entry] = better(best[entry], (key, uid))
        size[entry] += 1
        member.append(entry)
        digests.append(digest)
    rep = [best[e][1] for e in member]
    first = pa.array([u == r for u, r in zip(uids, rep, strict=True)], pa.bool_())
    if text_col is not None:
        return _told(rows, digests, rep, size, member).filter(first)
    content = rows["content"].combine_chunks()
    content = pc.fill_null(content, b"") if content.null_count else content
    out = rows.set_column(
        rows.schema.get_field_index("content"),
        "content",
        pc.if_else(first, content, pa.scalar(None, content.type)),
    )
    return _told(out, digests, rep, size, member)


def _told(rows: pa.Table, digests: list, rep: list, size: list, member: list) -> pa.Table:
    return (
        rows.append_column("digest", pa.array(digests, pa.binary()))
        .append_column("rep_uid", pa.array(rep, pa.int64()))
        .append_column("n_local", pa.array([size[e] for e in member], pa.int64()))
    )


def _windows(window_bytes: int, text_col: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            held.append(batch)
            total += batch.nbytes
            if total >= window_bytes:
                yield from _resolve(pa.Table.from_batches(held), text_col).combine_chunks().to_batches()
                held, total = [], 0
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield from _resolve(rows, text_col).combine_chunks().to_batches()

    return run


def _records(batches: Iterable[pa.RecordBatch], text_col: str | None = None) -> Iterator[tuple]:
    """Records of Arrow batches.  With ``text_col`` the content is that field of ``row``."""
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in SPILLED.names[:-1]]
        rows = batch.column("row").to_pylist() if "row" in batch.schema.names else [None] * batch.num_rows
        if text_col is None:
            contents = batch.column("content").to_pylist()
        else:
            contents = [None if r[text_col] is None else _encoded(r[text_col]) for r in rows]
        yield from zip(*columns, map(normalised, contents), rows, strict=True)


def _encoded(text: str | bytes) -> bytes:
    return text.encode() if isinstance(text, str) else text


class SpillFiles:
    """The partitions of one level of recursion, as Arrow files below ``folder``."""

    def __init__(
        self, fs: pafs.FileSystem, folder: str, level: int, batch_bytes: int, schema: pa.Schema
    ):
        self.fs, self.folder, self.level, self.batch_bytes = fs, folder, level, batch_bytes
        self.schema = schema
        fs.create_dir(folder, recursive=True)
        self.waiting: dict[int, list] = {}
        self.waiting_bytes: dict[int, int] = {}
        self.sinks: dict[int, pa.NativeFile] = {}
        self.writers: dict[int, pa.RecordBatchStreamWriter] = {}

    def path(self, part: int) -> str:
        return f"{self.folder}/{self.level}-{part}.arrow"

    def add(self, record: tuple) -> None:
        bits = self.level * FAN_OUT_BITS
        part = record[0][bits // 8] >> (bits % 8) & (1 << FAN_OUT_BITS) - 1
        self.waiting.setdefault(part, []).append(record)
        self.waiting_bytes[part] = self.waiting_bytes.get(part, 0) + len(record[5]) + 64
        if self.waiting_bytes[part] * (1 << FAN_OUT_BITS) >= self.batch_bytes:
            self.flush(part)

    def flush(self, part: int) -> None:
        if part not in self.writers:
            self.sinks[part] = self.fs.open_output_stream(self.path(part))
            self.writers[part] = pa.ipc.new_stream(self.sinks[part], self.schema)
        self.writers[part].write_batch(_spilled(self.waiting.pop(part), self.schema))
        self.waiting_bytes[part] = 0

    def close(self) -> list[int]:
        for part in list(self.waiting):
            self.flush(part)
        for part, writer in self.writers.items():
            writer.close()
            self.sinks[part].close()
        return sorted(self.writers)

    def read(self, part: int) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_stream(self.path(part)) as source, pa.ipc.open_stream(source) as s:
            yield from s
        self.fs.delete_file(self.path(part))


def _spilled(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _verdicts(rep, entry, best, size) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "rep_uid": pa.array(rep, pa.int64()),
            "keep_id": pa.array([best[e][0] for e in entry], pa.int64()),
            "keep_uid": pa.array([best[e][1] for e in entry], pa.int64()),
            "group_size": pa.array([size[e] for e in entry], pa.int64()),
        }
    )


def grace(
    records: Iterator[tuple],
    folder: str,
    table_bytes: int,
    level: int = 0,
    row_type: pa.DataType | None = None,
) -> Iterator[pa.RecordBatch]:
    """What one hash partition gives, in memory or by way of spill files.

    Verdicts for all records, or with ``row_type`` the best row of every class.
    """
    table, best, size, codes, rep, member = ContentTable(), [], [], [], [], []
    rows: list = []
    for digest, uid, best_uid, key, n, content, row in records:
        entry = table.find(digest, content)
        if entry == len(best):
            best.append((key, best_uid))
            size.append(0)
            codes.append(digest)
            rows.append(row)
        elif better(best[entry], (key, best_uid)) != best[entry]:
            best[entry], rows[entry] = (key, best_uid), row
        size[entry] += n
        if row_type is None:
            rep.append(uid)
            member.append(entry)
        can_split = len(best) > 1 and (level + 1) * FAN_OUT_BITS <= 8 * len(digest)
        if table.bytes > table_bytes and can_split:
            break
    else:
        if row_type is not None and rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, row_type)], names=["row"])
        elif rep:
            yield _verdicts(rep, member, best, size)
        return
    fs, path = pafs.FileSystem.from_uri(folder)
    schema = spill_schema(row_type)
    files = SpillFiles(fs, f"{path}/{uuid.uuid4().hex}", level, table_bytes, schema)
    # The class's size and best row travel on its first record; the others only ask for the verdict.
    told: set[int] = set()
    if row_type is not None:
        rep, member = [uid for _, uid in best], list(range(len(best)))
    for uid, entry in zip(rep, member, strict=True):
        n = 0 if entry in told else size[entry]
        told.add(entry)
        key, best_uid = best[entry]
        files.add((codes[entry], uid, best_uid, key, n, table.contents[entry], rows[entry]))
    del table, best, size, codes, rep, member, rows
    for record in records:
        files.add(record)
    try:
        for part in files.close():
            yield from grace(_records(files.read(part)), folder, table_bytes, level + 1, row_type)
    finally:
        fs.delete_dir(files.folder)


def resolved_windows(
    docs: DataFrame, id_col: str, text_col: str, window_bytes: int, whole_rows: bool = False
) -> DataFrame:
    """Rows with what their window says of them; with ``whole_rows`` the best ones, in ``row``."""
    if whole_rows:
        held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    else:
        held = F.col(text_col).cast("binary").alias("content")
    source = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), held
    )
    extra = [T.StructField("digest", T.BinaryType()), T.StructField("rep_uid", T.LongType()),
             T.StructField("n_local", T.LongType())]
    run = _windows(window_bytes, text_col if whole_rows else None)
    return source.mapInArrow(giving_back(run), T.StructType([*source.schema.fields, *extra]))


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
    window_bytes: int = WINDOW_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A to Z; null counts as empty.  The row with
    the largest id stays, a row without an id only if no row of its class has one; of repeated rows
    with equal id and text one stays.  An empty table gives an empty result.
    """
    folder = scratch(docs.sparkSession, "dedup-spill")
    staged = saved(resolved_windows(docs, id_col, text_col, window_bytes), "dedup-rows")
    reps = _representatives(staged, "content").repartition(F.col("digest"))
    verdicts = reps.mapInArrow(
        giving_back(lambda batches: grace(_records(batches), folder, table_bytes)),
        "rep_uid long, keep_id long, keep_uid long, group_size long",
    )
    return staged.drop("content", "n_local").join(verdicts, "rep_uid").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _representatives(resolved: DataFrame, *more: str) -> DataFrame:
    """The best row of each window and class, as the records of the hash partitions."""
    return resolved.where("uid = rep_uid").select(
        "digest", "uid", F.col("uid").alias("best_uid"), "id", F.col("n_local").alias("size"), *more
    )


def survivors(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
    window_bytes: int = WINDOW_BYTES,
) -> DataFrame:
    """The rows that stay by the same rules, with the columns of ``docs``; one shuffle of the texts."""
    folder = scratch(docs.sparkSession, "dedup-spill")
    resolved = resolved_windows(docs, id_col, text_col, window_bytes, whole_rows=True)
    reps = _representatives(resolved, "row").repartition(F.col("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(iter(batches), None)
        if first is not None:
            records = _records(chain([first], batches), text_col)
            kind = first.schema.field("row").type
            yield from grace(records, folder, table_bytes, row_type=kind)

    return reps.mapInArrow(giving_back(run), T.StructType([reps.schema["row"]])).select("row.*")
