"""Exact dedup by Grace hash partitioning.

Two texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``.
Each task deals its records to buckets by hash, in memory or, beyond a budget, in
spill files, and deals a bucket anew by further hash bits until its distinct contents
fit an open-addressing table that compares complete contents. Tasks first combine
their own copies, so a group of any size crosses the shuffle once per task.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import words
from quayside.llm.common import hot_join, id_text, materialize

SPACES = r"[\x20\x09-\x0D]"
#: Hash, has an id, best id, its code points, copies, rows like the best, content length.
HEAD = struct.Struct("<Q?qqqqQ")
FAN_BITS = 4
NUMBERS = ("keep", "points", "size", "same")


def _better(points: int, doc: int | None, row: list) -> bool:
    """Does this outrank the best of ``row``: more code points, then the smaller id, and a
    null id last?"""
    if points != row[3]:
        return points > row[3]
    return doc is not None and (row[2] is None or doc < row[2])


class Table:
    """Open addressing with linear probing over complete contents."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.rows: list[list] = []  # hash, content, best id, its code points, copies, rows like the best
        self.bytes = 0

    def add(self, h: int, content: bytes, doc: int | None, points: int, copies: int, same: int) -> None:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (k := self.slots[at]) >= 0:
            row = self.rows[k]
            if row[0] == h and row[1] == content:
                row[4] += copies
                if _better(points, doc, row):
                    row[2], row[3], row[5] = doc, points, same
                elif (points, doc) == (row[3], row[2]):
                    row[5] += same
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.rows.append([h, content, doc, points, copies, same])
        self.bytes += len(content) + 160
        if 2 * len(self.rows) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for k, row in enumerate(self.rows):
                at = (row[0] ^ (row[0] >> 32)) & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = k


def _read(file) -> Iterator[tuple]:
    file.seek(0)
    while head := file.read(HEAD.size):
        h, has_id, doc, points, copies, same, n = HEAD.unpack(head)
        yield h, file.read(n), doc if has_id else None, points, copies, same


def grace(records: Iterator[tuple], memory: int, depth: int = 0) -> Iterator[list]:
    """Distinct contents of (hash, content, id, code points, copies, rows like it) records,
    each with its best id and total copies. Beyond ``memory`` bytes of distinct contents, what the
    table holds and what follows goes to 2**FAN_BITS spill files by the next hash bits."""
    table = Table()
    records = iter(records)
    for record in records:
        table.add(*record)
        if table.bytes > memory and (depth + 1) * FAN_BITS <= 60:
            break
    else:
        yield from table.rows
        return
    shift = 60 - depth * FAN_BITS
    files = [tempfile.TemporaryFile(prefix="grace-") for _ in range(1 << FAN_BITS)]
    try:
        held, table = table.rows, None
        for source in (held, records):
            for h, content, doc, points, copies, same in source:
                file = files[(h >> shift) & ((1 << FAN_BITS) - 1)]
                file.write(HEAD.pack(h, doc is not None, doc or 0, points, copies, same, len(content)))
                file.write(content)
        del held
        for k, file in enumerate(files):
            yield from grace(_read(file), memory, depth + 1)
            file.close()
    finally:
        for file in files:
            file.close()


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        data, offsets = words.text_bytes(batch.column(1))
        ids = batch.column(0).to_pylist()
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        keep = ~words.SPACE[data]
        at = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
        content = data[keep].tobytes()
        for k, doc in enumerate(ids):
            own = content[at[k] : at[k + 1]]
            yield xxhash.xxh3_64_intdigest(own), own, doc, int(points[k + 1] - points[k]), 1, 1


def _out(rows: Iterator[list], last: bool) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        h, content, *numbers = map(list, zip(*held, strict=True))
        numbers = [pa.array(x, pa.int64()) for x in numbers]
        if last:
            sha = pa.array([hashlib.sha256(x).hexdigest() for x in content])
            return pa.RecordBatch.from_arrays([sha, *numbers], names=["sha", *NUMBERS])
        signed = pa.array([x - 2**64 if x >= 2**63 else x for x in h], pa.int64())
        return pa.RecordBatch.from_arrays([signed, pa.array(content, pa.binary()), *numbers], names=["h", "content", *NUMBERS])

    for row in rows:
        held.append(row)
        size += len(row[1]) + 64
        if size > 4 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def exact_groups(docs: DataFrame, memory: int = 48 << 20) -> DataFrame:
    """(sha, keep, points, size, same) for each distinct normalised text of ``docs(doc_id,
    text)``: the text's sha-256, id and code points of the row that stays, the number of
    rows, and of those that share its id and code points."""
    numbers = ", ".join(f"{n} long" for n in NUMBERS)

    def combine(batches):
        yield from _out(grace(_normal(batches), memory), last=False)

    def finish(batches):
        def records():
            for b in batches:
                cols = [b.column(i).to_pylist() for i in range(2 + len(NUMBERS))]
                for h, content, *rest in zip(*cols, strict=True):
                    yield h % 2**64, content, *rest

        yield from _out(grace(records(), memory), last=True)

    local = docs.select("doc_id", "text").mapInArrow(combine, f"h long, content binary, {numbers}")
    return local.repartition(F.col("h")).mapInArrow(finish, f"sha string, {numbers}")


def text_sha(text) -> F.Column:
    return F.sha2(F.regexp_replace(text, SPACES, ""), 256)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points, then the smallest id, stays. A
    null text counts as empty; empty texts are equal to each other. A null id comes
    last among ties; where it is best, keep_id is null. Rows repeated under one id count
    in group_size; those that also share the code points of the row that stays are all
    marked as kept. An empty table gives no rows; other columns are ignored. Spill files
    are in a task's own temporary folder: a task that is run again writes them again.
    """
    docs = id_text(df, id_col, text_col)
    groups = materialize(exact_groups(docs).drop("same").withColumn("rows", F.col("size")), "groups")
    rows = docs.select("doc_id", F.length("text").alias("length"), text_sha(F.col("text")).alias("sha"))
    return hot_join(rows, groups, ["sha"], "rows").select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("length") == F.col("points"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each text, that which ``exact_dedup`` keeps; all columns as
    they were, save that names beginning with ``__llm_`` are the operator's own. Of rows
    that share id and code points, any one stays."""
    own = {c: f"__llm_{c}" for c in ("sha", "keep", "points", "same")}
    groups = exact_groups(id_text(df, id_col, text_col)).withColumn("__llm_rows", F.col("size")).drop("size").withColumnsRenamed(own)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tagged = df.withColumn("__llm_sha", text_sha(text)).withColumn("__llm_length", F.length(text))
    groups = materialize(groups, "groups")
    found = hot_join(tagged, groups, ["__llm_sha"], "__llm_rows")
    found = found.filter(F.col(id_col).cast("long").eqNullSafe(F.col("__llm_keep")) & (F.col("__llm_length") == F.col("__llm_points")))
    if not groups.filter("__llm_same > 1").isEmpty():  # an id holds its best text more than once
        repeated = found.filter("__llm_same > 1").dropDuplicates(["__llm_sha"])
        found = found.filter("__llm_same = 1").unionByName(repeated)
    return found.drop("__llm_length", *own.values())
