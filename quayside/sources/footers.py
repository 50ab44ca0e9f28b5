"""What files say of themselves, read by tasks over a table of their names: statistics in
parquet footers, and first lines. Only the bytes needed are read."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: A text statistic from this length on may be a cut one: its file is read instead.
LONGEST_STATISTIC = 64
HEAD_BYTES = 64 << 10
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def _open(name: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if name.startswith("file:/") and not name.startswith("file:///"):
        name = "file:///" + name[6:]
    return pyarrow.fs.FileSystem.from_uri(name)


def named(spark: SparkSession, files: list[str]) -> DataFrame:
    """A table of file names, a task for every few hundred."""
    return spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files) // 200 + 1, 10_000)))


def footer_statistics(spark: SparkSession, files: list[str], column: str, kind: T.DataType) -> DataFrame:
    """(file, n_rows, n_bytes, nulls, low, high, known) of each parquet file: the column's
    extremes as its row groups state them. ``known`` is false where one states none, or a
    text that may be cut; a file of nulls alone is known to have none."""
    low_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                system, path = _open(name)
                with system.open_input_file(path) as file:
                    found = pq.read_metadata(file)
                    size = file.size()
                place = next((k for k in range(found.num_columns) if found.schema.column(k).path == column), None)
                low = high = None
                nulls, known = 0, True
                for g in range(found.num_row_groups):
                    group = found.row_group(g)
                    stats = None if place is None else group.column(place).statistics
                    if place is None or (stats is not None and stats.null_count == group.num_rows):
                        nulls += group.num_rows
                        continue
                    if stats is None or not stats.has_min_max or any(isinstance(v, (str, bytes)) and len(v) >= LONGEST_STATISTIC for v in (stats.min, stats.max)):
                        known = False
                        continue
                    nulls += stats.null_count or 0
                    low = stats.min if low is None else min(low, stats.min)
                    high = stats.max if high is None else max(high, stats.max)
                rows.append((name, found.num_rows, size, nulls, low, high, known))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), low_type, low_type, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["file", "n_rows", "n_bytes", "nulls", "low", "high", "known"])

    out = f"file string, n_rows long, n_bytes long, nulls long, low {kind.simpleString()}, high {kind.simpleString()}, known boolean"
    return named(spark, files).mapInArrow(run, out)


def column_extremes(spark: SparkSession, files: list[str], kinds: dict[str, T.DataType]) -> DataFrame:
    """(file, unknown, low_0, high_0, low_1 ...) of each row group of the files, every file opened
    once for all columns of ``kinds`` (pairs in their order). What a footer does not tell of a text
    or a whole number is read by the same task, a batch of that column at a time; ``unknown`` lists
    the columns of other kinds that it does not tell."""
    arrow = {c: to_arrow_type(kind) for c, kind in kinds.items()}
    readable = {c for c, kind in kinds.items() if isinstance(kind, (T.StringType, T.BinaryType, T.IntegralType))}

    def told(group: pq.RowGroupMetaData, place: int | None) -> tuple[bool, object, object]:
        stats = None if place is None else group.column(place).statistics
        if place is None or (stats is not None and stats.null_count == group.num_rows):
            return True, None, None
        if stats is None or not stats.has_min_max or any(isinstance(v, (str, bytes)) and len(v) >= LONGEST_STATISTIC for v in (stats.min, stats.max)):
            return False, None, None
        return True, stats.min, stats.max

    def read(file: pq.ParquetFile, g: int, column: str) -> tuple[object, object]:
        low = high = None
        for batch in file.iter_batches(row_groups=[g], columns=[column]):
            found = pc.min_max(batch.column(0)).as_py()
            if found["min"] is not None:
                low = found["min"] if low is None else min(low, found["min"])
                high = found["max"] if high is None else max(high, found["max"])
        return low, high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "unknown", *(f"{end}_{k}" for k in range(len(arrow)) for end in ("low", "high"))]
        types = [pa.string(), pa.list_(pa.string()), *(kind for kind in arrow.values() for _ in range(2))]
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                system, path = _open(name)
                with system.open_input_file(path) as source:
                    file = pq.ParquetFile(source)
                    found = file.metadata
                    places = {found.schema.column(k).path: k for k in range(found.num_columns)}
                    for g in range(found.num_row_groups):
                        row, unknown = [], []
                        for c in arrow:
                            known, low, high = told(found.row_group(g), places.get(c))
                            if not known and c in readable:
                                low, high = read(file, g, c)
                            elif not known:
                                unknown.append(c)
                            row += [low, high]
                        rows.append((name, unknown, *row))
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)

    out = [T.StructField("file", T.StringType()), T.StructField("unknown", T.ArrayType(T.StringType()))]
    out += [T.StructField(f"{end}_{k}", kind) for k, kind in enumerate(kinds.values()) for end in ("low", "high")]
    return named(spark, files).mapInArrow(run, T.StructType(out))


def first_lines(spark: SparkSession, files: list[str], most: int = HEAD_BYTES) -> DataFrame:
    """(file, head): each file's first line, from at most ``most`` of its bytes, gzip or not;
    null of an empty file. A longer first line fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for name in batch.column(0).to_pylist():
                system, path = _open(name)
                with system.open_input_stream(path, compression=None) as file:
                    raw = file.read(most)
                text = zlib.decompressobj(31).decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                if b"\n" not in text and len(raw) == most:
                    raise ValueError(f"{name}: no line ends in the first {most} bytes")
                heads.append(text.split(b"\n", 1)[0].rstrip(b"\r").decode() if text else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.string())], names=["file", "head"])

    return named(spark, files).mapInArrow(run, "file string, head string")


def _told(metadata: dict | None, gone: set[str]) -> dict | None:
    """A footer's key-value metadata, with the columns out of the schema that Spark keeps there."""
    if not metadata or ROW_METADATA not in metadata:
        return metadata
    schema = json.loads(metadata[ROW_METADATA])
    schema["fields"] = [f for f in schema["fields"] if f["name"] not in gone]
    return metadata | {ROW_METADATA: json.dumps(schema).encode()}


def rewrite_without(spark: SparkSession, files: list[str], columns: list[str]) -> DataFrame:
    """(file, rewritten, n_rows): take columns out of those parquet files that have any of
    them, each in its own place; files without stay as they are. A task writes a file whole
    beside the old one, a group of rows at a time, and then moves it there, so no file is ever
    half done, and one that is rewritten again is passed over."""
    gone = set(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                system, path = _open(name)
                with system.open_input_file(path) as source:
                    file = pq.ParquetFile(source)
                    kept = [f.name for f in file.schema_arrow if f.name not in gone]
                    rows.append((name, len(kept) < len(file.schema_arrow), file.metadata.num_rows))
                    if not rows[-1][1]:
                        continue
                    folder, _, base = path.rpartition("/")
                    beside = f"{folder}/.{base}.rewrite"  # hidden from readers
                    schema = pa.schema([file.schema_arrow.field(c) for c in kept], _told(file.schema_arrow.metadata, gone))
                    with system.open_output_stream(beside) as out, pq.ParquetWriter(out, schema, compression="zstd") as writer:
                        for g in range(file.num_row_groups):
                            writer.write_table(file.read_row_group(g, columns=kept).select(kept))
                system.move(beside, path)
                checksum = f"{folder}/.{base}.crc"  # of the old bytes, on a local file system
                if system.get_file_info(checksum).type != pyarrow.fs.FileType.NotFound:
                    system.delete_file(checksum)
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64()), strict=True)], names=["file", "rewritten", "n_rows"])

    return named(spark, files).mapInArrow(run, "file string, rewritten boolean, n_rows long")
