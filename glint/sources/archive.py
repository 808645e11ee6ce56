"""Members of a zip archive as a Spark data source.

The original dataset ships as one large zip. `zipmembers` is a Python data
source: the driver reads only the archive's central directory and plans the
input partitions; each executor opens the archive from the shared path and
reads its own part, so no member passes through the driver. Rows leave the
reader as Arrow batches.

The participants to read are a parameter, `pids`: members of others are
never planned. (Pushing a filter on `pid` down would be neater, but Spark 4.1
keeps what a Python source has pushed with the relation: a second query of the
same DataFrame would be read with the first one's filter.)

One member is many tasks in mode `lines`: a stored member is cut into byte
ranges, a deflated one at the restart points of an index that `index_zip`
builds once (see `restart`). A line belongs to the range it begins in.
Without an index a deflated member is one task.

Modes: `list` (member, size), `text` (value: the whole member as
UTF-8), `lines` (block, row, value: the offset of the range in the member and
the line's number in it order the lines), `records` (record_no, fields: the
records of a CSV member), `points` (the index). `pid` is null for a name
without a participant."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import CALIB_TSV_SCHEMA, DOT_TSV_SCHEMA, PID_SEGMENT
from ..sinks.commit import staged_write
from .parse import (
    first_source,
    gaze_rejects,
    log_rejects,
    parse_delimited,
    parse_gaze_lines,
    parse_log_text,
    type_form_fields,
)
from .restart import inflate, restart_points

_SCHEMAS = {
    "list": "member string, size bigint",
    "text": "member string, pid int, value string",
    "lines": "member string, pid int, block bigint, row bigint, value string",
    "records": "member string, pid int, record_no bigint, fields array<string>",
    "points": "member string, pid int, point int, byte bigint, bit int, offset bigint, end bigint, crc bigint, window binary",
}
_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
BATCH_ROWS = 2_000
BATCH_BYTES = 4_000_000
PIECE = 32 << 20  # bytes of a stored member in one range, and between restart points


def _pid(name: str) -> int | None:
    """The participant of a member (as `pid_from_name`)."""
    found = [m for m in (re.search(PID_SEGMENT, part) for part in name.split("/")) if m]
    number = int(found[-1].group(1)) if found else None
    return number if number is not None and number < 2**31 else None


class _Part(InputPartition):
    """Members to read whole, or one range of one member: from `offset` to
    `end` of its bytes, for a deflated one from restart point `point`."""

    def __init__(self, names: list[str], offset: int = 0, end: int | None = None, point: int | None = None):
        self.names, self.offset, self.end, self.point = names, offset, end, point


class ZipMembersReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.mode = options.get("mode", "list")
        self.pattern = options.get("pattern", "")
        self.batch = int(options.get("batch", "512"))
        self.piece = int(options.get("piece", PIECE))
        self.index = options.get("index", "")
        self.pids = {int(p) for p in options["pids"].split(",") if p} if "pids" in options else None
        fields = [f.split(" ") for f in _SCHEMAS[self.mode].split(", ")]
        self.arrow = pa.schema([(name, _TYPES[kind]) for name, kind in fields])

    # --- planning ---

    def partitions(self):
        rx = re.compile(self.pattern) if self.pattern else None
        with zipfile.ZipFile(self.path) as z:
            infos = [
                i for i in z.infolist() if not i.is_dir() and (rx is None or rx.search(i.filename))
                and (self.pids is None or _pid(i.filename) in self.pids)]
        infos.sort(key=lambda i: i.filename)
        if self.mode == "list":
            names = [i.filename for i in infos]
            return [_Part(names[i:i + self.batch]) for i in range(0, len(names), self.batch)] or [_Part([])]
        if self.mode == "points":
            return [_Part([i.filename]) for i in infos if i.compress_type == zipfile.ZIP_DEFLATED] or [_Part([])]
        if self.mode != "lines":
            return [_Part([i.filename]) for i in infos] or [_Part([])]
        return [p for i, ends in zip(infos, self._ranges(infos)) for p in ends] or [_Part([])]

    def _ranges(self, infos: list[zipfile.ZipInfo]) -> Iterator[list[_Part]]:
        known: dict[str, list[tuple[int, int, int]]] = {}
        if self.index:
            table = ds.dataset(self.index, format="parquet").to_table(
                columns=["member", "point", "offset", "end"], filter=ds.field("member").isin([i.filename for i in infos]))
            for row in table.to_pylist():
                known.setdefault(row["member"], []).append((row["point"], row["offset"], row["end"]))
        for i in infos:
            name, size = i.filename, i.file_size
            if i.compress_type == zipfile.ZIP_STORED:
                yield [_Part([name], at, min(at + self.piece, size)) for at in range(0, size, self.piece)]
            elif name in known:
                yield [_Part([name], offset, end, point) for point, offset, end in sorted(known[name])]
            else:
                yield [_Part([name])]

    # --- reading ---

    def _batches(self, rows: Iterator[tuple], width: int) -> Iterator[pa.RecordBatch]:
        """Rows and the size of each, in batches of bounded size."""
        held, size = [], 0
        for row, n in rows:
            held.append(row)
            size += n
            if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), self.arrow)], schema=self.arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), self.arrow)], schema=self.arrow)

    def read(self, partition: _Part):
        with zipfile.ZipFile(self.path) as z:
            for name in partition.names:
                yield from self._batches(self._rows(z, name, partition), len(self.arrow))

    def _rows(self, z: zipfile.ZipFile, name: str, part: _Part) -> Iterator[tuple[tuple, int]]:
        pid, info = _pid(name), z.getinfo(name)
        if self.mode == "list":
            yield (name, info.file_size), 0
        elif self.mode == "text":
            yield (name, pid, z.read(name).decode("utf-8", errors="replace")), info.file_size
        elif self.mode == "records":
            with z.open(name) as f:
                text = io.TextIOWrapper(f, encoding="utf-8", errors="replace", newline="")
                for i, fields in enumerate(csv.reader(text)):
                    if fields:
                        yield (name, pid, i, fields), sum(map(len, fields))
        elif self.mode == "points":
            with open(self.path, "rb") as f:
                start = _data_start(f, info)
                for i, p in enumerate(restart_points(f, start, start + info.compress_size, self.piece)):
                    yield (name, pid, i, p.byte - start, p.bit, p.offset, p.end, p.crc, p.window), len(p.window)
        else:
            for row, raw in enumerate(self._lines(z, info, part)):
                yield (name, pid, part.offset, row, raw.decode("utf-8", errors="replace").rstrip("\r\n")), len(raw)

    def _lines(self, z: zipfile.ZipFile, info: zipfile.ZipInfo, part: _Part) -> Iterator[bytes]:
        """The lines that begin in the range; streamed, a large member is
        never held whole."""
        if part.end is None:
            with z.open(info) as f:
                yield from f
            return
        with open(self.path, "rb") as f:
            start = _data_start(f, info)
            if part.point is None:
                yield from _lines_of(_stored(f, start + part.offset, start + info.file_size),
                                     part.end - part.offset, _after_break(f, start, part.offset))
                return
            row = ds.dataset(self.index, format="parquet").to_table(
                columns=["byte", "bit", "crc", "window"],
                filter=(ds.field("member") == info.filename) & (ds.field("point") == part.point)).to_pylist()[0]
            chunks = inflate(f, start + row["byte"], start + info.compress_size, row["bit"], row["window"])
            n = part.end - part.offset
            yield from _lines_of(_checked(chunks, n, row["crc"], info.filename), n, not row["window"] or row["window"][-1:] == b"\n")


def _data_start(f, info: zipfile.ZipInfo) -> int:
    """Where a member's data begins: after its local header."""
    f.seek(info.header_offset + 26)
    sizes = f.read(4)
    return info.header_offset + 30 + int.from_bytes(sizes[:2], "little") + int.from_bytes(sizes[2:], "little")


def _stored(f, at: int, stop: int) -> Iterator[bytes]:
    f.seek(at)
    while at < stop and (raw := f.read(min(1 << 20, stop - at))):
        at += len(raw)
        yield raw


def _after_break(f, start: int, offset: int) -> bool:
    if not offset:
        return True
    f.seek(start + offset - 1)
    return f.read(1) == b"\n"


def _checked(chunks: Iterator[bytes], n: int, crc: int, name: str) -> Iterator[bytes]:
    """`chunks`, of which the first `n` bytes must have the CRC-32 `crc`."""
    seen, got = 0, 0
    for c in chunks:
        got = zlib.crc32(c[:max(0, n - seen)], got)
        if seen < n <= seen + len(c) and got != crc:
            raise ValueError(f"the index doesn't fit the archive: {name}")
        seen += len(c)
        yield c


def _lines_of(chunks: Iterator[bytes], n: int, begins: bool) -> Iterator[bytes]:
    """The lines that begin in the first `n` bytes; unless the bytes
    themselves begin a line, the first belongs to the range before."""
    rest, at = b"", 0  # at: where `rest` begins
    for c in chunks:
        lines = (rest + c).split(b"\n")
        rest = lines.pop()
        for line in lines:
            if at >= n:
                return
            if begins:
                yield line
            begins, at = True, at + len(line) + 1
        if at >= n:
            return
    if rest and at < n and begins:
        yield rest


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipmembers"

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("mode", "list")]

    def reader(self, schema) -> DataSourceReader:
        return ZipMembersReader(dict(self.options))


def read_zip(
    spark: SparkSession, path: str, mode: str = "list", pattern: str = "", index: str | None = None, piece: int = PIECE,
    pids: Iterable[int] | None = None,
) -> DataFrame:
    """Members of the archive at `path` whose name matches `pattern`, of the
    participants `pids` (None: all); `index`: the restart points of
    `index_zip`, for mode `lines`."""
    spark.dataSource.register(ZipMembers)
    options = {"path": path, "mode": mode, "pattern": pattern, "index": index or "", "piece": piece}
    if pids is not None:
        options["pids"] = ",".join(map(str, pids))
    return spark.read.format("zipmembers").options(**options).load()


def index_zip(
    spark: SparkSession, path: str, out: str, pattern: str = r"(^|/)P_[0-9]+\.txt$", every: int = PIECE, overwrite: bool = False
) -> None:
    """Write the restart points of the deflated members that match, one about
    every `every` bytes, as a table on a folder that all tasks share. Each
    member is inflated once, by its own task."""
    points = read_zip(spark, path, "points", pattern, piece=every)
    staged_write(spark, out, lambda stage: points.write.parquet(stage), overwrite)


def _tag(df: DataFrame, strict: bool) -> DataFrame:
    """With `strict`, a member without a participant raises."""
    df = df.withColumnRenamed("member", "source")
    if strict:
        nobody = F.raise_error(F.concat(F.lit("no participant in path: "), F.col("source")))
        df = df.where(F.when(F.col("pid").isNull(), nobody.cast("boolean")).otherwise(F.lit(True)))
    return df


def zip_logs(
    spark: SparkSession, path: str, strict: bool = True, rejects: bool = False, watch: Observation | None = None,
    pids: Iterable[int] | None = None,
) -> DataFrame:
    """S4 from the archive: each `*.json` member is one array of events."""
    files = _tag(read_zip(spark, path, "text", r"\.json$", pids=pids), strict)
    return log_rejects(files) if rejects else parse_log_text(files, strict, watch).drop("source")


def zip_tobii_lines(spark: SparkSession, path: str, strict: bool = True, index: str | None = None, pids: Iterable[int] | None = None) -> DataFrame:
    """The lines of NDJSON members `P_<pid>.txt` (source, pid, block, row,
    value)."""
    return _tag(read_zip(spark, path, "lines", r"(^|/)P_[0-9]+\.txt$", index, pids=pids), strict)


def zip_tobii(
    spark: SparkSession, path: str, strict: bool = True, rejects: bool = False, check: bool = True,
    watch: Observation | None = None, index: str | None = None, pids: Iterable[int] | None = None,
) -> DataFrame:
    """S5 from the archive; `index`: see `index_zip`."""
    lines = zip_tobii_lines(spark, path, strict, index, pids)
    return gaze_rejects(lines) if rejects else parse_gaze_lines(lines, strict, check, watch)


def _tsv_members(spark, path, pattern, schema, strict):
    lines = _tag(read_zip(spark, path, "lines", pattern).where("block > 0 OR row > 0"), strict)
    return parse_delimited(lines.drop("block", "row"), schema).drop("source")


def zip_dots(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """S6 from the archive."""
    return _tsv_members(spark, path, r"final_dot_test_locations\.tsv$", DOT_TSV_SCHEMA, strict)


def zip_calibration(spark: SparkSession, path: str, pattern: str, strict: bool = True) -> DataFrame:
    """S7 from the archive; the member pattern is a parameter."""
    return _tsv_members(spark, path, pattern, CALIB_TSV_SCHEMA, strict)


def zip_specs(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """S8 from the archive: (pid, value) per `*specs.txt` member."""
    return _tag(read_zip(spark, path, "text", r"specs\.txt$"), strict).select("pid", "value")


def zip_form(spark: SparkSession, path: str) -> DataFrame:
    """S3 from the archive: the first `participant_characteristics.csv`
    member, read record by record by a CSV reader, so that a quoted note may
    hold line breaks."""
    records = read_zip(spark, path, "records", r"participant_characteristics\.csv").where("record_no > 0")
    return type_form_fields(first_source(records, "member"))


def screen_files(spark: SparkSession, path: str) -> DataFrame:
    """Screen recordings (`.flv`, `.mov`) of the archive, by name."""
    return read_zip(spark, path, "list", r"\.(flv|mov)$").orderBy("member")


def webcam_files(spark: SparkSession, path: str) -> DataFrame:
    """Webcam clips (`.webm`) of the archive, by name."""
    return read_zip(spark, path, "list", r"\.webm$").orderBy("member")
