"""Table sinks (K1-K7). All of them write through `commit.staged_write`."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .commit import save_beside, staged_write


def _ranged(df: DataFrame, path: str, keys: list[str], files: int | None, write: Callable[[DataFrame], None]) -> None:
    """`df` dealt by ranges of `keys`, each sorted, to `write`."""

    def dealt(rows: DataFrame) -> None:
        # without a count AQE merges small ranges of a small table
        rows = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
        write(rows.sortWithinPartitions(*keys))

    save_beside(df, path, dealt)


def write_table(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    dry_run: bool = False,
    compression: str = "uncompressed",
    keys: list[str] | None = None,
    check: Callable[[], None] | None = None,
    points: list[str] | None = None,
    row_group: int | None = None,
) -> DataFrame:
    """K1: Parquet table. A finished target is kept unless `overwrite`;
    `dry_run` returns the DataFrame without writing. With `keys` (O1) rows
    are range-partitioned and sorted by them, so row groups hold narrow key
    ranges that a filter can skip. `check` may reject the rows before the
    table appears (see `staged_write`).

    `points`: columns with a Bloom filter in every row group (of `row_group`
    bytes), so that a filter for one value skips the groups that lie around
    it but don't hold it. Parquet writes one only for a column without a
    dictionary, so these have none."""
    options = {"compression": compression}
    for c in points or []:
        options |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.enable.dictionary#{c}": "false"}
    if row_group:
        options["parquet.block.size"] = str(row_group)

    def save(stage: str) -> None:
        put = lambda out: out.write.options(**options).parquet(stage)
        _ranged(df, path, keys, None, put) if keys else put(df)

    if not dry_run:
        staged_write(df.sparkSession, path, save, overwrite, check)
    return df


def write_partitioned(
    df: DataFrame,
    path: str,
    key: str = "pid",
    order: str = "timestamp",
    fmt: str = "parquet",
    overwrite: bool = False,
    compression: str | None = "lz4",
    files: int | None = None,
    bucket_mod: int | None = None,
    header: bool = True,
    shuffle: bool = True,
    check: Callable[[], None] | None = None,
) -> DataFrame:
    """K2 / K3: one folder per key (`pid=7/`), rows sorted by `order` in
    every file; the key comes back from the folder name on read (and is
    left out of CSV files).

    Rows are range-partitioned on (key, order) first: a participant with a
    large share of the data is cut into several time ranges written by
    several tasks instead of one, and each file covers one contiguous,
    sorted range (tight min/max statistics). With `bucket_mod`, folders are
    `pid % n` buckets instead of one per participant, to avoid many small
    files when there are many participants.

    `shuffle=False` skips the range shuffle and only sorts within each
    task: for input already clustered by key (one file per participant, as
    the eye-tracker recordings are) every task writes its own participant's
    sorted file and the largest table is never moved."""
    out = df
    part_col = key
    if bucket_mod:
        part_col = f"{key}_bucket"
        out = out.withColumn(part_col, F.pmod(F.col(key), F.lit(bucket_mod)))

    def save(stage: str) -> None:
        def put(rows: DataFrame) -> None:
            w = rows.write.partitionBy(part_col)
            if compression and fmt == "parquet":
                w = w.option("compression", compression)
            if fmt == "csv":
                w = w.option("header", header)
            w.format(fmt).save(stage)

        _ranged(out, path, [key, order], files, put) if shuffle else put(out.sortWithinPartitions(key, order))

    staged_write(df.sparkSession, path, save, overwrite, check)
    return df


def write_sorted(
    df: DataFrame,
    path: str,
    keys: list[str],
    overwrite: bool = False,
    compression: str = "lz4",
    files: int | None = None,
) -> DataFrame:
    """K4: one table sorted by `keys`: range-partitioned so that each file
    holds one contiguous key range, sorted within."""

    def save(stage: str) -> None:
        _ranged(df, path, keys, files, lambda out: out.write.option("compression", compression).parquet(stage))

    staged_write(df.sparkSession, path, save, overwrite)
    return df


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """K5: CSV with a header (one file per task)."""
    staged_write(df.sparkSession, path, lambda stage: df.write.option("header", True).csv(stage), overwrite)
    return df


def _iso(c: str) -> F.Column:
    """ISO text of an instant; a fraction only where there is one."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(c, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def form_json(form: DataFrame) -> DataFrame:
    """K6: each participant row as one JSON text (pid, json): ISO instants
    and times of day with seconds, sizes as {w, h}, corners of the tracking
    box as {x, y, z}, nulls kept."""
    cols = []
    for f in form.schema.fields:
        name, kind = f.name, f.dataType.simpleString()
        if name == "time_of_day_min":  # a helper of ours
            continue
        if name == "time_of_day":
            cols.append(F.concat(name, F.lit(":00")).alias(name))
        elif name == "tracking_box":
            def corner(k):
                c = F.col("tracking_box")[k]
                return F.when(c.isNotNull(), F.struct(*[F.get(c, i).alias(a) for i, a in enumerate("xyz")])).alias(k)

            box = F.struct(*[corner(k) for k in f.dataType.fieldNames()])
            cols.append(F.when(F.col(name).isNotNull(), box).alias(name))
        elif kind.startswith("timestamp"):
            cols.append(_iso(name).alias(name))
        else:
            cols.append(F.col(name))
    return form.select("pid", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """K6: rows as JSON lines."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    staged_write(df.sparkSession, path, lambda stage: df.write.option("timestampNTZFormat", fmt).json(stage), overwrite)
    return df


def build_tables(
    builders: dict[str, Callable[[], DataFrame]],
    process: Iterable[str],
    sink: Callable[[str, DataFrame], object],
) -> list[str]:
    """K7: build and sink only the selected tables; returns their names."""
    done = []
    for name in builders:
        if name in set(process):
            sink(name, builders[name]())
            done.append(name)
    return done
