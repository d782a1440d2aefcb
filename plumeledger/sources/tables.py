"""Keyed tables as Parquet folders ``<root>/<name>``, published snapshot by snapshot.

Every write puts its files into a folder of its own, ``batch=<id>``, and then publishes a
snapshot: a small file in ``_snapshots`` that lists the folders of which the table now
consists. Readers resolve the newest snapshot, so they see a write whole or not at all, and a
write that fails at any point leaves the table as it was. Folders that the last two
snapshots no longer list are deleted.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import latest_by_key, upsert
from ..schemas import TABLES, conform
from .workspace import file_system, written

FILE_BYTES = 256 * 1024 * 1024
#: A task sorts the rows of one file in memory, where they take their full width; in the file, equal
#: values and nulls take next to nothing, so that its bytes alone bound no task.
FILE_ROWS = 1_000_000


def table_path(root: str, name: str) -> str:
    return f"{root}/{name}"


def _snapshots(spark: SparkSession, root: str, name: str) -> list[int]:
    path, files = file_system(spark, f"{table_path(root, name)}/_snapshots")
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def _folders(spark: SparkSession, root: str, name: str, number: int) -> list[str]:
    """The folders of a snapshot, relative to the table, the batch first."""
    path, files = file_system(spark, f"{table_path(root, name)}/_snapshots/{number:012d}")
    stream = files.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _live(spark: SparkSession, root: str, name: str) -> list[str] | None:
    """The folders of the newest snapshot; None if there is no table yet."""
    numbers = _snapshots(spark, root, name)
    return _folders(spark, root, name, numbers[-1]) if numbers else None


def _read(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    schema = TABLES[name].storage_ddl
    if not folders:
        return spark.createDataFrame([], schema)
    base = table_path(root, name)
    return (
        spark.read.schema(schema)
        .option("basePath", base)
        .parquet(*[f"{base}/{_globbed(folder)}" for folder in folders])
    )


def _globbed(folder: str) -> str:
    """The folder's name with the characters escaped that a path pattern would read."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in folder)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A whole table with its declared columns; filters on it reach the scan.

    The frame stays on the snapshot it was made from, which the next write still keeps.
    """
    folders = _live(spark, root, name)
    if folders is None:
        raise FileNotFoundError(f"no table at {table_path(root, name)}")
    return _read(spark, root, name, folders).select(*TABLES[name].columns)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return bool(_snapshots(spark, root, name))


def snapshot_number(spark: SparkSession, root: str, name: str) -> int:
    """The number of the newest snapshot; -1 if there is no table yet."""
    return max(_snapshots(spark, root, name), default=-1)


def _leaves(spark: SparkSession, root: str, name: str, batch: str) -> list[str]:
    """Folders of a batch that hold data files, relative to the table. The driver lists as many
    entries as the batch has folders, all of which it keeps in its file index anyway."""
    depth = len(TABLES[name].directories)
    base, files = file_system(spark, table_path(root, name))
    start = file_system(spark, f"{table_path(root, name)}/{batch}")[0]
    level = [start] if files.exists(start) else []
    for _ in range(depth):
        level = [
            child.getPath()
            for folder in level
            for child in files.listStatus(folder)
            if child.isDirectory() and "=" in child.getPath().getName()
        ]
    prefix = len(base.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()) + 1
    return [p.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()[prefix:] for p in level]


def _publish(
    rows: DataFrame, root: str, name: str, n_files: int, kept: list[str] | None, replaced: bool
) -> int:
    """Write ``rows`` as a new batch, laid out by the whole key, and publish the snapshot. The
    rows written are returned: they are counted as they pass, not read again.

    The key is unique, so its ranges are even however the rows spread over partitions or
    facilities: one hot partition becomes several files, a small one part of a task.
    ``kept`` lists the folders of the table so far; with ``replaced``, those for which the
    batch has a folder are dropped, otherwise all are.
    """
    spark, table, base = rows.sparkSession, TABLES[name], table_path(root, name)
    order = list(dict.fromkeys([*table.directories, *table.key]))
    batch = f"batch={uuid.uuid4().hex}"
    seen = Observation()
    # Above the exchange, so that the sampling for its ranges is not counted.
    laid = rows.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
    writer = laid.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if table.directories:
        writer = writer.partitionBy(*table.directories)
    writer.parquet(f"{base}/{batch}")
    place = lambda folder: folder.partition("/")[2]
    new = _leaves(spark, root, name, batch)
    old = kept if kept is not None and replaced else []
    taken = {place(folder) for folder in new}
    live = sorted([*new, *[f for f in old if place(f) not in taken]])

    numbers = _snapshots(spark, root, name)
    number = numbers[-1] + 1 if numbers else 0
    hidden, files = file_system(spark, f"{base}/_snapshots/.{batch}")
    stream = files.create(hidden, True)
    try:
        stream.write(json.dumps(live).encode())
    finally:
        stream.close()
    final, _ = file_system(spark, f"{base}/_snapshots/{number:012d}")
    if not files.rename(hidden, final):
        raise RuntimeError(f"another write to {name} was published first; write the rows again")
    _clean(spark, root, name, [*numbers, number])
    return seen.get["rows"]


def _clean(spark: SparkSession, root: str, name: str, numbers: list[int]) -> None:
    """Drop snapshots but the last two, and the folders that only dropped ones list."""
    if len(numbers) < 3:
        return
    held = {f for n in numbers[-2:] for f in _folders(spark, root, name, n)}
    batches = {f.partition("/")[0] for f in held}
    for n in numbers[:-2]:
        for folder in _folders(spark, root, name, n):
            gone = folder if folder.partition("/")[0] in batches else folder.partition("/")[0]
            if folder not in held:
                path, files = file_system(spark, f"{table_path(root, name)}/{gone}")
                files.delete(path, True)
        path, files = file_system(spark, f"{table_path(root, name)}/_snapshots/{n:012d}")
        files.delete(path, False)


def _touched(existing: DataFrame, batch: DataFrame, directories: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in directories that ``batch`` has rows in, by a join on the directory
    columns, which prunes the scan when it runs."""
    if not directories:
        return existing
    return existing.join(batch.select(*directories).distinct(), list(directories), "left_semi")


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "upsert",
    order: Sequence[Column] | None = None,
    file_bytes: int = FILE_BYTES,
    file_rows: int = FILE_ROWS,
) -> int:
    """Write rows into a table; the number of rows in the files written is returned.

    ``upsert`` replaces rows by key and leaves all others. ``order`` says which incoming
    row wins a key (the first); it may use further columns of ``df``, and is by default
    all columns, descending. Only directories with incoming rows are read and written
    anew. ``refresh`` replaces the whole table, so nothing stale remains.

    The rows go to a scratch table first, because finding the ranges of the layout takes a
    second pass. The number of files follows the bytes and the rows to be written, not the
    shuffle setting. Of two writes to one table at a time, one fails.
    """
    if mode not in ("upsert", "refresh"):
        raise ValueError(f"unknown mode {mode!r}")
    table = TABLES[name]
    spark = df.sparkSession
    if order is None:
        # Maps have no order of their own; their sorted entries do.
        order = [
            F.desc(F.array_sort(F.map_entries(c)) if kind.startswith("map") else F.col(c))
            for c, kind in table.columns.items()
        ]
    extra = [c for c in df.columns if c not in table.columns]
    rows = table.with_derived(conform(df, name, keep=extra))
    fresh = latest_by_key(rows, table.key, order).drop(*extra)
    with written(fresh, f"batch-{name}") as batch:
        live = _live(spark, root, name) if mode == "upsert" else None
        merged, size, count = batch.rows, batch.size(), batch.rows.count()
        if live:
            existing = _read(spark, root, name, live).select(*batch.rows.columns)
            existing = _touched(existing, batch.rows, table.directories)
            merged = upsert(existing, batch.rows, table.key)
            old_size, old_count = _extent(_touched(_placed(spark, root, name, live), batch.rows, table.directories))
            size, count = size + old_size, count + old_count
        n_files = max(1, math.ceil(size / file_bytes), math.ceil(count / file_rows))
        return _publish(merged, root, name, n_files, live, mode == "upsert")


def _placed(spark: SparkSession, root: str, name: str, live: list[str]) -> DataFrame:
    """Rows with nothing but their directories and the file they come from."""
    return _read(spark, root, name, live).select(
        *TABLES[name].directories,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    )


def _extent(placed: DataFrame) -> tuple[int, int]:
    """Bytes of the files that ``placed`` rows come from, and the rows; only footers are read."""
    files = placed.groupBy("file", "size").agg(F.count(F.lit(1)).alias("rows"))
    size, rows = files.agg(F.sum("size"), F.sum("rows")).first()
    return size or 0, rows or 0


def write_owner_tables(owner_years: DataFrame, root: str) -> dict[str, int]:
    """The same rows under (year, owner) and under (owner, year); table -> rows written."""
    with written(owner_years, "owner-year") as stage:
        names = ("analysis_owner_year", "analysis_owner_trend")
        return {name: write_table(stage.rows, root, name, mode="refresh") for name in names}
