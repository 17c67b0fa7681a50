"""Writing tables as Parquet folders under a commit log: appended batches, keyed batches in hash buckets, snapshots.

Folders count once the table's log names them (``commits``), in one order over all streams that write a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.operators.commits import LOG, CommitTaken, Files, State, commit, read_state
from dwellframe.schemas import CONTACT_COLUMNS

STREAM, BATCH, BASE, BUCKET, VERSION = "stream", "batch_id", "base", "bucket", "v"
#: Columns that every row of a stream table carries: who wrote it, in which micro-batch, and its commit's number.
WRITTEN = T.StructType([
    T.StructField("written_stream", T.StringType()), T.StructField("written_batch", T.LongType()), T.StructField("written_seq", T.LongType()),
])
#: Rows a bucket of a keyed table holds before its folder is cut into more buckets.
BUCKET_ROWS = 1 << 20
#: Folders of about one size that are merged into one of the next size.
FAN = 8


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, drop_contacts: bool = False) -> None:
    """Add rows as they are; duplicates are allowed. ``drop_contacts`` leaves personal contact columns out."""
    if drop_contacts:
        df = df.drop(*CONTACT_COLUMNS)
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


# --- stream tables ------------------------------------------------------------------------------


def bucket_of(keys: list[str], bits: int) -> Column:
    """The bucket of a key among ``2 ** bits``; buckets of fewer bits hold whole buckets of more."""
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1))


def bits_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(0, (max(0, rows - 1) // bucket_rows).bit_length())


def write_folder(df: DataFrame, path: str, folder: str, keys: list[str] | None, rows: int, bucket_rows: int = BUCKET_ROWS) -> dict:
    """Write ``df`` (of at most ``rows`` rows) into a data folder of the table; returns the folder's properties.

    With ``keys`` the rows lie in hash buckets of them, one folder a bucket, as many as the rows fill.
    """
    spark, root, made = df.sparkSession, path.rstrip("/"), {}
    if keys:
        made["bits"] = bits_for(rows, bucket_rows)
        dealt = df.withColumn(BUCKET, bucket_of(keys, made["bits"])).repartition(BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/{folder}")
        names = [n for n in Files(spark, root).names(folder) if n.startswith(f"{BUCKET}=")]
        made["buckets"] = sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names)
    else:
        df.write.mode("overwrite").parquet(f"{root}/{folder}")
    # counted from the files' own footers
    return {"rows": spark.read.schema(WRITTEN).option("recursiveFileLookup", "true").parquet(f"{root}/{folder}").count(), **made}


def write_batch(
    df: DataFrame, path: str, stream: str, batch_id: int, keys: list[str] | None = None, rows: int = 0,
    bucket_rows: int = BUCKET_ROWS, lacking: Callable[[State], DataFrame] | None = None,
) -> State:
    """Commit one micro-batch of one stream. A batch that the table has already is left as it is.

    ``stream`` is the writer's own name, kept with its checkpoint: a new checkpoint needs a new name, since
    its batches are numbered from 0 again. Tries of one batch overwrite each other until one is committed.
    ``keys`` puts the rows, at most ``rows``, into hash buckets. If other streams commit meanwhile, the rows get a
    later number. Where they depend on what the table holds, ``lacking`` gives them for a state of it, and
    again for the newer one.
    """
    if not stream or "/" in stream or "=" in stream:
        raise ValueError("a stream's name must not be empty or hold / or =")
    spark, folder, props = df.sparkSession, f"{STREAM}={stream}/{BATCH}={batch_id}", None
    state = read_state(spark, path)
    while batch_id > state.streams.get(stream, -1):
        if props is None or lacking:
            made = (lacking(state) if lacking else df).withColumns({"written_stream": F.lit(stream), "written_batch": F.lit(batch_id).cast("long")})
            props = {"stream": stream, "batch": batch_id, **write_folder(made, path, folder, keys, rows, bucket_rows)}
        if done := commit(spark, path, state, {folder: props}, streams={stream: batch_id}):
            return done
        state = read_state(spark, path)
    return state


def exists(spark: SparkSession, path: str) -> bool:
    return Files(spark, path).exists("")


def _rows(spark: SparkSession, path: str, schema: T.StructType, state: State, folders: list[str]) -> DataFrame:
    """Rows of some folders of ``state``, or of some buckets of them, with the ``WRITTEN`` columns."""
    full = T.StructType([*schema.fields, *WRITTEN.fields])
    if not folders:
        return spark.createDataFrame([], full)
    files = [f"{path.rstrip('/')}/{f}" for f in folders]
    rows = spark.read.schema(full).option("recursiveFileLookup", "true").parquet(*files)  # buckets are places, not columns
    # merged folders hold their rows' numbers, the others have one each; their number is bounded by merging
    numbers = {f"{p['stream']}/{p['batch']}": p["seq"] for p in state.folders.values() if "stream" in p}
    if not numbers:
        return rows
    number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    own = F.element_at(number, F.concat_ws("/", "written_stream", F.col("written_batch").cast("string"))).cast("long")
    return rows.withColumn("written_seq", F.coalesce(F.col("written_seq"), own))


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: tuple[str, int] | None = None, written: bool = False,
    state: State | None = None,
) -> DataFrame:
    """All committed micro-batches of all streams; an empty table if there are none.

    ``before`` = (stream, n) leaves out that stream's own batches from ``n`` on. ``written`` adds the ``WRITTEN`` columns.
    """
    state = state or read_state(spark, path)
    late = lambda p: before and p.get("stream") == before[0] and p["batch"] >= before[1]
    rows = _rows(spark, path, schema, state, [f for f, p in state.folders.items() if p["rows"] and not late(p)])
    return rows if written else rows.select(*schema.names)


def touched(state: State, buckets: set[int], bits: int) -> list[str]:
    """Folders of the buckets in which keys of the given buckets (among ``2 ** bits``) can lie."""
    found = []
    for folder, props in state.folders.items():
        if "bits" in props:
            there = {b & ((1 << props["bits"]) - 1) for b in buckets}
            found += [f"{folder}/{BUCKET}={b}" for b in props["buckets"] if b in there]
        elif props["rows"]:
            found.append(folder)
    return found


def rows_at_keys(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], wanted: DataFrame, state: State
) -> DataFrame:
    """The table's rows in the buckets that the keys of ``wanted`` fall into; other buckets are not opened.

    What reaches the driver are bucket numbers, at most as many as the largest folder has.
    """
    bits = max([p.get("bits", 0) for p in state.folders.values()], default=0)
    hit = {r[0] for r in wanted.select(bucket_of(keys, bits).alias("b")).distinct().collect()}
    return _rows(spark, path, schema, state, touched(state, hit, bits)).select(*schema.names)


def _merged(
    spark: SparkSession, path: str, schema: T.StructType, state: State, folders: list[str], reduce: Callable[[DataFrame], DataFrame],
    keys: list[str] | None, bucket_rows: int, level: int,
) -> tuple[str, dict]:
    """Write the rows of some folders into one; its name, which no other merge gets, and its properties."""
    files = Files(spark, path)
    number = max([int(f.removeprefix(f"{BASE}=")) for f in files.names("") if f.startswith(f"{BASE}=")], default=-1) + 1
    while not files.publish(f"{LOG}/{BASE}-{number}", ""):
        number += 1
    rows = reduce(_rows(spark, path, schema, state, [f for f in folders if state.folders[f]["rows"]]))
    most = sum(state.folders[f]["rows"] for f in folders)
    return f"{BASE}={number}", {"level": level, **write_folder(rows, path, f"{BASE}={number}", keys, most, bucket_rows)}


def merge_batches(
    spark: SparkSession, path: str, schema: T.StructType, reduce: Callable[[DataFrame], DataFrame] = lambda df: df,
    keys: list[str] | None = None, fan: int = FAN, bucket_rows: int = BUCKET_ROWS,
) -> State:
    """Merge folders of about one size, ``fan`` at a time, into one of the next size, until no size has so many.

    So a table has at most ``fan`` folders for each power of ``fan``, and a row is rewritten once for each. A merge that
    another writer overtakes is given up, for the next call to do. Nothing is deleted.
    """
    state = read_state(spark, path)
    while True:
        levels: dict[int, list[str]] = {}
        for folder, props in state.folders.items():
            levels.setdefault(props.get("level", 0), []).append(folder)
        full = [level for level, folders in levels.items() if len(folders) >= fan]
        if not full:
            return state
        level = min(full)
        name, props = _merged(spark, path, schema, state, levels[level], reduce, keys, bucket_rows, level + 1)
        done = commit(spark, path, state, {name: props}, levels[level])
        if done is None:
            return read_state(spark, path)
        state = done


def fold_batches(
    spark: SparkSession, path: str, schema: T.StructType, reduce: Callable[[DataFrame], DataFrame] = lambda df: df,
    keys: list[str] | None = None, bucket_rows: int = BUCKET_ROWS,
) -> dict[str, int]:
    """Merge everything but each stream's last micro-batch into one folder, reduced. Returns the last batch it holds of each stream."""
    state = read_state(spark, path)
    while True:
        held, last = dict(state.more.get("held", {})), state.streams
        fresh = [(p["stream"], p["batch"]) for p in state.folders.values() if "stream" in p and p["batch"] < last[p["stream"]]]
        for stream, batch in fresh:
            held[stream] = max(batch, held.get(stream, -1))
        if not fresh:
            return held
        old = [f for f, p in state.folders.items() if "stream" not in p or (p["stream"], p["batch"]) in fresh]
        level = max(p.get("level", 0) for p in state.folders.values()) + 1
        name, props = _merged(spark, path, schema, state, old, reduce, keys, bucket_rows, level)
        if commit(spark, path, state, {name: props}, old, held=held):
            return held
        state = read_state(spark, path)


# --- snapshots ----------------------------------------------------------------------------------


def snapshot_version(spark: SparkSession, root: str) -> int | None:
    return read_state(spark, root).seq or None


def _partition(name: str) -> dict[str, str | None]:
    """Partition values from a folder's name, as text; Spark's name for null is null."""
    pairs = [part.split("=", 1) for part in name.split("/")[1:]]
    return {k: None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for k, v in pairs}


def _snapshot(spark: SparkSession, root: str, state: State, folders: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(state.more["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    base = root.rstrip("/")
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).select(*schema.names)


def read_snapshot(spark: SparkSession, root: str, parts: list[dict] | None = None, state: State | None = None) -> DataFrame:
    """The current version, or that of ``state``; with ``parts``, only those partitions (dicts of partition values) of it."""
    state = state or read_state(spark, root)
    if not state.seq:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    return _snapshot(spark, root, state, [f for f in state.folders if parts is None or _wanted(f, parts)])


def _wanted(folder: str, parts: list[dict]) -> bool:
    own = _partition(folder)
    return any(all(own.get(k) == (None if v is None else str(v)) for k, v in part.items()) for part in parts)


def _write_version(
    df: DataFrame, root: str, version: int, partition_by: list[str], measures: dict[str, Column] | None = None
) -> dict[str, dict]:
    """Write rows below a name of this writer's own; the folders of its partitions, with ``measures`` of their rows.

    Partitions are dealt by their size as measured while shuffling, so a large one spans many files and small ones share a task.
    """
    spark, base = df.sparkSession, f"{root.rstrip('/')}/{VERSION}={version}-{uuid.uuid4().hex[:12]}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(base)
    files, level = Files(spark, root), [base.rsplit("/", 1)[1]]
    for key in partition_by:
        level = [f"{f}/{n}" for f in level for n in files.names(f) if n.startswith(f"{key}=")]
    made: dict[str, dict] = {f: {} for f in level}
    if measures and level:
        own = spark.read.schema(df.schema).parquet(base)
        found = own.groupBy(*partition_by).agg(*[c.alias(n) for n, c in measures.items()]).collect()
        by_part = {tuple(None if r[k] is None else str(r[k]) for k in partition_by): r for r in found}
        for f in level:
            r = by_part[tuple(_partition(f)[k] for k in partition_by)]
            made[f] = {n: r[n] for n in measures}
    return made


def write_snapshot(
    df: DataFrame, root: str, partition_by: list[str] | None = None, on: int | None = None, measures: dict[str, Column] | None = None, **more
) -> int:
    """Write the table's next version beside the one being read; returns its number.

    The log names the files of each partition of a version, so readers see either the old table or the whole new
    one. A version can be written once: the writer that comes second gets :class:`CommitTaken`. ``on`` is the
    version that ``df`` was made from, if another may have been written since; default is the current one.
    ``measures`` are aggregates kept with each partition in the log, ``more`` anything kept with the table.
    """
    spark, keys = df.sparkSession, list(partition_by or [])
    state = read_state(spark, root)
    if on is not None and on != state.seq:
        raise CommitTaken(f"{root} is at version {state.seq}, not {on}")
    added = _write_version(df, root, state.seq + 1, keys, measures)
    ordered = [c for c in df.columns if c not in keys] + keys
    done = commit(spark, root, state, added, list(state.folders), schema=df.select(*ordered).schema.jsonValue(), partition_by=keys, **more)
    if done is None:
        raise CommitTaken(f"version {state.seq + 1} of {root} was written meanwhile")
    return done.seq


def update_snapshot(
    spark: SparkSession, root: str, parts: list[dict], change: Callable[[DataFrame], DataFrame], on: int | None = None,
    measures: dict[str, Column] | None = None, **more,
) -> int:
    """The next version, in which only the partitions named in ``parts`` are rewritten: ``change`` gets their rows.

    Other partitions keep their files. ``change`` may add columns, which are null elsewhere, and rows of partitions
    named in ``parts`` only. The writer that comes second gets :class:`CommitTaken` and can start over on the new version.
    ``more`` is kept with the table from this version on.
    """
    state = read_state(spark, root)
    if not state.seq:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    if on is not None and on != state.seq:
        raise CommitTaken(f"{root} is at version {state.seq}, not {on}")
    keys, old = state.more["partition_by"], [f for f in state.folders if _wanted(f, parts)]
    rows = change(_snapshot(spark, root, state, old))
    added = _write_version(rows, root, state.seq + 1, keys, measures)
    if stray := [f for f in added if not _wanted(f, parts)]:
        raise ValueError(f"rows outside the given partitions: {sorted(_partition(stray[0]).items())}")
    known = T.StructType.fromJson(state.more["schema"])
    names = [c for c in dict.fromkeys([*known.names, *rows.columns]) if c not in keys] + keys
    schema = T.StructType([rows.schema[c] if c in rows.columns else known[c] for c in names])
    done = commit(spark, root, state, added, old, schema=schema.jsonValue(), **more)
    if done is None:
        raise CommitTaken(f"version {state.seq + 1} of {root} was written meanwhile")
    return done.seq


def parts_of(df: DataFrame, keys: list[str]) -> list[dict]:
    """The partitions that rows of ``df`` lie in: one dict for each combination of ``keys``, as many as a table has partitions."""
    return [r.asDict() for r in df.select(*keys).distinct().collect()]
