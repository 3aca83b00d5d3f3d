"""Writes: full refresh, date slice, append, fan-out, copy, report, alerts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.nested import ACCEPTED, FlattenSpec, counted_outcomes, route
from ledgerloom.session import remove_dir
from ledgerloom.sinks import snapshots


def write_full_refresh(df: DataFrame, target: str, fmt: str = "parquet", **options: str) -> int:
    """Replace the whole table; its version (see ``snapshots``, read it with ``read_table``).

    Readers see the old rows until the new ones are complete, and then these. A
    write or a publication that fails leaves the old table.
    """
    return snapshots.refresh(df, target, fmt, **options)


def write_append(df: DataFrame, target: str, fmt: str = "parquet", batch: str | None = None) -> int:
    """Add rows and keep what is there; its version. A ``batch`` that the table
    holds already is not added again, so a job may be run again after a failure."""
    return snapshots.append(df, target, batch, fmt)


def write_routed(df: DataFrame, spec: FlattenSpec, target: str) -> dict[str, int]:
    """Store flat rows and rejects of documents as slices of one table, in one pass; their counts.

    Slices are named by ``outcome``. An accepted row has its flat columns; a reject
    has them as far as they can be read, and the whole document as JSON. The counts
    are taken by an observation of the same pass, so nothing is read again.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    flat = [F.expr(expression).alias(name) for name, expression in spec.columns.items()]
    rows = route(df, spec).select(
        *flat, F.when(F.col("outcome") != ACCEPTED, whole).alias("rejected_document"), "outcome"
    )
    counted, seen = counted_outcomes(rows, spec)
    snapshots.refresh(counted, target, slice_col="outcome")
    return seen.get


def read_routed(spark: SparkSession, spec: FlattenSpec, target: str) -> tuple[DataFrame, DataFrame]:
    """The flat rows of ``write_routed``, and its rejects with ``outcome``, the predicate they failed."""
    accepted = snapshots.read_table(spark, target, slices=[ACCEPTED]).select(*spec.columns)
    return accepted, snapshots.read_table(spark, target, slices=spec.required)


def write_folder(df: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a plain folder of files that other programs read.

    The files are written beside the target and take its place by two renames,
    between which the target is absent for a moment; for tables that are read at
    any time use ``write_full_refresh``. A write that fails leaves the old folder; a
    rename that fails puts it back.
    """
    fresh = f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).options(**options).save(fresh)
        _switch(df.sparkSession, target, fresh)
    except Exception:
        remove_dir(df.sparkSession, fresh)
        raise


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def _switch(spark: SparkSession, target: str, fresh: str) -> None:
    """Put the folder ``fresh`` in the place of ``target``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    here, new, old = path(target), path(fresh), path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(here)
    if had:
        _rename(files, here, old)
    try:
        _rename(files, new, here)
    except Exception:
        if had:
            _rename(files, old, here)
        raise
    if had:
        files.delete(old, True)


def write_jdbc(
    df: DataFrame, url: str, table: str, append: bool = False, batch: int = 10000, **options: str
) -> None:
    """Store rows in a database table. A refresh truncates and keeps the table's
    definition; every partition of ``df`` writes over its own connection."""
    writer = df.write.format("jdbc").mode("append" if append else "overwrite")
    settings = {"url": url, "dbtable": table, "truncate": "true", "batchsize": str(batch)}
    writer.options(**settings, **options).save()


def write_date_slice(df: DataFrame, target: str, date_col: str, as_of: date, batch: str | None = None) -> int:
    """Store every row of ``df`` as the slice of ``as_of``, replacing that slice; the version.

    Also when ``df`` is empty, so a second run on the same day gives the same table
    and older days stay put. A run that fails leaves the day's old rows, and two
    runs for different days at once both stand.
    """
    day = df.drop(date_col).withColumn(date_col, F.lit(as_of))
    return snapshots.replace_slices(day, target, date_col, [as_of], batch=batch)


def replace_dates(df: DataFrame, target: str, date_col: str, batch: str | None = None) -> int:
    """Replace exactly the dates that occur in ``df``, all in one step; the version."""
    return snapshots.replace_slices(df, target, date_col, batch=batch)


def write_fan_out(spark: SparkSession, df: DataFrame, targets: Sequence[str]) -> None:
    """Write the same rows to several targets.

    The plan runs once, into the first target's data; the others copy the stored
    rows. Nothing is cached, so a lost executor costs a re-read only and all
    targets hold the same rows even if the plan is not repeatable. All rows are
    stored before the first target changes, so a write that fails changes none.
    """
    first, *others = targets
    entries = {first: snapshots.store(df, first, "parquet")}
    stored = spark.read.schema(df.schema).parquet(*[f"{first.rstrip('/')}/{e['folder']}" for e in entries[first]])
    try:
        for target in others:
            entries[target] = snapshots.store(stored, target, "parquet")
    except Exception:
        for target, held in entries.items():
            snapshots.discard(spark, target, held)
        raise
    for target in targets:
        snapshots.publish_refresh(df, target, entries[target])


def copy_table(
    spark: SparkSession,
    source: str | None,
    target: str | None,
    source_format: str = "parquet",
    target_format: str = "parquet",
    columns: Sequence[str] | None = None,
    source_options: Mapping[str, str] | None = None,
    target_options: Mapping[str, str] | None = None,
) -> None:
    """Copy a stored table elsewhere, in another format if wanted.

    A side without a path is what its options name: a database table, with
    format ``jdbc`` and the options ``url``, ``dbtable`` and, for a read in
    parallel, ``partitionColumn`` and its bounds. A target with a path becomes a
    table of ``write_full_refresh``.
    """
    df = spark.read.format(source_format).options(**(source_options or {})).load(source)
    df = df.select(*columns) if columns else df
    if target is None:
        options = {"truncate": "true", **(target_options or {})}
        df.write.format(target_format).mode("overwrite").options(**options).save()
    else:
        write_full_refresh(df, target, target_format, **(target_options or {}))


def with_headers(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Rename all columns, in order, to display headers."""
    if len(headers) != len(df.columns):
        raise ValueError(f"{len(headers)} headers for {len(df.columns)} columns")
    return df.toDF(*headers)


def write_report(
    df: DataFrame, headers: Sequence[str], path: str, order: Sequence[str] = ()
) -> None:
    """CSV parts whose concatenation, by name, is the report: the display headers
    as its first line, then the rows, ordered by the columns ``order``.

    A range sort deals the rows to parts, so no task holds the whole report.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    keys = [names[df.columns.index(c)] for c in order]
    with_headers(df, headers)
    rows = df.toDF(*names).select(
        F.lit(1).alias("_row"),
        *[F.col(c).alias(f"_{c}") for c in keys],
        *[F.col(c).cast("string") for c in names],
    )
    first = rows.sparkSession.createDataFrame([tuple(headers)], ", ".join(f"{c} string" for c in names))
    kinds = dict(rows.dtypes)
    empty = [F.lit(None).cast(kinds[f"_{c}"]).alias(f"_{c}") for c in keys]
    titled = first.select(F.lit(0).alias("_row"), *empty, *names).unionByName(rows)
    lines = titled.orderBy("_row", *[f"_{c}" for c in keys]).select(*names)
    write_folder(lines, path, "csv", escape='"')


def alert_rows(df: DataFrame, parts: Mapping[str, Column | str], into: str = "message") -> DataFrame:
    """One readable line per row: ``label: value`` pairs joined by commas."""
    shown = []
    for label, value in parts.items():
        value = F.col(value) if isinstance(value, str) else value
        shown.append(F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit("none"))))
    return df.withColumn(into, F.concat_ws(", ", *shown))
