"""Table writers: partition replace, append, overwrite, create-or-replace, CSV files.

``insertInto`` matches columns by position, so every writer first reorders the frame to the
target's column order *by name*. Multi-partition writes are rebalanced on the partition
columns (one shuffle; AQE splits a hot hour into several tasks) so that each task writes few
partitions and file counts stay bounded. Nothing is coalesced to one task.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigscore.functions.text import escape_breaks, unescape_breaks
from sigscore.schemas import PARTITION_COLUMNS, ddl
from sigscore.session import materialise, remove_folder, unique_name
from sigscore.sources.tables import parse_partition, partition_predicate

# CSV keeps full timestamp precision only with an explicit pattern (the default drops micros),
# edge blanks only when told to, and tells an empty string from NULL by a marker for NULL. Quotes
# are doubled, so that a backslash is an ordinary character. Line breaks and backslashes in text
# are escaped by the writers here (a record is a line, so files can be split) and a table property
# says so; ``read_table`` and ``read_csv_files`` take the escapes back.
CSV_OPTIONS = {"header": "false", "sep": ",", "escape": '"', "nullValue": "\\N",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"}


FILE_BYTES = 256 * 1024 * 1024  # of a partition's files, that one file should hold
ESCAPED = "sigscore.escaped_text"
VERSION = "v-"   # begins the name of a folder that holds one version of an external table


def _quote(name: str) -> str:
    """A possibly qualified table name as back-quoted identifiers."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def format_options(fmt: str, compression: str | None = None,
                   csv_options: dict[str, str] | None = None) -> dict[str, str]:
    """Writer / table options of a format (CSV timestamp patterns, compression)."""
    opts = {**CSV_OPTIONS, **(csv_options or {})} if fmt == "csv" else {}
    if compression:
        opts["compression"] = compression
    return opts


def create_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 partition_by: Sequence[str] = PARTITION_COLUMNS, location: str | None = None,
                 compression: str | None = None,
                 csv_options: dict[str, str] | None = None,
                 if_not_exists: bool = False) -> str:
    """``CREATE TABLE [IF NOT EXISTS] … USING fmt [PARTITIONED BY] [LOCATION]`` (a datasource
    table; external when ``location`` is given)."""
    opts = format_options(fmt, compression, csv_options)
    exists = "IF NOT EXISTS " if if_not_exists else ""
    sql = f"CREATE TABLE {exists}{_quote(name)} ({ddl(schema)}) USING {fmt}"
    if opts:
        sql += " OPTIONS (" + ", ".join(f"{_literal(k)} {_literal(v)}"
                                        for k, v in opts.items()) + ")"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        sql += f" LOCATION {_literal(location)}"
    if fmt == "csv" and not csv_options:
        sql += f" TBLPROPERTIES ({_literal(ESCAPED)} 'true')"
    spark.sql(sql)
    return name


def _text_columns(df: DataFrame, change, but: Sequence[str]) -> DataFrame:
    """``df`` with ``change`` on its text columns, ``but`` those named."""
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) and f.name not in but
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _has_escaped_text(spark: SparkSession, table: str) -> bool:
    return any(r["key"] == ESCAPED and r["value"] == "true"
               for r in spark.sql(f"SHOW TBLPROPERTIES {_quote(table)}").collect())


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, with line breaks and backslashes of text as they were written."""
    rows = spark.table(table)
    if not _has_escaped_text(spark, table):
        return rows
    return _text_columns(rows, unescape_breaks, _partition_columns(spark, table))


def _for_table(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order, text escaped where the table holds it so."""
    rows = _by_name(df, _table_columns(spark, table))
    if not _has_escaped_text(spark, table):
        return rows
    return _text_columns(rows, escape_breaks, _partition_columns(spark, table))


def _by_name(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"frame lacks target columns {missing}")
    return df.select(*columns)


def _table_columns(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def compact(spark: SparkSession, table: str, file_bytes: int | None = None) -> int:
    """Rewrite the ``(date, hour)`` partitions whose files are more than their bytes ask for, one
    file for each ``file_bytes``; return the number of partitions. The rows are copied first, and
    only those partitions are replaced, when the job commits; the others are neither read for
    rows nor written."""
    most = file_bytes or FILE_BYTES
    parts = _partition_columns(spark, table)
    files = spark.table(table).select(*parts, F.col("_metadata.file_path").alias("f"),
                                      F.col("_metadata.file_size").alias("b")).distinct()
    small = files.groupBy(*parts).agg(F.count("*").alias("n"), F.sum("b").alias("b")).where(
        F.col("n") > F.ceil(F.col("b") / most)).select(*parts)
    n = small.count()
    if n:
        # one row per partition: bounded by the table's partitions, which the driver lists anyway
        copy = materialise(spark.table(table).join(F.broadcast(small), parts, "left_semi"), "compact")
        with dynamic_partition_write(spark, "dynamic"):
            _by_name(_rebalanced(copy, parts), _table_columns(spark, table)).write.insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
    return n


@contextlib.contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting for the duration of one write, then restore it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextlib.contextmanager
def dynamic_partition_write(spark: SparkSession, overwrite_mode: str | None = None
                            ) -> Iterator[None]:
    """Scope for a write whose partitions come from the data: Hive-format targets need
    ``hive.exec.dynamic.partition.mode=nonstrict`` (harmless for datasource tables), and an
    overwrite needs its partition overwrite mode set explicitly."""
    with contextlib.ExitStack() as stack:
        stack.enter_context(session_conf(spark, "hive.exec.dynamic.partition", "true"))
        stack.enter_context(session_conf(spark, "hive.exec.dynamic.partition.mode",
                                         "nonstrict"))
        if overwrite_mode:
            stack.enter_context(session_conf(
                spark, "spark.sql.sources.partitionOverwriteMode", overwrite_mode))
        yield


def replace_partition(spark: SparkSession, df: DataFrame, table: str,
                      date: str | dt.date, hour: int | str) -> int:
    """Idempotently replace one ``(date, hour)`` partition of ``table`` with ``df``'s rows;
    return the number of rows written.

    The rows are written with dynamic partition overwrite: Spark stages the new files and
    swaps the partition only when the job commits, so a failed job leaves the old hour in
    place. An ``Observation`` on the same write counts the rows that went through; when there
    were none (dynamic overwrite would then keep the old rows), the partition is emptied with
    a static ``INSERT OVERWRITE`` of nothing. Every other partition is left as it is, rows of
    other hours in ``df`` are not written, and the values are validated (ISO date, hour 0..23)
    before they reach any statement.
    """
    day, h = parse_partition(date, hour)
    seen = Observation(unique_name("replace_rows"))
    rows = (_for_table(spark, df.where(partition_predicate(day, h)), table)
            .observe(seen, F.count(F.lit(1)).alias("rows")))
    with dynamic_partition_write(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=True)
    written = int(seen.get["rows"])
    if written == 0:
        _clear_partition(spark, table, day, h)
    return written


def _clear_partition(spark: SparkSession, table: str, day: dt.date, hour: int) -> None:
    target = spark.table(table).schema
    data_schema = T.StructType([f for f in target.fields if f.name not in PARTITION_COLUMNS])
    view = unique_name("_empty_src")
    spark.createDataFrame([], data_schema).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {_quote(table)} "
                  f"PARTITION (`date` = DATE'{day.isoformat()}', `hour` = {hour}) "
                  f"SELECT * FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)


def append(spark: SparkSession, df: DataFrame, table: str, rebalance: bool = True) -> None:
    """Append to an existing table; on a partitioned table partitions are dynamic."""
    cols = _table_columns(spark, table)
    parts = [c for c in PARTITION_COLUMNS if c in cols] if rebalance else []
    with dynamic_partition_write(spark):
        _for_table(spark, _rebalanced(df, parts), table).write.insertInto(table)


def create_batched_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                         location: str | None = None) -> str:
    """A table for ``append_once``: partitioned by date, hour and ``batch``, with its ledger
    ``<name>__batches`` (batch, rows, committed) beside it."""
    batched = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    create_table(spark, name, batched, fmt, (*PARTITION_COLUMNS, "batch"), location)
    ledger = T.StructType([T.StructField("batch", T.StringType()), T.StructField("rows", T.LongType()),
                           T.StructField("committed", T.TimestampType())])
    create_table(spark, f"{name}__batches", ledger, "parquet", (),
                 f"{location.rstrip('/')}__batches" if location else None)
    return name


def append_once(df: DataFrame, table: str, batch: str) -> int:
    """Append the rows of one batch; a batch that the ledger names is not written again. Returns
    the number of rows written.

    The rows' partitions belong to the batch alone and are replaced when the job commits, so a
    batch that was cut short, or written but not yet entered in the ledger, is written over by its
    rerun and never twice. A batch's rows must be the same in each run, as a replayed micro-batch's
    are. The table's other batches are not touched.
    """
    spark = df.sparkSession
    ledger = f"{table}__batches"
    if not spark.table(ledger).where(F.col("batch") == batch).isEmpty():
        return 0
    overwrite_rows(spark, df.withColumn("batch", F.lit(batch)), table, "dynamic")
    spark.catalog.refreshTable(table)
    n = spark.table(table).where(F.col("batch") == batch).count()
    spark.range(1).select(F.lit(batch).alias("batch"), F.lit(n).cast("long").alias("rows"),
                          F.current_timestamp().alias("committed")).write.insertInto(ledger)
    return n


def overwrite_rows(spark: SparkSession, df: DataFrame, table: str,
                   partition_mode: str = "dynamic", rebalance: bool = True) -> None:
    """Overwrite the rows of an existing table (a missing table is an error).

    ``partition_mode="dynamic"`` replaces only the partitions present in ``df``;
    ``"static"`` empties the whole table first. ``insertInto`` ignores a writer option for
    this, so the session setting is scoped around the one write.
    """
    if partition_mode not in ("dynamic", "static"):
        raise ValueError("partition_mode must be 'dynamic' or 'static'")
    cols = _table_columns(spark, table)
    parts = [c for c in PARTITION_COLUMNS if c in cols] if rebalance else []
    rows = _for_table(spark, _rebalanced(df, parts), table)
    with dynamic_partition_write(spark, partition_mode):
        rows.write.insertInto(table, overwrite=True)


def save_table(df: DataFrame, name: str, fmt: str | None = None,
               partition_by: Sequence[str] = (), compression: str | None = None,
               path: str | None = None, mode: str = "overwrite", rebalance: bool = True) -> None:
    """Create or replace a table from ``df``; external, in a folder of versions, when ``path`` is
    set or the table is partitioned (its partitions name their folders, which a managed table's
    change of name would leave behind; the folder is then the name's in the warehouse).
    ``drop_table`` removes such a table with its files.

    A replacement is written whole, as a table of its own, before the name passes to it: a write
    that fails leaves the old table as it was, and ``df`` may read the table that it replaces. The
    change of names is two catalog steps; where a driver dies between them, the next ``save_table``
    (or ``finish_swap``) gives the old table its name back. Files of the version before go when the
    names have changed; a folder that is no version of this writer's stays.

    A partitioned write is rebalanced on its partition columns by default (one shuffle, bounded
    files per partition whatever the input order); input already clustered by time can pass
    ``rebalance=False`` and be written without a shuffle. Modes other than ``overwrite`` are those
    of ``saveAsTable``.
    """
    spark = df.sparkSession
    fmt = fmt or spark.conf.get("spark.sql.sources.default", "parquet")
    if mode != "overwrite":
        _save_as(df, name, fmt, partition_by, compression, path, mode, rebalance)
        return
    finish_swap(spark, name)
    if partition_by and not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('.', '/')}"
    staged = unique_name(f"{name}__next")
    version = f"{path.rstrip('/')}/{unique_name(VERSION + 'x')}" if path else None
    try:
        _save_as(df, staged, fmt, partition_by, compression, version, "error", rebalance)
        _swap(spark, staged, name)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(staged)}")
        if version:
            remove_folder(spark, version)
        raise


def _save_as(df, name, fmt, partition_by, compression, path, mode, rebalance) -> None:
    escaped = fmt == "csv"
    rows = _text_columns(df, escape_breaks, partition_by) if escaped else df
    writer = _rebalanced(rows, partition_by if rebalance else ()).write.mode(mode).format(fmt)
    for key, value in format_options(fmt, compression).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if escaped:
        df.sparkSession.sql(f"ALTER TABLE {_quote(name)} SET TBLPROPERTIES ({_literal(ESCAPED)} = 'true')")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {_quote(old)} RENAME TO {_quote(new)}")


def _version_folder(spark: SparkSession, table: str) -> str | None:
    """The folder of an external table, if it is a version that ``save_table`` wrote."""
    about = {r["col_name"]: r["data_type"] for r in
             spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(table)}").collect()}
    folder = (about.get("Location") or "").rstrip("/")
    ours = about.get("Type") == "EXTERNAL" and folder.rsplit("/", 1)[-1].startswith(VERSION)
    return folder if ours else None


def _swap(spark: SparkSession, staged: str, name: str) -> None:
    """Give ``name`` to the table ``staged``; the table that had it, if any, goes."""
    before = f"{name}__prev"
    if not spark.catalog.tableExists(name):
        _rename(spark, staged, name)
        return
    _rename(spark, name, before)
    try:
        _rename(spark, staged, name)
    except BaseException:
        _rename(spark, before, name)
        raise
    drop_table(spark, before)
    spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table, with its files also where it is a version that ``save_table`` wrote."""
    folder = _version_folder(spark, table)
    spark.sql(f"DROP TABLE {_quote(table)}")
    if folder:
        remove_folder(spark, folder)


def finish_swap(spark: SparkSession, name: str) -> None:
    """After a driver that died while names changed: the old table has its name again, or, if the
    new one has it already, the old one goes."""
    before = f"{name}__prev"
    if not spark.catalog.tableExists(before):
        return
    if spark.catalog.tableExists(name):
        drop_table(spark, before)
    else:
        _rename(spark, before, name)


def write_csv_files(df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS,
                    mode: str = "overwrite", rebalance: bool = True) -> None:
    """Headerless CSV files; partition values live in folder names, not inside the files. A record
    is a line: line breaks and backslashes in text are escaped."""
    df = _text_columns(df, escape_breaks, partition_by)
    writer = (_rebalanced(df, partition_by if rebalance else ()).write.mode(mode)
              .options(**CSV_OPTIONS))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_csv_files(spark: SparkSession, path: str, schema: T.StructType,
                   mode: str = "PERMISSIVE") -> DataFrame:
    """Read back what ``write_csv_files`` wrote (partition columns come from folder names)."""
    rows = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", mode).csv(path)
    return _text_columns(rows, unescape_breaks, PARTITION_COLUMNS)


def insert_values(spark: SparkSession, table: str, date: str | dt.date, hour: int | str,
                  rows: Iterable[Sequence], schema: T.StructType | None = None) -> None:
    """``INSERT INTO … PARTITION (date, hour)`` of literal rows held by the caller."""
    day, h = parse_partition(date, hour)
    data_cols = [c for c in _table_columns(spark, table) if c not in PARTITION_COLUMNS]
    target = spark.table(table).schema
    data_schema = schema or T.StructType([target[c] for c in data_cols])
    frame = spark.createDataFrame(list(rows), data_schema)
    if _has_escaped_text(spark, table):
        frame = _text_columns(frame, escape_breaks, ())
    view = unique_name("_values_src")
    frame.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {_quote(table)} "
                  f"PARTITION (`date` = DATE'{day.isoformat()}', `hour` = {h}) "
                  f"SELECT {', '.join(f'`{c}`' for c in data_cols)} FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)


def score_and_save(df: DataFrame, name: str, path: str | None = None, column: str = "x1",
                   out: str = "y", fmt: str | None = None) -> None:
    """Score one column of a table and create or replace a two-column result table."""
    from sigscore.operators.enrich import score_simple
    save_table(score_simple(df, column, out), name, fmt=fmt, path=path)
