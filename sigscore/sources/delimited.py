"""Headerless delimited text: folders read with a declared schema, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigscore.schemas import PARTITION_COLUMNS, SIMPLE_SCHEMA, SIMPLE_STRING_SCHEMA
from sigscore.session import unique_name


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = SIMPLE_SCHEMA,
             sep: str = ",", mode: str = "FAILFAST") -> DataFrame:
    """A folder of headerless comma-separated files with a declared schema.

    A field that does not parse and a record with other than the declared number of fields
    raise. ``mode="PERMISSIVE"`` reads them as NULLs instead and drops surplus fields; a schema
    with a ``_corrupt_record`` STRING column then keeps the raw record of each.
    """
    return (spark.read.schema(schema).option("header", "false").option("sep", sep)
            .option("mode", mode).csv(path))


def scan_csv_strings(spark: SparkSession, path: str,
                     schema: T.StructType = SIMPLE_STRING_SCHEMA) -> DataFrame:
    """Same, every column STRING (typed later with ``try_cast``)."""
    return scan_csv(spark, path, schema)


def create_csv_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                     sep: str = ",", if_not_exists: bool = True) -> str:
    """External headerless CSV table over a folder (``CREATE TABLE IF NOT EXISTS … USING csv
    LOCATION``)."""
    from sigscore.sinks.tables import create_table
    create_table(spark, name, schema, "csv", (), location, csv_options={"sep": sep},
                 if_not_exists=if_not_exists)
    return name


def load_csv_into_table(spark: SparkSession, path: str, table: str, sep: str = ",",
                        mode: str = "FAILFAST") -> None:
    """Append the rows of a headerless CSV folder to an existing table.

    Headerless fields have a position only: they are read in the order of the table's columns.
    Malformed records raise unless ``mode`` says otherwise (see ``scan_csv``).
    """
    target = spark.table(table)
    scan_csv(spark, path, target.schema, sep, mode).write.insertInto(table)


def load_csv_partition(spark: SparkSession, path: str, table: str, date: str, hour: int | str,
                       sep: str = ",", mode: str = "FAILFAST", ours: bool = False) -> int:
    """Load a staged headerless CSV folder, which has the table's data columns in order and no
    ``date`` and ``hour``, into one static partition, replacing what is there; return the rows.

    The staged lines are counted first. If other than that many records come out of them (records
    that ``mode`` drops, or that span lines) nothing is replaced and a ValueError says both counts.
    ``ours``: files that ``write_csv_files`` wrote, with its options and escapes.
    """
    from sigscore.sinks.tables import read_csv_files, replace_partition
    from sigscore.sources.tables import parse_partition
    day, h = parse_partition(date, hour)
    target = spark.table(table)
    data = T.StructType([f for f in target.schema.fields if f.name not in PARTITION_COLUMNS])
    rows = read_csv_files(spark, path, data, mode) if ours else scan_csv(spark, path, data, sep, mode)
    staged = spark.read.text(path).where(F.col("value") != "").count()
    # the greatest hash needs every field, so that the records are parsed and not only counted
    parsed = rows.agg(F.count(F.lit(1)), F.max(F.xxhash64(*rows.columns))).first()[0]
    if parsed != staged:
        raise ValueError(f"{staged} lines are staged in {path}, {parsed} records come out of them")
    dated = rows.withColumn("date", F.lit(day)).withColumn("hour", F.lit(h))
    return replace_partition(spark, dated, table, date, hour)


def split_csv(spark: SparkSession, path: str, schema: T.StructType, out: str,
              sep: str = ",") -> tuple[int, int]:
    """Split a headerless CSV folder in one pass: records that fit ``schema`` go to ``out``/bad=false,
    the others, with the raw text in ``_corrupt_record``, to ``out``/bad=true (Parquet). Returns the
    numbers of good and bad ones, which add up to the records of the input."""
    raw = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    seen = Observation(unique_name("split_csv"))
    bad = F.col("_corrupt_record").isNotNull()
    rows = scan_csv(spark, path, raw, sep, "PERMISSIVE").withColumn("bad", bad).observe(
        seen, F.count_if(~F.col("bad")).alias("good"), F.count_if("bad").alias("bad"))
    rows.write.partitionBy("bad").parquet(out)
    return int(seen.get["good"]), int(seen.get["bad"])


def load_csv_quarantine(spark: SparkSession, path: str, table: str, quarantine: str,
                        sep: str = ",") -> tuple[int, int]:
    """Append a CSV folder's good records to a table; its malformed ones are left under
    ``quarantine`` (see ``read_quarantine``). Returns both counts. The input is read once; what is
    loaded is what was split off, so the two never disagree."""
    target = spark.table(table)
    counts = split_csv(spark, path, target.schema, quarantine, sep)
    _part_of_split(spark, target.schema, quarantine, False).drop("_corrupt_record").write.insertInto(table)
    return counts


def read_quarantine(spark: SparkSession, schema: T.StructType, quarantine: str) -> DataFrame:
    """The raw text of the malformed records, one column ``_corrupt_record``."""
    return _part_of_split(spark, schema, quarantine, True).select("_corrupt_record")


def _part_of_split(spark, schema, out, bad) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType()),
                          T.StructField("bad", T.BooleanType())])
    return spark.read.schema(whole).parquet(out).where(F.col("bad") == F.lit(bad)).drop("bad")
