"""Landed CSV files -> raw tables.

Two regimes, as in the original loader:

* header-named, all-string tables (bands, albums, labels): the column names
  come from the file header with blanks turned into '_', every column is
  read as a string (ids that look numeric are not), then a rename map keeps
  and renames the columns we use;
* typed tables written by the ingester (setlists, songs, band_mapping): a
  declared schema, no inference pass.

Files stay splittable (no multi-line records). Empty text cells of the raw tables
load as '', which the marts count as a value where they count distinct ones;
``empty_as=None`` loads them as NULL instead.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_event_date
from .commits import Files
from .ledger import Ledger
from .schemas import RAW_TABLES, RawTable

# One dialect both ways: a quote in a value is doubled, blanks at its ends are kept.
_DIALECT = {"header": "true", "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
WRITE_OPTIONS = dict(_DIALECT)
# Each file's header is checked against the schema: moved or other columns stop the read.
_CSV_OPTIONS = {**_DIALECT, "multiLine": "false", "mode": "FAILFAST", "enforceSchema": "false"}


def sanitise_header(name: str) -> str:
    """'Band ID' -> 'Band_ID' (ends trimmed, inner blanks to '_')."""
    return name.strip().replace(" ", "_")


def _fill_empty(df: DataFrame, empty_as: str | None) -> DataFrame:
    if empty_as is None:
        return df
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(empty_as, subset=cols)


def read_header_named(spark: SparkSession, path: str, renames: dict[str, str],
                      empty_as: str | None = None) -> DataFrame:
    """All-string CSV named by its header, then ``renames`` (old -> new) applied.

    All files under ``path`` must share one header.
    """
    names = spark.read.options(**_CSV_OPTIONS).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = spark.read.options(**_CSV_OPTIONS).schema(schema).csv(path)
    df = df.toDF(*[sanitise_header(c) for c in df.columns])
    out = df.select(*[F.col(old).cast("string").alias(new) for old, new in renames.items()])
    return _fill_empty(out, empty_as)


def _text_schema(schema: T.StructType) -> T.StructType:
    """Same fields, dates as text: the API date format is parsed explicitly."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType)
                                       else f.dataType, True) for f in schema.fields])


def typed(df: DataFrame, schema: T.StructType, empty_as: str | None = None) -> DataFrame:
    """Rows read with the text schema: dates parsed, blank texts filled."""
    dates = {f.name: parse_event_date(f.name) for f in schema.fields
             if isinstance(f.dataType, T.DateType)}
    if dates:
        df = df.withColumns(dates)
    return _fill_empty(df, empty_as)


def read_typed(spark: SparkSession, path: str | list[str], schema: T.StructType,
               empty_as: str | None = None) -> DataFrame:
    df = spark.read.options(**_CSV_OPTIONS).schema(_text_schema(schema)).csv(path)
    return typed(df, schema, empty_as)


def landed_paths(spark: SparkSession, table: RawTable, landing_dir: str) -> list[str]:
    """Where a typed table's files are: under its own name, and in the ledger's batches."""
    path = os.path.join(landing_dir, table.filename)
    batches = Ledger(spark, landing_dir).folders(table.filename)
    return ([path] if not batches or Files(spark, path).exists() else []) + batches


def read_as_text(spark: SparkSession, table: RawTable, landing_dir: str) -> DataFrame:
    """A typed raw table with every column as it stands in the files."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in table.schema.fieldNames()])
    return spark.read.options(**_CSV_OPTIONS).schema(schema).csv(
        landed_paths(spark, table, landing_dir))


def read_raw_table(spark: SparkSession, table: RawTable, landing_dir: str,
                   empty_as: str | None = "") -> DataFrame:
    """The rows under the table's own name, and those of the batches in the folder's ledger."""
    if table.all_string:
        path = os.path.join(landing_dir, table.filename)
        df = read_header_named(spark, path, table.renames, empty_as)
        return df.select(*table.schema.fieldNames())
    return read_typed(spark, landed_paths(spark, table, landing_dir), table.schema, empty_as)


def load_raw(spark: SparkSession, landing_dir: str,
             empty_as: str | None = "") -> dict[str, DataFrame]:
    """All six raw tables from a landing folder (lazy)."""
    return {name: read_raw_table(spark, t, landing_dir, empty_as) for name, t in RAW_TABLES.items()}
