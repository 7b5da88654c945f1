"""Landed CSV with lines that do not fit: rows and rejects, and a report of types that drift.

``read_raw_table`` stops at the first such line, which is right for files that we wrote.
Here a line that has other columns or values of another type is set apart with its file,
and the load goes on up to a limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_event_date
from .csv import _CSV_OPTIONS, _text_schema, landed_paths, read_as_text, typed
from .schemas import RawTable

#: A line that does not fit, as it stands in the file.
BAD = "_line"


class TooManyRejects(RuntimeError):
    pass


def read_with_rejects(spark: SparkSession, table: RawTable, landing_dir: str,
                      empty_as: str | None = "") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a typed raw table; rejects has table_name, file, line.

    Each reads the files once. All columns are parsed in both, so a value of a wrong
    type rejects its line whatever columns a query needs later.
    """
    schema = _text_schema(table.schema)
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    lines = (spark.read.options(**{**_CSV_OPTIONS, "mode": "PERMISSIVE", "columnPruning": "false",
                                   "columnNameOfCorruptRecord": BAD})
             .schema(whole).csv(landed_paths(spark, table, landing_dir)))
    # Spark reads no column of bad lines unless others are asked for too: ask for all.
    asked = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.fieldNames()])) >= 0
    rows = typed(lines.where(F.col(BAD).isNull() & asked).drop(BAD), table.schema, empty_as)
    rejects = (lines.withColumn("file", F.input_file_name()).where(F.col(BAD).isNotNull() & asked)
               .select(F.lit(table.name).alias("table_name"), "file", F.col(BAD).alias("line")))
    return rows, rejects


def keep_rejects(rejects: DataFrame, path: str, most: int) -> int:
    """Write the rejects to ``path`` and return their number; raise if there are more than
    ``most`` (they are written all the same)."""
    rejects.write.mode("overwrite").parquet(path)
    n = rejects.sparkSession.read.schema(rejects.schema).parquet(path).count()
    if n > most:
        raise TooManyRejects(f"{n} lines do not fit, {most} are allowed; see {path}")
    return n


#: The lattice of types that texts are tried for, the narrowest first.
LATTICE = ("bigint", "double", "boolean", "date")

#: What every number that Spark reads begins with, what every truth value is and every date has.
#: Other texts are not tried: inside Spark each one that does not parse costs an exception.
NUMBER_BEGINS = r"(?i)^[\x00-\x20\x7f]*[+-]?(?:[0-9.]|inf|nan)"
BOOLEAN = r"(?i)^[\x00-\x20\x7f]*(?:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7f]*\z"
DATE_HAS = "%-%-%"


def type_report(spark: SparkSession, table: RawTable, landing_dir: str) -> DataFrame:
    """One row per column of a landed table: table_name, column_name, declared, found (the
    narrowest type that all its values have), n (values that are not blank), misfits (of these,
    how many do not have the declared type) and the first of them in order of characters.

    One aggregate over all columns, as text, in one pass. Each value is tried once for
    each type.
    """
    names = table.schema.fieldNames()
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    texts = read_as_text(spark, table, landing_dir)
    values = texts.select(*[F.when(F.trim(F.col(c)) != "", F.col(c)).alias(c) for c in names])

    def fits(c: str, kind: str):
        # ``when``, as both sides of an ``&`` may be computed for every row.
        if kind == "string":
            fit = F.col(c)
        elif kind == "date":
            fit = F.when(F.col(c).like(DATE_HAS), parse_event_date(c))
        else:
            pattern = BOOLEAN if kind == "boolean" else NUMBER_BEGINS
            fit = F.when(F.col(c).rlike(pattern), F.col(c).try_cast(kind))
        return fit.isNotNull()

    tried = values.select(*names, *[fits(c, k).alias(f"{c}_as_{k}")
                                    for c in names for k in dict.fromkeys((*LATTICE, kinds[c]))])

    def misfit(c: str):
        return F.col(c).isNotNull() & ~F.col(f"{c}_as_{kinds[c]}")

    row = tried.agg(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("declared"),
        F.count(c).alias("n"), F.count_if(misfit(c)).alias("misfits"),
        F.min(F.when(misfit(c), F.col(c))).alias("first_misfit"),
        *[F.count_if(f"{c}_as_{k}").alias(k) for k in LATTICE]).alias(c)
        for c in names])
    each = row.select(F.explode(F.array(*names)).alias("c")).select("c.*")
    found = F.when(F.col("n") == 0, F.lit(None).cast("string"))
    for k in LATTICE:
        found = found.when(F.col(k) == F.col("n"), k)
    return each.select(F.lit(table.name).alias("table_name"), "column_name", "declared",
                       found.otherwise("string").alias("found"), "n", "misfits", "first_misfit")
