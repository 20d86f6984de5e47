"""CSV records. Every field is text; types are given after the checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weir.operators.contract import require_fields
from weir.operators.validate import ERRORS, IS_VALID

# The text of a line that has more or fewer fields than its header; its other fields are then NULL.
MALFORMED = "malformed_record"
# Where a record stands: its file, its part of the file, its number there.
PLACE = "record_place"

# A quote inside a quoted field is doubled, as spreadsheet programs and Python's csv write it.
# Every file's header is compared with the schema, so files that differ fail the read. All columns are
# parsed, whatever is asked for, so that a line is well formed or not for every reader.
_READ = {
    "header": "true",
    "enforceSchema": "false",
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    "columnPruning": "false",
}
_WRITE = {
    "header": "true",
    "escape": "\"",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def text_schema(fields: Sequence[str]) -> StructType:
    """Return a schema of text fields."""
    return StructType([StructField(name, StringType()) for name in fields])


def read_records(
    spark: SparkSession, path: str, fields: Sequence[str], multi_line: bool = False, place: bool = False
) -> DataFrame:
    """Read CSV files by their header. Missing values are NULL; fields beyond ``fields`` are kept.

    Columns are found by name, in whatever order the files have them: one line is read for the
    names, and no type is inferred. ``multi_line`` admits line breaks inside quoted fields, at the
    price of unsplittable files; files of this library need it not, see ``read_written``. A line that doesn't fit
    its header is a row with its text in ``malformed_record``. ``place`` adds the record's place, which orders records
    by file and position.
    """
    options = {**_READ, "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    table = spark.read.schema(text_schema([*names, MALFORMED])).options(**options).csv(path)
    if place:
        where = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
        table = table.select("*", where.alias(PLACE))
    return require_fields(_without_fields(table, names), fields, path)


def _without_fields(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Blank the fields of malformed lines: which text belongs to which is unknown."""
    return table.withColumns({n: F.when(F.col(MALFORMED).isNull(), F.col(n)) for n in names})


def mark_malformed(checked: DataFrame) -> DataFrame:
    """Reject malformed lines of a checked frame for that reason alone, with their text."""
    bad = F.col(MALFORMED).isNotNull()
    reason = F.array(F.concat(F.lit("Malformed record: "), F.col(MALFORMED)))
    return checked.withColumns(
        {ERRORS: F.when(bad, reason).otherwise(F.col(ERRORS)), IS_VALID: F.when(bad, False).otherwise(F.col(IS_VALID))}
    )


def stream_records(spark: SparkSession, path: str, fields: Sequence[str], max_files: int | None = None) -> DataFrame:
    """Read a folder of CSV files as a stream; ``fields`` are in the order of the files."""
    reader = spark.readStream.schema(text_schema([*fields, MALFORMED])).options(**_READ)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _without_fields(reader.csv(path), fields)


def _escaped(df: DataFrame) -> DataFrame:
    """Spell line breaks as ``\\n`` and ``\\r`` and a backslash as two, so that a record is one line."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    spelled = {n: F.replace(F.col(n), F.lit("\\"), F.lit("\\\\")) for n in texts}
    for sign, name in (("\n", "\\n"), ("\r", "\\r")):
        spelled = {n: F.replace(c, F.lit(sign), F.lit(name)) for n, c in spelled.items()}
    return df.withColumns(spelled)


def _unescaped(column: Column) -> Column:
    parts = F.split(column, r"\\\\")
    spelled = F.transform(
        parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(spelled, "\\")


def read_written(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Read files that ``write_records`` or ``write_batch`` wrote; any text comes back as it was."""
    table = read_records(spark, path, fields)
    return table.select(*(_unescaped(F.col(n)).alias(n) for n in table.columns if n != MALFORMED))


def write_records(df: DataFrame, path: str, first: bool = True) -> None:
    """Write rows as CSV, one line each; ``first`` clears the output of earlier runs, otherwise rows are added."""
    writer = _escaped(df).write.mode("overwrite" if first else "append").option("partitionOverwriteMode", "static")
    writer.options(**_WRITE).csv(path)


def write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write one micro-batch of a run to its own folder, so that a retry replaces it and nothing else."""
    _escaped(df).write.mode("overwrite").options(**_WRITE).csv(f"{path}/run={run}/batch_id={batch_id}")


def clear_batches(like: DataFrame, path: str) -> None:
    """Remove the batches of earlier runs, leaving an empty folder. ``like`` gives any schema."""
    empty = like.sparkSession.createDataFrame([], text_schema([*like.columns[:1], "run", "batch_id"]))
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run", "batch_id").csv(path)


def count_records(spark: SparkSession, path: str, fields: Sequence[str]) -> int:
    """Count the rows of CSV output, which may have no file with a header when there are none."""
    return spark.read.schema(text_schema(fields)).options(**_READ).csv(path).count()
