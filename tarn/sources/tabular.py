"""CSV and JSON-lines files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DatetimeType,
    MapType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

# JSON has no timestamp type; keep microseconds, and the zone where there is one, so that a round
# trip loses nothing.
TIMESTAMP_FORMATS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# How the CSV pair tells values apart: null is \N, an empty text is "", quotes are doubled, white
# space stays. A text that reads \N, \\N and so on gets one more backslash in the file.
NULL = "\\N"
CSV_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": NULL,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


#: Texts of one file, by their mean size; files are what the reader deals to tasks.
FILE_BYTES = 64 << 20


def _text_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def _rows_per_file(df: DataFrame, file_bytes: int) -> int:
    """How many rows of mean size make ``file_bytes``; other columns count 16 bytes."""
    texts = _text_columns(df.schema)
    mean = 16.0 * len(df.columns)
    if texts:
        sizes = [F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) for name in texts]
        total = sizes[0]
        for size in sizes[1:]:
            total = total + size
        mean += df.agg(F.avg(total)).first()[0] or 0.0
    return max(1, int(file_bytes / mean))


def write_csv(df: DataFrame, path: str, file_rows: int | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Write with a header what :func:`read_csv` reads back without loss.

    A file with line breaks in its texts can only be read from its beginning, by one task, so no
    file gets more than ``file_rows``; without that number, as many as make about ``file_bytes``,
    for which the texts' sizes are summed in a pass of their own.
    """
    marked = {name: F.regexp_replace(F.col(name), r"^(\\+N)$", r"\\$1") for name in _text_columns(df.schema)}
    rows = file_rows or _rows_per_file(df, file_bytes)
    writer = df.withColumns(marked).write.mode("overwrite").option("maxRecordsPerFile", rows)
    writer.options(emptyValue='""', **CSV_FORMAT).csv(path)


def _read(spark: SparkSession, path: str, schema: StructType | str | None, infer: bool, multi_line: bool, mode: str) -> DataFrame:
    reader = spark.read.options(emptyValue="", multiLine=multi_line, mode=mode, **CSV_FORMAT)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    rows = reader.csv(path, inferSchema=infer)
    plain = {name: F.regexp_replace(F.col(f"`{name}`"), r"^\\(\\+N)$", "$1") for name in _text_columns(rows.schema)}
    return rows.withColumns(plain)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """What :func:`write_csv` wrote, with its schema: one pass over the data.

    A value that does not fit its type fails the job; ``mode='PERMISSIVE'`` makes it null,
    ``'DROPMALFORMED'`` leaves the row out. Texts may hold line breaks, so a file is read by one
    task, which small files share (``spark.sql.files.maxPartitionBytes``); where no text does,
    ``multi_line=False`` splits large files.
    """
    return _read(spark, path, schema, False, multi_line, mode)


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header and inferred types. Costs a second full pass; for exploration only.

    Line breaks, null, empty texts and ``\\N`` are told apart as in :func:`read_csv`; a row with
    too few or too many fields fails the job, or what ``mode`` says.
    """
    return _read(spark, path, None, True, multi_line, mode)


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header, every column a string; cast with :func:`typed`. Otherwise as :func:`read_csv_inferred`."""
    return _read(spark, path, None, False, multi_line, mode)


def typed(df: DataFrame, types: dict[str, str], malformed: str = "fail") -> DataFrame:
    """Cast string columns. ``malformed='null'`` turns unreadable values into null."""
    if malformed not in ("fail", "null"):
        raise ValueError("malformed must be 'fail' or 'null'")
    casts = {
        name: F.col(name).cast(kind) if malformed == "fail" else F.col(name).try_cast(kind)
        for name, kind in types.items()
    }
    return df.withColumns(casts)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines from a file or a directory; the codec follows the file suffix.

    Without a schema Spark reads everything twice to infer one. A single .gz file
    is one task: follow it with ``repartition`` before heavy work.
    """
    reader = spark.read.options(**TIMESTAMP_FORMATS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write one JSON document a row, replacing what is at ``path``."""
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .options(**TIMESTAMP_FORMATS)
        .json(path)
    )


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` not nullable in its schema; a null in them fails the job.

    Stays a column expression: rebuilding a frame from its rows to change a flag would
    send every row through Python.
    """
    checked = {}
    for name in columns:
        message = F.lit(f"null in column {name}")
        value = F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))
        # The second argument is never reached; it tells the schema that no null remains.
        checked[name] = F.coalesce(value, _some_value(df.schema[name].dataType))
    return df.withColumns(checked)


def _some_value(kind: DataType) -> Column:
    """Any value of a type that is not null."""
    if isinstance(kind, NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, (StringType, BinaryType)):
        return F.lit("").cast(kind)
    if isinstance(kind, BooleanType):
        return F.lit(False)
    if isinstance(kind, DatetimeType):
        return F.expr(f"{kind.typeName()}'1970-01-01'")
    if isinstance(kind, ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, MapType):
        return F.create_map().cast(kind)
    if isinstance(kind, StructType):
        return F.struct(*[_some_value(f.dataType).alias(f.name) for f in kind]).cast(kind)
    raise TypeError(f"columns of type {kind.simpleString()} cannot be required")


def string_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])
