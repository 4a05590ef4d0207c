"""File readers, with the bad-record policies of CSV and readers chosen by extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
_FORMATS = {"csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "orc": "orc", "txt": "text"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV with inferred or given types.

    Spark parses only the fields a query needs, so a line whose bad field is
    not selected would count as good. Where bad lines must be dropped or must
    fail, a condition that always holds therefore reads every field.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    df = reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)
    if mode.upper() in ("DROPMALFORMED", "FAILFAST"):
        df = df.where(F.hash(*df.columns) >= F.lit(-(2**31)))
    return df


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_path(spark: SparkSession, path: str, **options) -> DataFrame:
    """Any supported file or folder; the extension picks the format."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in _FORMATS:
        raise ValueError(f"no reader for {path!r}")
    if extension == "csv":
        options = {"header": True, "inferSchema": True, **options}
    return spark.read.options(**options).format(_FORMATS[extension]).load(path)


def split_bad_records(
    spark: SparkSession, path: str, schema: T.StructType, bad_path: str, header: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that did not parse.

    Bad lines are written to ``bad_path`` as JSON, with the file they came from
    and the fields that did parse, and read back from there, so they stay
    available after the run. Spark parses only the fields a query needs; both
    sides therefore read every field, so a line is bad by all of them.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = (
        spark.read.schema(wide)
        .option("header", header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    parsed = parsed.where(F.hash(*schema.names, CORRUPT) >= F.lit(-(2**31)))
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    (
        bad.select(F.col("_metadata.file_path").alias("path"), F.col(CORRUPT).alias("record"), *schema.names)
        .write.mode("overwrite")
        .json(bad_path)
    )
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    captured = spark.read.option("recursiveFileLookup", True).schema("path string, record string").json(bad_path)
    return good, captured


def json_rows(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON text held in a column, as one typed column per field."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*df.columns, "_json.*")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below a folder with size and time. File contents are not read."""
    return binary_files(spark, path, glob).select("path", "name", "length", "modificationTime")


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole files as rows; split a large text source into many files before this."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).withColumn("name", F.element_at(F.split("path", "/"), -1))
