"""Message and file streams into append-only tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import body_text

MESSAGE = "body binary, offset bigint, enqueued_at timestamp"


def to_messages(df: DataFrame, offset: str, enqueued_at: str) -> DataFrame:
    """Rows as messages: a JSON body in bytes, an offset and a time."""
    return df.select(
        F.encode(F.to_json(F.struct(*df.columns)), "UTF-8").alias("body"),
        F.col(offset).alias("offset"),
        F.col(enqueued_at).cast("timestamp").alias("enqueued_at"),
    )


def send(messages: DataFrame, landing: str, per_file: int = 100_000) -> None:
    """Put messages where a stream reads them, in small files."""
    messages.write.mode("append").option("maxRecordsPerFile", per_file).parquet(landing)


def read_messages(
    spark: SparkSession, landing: str, start_offset: int | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Message stream from ``start_offset`` on (inclusive), the body as text next to the metadata."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)
    if start_offset is not None:
        stream = stream.where(F.col("offset") >= start_offset)
    return stream.select(body_text("body").alias("payload"), "offset", "enqueued_at")


def read_new_files(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Stream of files as they arrive. Types are inferred once, by a batch read, if not given."""
    if schema is None:
        infer = {"header": True, "inferSchema": True, **options} if fmt == "csv" else options
        schema = spark.read.format(fmt).options(**infer).load(landing).schema
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(landing)


def evolved(known: T.StructType | None, found: T.StructType) -> T.StructType:
    """``known`` with the columns of ``found`` that it lacks; a known column keeps its type."""
    if known is None:
        return found
    names = {f.name for f in known.fields}
    return T.StructType([*known.fields, *[T.StructField(f.name, f.dataType) for f in found.fields if f.name not in names]])


def _known_schema(spark: SparkSession, folder: str) -> T.StructType | None:
    """The widest schema kept in ``folder``, or none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    kept = spark.read.schema("width int, schema string").json(folder)
    last = kept.agg(F.max(F.struct("width", "schema"))["schema"]).first()[0]
    return None if last is None else T.StructType.fromJson(json.loads(last))


def fitted(text: Column, kind: T.DataType) -> Column:
    """A field's JSON text as a value of ``kind``, null where it does not fit as a whole."""
    if isinstance(kind, T.StringType):
        return text
    if not isinstance(kind, T.StructType | T.ArrayType | T.MapType):
        return text.try_cast(kind)
    schema = T.StructType([T.StructField("v", kind), T.StructField("__broken", T.StringType())])
    read = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), schema, {"columnNameOfCorruptRecord": "__broken"})
    return F.when(read["__broken"].isNull(), read["v"])


def read_rescuing(
    spark: SparkSession, landing: str, schema_folder: str, hints: str = "", rescue: str = "_rescued", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of JSON-lines files whose columns grow from start to start, keeping what does not fit.

    At each start the files present are read once by a batch to infer types,
    and columns not known yet are added to the schema kept in
    ``schema_folder``, one small file per start that found any; a type once
    known, or given by ``hints`` (DDL text), never changes. ``rescue`` is a map
    of text by field name: it holds a value that does not fit its column's type
    (null in the column) and a field that this start's schema lacks; a line
    that is no JSON object stands there whole under the empty name. It is null
    where all fits. No row is lost or refused; blank lines are no rows.
    """
    known = _known_schema(spark, schema_folder)
    first = known if known is not None else (T.StructType.fromDDL(hints) if hints else None)
    sampled = spark.read.option("columnNameOfCorruptRecord", "__broken").json(landing).schema
    schema = evolved(first, T.StructType([f for f in sampled.fields if f.name != "__broken"]))
    if schema != known:
        text = spark.createDataFrame([(len(schema.fields), schema.json())], "width int, schema string")
        text.coalesce(1).write.mode("append").json(schema_folder)

    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    fields = F.when(F.startswith(F.ltrim("value"), F.lit("{")), F.from_json("value", "map<string,string>"))
    lines = reader.load(landing).where("trim(value) <> ''").select("value", fields.alias("__fields"))
    typed = [fitted(F.element_at("__fields", F.lit(f.name)), f.dataType).alias(f.name) for f in schema.fields]
    rows = lines.select("value", "__fields", F.struct(*typed).alias("__row"))
    fitting = F.filter(F.array(*[F.when(F.col("__row")[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields]), lambda n: n.isNotNull())
    misfits = F.map_filter("__fields", lambda name, value: value.isNotNull() & ~F.array_contains(fitting, name))
    kept = F.when(F.col("__fields").isNull(), F.create_map(F.lit(""), F.col("value"))).when(F.size(misfits) > 0, misfits)
    return rows.select("__row.*", kept.alias(rescue))


def append(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Write what is there now to a table folder and stop.

    The checkpoint belongs to this sink. A later call with it continues where
    this one ended, also after a crash, and adds no row twice. With partition
    columns the rows of a folder are gathered first, so a folder gets one file
    per batch, or several where it is too large for one task.
    """
    if partition_by:
        stream = stream.hint("rebalance", *partition_by)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()


def window_counts(stream: DataFrame, ts: str, key: str, width: str, lateness: str) -> DataFrame:
    """Rows per key and tumbling window; a window is emitted once the watermark has passed its end."""
    return (
        stream.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("w"), key)
        .agg(F.count("*").alias("ct"))
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ct")
    )


def keep_current(stream: DataFrame, source: str, part: str, total: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Bring the table ``target`` up to date with what ``stream`` brings of the table ``source``, and stop.

    Both tables are stored by the calendar column ``part``, a day or a month;
    ``total`` makes the rows of a target folder from all source rows of that
    folder. Each batch replaces the folders it touches by a fresh total over
    the source, so a batch that is run again after a crash changes nothing, and
    late rows reopen their own folder only. The values of ``part`` in a batch,
    at most those of the calendar, are listed by the driver so that the scan of
    ``source`` reads their folders alone; a null one is a folder of its own.
    """
    spark = stream.sparkSession

    def update(batch: DataFrame, _id: int) -> None:
        values = [row[0] for row in batch.select(part).distinct().collect()]
        if not values:
            return
        touched = F.col(part).isin([v for v in values if v is not None])
        if None in values:
            touched = F.coalesce(touched, F.lit(False)) | F.col(part).isNull()
        fresh = total(spark.read.schema(stream.schema).parquet(source).where(touched)).hint("rebalance", part)
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(target)

    stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
