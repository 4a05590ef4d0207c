"""Incremental file loads that never load the same file twice."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import list_files

_LOADS = "path string, length bigint, load_id int, schema string"

#: Numbers from narrow to wide.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


class TypeClash(ValueError):
    """A column's types in two loads have no common type."""


def _loads(spark: SparkSession, target: str) -> DataFrame:
    try:
        return spark.read.schema(_LOADS).parquet(f"{target}/loads")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOADS)


def common_type(a: T.DataType, b: T.DataType, column: str = "") -> T.DataType:
    """The narrowest type that holds the values of both.

    Numbers widen to the wider one, and to double where a whole and a
    fractional type meet; dates to timestamps; other plain types that differ
    become text. Structs are merged by field, arrays and maps by their parts.
    A struct, array or map has no common type with anything else.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b, f"{column}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{column}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType, column), common_type(a.valueType, b.valueType, column))
    if any(isinstance(x, (T.StructType, T.ArrayType, T.MapType)) for x in (a, b)):
        raise TypeClash(f"{column}: {a.simpleString()} and {b.simpleString()}")
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        wide = max(a, b, key=lambda x: _NUMBERS.index(type(x)))
        return T.DoubleType() if isinstance(wide, T.FloatType) else wide
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(x, (*_NUMBERS, T.DecimalType)) for x in (a, b)):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda x: _TIMES.index(type(x)))
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """The columns of both, those of ``a`` first; names are compared without case, as Spark's are."""
    known = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = known.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, common_type(f.dataType, other.dataType, prefix + f.name) if other else f.dataType))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in known.values()])


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as the wider type ``want``; absent fields are null."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            old = own.get(f.name.lower())
            part = fitted(value.getField(old.name), old.dataType, f.dataType) if old else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    return value.cast(want)


def _same_schema(schema: T.StructType) -> T.StructType:
    """Without what does not matter here: null columns are text, all columns may be null."""
    plain = lambda t: T.StringType() if isinstance(t, T.NullType) else t
    return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in schema.fields])


def _schemas(spark: SparkSession, target: str, loads: DataFrame) -> dict[str, list[int]]:
    """Load ids by their schema as JSON; the driver holds a line per load."""
    found: dict[str, list[int]] = {}
    for row in loads.groupBy("load_id").agg(F.max("schema").alias("schema")).orderBy("load_id").collect():
        schema = row.schema or _same_schema(spark.read.parquet(f"{target}/data/_load={row.load_id}").schema).json()
        found.setdefault(schema, []).append(row.load_id)
    return found


def _merged(schemas) -> T.StructType:
    return reduce(common_schema, (T.StructType.fromJson(json.loads(s)) for s in schemas))


def copy_into(
    spark: SparkSession, target: str, source: str, fmt: str, glob: str | None = None, widen: bool = True, **options
) -> int:
    """Load the files of ``source`` that ``target`` has not taken yet; returns how many.

    Rows go to ``data/_load=<id>`` first and the file names to ``loads`` last.
    Readers follow ``loads`` only, so a load that dies in between leaves
    nothing visible and can simply run again. Columns may differ from one load
    to the next, and so may their types: each load keeps the types it was read
    with, next to its files, and readers widen them to the common ones. Before
    a load is written its types are reconciled with those of all earlier loads;
    if there is no common type, or if ``widen`` is False and a type would have
    to change, TypeClash is raised and the table stays as it is. The driver
    holds the names of the new files, as Spark's own file index does.
    """
    loads = _loads(spark, target)
    found = list_files(spark, source, glob).select("path", "length")
    new = [(r.path, r.length) for r in found.join(loads.select("path"), "path", "left_anti").collect()]
    if not new:
        return 0
    load_id = (loads.agg(F.max("load_id")).first()[0] or 0) + 1
    if fmt == "csv":
        options = {"header": True, "inferSchema": True, "enforceSchema": False, **options}
    rows = spark.read.options(**options).format(fmt).load([path for path, _ in new])
    schema = _same_schema(rows.schema)
    earlier = _schemas(spark, target, loads)
    if earlier:
        before = _merged(earlier)
        after = common_schema(before, schema)
        types = {f.name.lower(): f.dataType for f in after.fields}
        changed = [f.name for part in (before, schema) for f in part.fields if types[f.name.lower()] != f.dataType]
        if changed and not widen:
            raise TypeClash(f"types would change: {', '.join(sorted(set(changed)))}")
    rows = rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.write.mode("overwrite").parquet(f"{target}/data/_load={load_id}")
    taken = spark.createDataFrame([(path, length, load_id, schema.json()) for path, length in new], _LOADS)
    taken.coalesce(1).write.mode("append").parquet(f"{target}/loads")
    return len(new)


def read_copied(spark: SparkSession, target: str) -> DataFrame:
    """All rows of completed loads under the common types; a column absent from a load is null there.

    Loads of one schema are one scan, so the plan follows the number of
    different schemas, and filters and columns still reach the files.
    """
    schemas = _schemas(spark, target, _loads(spark, target))
    if not schemas:
        raise ValueError(f"nothing was loaded into {target}")
    want = _merged(schemas)
    parts = []
    for text, ids in schemas.items():
        schema = T.StructType.fromJson(json.loads(text))
        rows = spark.read.schema(schema).parquet(*[f"{target}/data/_load={i}" for i in ids])
        own = {f.name.lower(): f for f in schema.fields}
        columns = []
        for f in want.fields:
            have = own.get(f.name.lower())
            value = fitted(F.col(f"`{have.name}`"), have.dataType, f.dataType) if have else F.lit(None).cast(f.dataType)
            columns.append(value.alias(f.name))
        parts.append(rows.select(columns))
    return reduce(DataFrame.unionAll, parts)
