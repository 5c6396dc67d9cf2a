"""Month files whose columns changed over the years, read as one table.

A scan has one schema, and a file of another type aborts it. Here files are grouped
by the schema in their footers; each group is scanned with its own schema and cast
to the least type that holds all, above the scan, so that filters and columns still
reach the reader. Names are compared without case. What a cast cannot hold exactly
is warned of, and ``drift_report`` and ``inexact_values`` say where and how much.
"""

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import existing_paths

FOOTERS_AT_ONCE = 16

# Whole types from narrow to wide, with the digits they may need.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_FLOATING = (T.FloatType(), T.DoubleType())
_MOMENT = (T.TimestampNTZType(), T.TimestampType())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that takes values of both; None if there is none.

    Whole numbers widen, with a floating one they become double, with a decimal a
    decimal of enough digits (double beyond 38). A date with a timestamp becomes that, the two kinds
    of timestamp the one with a zone. Text takes every plain type. Arrays, maps and structs must be equal.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    if all(x in _WHOLE or x in _FLOATING or isinstance(x, T.DecimalType) for x in (a, b)):
        if a in _FLOATING or b in _FLOATING:
            return T.DoubleType()
        shapes = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_WHOLE[x], 0) for x in (a, b)]
        before, after = (max(s) for s in zip(*shapes))
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    if all(x in _MOMENT or isinstance(x, T.DateType) for x in (a, b)):
        return next(m for m in reversed(_MOMENT) if m in (a, b))
    plain = lambda x: not isinstance(x, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))
    return T.StringType() if T.StringType() in (a, b) and plain(a) and plain(b) else None


def holds_all(source: T.DataType, target: T.DataType) -> bool:
    """Does ``target`` hold every value of ``source`` exactly?"""
    if target == T.DoubleType():
        return not (source == T.LongType() or isinstance(source, T.DecimalType))
    return True


@dataclass
class Group:
    """Files of one schema."""

    files: list[str]
    schema: T.StructType

    def field(self, name: str) -> T.StructField | None:
        return next((f for f in self.schema if f.name.lower() == name.lower()), None)


def schema_groups(spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None, skip_missing: bool = False) -> list[Group]:
    """The parquet files of ``paths`` (files, folders or wildcards) by schema, in order of the first file.

    The footer of each file is read, several at a time; meant for files by month
    or day, not for the parts of one large write, which have one schema.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    paths = existing_paths(spark, paths) if skip_missing else paths
    reader = lambda: spark.read if base_path is None else spark.read.option("basePath", base_path)
    files = sorted({f for p in paths for f in reader().parquet(p).inputFiles()})
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda f: reader().parquet(f).schema, files))
    groups: dict[str, Group] = {}
    for file, schema in zip(files, schemas):
        key = schema.simpleString()
        groups.setdefault(key, Group([], schema)).files.append(file)
    return list(groups.values())


def common_schema(groups: Sequence[Group]) -> T.StructType:
    """All columns of the groups in the order in which they first come, each with a type that takes it from every group."""
    names: dict[str, str] = {}
    for group in groups:
        for field in group.schema:
            names.setdefault(field.name.lower(), field.name)
    fields = []
    for name in names.values():
        kinds = [f.dataType for g in groups if (f := g.field(name)) is not None]
        kind = reduce(lambda a, b: a and common_type(a, b), kinds)
        if kind is None:
            raise ValueError(f"column {name} has types that no type takes together: {', '.join(sorted({k.simpleString() for k in kinds}))}")
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def _scan(spark: SparkSession, group: Group, base_path: str | None) -> DataFrame:
    reader = spark.read.schema(group.schema)
    return (reader if base_path is None else reader.option("basePath", base_path)).parquet(*group.files)


def _inexact(groups: Sequence[Group], target: T.StructType) -> list[tuple[Group, str, T.DataType]]:
    return [(g, f.name, f.dataType) for g in groups for f in target if (own := g.field(f.name)) is not None and not holds_all(own.dataType, f.dataType)]


def read_drifting(spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None, skip_missing: bool = False) -> DataFrame:
    """One table of files whose schemas differ: one scan per distinct schema, columns a file lacks are null.

    Warns of casts that may not hold every value (a bigint or decimal as double).
    Rows come in no order. Raises if a column's types have nothing in common.
    """
    groups = schema_groups(spark, paths, base_path, skip_missing)
    target = common_schema(groups)
    for group, name, kind in _inexact(groups, target):
        warnings.warn(f"{name}: {group.field(name).dataType.simpleString()} of {len(group.files)} files is read as {kind.simpleString()}", stacklevel=2)

    def cast(group: Group, field: T.StructField) -> Column:
        own = group.field(field.name)
        value = F.lit(None) if own is None else F.col(f"`{own.name}`")
        return (value if own is not None and own.dataType == field.dataType else value.cast(field.dataType)).alias(field.name)

    frames = [_scan(spark, g, base_path).select(*[cast(g, f) for f in target]) for g in groups]
    return reduce(DataFrame.union, frames)


def drift_report(spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None, skip_missing: bool = False) -> DataFrame:
    """Per column and type it has in some files (null: it is not there): number of files, type it is read as, and whether that holds every value."""
    groups = schema_groups(spark, paths, base_path, skip_missing)
    found: dict[tuple, int] = {}
    for field in common_schema(groups):
        for group in groups:
            own = group.field(field.name)
            key = (field.name, own and own.dataType.simpleString(), field.dataType.simpleString(), own is None or holds_all(own.dataType, field.dataType))
            found[key] = found.get(key, 0) + len(group.files)
    rows = [(*key[:2], n, *key[2:]) for key, n in found.items()]
    return spark.createDataFrame(rows, "column_name string, file_type string, files bigint, read_as string, exact boolean")


def inexact_values(spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None, skip_missing: bool = False) -> DataFrame:
    """``column_name`` and ``values``: how many values of each column change by being read as the common type.

    Only the columns and files concerned are scanned; no rows where every cast is exact.
    """
    groups = schema_groups(spark, paths, base_path, skip_missing)
    counts = []
    for group, name, kind in _inexact(groups, common_schema(groups)):
        own = group.field(name)
        value = F.col(f"`{own.name}`")
        changed = F.coalesce(value.cast(kind).try_cast("decimal(38,6)" if isinstance(own.dataType, T.DecimalType) else own.dataType) != value, value.isNotNull())
        counts.append(_scan(spark, group, base_path).agg(F.lit(name).alias("column_name"), F.count_if(changed).alias("values")))
    none = spark.createDataFrame([], "column_name string, values bigint")
    return reduce(DataFrame.union, counts, none).groupBy("column_name").agg(F.sum("values").alias("values"))
