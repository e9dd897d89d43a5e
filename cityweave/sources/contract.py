"""Event-schema contract: day layouts reconciled with one declared schema.

A log written over months changes its layout: fields come, types widen.  Spark
takes the schema of a window from one of its files, so fields that this file
lacks would vanish from all days.  Here the footers of every day are compared
with the declared schema first, and the window is then read in one scan by it.

* A declared field that a day lacks is NULL there, at any depth.
* A type that Spark's Parquet reader widens to the declared one is taken.
* Any other type is refused, with the day, the field and both types.
* Fields beyond the contract are not read.
* Field names are matched without regard to case, as Spark reads them.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Fields that the marts read, with the types that they use.
EVENT_CONTRACT = (
    "event struct<message_id: bigint, message_from: bigint, message_to: bigint, message_ts: string, datetime: string,"
    " user: string, subscription_channel: bigint, reaction_from: string>, event_type string, lat double, lon double"
)

# Parquet types that the reader widens: declared type -> types found in files.
WIDENED = {
    "int": ("tinyint", "smallint"),
    "bigint": ("tinyint", "smallint", "int"),
    "double": ("tinyint", "smallint", "int", "float"),
}


def _as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def conflicts(found: DataType, declared: DataType, path: str = "") -> list[tuple[str, str, str]]:
    """``(field, type found, type declared)`` of every field whose type does not fit."""
    if isinstance(found, StructType) and isinstance(declared, StructType):
        have = {f.name.lower(): f.dataType for f in found.fields}
        inner = ((f, have.get(f.name.lower())) for f in declared.fields)
        return [c for f, t in inner if t is not None for c in conflicts(t, f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(found, ArrayType) and isinstance(declared, ArrayType):
        return conflicts(found.elementType, declared.elementType, f"{path}.element")
    if isinstance(found, MapType) and isinstance(declared, MapType):
        return conflicts(found.keyType, declared.keyType, f"{path}.key") + conflicts(found.valueType, declared.valueType, f"{path}.value")
    a, b = found.simpleString(), declared.simpleString()
    return [] if a == b or a in WIDENED.get(b, ()) else [(path, a, b)]


def layout(spark: SparkSession, folder: str) -> StructType:
    """Schema of all files of one day, merged from their footers by a Spark job."""
    try:
        return spark.read.option("mergeSchema", True).parquet(folder).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        raise ValueError(f"files of {folder} have no common layout") from e


def reconciled(spark: SparkSession, folders: list[str], contract: StructType | str = EVENT_CONTRACT) -> StructType:
    """The contract as a schema that reads all ``folders``; raises if a type of a day does not fit."""
    declared = _as_struct(contract)
    refused = [(folder, *c) for folder in folders for c in conflicts(layout(spark, folder), declared)]
    if refused:
        raise ValueError("events do not fit the contract: " + "; ".join(f"{d}: {f} is {a}, not {b}" for d, f, a, b in refused))
    return declared
