"""City dictionary: ``;``-separated CSV with decimal-comma coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityweave.functions.parsing import decimal_comma_to_double

# Header of the city dictionary file, in file order.
CITY_CSV_COLUMNS = ("id", "city", "lat", "lng")

CITY_CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in CITY_CSV_COLUMNS])


def parse_city_dictionary(raw: DataFrame) -> DataFrame:
    """Text dictionary (``id, city, lat, lng``) -> typed cities.

    ``city_id`` stays a string (it becomes ``zone_id``).  Rows whose
    coordinates do not parse are dropped, as the marts cannot place them.
    """
    return raw.select(
        F.col("id").alias("city_id"),
        F.col("city").alias("city_name"),
        decimal_comma_to_double("lat").alias("city_lat"),
        decimal_comma_to_double("lng").alias("city_lon"),
    ).where(F.col("city_lat").isNotNull() & F.col("city_lon").isNotNull())


def read_city_text(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Read the raw dictionary; the header must be exactly ``id;city;lat;lng``.

    Under an explicit schema Spark binds CSV columns by position, so a
    reordered header would silently load latitudes as names.
    ``enforceSchema=false`` makes Spark check every file's header against the
    schema and fail instead.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .schema(CITY_CSV_SCHEMA)
        .csv(path)
    )


def read_cities(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Typed city dictionary from the CSV at ``path``."""
    return parse_city_dictionary(read_city_text(spark, path, sep))
