"""Readers that produce the all-string landing DataFrame.

Sources: JSON payload column (the message-bus value), JSON-lines files, a
Kafka topic, in-memory records (tests), and any DataFrame with the landing
columns.  Every reader ends in the same declared ``LANDING_SCHEMA``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import LANDING_FIELDS, LANDING_SCHEMA

# Values are parsed as text so a quoted or malformed number is reported, not nulled.
_JSON_SCHEMA = LANDING_SCHEMA
_JSON_OPTIONS = {"mode": "PERMISSIVE", "primitivesAsString": "true"}
#: Column with the text of a record that is no JSON (null for the others).
CORRUPT = "_corrupt_record"
_CORRUPT_SCHEMA = StructType([*LANDING_SCHEMA.fields, StructField(CORRUPT, StringType())])
_CORRUPT_OPTIONS = {**_JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT}


def to_landing(df: DataFrame) -> DataFrame:
    """Project any frame onto the landing columns (missing columns become NULL)."""
    present = set(df.columns)
    cols = []
    for field in LANDING_SCHEMA.fields:
        c = F.col(field.name) if field.name in present else F.lit(None)
        cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def parse_json_payload(value: Column) -> Column:
    """JSON text/bytes -> landing struct (PERMISSIVE: bad JSON gives a NULL-field row)."""
    return F.from_json(value.cast("string"), _JSON_SCHEMA, _JSON_OPTIONS)


def from_json_values(df: DataFrame, value_col: str = "value", keep_corrupt: bool = False) -> DataFrame:
    """Message values (e.g. a topic's ``value`` column) -> landing rows.

    ``keep_corrupt`` adds the column ``CORRUPT`` with the text of values that are no JSON;
    such rows have null fields, fail validation, and take their text into the quarantine.
    """
    if keep_corrupt:
        data = F.from_json(F.col(value_col).cast("string"), _CORRUPT_SCHEMA, _CORRUPT_OPTIONS)
    else:
        data = parse_json_payload(F.col(value_col))
    return df.select(data.alias("data")).select("data.*")


def to_json_values(df: DataFrame) -> DataFrame:
    """Landing/processed rows -> one JSON ``value`` per row (the publish side)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def read_json_lines(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines files with the declared landing schema (no inference); ``keep_corrupt`` as above."""
    if keep_corrupt:
        return spark.read.schema(_CORRUPT_SCHEMA).options(**_CORRUPT_OPTIONS).json(path)
    return spark.read.schema(_JSON_SCHEMA).options(**_JSON_OPTIONS).json(path)


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               starting_offsets: str = "earliest") -> DataFrame:
    """Bounded read of a topic from ``starting_offsets`` to the latest offset.

    Needs the spark-sql-kafka connector on the classpath (not bundled here).
    """
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return from_json_values(raw)


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish rows as JSON values (acks=all); needs the Kafka connector."""
    (
        to_json_values(df).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def from_records(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Small in-memory record lists (tests, examples) -> landing rows.

    A missing ``currency`` key defaults to USD and a missing ``is_flagged`` to
    False; explicit None values stay NULL.  Numbers are kept as their text.
    """
    rows = []
    for r in records:
        row = []
        for name in LANDING_FIELDS:
            if name == "currency" and name not in r:
                v = "USD"
            else:
                v = r.get(name)
            if v is not None and not isinstance(v, str):
                v = repr(float(v)) if name == "amount" else str(v)
            row.append(v)
        row.append(r.get("is_flagged", False))
        rows.append(tuple(row))
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def select_source(spark: SparkSession, records: Iterable[Mapping] | None = None,
                  kafka: Mapping | None = None, path: str | None = None) -> DataFrame:
    """Landing frame from the first source given: records, then a topic, then a path."""
    if records is not None:
        return from_records(spark, records)
    if kafka:
        return read_kafka(spark, kafka["bootstrap_servers"], kafka["topic"])
    if path:
        return read_json_lines(spark, path)
    raise ValueError("Must provide records, a kafka config or an input path")
