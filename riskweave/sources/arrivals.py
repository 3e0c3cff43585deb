"""File-arrival notifications: nested JSON to one row per new CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVAL_SCHEMA = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, "
    "object: struct<key: string, size: bigint>>>>"
)


def parse_arrival_events(df: DataFrame, col: str, keep: list[str] | None = None) -> DataFrame:
    """(bucket, key, size) of every notified ``.csv`` object; a missing size is 0.

    Events without records, or without a CSV key, give no rows.
    """
    records = F.from_json(F.col(col), ARRIVAL_SCHEMA)["Records"]
    flat = df.select(*(keep or []), F.explode(records).alias("r"))
    return flat.select(
        *(keep or []),
        F.col("r.s3.bucket.name").alias("bucket"),
        F.col("r.s3.object.key").alias("key"),
        F.coalesce(F.col("r.s3.object.size"), F.lit(0)).cast("bigint").alias("size"),
    ).where(F.col("key").endswith(".csv"))


def sample_events(events: DataFrame) -> DataFrame:
    """Arrival notifications built from the event table.

    Errors carry no records, every third event names a JSON file, every fifth lacks a size and
    every seventh lists two files.
    """
    n = F.col("event_id")

    def record(suffix: str):
        ending = F.when(n % 3 == 0, ".json").otherwise(".csv")
        key = F.concat(F.lit("raw/loans/"), F.col("user_id").cast("string"), F.lit(suffix), ending)
        size = F.when(n % 5 != 0, F.get_json_object("props", "$.k").cast("bigint"))
        return F.struct(F.struct(
            F.struct(F.concat(F.lit("lake-"), F.col("event_type")).alias("name")).alias("bucket"),
            F.struct(key.alias("key"), size.alias("size")).alias("object"),
        ).alias("s3"))

    records = (
        F.when(F.col("event_type") == "error", F.array().cast(ARRIVAL_SCHEMA.split(" ", 1)[1]))
        .when(n % 7 == 0, F.array(record("_a"), record("_b")))
        .otherwise(F.array(record("_a")))
    )
    return events.select("event_id", F.to_json(F.struct(records.alias("Records"))).alias("event"))
