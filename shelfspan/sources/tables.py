"""Readers with explicit schemas, and writers, for all tables of the library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfspan import schemas
from shelfspan.functions.scalar import date_parts
from shelfspan.operators import quality
from shelfspan.operators.external import derive_weather
from shelfspan.operators.joins import outer_chain
from shelfspan.operators.panel import fill_indicators, melt


def read_wide_sales(spark: SparkSession, path: str, days: Sequence[str]) -> DataFrame:
    """Wide daily sales from CSV; ``days`` names the day columns of the file."""
    return spark.read.schema(schemas.wide_sales(days)).csv(path, header=True, enforceSchema=False)


def read_sales(spark: SparkSession, path: str, days: Sequence[str]) -> DataFrame:
    """Wide daily sales from CSV, melted to one row per series and day."""
    return melt(read_wide_sales(spark, path, days))


def header_days(spark: SparkSession, path: str, prefix: str = "d_") -> list[str]:
    """Day columns named in a CSV header; only the header is read."""
    header = spark.read.csv(path, header=True).columns
    return [c for c in header if c.startswith(prefix)]


def read_named(spark: SparkSession, path: str, schema) -> DataFrame:
    """The columns of ``schema`` from a CSV whose header may name them in any order, and others too."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    known = {f.name: f for f in wanted}
    found = [known.get(c, StructField(c, StringType())) for c in spark.read.csv(path, header=True).columns]
    return spark.read.schema(StructType(found)).csv(path, header=True, enforceSchema=False).select(*known)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar from CSV with parsed dates, calendar parts and event flags."""
    raw = read_named(spark, path, schemas.CALENDAR)
    dated = raw.withColumn("date", F.to_date("date"))
    exists = {f"{c}_exists": F.col(c).isNotNull() for c in schemas.EVENT_COLUMNS}
    return dated.withColumns({**date_parts(), **exists})


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return read_named(spark, path, schemas.PRICES)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Landed weather payloads: one row per state and day, with derived columns."""
    payload = spark.read.schema(schemas.WEATHER_PAYLOAD).json(path)
    days = payload.select("state_id", F.explode("days").alias("day")).select("state_id", "day.*")
    return derive_weather(days.withColumn("date", F.to_date("datetime"))).drop("datetime")


def read_economic(spark: SparkSession, path: str) -> DataFrame:
    """Landed indicator payloads as rows ``(date, series_id, value)``; text that is no number is null."""
    payload = spark.read.schema(schemas.ECONOMIC_PAYLOAD).json(path)
    rows = payload.select("series_id", F.explode("observations").alias("seen"))
    return rows.select(
        F.to_date("seen.date").alias("date"), "series_id", F.col("seen.value").try_cast("double").alias("value")
    )


def economic_table(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One column per indicator, outer-joined by date and filled forward."""
    tables = [long.where(F.col("series_id") == c).select("date", F.col("value").alias(c)) for c in columns]
    return fill_indicators(outer_chain(tables), columns)


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), form: str = "parquet", mode: str = "error") -> None:
    """Table sink; Parquet by default, partitioned by low-cardinality columns."""
    writer = df.write.mode(mode).format(form)
    if form == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*by) if by else writer).save(path)


def write_checked(
    df: DataFrame, path: str, dataset: str, rules: Sequence[quality.Rule], by: Sequence[str] = (), mode: str = "error", dynamic: bool = False
) -> DataFrame:
    """Parquet sink that counts quality rules while it writes, without a second scan; returns their rows.

    ``dynamic`` with mode overwrite replaces only the partitions that get rows.
    """
    watched, observation = quality.observe_rules(df, rules) if rules else (df, None)
    writer = watched.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    if observation is None:
        return df.sparkSession.createDataFrame([], quality.REPORT)
    return quality.observed_report(df.sparkSession, dataset, rules, observation)


def read_feature_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_results(metrics: DataFrame, path: str, mode: str = "error") -> None:
    """Metric tables are small; they are kept as JSON lines."""
    metrics.write.mode(mode).json(path)


def read_results(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_run(spark: SparkSession, path: str, record: dict[str, str]) -> None:
    """Append one training or promotion record to the runs table."""
    schema = ", ".join(f"{name} string" for name in record)
    row = spark.createDataFrame([tuple(str(v) for v in record.values())], schema)
    row.withColumn("recorded_at", F.current_timestamp()).write.mode("append").json(path)


def write_summary(summary: DataFrame, path: str, mode: str = "error") -> None:
    """The one-row exploration summary as JSON."""
    summary.write.mode(mode).json(path)


def readable(df: DataFrame) -> bool:
    """Whether a table can be read and has at least one row."""
    try:
        return not df.isEmpty()
    except Exception as error:
        if type(error).__module__.startswith(("pyspark", "py4j")):
            return False
        raise


def weather_payload(df: DataFrame) -> DataFrame:
    """Nested form of a weather table: one payload per state and year."""
    fields = [f.name for f in schemas.WEATHER_DAY.fields]
    day = F.struct(*[F.col(c) for c in fields]).alias("day")
    rows = df.withColumn("datetime", F.date_format("date", "yyyy-MM-dd"))
    return rows.groupBy("state_id", F.year("date").alias("year")).agg(F.collect_list(day).alias("days")).drop("year")


def economic_payload(long: DataFrame) -> DataFrame:
    """Nested form of indicator rows: one payload per indicator and year."""
    seen = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value"))
    return long.groupBy("series_id", F.year("date").alias("year")).agg(F.collect_list(seen).alias("observations")).drop("year")
