"""Readers (survey S1-S5).

Raw files carry no order of their own, yet "keep the first duplicate" needs
one: readers attach ``ingest_seq`` with ``monotonically_increasing_id`` right
after the scan, before any shuffle, so it follows file and line order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("join_date", T.DateType()),
    T.StructField("loyalty_points", T.IntegerType()),
    T.StructField("is_churned", T.IntegerType()),
])

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("amount", T.DecimalType(15, 2)),
    T.StructField("discount_percent", T.DecimalType(5, 2)),
    T.StructField("final_amount", T.DecimalType(15, 2)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("is_returned", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
])

GEN1_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("join_date", T.StringType()),
])

GEN1_TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", T.DecimalType(15, 2)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("returned", T.IntegerType()),
])


def with_ingest_seq(df: DataFrame) -> DataFrame:
    """File order: path, split, then row.  Spark packs splits into tasks by size, so the
    row id alone would not follow the order of several files."""
    return df.withColumn("ingest_seq", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row")))


_BAD = "_bad_line"


def _parsed(spark: SparkSession, path: str, schema: T.StructType, date_format: str) -> DataFrame:
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]))
            .option("header", True).option("dateFormat", date_format)
            .option("columnPruning", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(path))


def _whole(schema: T.StructType):
    """Always true, but reads every field: a line is good or bad whatever columns are asked for."""
    return F.xxhash64(*schema.fieldNames()).bitwiseOR(F.lit(1)) != 0


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The lines that hold what ``schema`` says; the others are told by ``bad_lines``."""
    rows = _parsed(spark, path, schema, date_format)
    return rows.where(_whole(schema) & F.col(_BAD).isNull()).drop(_BAD)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """file, line of every line that cannot be read as ``schema`` (a wrong type, a missing or a further field)."""
    rows = _parsed(spark, path, schema, date_format).withColumn("file", F.col("_metadata.file_path"))
    return rows.where(_whole(schema) & F.col(_BAD).isNotNull()).select("file", F.col(_BAD).alias("line"))


def set_aside(spark: SparkSession, path: str, schema: T.StructType, target: str, date_format: str = "yyyy-MM-dd",
              allowed: int | None = None) -> int:
    """Write the bad lines of ``path`` to ``target`` and return how many there are; more than ``allowed`` are an error."""
    bad_lines(spark, path, schema, date_format).write.mode("overwrite").parquet(target)
    n = spark.read.parquet(target).count()
    if allowed is not None and n > allowed:
        raise ValueError(f"{n} lines of {path} cannot be read; they are in {target}")
    return n


def extract_data(spark: SparkSession, customers_path: str, transactions_path: str):
    """Typed raw customers and transactions (dates parsed at read)."""
    c = with_ingest_seq(read_csv(spark, customers_path, CUSTOMER_SCHEMA))
    t = with_ingest_seq(read_csv(spark, transactions_path, TRANSACTION_SCHEMA))
    return c, t


def load_gen1(spark: SparkSession, customers_path: str, transactions_path: str):
    """Gen-1 raw files read with string dates, parsed afterwards (``to_date``)."""
    c = with_ingest_seq(read_csv(spark, customers_path, GEN1_CUSTOMER_SCHEMA))
    t = with_ingest_seq(read_csv(spark, transactions_path, GEN1_TRANSACTION_SCHEMA))
    return (c.withColumn("join_date", F.to_date("join_date")),
            t.withColumn("date", F.to_date("date")))


PROCESSED_TABLES = ("customers_cleaned", "transactions_cleaned", "rfm_scores", "customer_360",
                    "monthly_summary")


def load_processed(spark: SparkSession, base_dir: str, fmt: str = "parquet",
                   tables=PROCESSED_TABLES) -> dict[str, DataFrame]:
    """The processed tables written by the ETL job."""
    out = {}
    for name in tables:
        path = f"{base_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            # Processed CSV exports carry derived columns; infer their types
            # like the reference's read_csv (parquet keeps exact types).
            out[name] = spark.read.option("header", True).option("inferSchema", True).csv(path)
        else:
            out[name] = spark.read.format(fmt).load(path)
    return out
