"""Sinks (survey W1-W10).

Every table replaces the one before, as in the reference.  It is written aside and
swapped in when it is complete, so a failed write leaves the old table as it was.
Tables partitioned by columns are clustered first: each partition is written by as many tasks
as its counted rows need, not by every task.  Only aggregates whose size is
bounded by dimensions (days x categories x channels, KPI rows) go to one file for BI tools.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


#: Rows of one file of a partitioned table.
ROWS_PER_FILE = 2_000_000


def clustered(df: DataFrame, partition_by, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` dealt so that each partition lies in ceil(rows / ``rows_per_file``) tasks.

    The counts are a table of one row a partition value, bounded by the calendar or another dimension.
    A partition that holds a third of all rows is spread by a hash of its rows.
    """
    spark = df.sparkSession
    counts = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows")).collect()
    places = [tuple(r[c] for c in partition_by) + (-(-r["_rows"] // rows_per_file),) for r in counts]
    if not places:
        return df
    kinds = ", ".join(f"_p{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(partition_by))
    files = spark.createDataFrame(places, f"{kinds}, _files long")
    same = None
    for i, c in enumerate(partition_by):
        test = F.col(c).eqNullSafe(F.col(f"_p{i}"))
        same = test if same is None else same & test
    names = [f"_p{i}" for i in range(len(partition_by))]
    dealt = (df.withColumn("_row", F.xxhash64(*df.columns)).join(F.broadcast(files), same)      # a row a partition value
             .withColumn("_file", F.pmod(F.col("_row"), F.col("_files"))).drop("_row", "_files", *names))
    return dealt.repartition(sum(p[-1] for p in places), *partition_by, "_file").drop("_file")


def _swap(df: DataFrame, path: str, write) -> None:
    """Write beside ``path``, then take the old table's place; a failed write changes nothing.

    A rename is atomic on HDFS and local file systems.  An interrupted swap leaves the old table
    under its name with ``.old-`` behind it.
    """
    jvm, mark = df.sparkSession._jvm, uuid.uuid4().hex[:12]
    new, old, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new-{mark}", f"{path}.old-{mark}", path))
    fs = target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    try:
        write(f"{path}.new-{mark}")
    except BaseException:
        fs.delete(new, True)
        raise
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"could not put the new table in place: {path}")
    fs.delete(old, True)


def write_table(df: DataFrame, base: str, name: str, fmt: str = "parquet",
                partition_by=None, single_file: bool = False, rows_per_file: int = ROWS_PER_FILE) -> str:
    path = _path(base, name)
    if fmt == "csv":
        # CSV has no decimal/boolean types of its own: write their text forms.
        df = df.select(*[F.col(f.name).cast("string").alias(f.name)
                         if isinstance(f.dataType, DecimalType) else F.col(f.name)
                         for f in df.schema.fields])
    if single_file:
        df = df.repartition(1)       # coalesce(1) would run the aggregation itself in one task
    if partition_by:
        df = clustered(df, partition_by, rows_per_file)
    w = df.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    _swap(df, path, w.save)
    return path


def load_data(customers: DataFrame, transactions: DataFrame, rfm: DataFrame, base: str,
              fmt: str = "parquet", monthly: DataFrame | None = None,
              customer_360: DataFrame | None = None) -> dict[str, str]:
    """Cleaned customers, transactions (partitioned by year/month), RFM,
    and the monthly summary / customer 360 tables of the ETL load step."""
    out = {
        "customers_cleaned": write_table(customers, base, "customers_cleaned", fmt),
        "transactions_cleaned": write_table(transactions, base, "transactions_cleaned", fmt,
                                            partition_by=["year", "month"]),
        "rfm_scores": write_table(rfm, base, "rfm_scores", fmt),
    }
    if monthly is not None:
        out["monthly_summary"] = write_table(monthly, base, "monthly_summary", fmt, single_file=True)
    if customer_360 is not None:
        out["customer_360"] = write_table(customer_360, base, "customer_360", fmt)
    return out


def write_gen1(processed: DataFrame, rfm: DataFrame, base: str, fmt: str = "parquet") -> dict:
    """processed_transactions + rfm_scores of the gen-1 ETL."""
    return {"processed_transactions": write_table(processed, base, "processed_transactions", fmt,
                                                  partition_by=["year"]),
            "rfm_scores": write_table(rfm, base, "rfm_scores", fmt)}


def write_reports(reports: dict[str, DataFrame], base: str, prefix: str = "sql_",
                  fmt: str = "parquet") -> dict[str, str]:
    """One table per named report."""
    return {name: write_table(df, base, f"{prefix}{name}", fmt) for name, df in reports.items()}


def export_powerbi(daily: DataFrame, profile: DataFrame, base: str, fmt: str = "csv") -> dict:
    """Daily revenue (dimension-bounded, one file) + customer profile."""
    return {"powerbi_daily_revenue": write_table(daily, base, "powerbi_daily_revenue", fmt,
                                                 single_file=True),
            "powerbi_customer_profile": write_table(profile, base, "powerbi_customer_profile", fmt)}


def write_kpis(kpis: DataFrame, base: str, fmt: str = "csv") -> str:
    """(KPI, Value) rows."""
    return write_table(kpis, base, "kpi_summary", fmt, single_file=True)


def save_model(model, path: str) -> str:
    """MLlib persistence (``PipelineModel``/``KMeansModel`` ...)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def plain_exports(customers: DataFrame, transactions: DataFrame, rfm: DataFrame, base: str,
                  n: int = 10000, fmt: str = "csv") -> dict:
    """Customers and RFM as they are, plus the first-n transaction sample."""
    return {"excel_customers": write_table(customers, base, "excel_customers", fmt),
            "excel_transactions_sample": write_table(first_n(transactions, n), base,
                                                     "excel_transactions_sample", fmt,
                                                     single_file=True),
            "excel_rfm": write_table(rfm, base, "excel_rfm", fmt)}


def first_n(transactions: DataFrame, n: int = 10000) -> DataFrame:
    """The first n transactions in file order, i.e. by date then id.

    A plain ``orderBy().limit(n)`` merges n rows from every partition in one
    task.  First the exact cutoff date is found from per-day counts (one row
    per calendar day, a bounded table): the first day whose running count
    reaches n.  Only rows up to it (and NULL dates, which sort first) can be
    in the result, so the top-n merge sees about n rows per day kept.
    """
    per_day = transactions.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.orderBy(F.col("transaction_date").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    cutoff = per_day.withColumn("_cum", F.sum("_c").over(running)) \
        .where(F.col("_cum") >= n).agg(F.min("transaction_date").alias("d")).first()["d"]
    kept = transactions if cutoff is None else transactions.where(
        F.col("transaction_date").isNull() | (F.col("transaction_date") <= F.lit(cutoff)))
    return kept.orderBy("transaction_date", "transaction_id").limit(n)
