"""File sources: CSV as text columns, JSON lines with their raw line, fingerprints and row estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom.functions.parse import is_quoted_amount

S = T.StringType()
LOCATION = T.StructType([T.StructField(n, S) for n in ("province", "city", "coordinates")])
METADATA = T.StructType([T.StructField("device_id", S), T.StructField("session_id", S), T.StructField("retry_flag", T.BooleanType())])
TRANSACTION = T.StructType([*(T.StructField(n, S) for n in ("transaction_id", "account_id", "transaction_date", "transaction_time", "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel")), T.StructField("location", LOCATION), T.StructField("metadata", METADATA)])
CUSTOMER_COLUMNS = ("customer_id", "id_number", "first_name", "last_name", "dob", "gender", "province", "income_band", "segment", "risk_score", "kyc_status", "product_flags")
ACCOUNT_COLUMNS = ("account_id", "customer_ref", "account_type", "account_status", "open_date", "product_tier", "mobile_number", "digital_channel", "credit_limit", "current_balance", "last_activity_date")


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A CSV file with a header, every column as text. With ``columns`` malformed rows show in ``_corrupt``."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    if columns is None:
        return reader.option("inferSchema", False).csv(path)
    schema = T.StructType([*(T.StructField(c, S) for c in columns), T.StructField("_corrupt", S)])
    return reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").csv(path)


def parse_transactions(lines: DataFrame, raw: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """JSON lines to the fixed struct, keeping the raw line; malformed lines give null fields."""
    event = lines.withColumn("_event", F.from_json(F.col(raw), TRANSACTION))
    return event.select("_event.*", F.col(raw).alias("raw_json"), is_quoted_amount(F.col(raw)).alias("amount_was_quoted"), (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingestion_timestamp"))


def read_transactions(spark: SparkSession, path: str, ingested_at: Column | None = None) -> DataFrame:
    return parse_transactions(spark.read.text(path), "value", ingested_at)


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with typed nulls for the columns it lacks."""
    return df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c not in df.columns))


def read_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several Parquet folders as one frame with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def fingerprints(spark: SparkSession, path: str, kind: str = "text") -> DataFrame:
    """Path, size and modification time of each file, without reading them beyond their metadata column."""
    files = spark.read.format("binaryFile").load(path) if kind == "binary" else spark.read.format(kind).load(path)
    meta = files.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return meta.distinct()


def estimate_rows(spark: SparkSession, path: str, sample: int = 10_000) -> int:
    """Rows of a text source from the mean length of ``sample`` lines; an estimate for planning, not a result."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    total = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    mean = spark.read.text(path).limit(sample).agg(F.avg(F.octet_length("value") + 1)).first()[0]
    return int(total / mean) if mean else 0
