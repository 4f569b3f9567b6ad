"""Inputs shared by the queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.session import scratch
from dockline.sinks.storage import Folder

ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""

ORDERS_TEXT_SCHEMA = (
    "o_orderkey:string, o_custkey:string, o_orderstatus:string, "
    "o_totalprice:double, o_orderdate:timestamp, o_orderpriority:string"
)

OBJECTS_SQL = """
SELECT o_orderkey,
       'b' || (o_custkey % 3) AS bucket,
       'daily/data/' || strftime(o_orderdate, '%Y%m%d') || '/part-' || (o_orderkey % 4) || '.csv' AS name
FROM orders
"""

RULES = [
    ("all", "b0", r"^daily/data/\d{8}/", "file", True),
    ("y1998", "b0", r"/1998\d{4}/", "file", True),
    ("manual", "b1", r"^daily/", "file", False),
    ("suffix", "b1", r"part-3\.csv$", "file", True),
    ("marker", "b2", r"/DONE$", "marker", True),
    ("folder", "b2", r"^daily/data/\d{8}/?$", "folder", True),
]

RULES_SQL = "(VALUES " + ", ".join(
    f"({i}, '{n}', '{b}', '{p}', '{m}', {str(a).upper()})" for i, (n, b, p, m, a) in enumerate(RULES)
) + ") AS rules(ordinal, job, source_bucket, source_prefix, mode, auto_trigger)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object names made from orders: ``o_orderkey, bucket, name``."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("b"), (F.col("o_custkey") % 3).cast("string")).alias("bucket"),
        F.concat(
            F.lit("daily/data/"), day, F.lit("/part-"), (F.col("o_orderkey") % 4).cast("string"), F.lit(".csv")
        ).alias("name"),
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over all tasks, as a table of few large row groups is read by few."""
    return df.hint("rebalance", key)


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, *rule) for i, rule in enumerate(RULES)],
        "ordinal bigint, name string, source_bucket string, source_prefix string, mode string, auto_trigger boolean",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def order_rows(df: DataFrame) -> DataFrame:
    """Orders read back from files, in the types of the original table."""
    return df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        naive(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"),
        "o_orderpriority",
    )


def naive(moment: Column) -> Column:
    return moment.cast("timestamp_ntz")


def cents(amount: str) -> Column:
    """A sum that does not depend on the order of its rows."""
    return F.sum(F.col(amount).cast("decimal(18,2)")).cast("double")


CENTS_SQL = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def plain_folders(root: str, spark: SparkSession, prefix: str) -> None:
    """``k=v`` folders below a root as plain dated ones."""
    folder = Folder(spark, root)
    for child in folder.children():
        if child.startswith(f"{prefix}="):
            folder.rename(child, child.split("=", 1)[1])


def monthly_orders(spark: SparkSession, sf_dir: str, fmt: str = "csv", **options: str) -> str:
    """Orders as files below ``<scratch>/daily/data/<yyyyMM>``; returns that root."""
    return dated_files(orders(spark, sf_dir), "o_orderdate", "yyyyMM", fmt, **options)


def dated_files(df: DataFrame, column: str, pattern: str, fmt: str, **options: str) -> str:
    spark = df.sparkSession
    root = f"{scratch(spark, 'files')}/daily/data"
    dated = df.withColumn("folder", F.date_format(column, pattern)).hint("rebalance", "folder")
    dated.write.options(**options).partitionBy("folder").format(fmt).save(root)
    plain_folders(root, spark, "folder")
    return root


def flat_orders(spark: SparkSession, sf_dir: str, fmt: str, **options: str) -> str:
    """Orders as files of one folder."""
    root = scratch(spark, "files")
    orders(spark, sf_dir).write.options(**options).format(fmt).save(root)
    return root


def strip_extensions(spark: SparkSession, root: str) -> str:
    """Rename ``part-0.csv.gz`` to ``part-0``, so only the caller knows the codec."""
    folder = Folder(spark, root)
    for name in folder.files():
        if name.startswith("part-"):
            folder.rename(name, name.split(".", 1)[0])
        elif name.startswith(".part-"):
            # Checksums of a local file system name the files they belong to.
            folder.remove(name)
    return root
