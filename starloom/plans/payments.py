"""Payment CSV to monthly revenue."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.schemas import schema
from starloom.sources.files import stage_csv


def read_payments(spark: SparkSession, path) -> DataFrame:
    return stage_csv(spark, path, schema("payment_csv"), sep=";")


def read_payments_untyped(spark: SparkSession, path) -> DataFrame:
    """All columns as text, then cast."""
    return stage_csv(spark, path, sep=";").withColumns(
        {
            "payment_date": F.to_timestamp("payment_date"),
            "amount": F.col("amount").try_cast("double"),
        }
    )


def monthly_revenue(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.month("payment_date").alias("month")).agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("revenue")
    )
