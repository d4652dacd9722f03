"""External tables with a fixed, commented schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _column(name: str, data_type: DataType, comment: str) -> StructField:
    return StructField(name, data_type, True, {"comment": comment})


# Names and types of the public blockchain transactions dataset.
TRANSACTIONS = StructType(
    [
        _column("date", StringType(), "day of the block, YYYY-MM-DD"),
        _column("hash", StringType(), "transaction hash"),
        _column("nonce", LongType(), "earlier transactions of the sender"),
        _column("transaction_index", LongType(), "position in the block"),
        _column("from_address", StringType(), "sender"),
        _column("to_address", StringType(), "receiver"),
        _column("value", DoubleType(), "wei moved; exact up to 2^53"),
        _column("gas", LongType(), "gas offered by the sender"),
        _column("gas_price", LongType(), "wei per unit of gas offered"),
        _column("input", StringType(), "call data"),
        _column("receipt_cumulative_gas_used", LongType(), "gas used in the block so far"),
        _column("receipt_gas_used", LongType(), "gas used by this transaction"),
        _column("receipt_contract_address", StringType(), "contract made, if any"),
        _column("receipt_status", LongType(), "1 on success, 0 on failure"),
        _column("block_timestamp", TimestampType(), "time of the block"),
        _column("block_number", LongType(), "number of the block"),
        _column("block_hash", StringType(), "hash of the block"),
        _column("max_fee_per_gas", LongType(), "upper bound on base plus priority fee"),
        _column("max_priority_fee_per_gas", LongType(), "upper bound on the miner's fee"),
        _column("transaction_type", LongType(), "envelope type"),
        _column("receipt_effective_gas_price", LongType(), "wei per unit of gas paid"),
    ]
)


def external_table(
    spark: SparkSession, name: str, path: str, schema: StructType
) -> DataFrame:
    """Declare Parquet files under ``path`` as a table; dropping it keeps the files."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def external_view(
    spark: SparkSession, name: str, path: str, schema: StructType | None = None
) -> DataFrame:
    """The same for this session only, without a catalog entry."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    df.createOrReplaceTempView(name)
    return df
