"""JDBC source and sink for the catalogue tables (the warehouse connector).

Plain ``spark.read.jdbc`` / ``DataFrameWriter.jdbc``: reads are split into
``num_partitions`` range scans on a numeric or date column when one is given
(otherwise a single task reads the table, which is only right for small
tables), and writes go out in ``batchsize`` row batches from every task.

Only ``append`` and ``overwrite`` exist on the JDBC side. A keyed upsert needs
the database's own ``ON CONFLICT`` statement, which Spark's JDBC writer does
not issue; keyed loads go through ``TableStore`` instead.

No database server runs in this build's test environment, so these two
functions are not exercised by the test suite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append",
               batchsize: int = 10_000) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError("JDBC writes support append or overwrite; use TableStore.upsert for keyed loads")
    props = {**properties, "batchsize": str(batchsize)}
    if mode == "overwrite":
        props.setdefault("truncate", "true")  # keep the table's declared keys and grants
    df.write.jdbc(url, table, mode=mode, properties=props)
