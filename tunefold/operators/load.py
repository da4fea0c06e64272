"""Keyed loads into catalogued tables: insert, overwrite, upsert, plus select_all.

A table is a Parquet table of Spark's catalog, partitioned by a hash of its
primary key (or by columns of the key that its schema names) and, within
partitions, bucketed by the key. All writes go through Spark's own commit:

* ``insert``: appends the batch; fails on a NULL or repeated key in the batch or a
  key already in the table.
* ``overwrite``: the batch becomes the table. Its partitions replace those of the
  table by dynamic partition overwrite, then partitions without rows of the batch go.
* ``upsert``: the partitions that hold a key of the batch are joined with it (full
  outer, by key) and replaced by the result through dynamic partition overwrite;
  other partitions are neither read nor written. A key twice in one batch is an error by
  default (as ``ON CONFLICT DO UPDATE`` refuses it); ``on_duplicate="keep_latest"``
  keeps the row with the greatest ``order_by``.

The stored side of both key matches is read by buckets, so only the batch is
shuffled, and every task writes the files of its own bucket. The table's partitions
are dealt into groups, the more of them the more rows there are (``ROWS_PER_TASK``): a
task has one bucket of one group, so ``buckets`` tasks serve a small load and up to
``parts`` times as many a large one. A key never changes its partition, so loads of
different keys never meet.

The batch is written to the shared folder first; its keys are checked there, and
an error in its plan leaves the table alone. The number of loaded rows is
observed during that write. What comes to the driver are counts and the names of
partitions (at most ``parts``, or one per value of the named columns in the batch).

One writer at a time per table, as the warehouse assumed too; a load that is cut off
in Spark's commit is repeated. A catalog that lasts (a metastore) has the
tables in every session; with Spark's own in-memory one, ``create_tables`` finds
the partitions that earlier sessions wrote into the store's folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEY_PART, TableSchema
from ..session import scratch_path, written

LOAD_METHODS = ("insert", "upsert", "overwrite")
#: Rows that a task of a load should have at most; a load has more tasks where its rows are more.
ROWS_PER_TASK = 250_000
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class KeyViolation(ValueError):
    pass


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace the partitions they have rows of."""
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


class TableStore:
    """Keyed tables of one database, whose folder is ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, "store")).rstrip("/")
        self.database = database or f"tunefold_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}"
        self.schemas: dict[str, TableSchema] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")

    # -- tables --------------------------------------------------------------
    def name(self, table: str) -> str:
        """The table's (or view's) name for SQL."""
        return f"`{self.database}`.`{table}`"

    def table_exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.name(name))

    def create_tables(self, schemas: Mapping[str, TableSchema] | list[TableSchema]) -> None:
        """Create each table unless it exists (its schema is remembered either way)."""
        for s in schemas.values() if isinstance(schemas, Mapping) else schemas:
            self.schemas[s.name] = s
            if self.table_exists(s.name):
                continue
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in s.stored.fields)
            parts = ", ".join(f"`{c}`" for c in s.partition_columns)
            keys = ", ".join(f"`{k}`" for k in s.bucket_columns)
            clustered = f"CLUSTERED BY ({keys}) INTO {s.buckets} BUCKETS" if keys else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(s.name)} ({columns}) USING parquet "
                f"PARTITIONED BY ({parts}) {clustered} LOCATION '{self.root}/{s.name}'")
            fs, at = self._folder(f"{self.root}/{s.name}")
            if fs.exists(at):
                self.spark.catalog.recoverPartitions(self.name(s.name))

    def drop_table(self, name: str) -> None:
        """The table and its rows are gone."""
        if self.table_exists(name):
            self.spark.sql(f"DROP TABLE {self.name(name)}")
            self._delete(f"{self.root}/{name}")

    def select_all(self, name: str) -> DataFrame:
        """The whole table as it is now, declared columns in declared order."""
        return self.spark.table(self.name(name)).select(*self._schema(name).columns)

    def compact(self, name: str) -> None:
        """Rewrites every partition as one file per bucket (many small inserts leave many small files)."""
        s = self._schema(name)
        stored = self.spark.table(self.name(name))
        self._replace(self._by_bucket(stored, s, stored.count()), s)

    def _schema(self, name: str) -> TableSchema:
        if name not in self.schemas:
            raise ValueError(f"no schema declared for table {name!r}")
        return self.schemas[name]

    def _folder(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _delete(self, path: str) -> None:
        fs, at = self._folder(path)
        fs.delete(at, True)

    # -- batches ---------------------------------------------------------------
    def _staged(self, df: DataFrame, s: TableSchema, check: bool, repeats: bool = False, by_part: bool = False) -> tuple[DataFrame, int]:
        """The batch with its partition column, written and checked, and its number of rows; the table doesn't have it yet.

        ``by_part``: in a folder per partition, for steps that read the partitions one by one.
        """
        missing = [c for c in s.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{s.name}: batch lacks columns {missing}")
        rows = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in s.struct.fields))
        if KEY_PART in s.partition_columns:
            rows = rows.withColumn(KEY_PART, F.pmod(F.xxhash64(*s.primary_key), F.lit(s.parts)).cast("int"))
        seen = Observation(f"{s.name} batch")
        folders = s.partition_columns if by_part and s.bucket_columns else ()
        staged = written(rows.select(*s.stored.names).observe(seen, F.count(F.lit(1)).alias("rows")), f"batch-{s.name}", folders)
        if check:
            self.check_keys(staged.select(*s.primary_key), s, repeats)
        return staged, seen.get.get("rows", 0)

    @staticmethod
    def check_keys(keys: DataFrame, s: TableSchema, repeats: bool = False) -> None:
        """No NULL and no repeated key: one hash aggregate over the key columns, then two sums. ``repeats``: keys may repeat."""
        null = F.greatest(*(F.col(k).isNull() for k in s.primary_key), F.lit(False))
        per_key = keys.groupBy(*s.primary_key).agg(F.count(F.lit(1)).alias("__n"))
        row = per_key.agg(F.sum(F.when(null, F.col("__n"))).alias("nulls"), F.sum(F.col("__n") - 1).alias("again")).first()
        if row["nulls"]:
            raise KeyViolation(f"{row['nulls']} row(s) with a NULL key in {s.primary_key}")
        if row["again"] and not repeats:
            raise KeyViolation(f"{row['again']} repeated key(s) in the batch on {s.primary_key}")

    def _keep_latest(self, df: DataFrame, s: TableSchema, order_by: str) -> DataFrame:
        """One row per key: greatest ``order_by`` (NULL lowest), then greatest row as a tie-break.

        The aggregate holds a row per key, so Spark sorts by key instead of
        hashing; repeats of a hot key are still combined before the shuffle.
        """
        row = F.struct(*s.columns)
        rank = F.struct(F.col(order_by).isNotNull(), F.col(order_by), row.alias("row"))  # holds the row, once
        return df.groupBy(*s.primary_key).agg(F.max(rank).alias("__best")).select("__best.row.*")

    # -- writing ---------------------------------------------------------------
    @staticmethod
    def _groups(s: TableSchema, rows: int) -> int:
        """Groups that the table's partitions are dealt into for a load of so many rows."""
        return min(s.parts, max(1, -(-rows // (s.buckets * ROWS_PER_TASK))))

    def _by_bucket(self, rows: DataFrame, s: TableSchema, number: int) -> DataFrame:
        """``number`` rows dealt as the table's buckets are, so that a task writes one file per partition at most.

        A table without buckets gets as many files per partition as hold ``ROWS_PER_TASK`` rows each.
        """
        if not s.bucket_columns:
            files = max(1, -(-number // ROWS_PER_TASK))
            spread = [F.pmod(F.xxhash64(*s.primary_key), F.lit(files))] if files > 1 else []
            return rows.repartition(*s.partition_columns, *spread)
        groups = self._groups(s, number)
        if groups == 1:
            return rows.repartition(s.buckets, *s.bucket_columns)
        bucket = F.pmod(F.hash(*s.bucket_columns), F.lit(s.buckets))  # as Spark numbers them
        return rows.repartitionById(groups * s.buckets, (F.col(KEY_PART) % groups) * s.buckets + bucket)

    def _append(self, rows: DataFrame, s: TableSchema) -> None:
        rows.write.mode("append").insertInto(self.name(s.name))

    def _replace(self, rows: DataFrame, s: TableSchema) -> None:
        with _dynamic_overwrite(self.spark):
            rows.write.mode("overwrite").insertInto(self.name(s.name))

    def _touched(self, batch: DataFrame, s: TableSchema) -> tuple[DataFrame, Column]:
        """The table's partitions that the batch has rows of, and the condition that picks them (on literals, so others aren't listed)."""
        values = [tuple(r) for r in batch.select(*s.partition_columns).distinct().collect()]
        if len(s.partition_columns) == 1:
            picked = F.col(s.partition_columns[0]).isin([v for v, in values])
        else:
            picked = F.lit(False)
            for v in values:
                each = F.lit(True)
                for c, x in zip(s.partition_columns, v):
                    each = each & (F.col(c) == F.lit(x))
                picked = picked | each
        return self.spark.table(self.name(s.name)).where(picked), picked

    def merged(self, batch: DataFrame, s: TableSchema, number: int = 0) -> DataFrame:
        """The partitions of the table that an upsert of ``batch`` (``number`` rows, staged by partition) replaces, as they are afterwards."""
        old, _ = self._touched(batch, s)
        groups = self._groups(s, number) if s.bucket_columns else 1
        if groups == 1:
            return self._merged(old, batch, s)
        # Each group of partitions is a join of its own: it scans its own folders on both sides.
        of = lambda df, g: df.where(F.col(KEY_PART).isin([p for p in range(s.parts) if p % groups == g]))
        return reduce(DataFrame.unionByName, (self._merged(of(old, g), of(batch, g), s) for g in range(groups)))

    def _merged(self, old: DataFrame, batch: DataFrame, s: TableSchema) -> DataFrame:
        new = batch.select(*(F.col(k).alias(f"__{k}") for k in s.primary_key), F.struct(*s.stored.names).alias("__new"))
        if s.bucket_columns:
            new = new.repartition(s.buckets, *(f"__{k}" for k in s.bucket_columns))
        same = [old[k] == new[f"__{k}"] for k in s.primary_key]
        both = old.join(new.hint("merge"), same, "full_outer")
        row = (F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in s.stored.names)
        return both.select(*row)

    # -- loads -------------------------------------------------------------------
    def insert(self, df: DataFrame, name: str, check_keys: bool = True) -> int:
        """Appends; returns the number of rows."""
        s = self._schema(name)
        self.create_tables([s])
        batch, rows = self._staged(df, s, check_keys)
        if check_keys:
            there, _ = self._touched(batch, s)
            keys = batch.select(*s.primary_key)
            keys = keys.repartition(s.buckets, *s.bucket_columns) if s.bucket_columns else keys
            if not there.select(*s.primary_key).join(keys.hint("merge"), list(s.primary_key), "left_semi").isEmpty():
                raise KeyViolation(f"{name}: batch repeats keys already in the table")
        self._append(self._by_bucket(batch, s, rows), s)
        return rows

    def overwrite(self, df: DataFrame, name: str, check_keys: bool = True, repeats: bool = False) -> int:
        """Replaces the table; returns the number of rows. ``repeats``: a key may come several times (a log as it was kept)."""
        s = self._schema(name)
        self.create_tables([s])
        batch, rows = self._staged(df, s, check_keys, repeats)
        self._replace(self._by_bucket(batch, s, rows), s)
        _, live = self._touched(batch, s)
        stale = self.spark.table(self.name(name)).where(~F.coalesce(live, F.lit(False))).select(*s.partition_columns).distinct()
        for r in stale.collect():
            self._drop_partition(s, r.asDict())
        return rows

    def _drop_partition(self, s: TableSchema, values: dict) -> None:
        spec = ", ".join(f"`{c}` = {v!r}" if isinstance(v, int) else "`{}` = '{}'".format(c, v.replace("\\", "\\\\").replace("'", "\\'"))
                         for c, v in values.items())
        found = self.spark.sql(f"DESCRIBE EXTENDED {self.name(s.name)} PARTITION ({spec})")
        at = found.where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"ALTER TABLE {self.name(s.name)} DROP IF EXISTS PARTITION ({spec})")
        self._delete(at)

    def upsert(self, df: DataFrame, name: str, on_duplicate: str = "error", order_by: str | None = None,
               check_keys: bool = True) -> int:
        """Rows of the table whose key is not in the batch, plus the batch; returns the number of rows of the batch.

        ``check_keys=False`` skips the NULL-key check where the caller guarantees it.
        """
        s = self._schema(name)
        if on_duplicate not in ("error", "keep_latest"):
            raise ValueError(f"unknown on_duplicate policy {on_duplicate!r}")
        latest = on_duplicate == "keep_latest"
        if latest and order_by is None:
            raise ValueError("keep_latest needs order_by")
        self.create_tables([s])
        batch, rows = self._staged(self._keep_latest(df, s, order_by) if latest else df, s, check_keys or not latest, by_part=True)
        self._replace(self.merged(batch, s, rows), s)
        return rows

    def load(self, tables: Mapping[str, DataFrame], schemas: Mapping[str, TableSchema] | None = None,
             method: str = "overwrite", **kwargs) -> dict[str, int]:
        """Load each named frame with one method; returns the rows of each."""
        if method not in LOAD_METHODS:
            raise ValueError(f"unknown load method {method!r}: use one of {', '.join(LOAD_METHODS)}")
        if schemas:
            for s in schemas.values():
                self.schemas.setdefault(s.name, s)
        for name in tables:
            self._schema(name)  # raises for a table without schema
        return {name: getattr(self, method)(df, name, **kwargs) for name, df in tables.items()}
