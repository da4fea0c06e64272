"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session comes from the caller (spark-submit, a notebook, the
driver's harness); nothing here changes its settings except where a value is
missing. Scratch data (landed pages, table versions, stream checkpoints) lives
under the folder the cluster names in ``spark.checkpoint.dir`` so that every
executor sees it; only when that setting is absent (unit tests) do we pick one.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tunefold") -> SparkSession:
    """A local-mode session configured the way the tests and bench expect."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder from ``spark.checkpoint.dir``.

    Set only where the session has none (local tests), never overridden.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tunefold-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared folder."""
    return f"{shared_dir(spark)}/tunefold-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str, folders: tuple[str, ...] = ()):
    """``df`` written to a scratch folder and read again: what several steps read is computed once. ``folders``: last columns to partition by."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_session(spark: SparkSession, rows: int, join_small: bool = False) -> SparkSession:
    """A session beside ``spark`` for a statement that collects sets beside several distinct counts, over ``rows`` rows.

    Spark holds each group's finished set beside the rows of the distinct counts, and copies it once for every
    row of the group that is in the same partition, and then once for every partition: rows over partitions, plus
    partitions. Both are about the root of the rows of a large group, which is taken as a quarter of all. Fewer
    would be left where Spark joins small partitions, so it joins only next to empty ones, or with ``join_small``, for a
    statement without such sets, up to 1 MB: a task holds the finished values of all groups of its partitions. The
    other settings are those of ``spark``, which keeps its own; a session has temp views for itself.
    """
    beside = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            beside.conf.set(k, v)
    beside.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    beside.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.isqrt(rows // 4))
    joined = "1m" if join_small else "1k"
    for k, v in {"spark.sql.shuffle.partitions": str(partitions),
                 "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": joined,
                 "spark.sql.adaptive.coalescePartitions.minPartitionSize": joined}.items():
        beside.conf.set(k, v)
    return beside


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """SQL settings for a run over ``input_bytes`` of parquet on ``cores`` executor cores.

    Shuffle partitions start at about one per ``partition_bytes`` of input (at
    least two waves of tasks); AQE then coalesces small ones and splits skewed
    join partitions. Scans use the same split size. Apply with
    ``spark.conf.set`` for each pair (all are runtime SQL settings).
    """
    waves = 2 * max(1, cores)
    shuffle = max(waves, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    }
