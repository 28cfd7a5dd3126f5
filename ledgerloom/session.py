"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Adaptive execution re-plans joins from
# real shuffle sizes; skewed join partitions are split even where that costs an
# extra exchange, because one business key may hold a large share of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # rows of a few batches are written without sorting them by batch first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # tables at rest are written once and mostly text; zstd takes about two thirds of the space of snappy
    "spark.sql.parquet.compression.codec": "zstd",
    # values of a column are looked up in its dictionary until that is full; of ids and texts no more than this is tried
    "parquet.dictionary.page.size": "65536",
    # rows read at once; a row may be a whole document, and 4,096 of them are a row group at a time for each task
    "spark.sql.parquet.columnarReaderBatchSize": "64",
}
# Least number of partitions an exchange deals rows to; adaptive execution joins small ones to its advisory size
# afterwards. What a task sorts or collects thus follows that size also under a small setting. Up to 200 partitions
# are written without being sorted in memory first.
PARTITIONS = 200


_LOCAL_FOLDERS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    initial = max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; a cluster
    without the setting is a configuration error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared work folder."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str, rows_per_file: int = 0):
    """Write ``df`` to the shared work folder and read it back.

    Used where a result feeds several readers: it is computed once, its size is
    known to the optimizer, and a lost executor costs no recomputation of its
    inputs. ``rows_per_file`` lets a task write several files, 0 for one.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(*jobs: Callable):
    """Submit independent Spark jobs at the same time and return their results in order.

    The cluster stays busy while one of them plans, lists files or finishes its last tasks.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
