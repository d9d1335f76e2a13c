"""Spark session defaults and the shared folder for persisted stages."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants. AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tallybook",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` and the submitter decides; in tests
    pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The shared folder is only needed by steps that write stages
    # (materialize, streaming); shared_path() asks for it when they run.
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # "local-cluster[..]" has executors of its own
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster names this folder; we only read it. Where it is unset and the
    session is local (tests, the bench), a fresh scratch folder is made and
    set. On a cluster an unset value is an error: a machine-local folder would
    vanish with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
    path = tempfile.mkdtemp(prefix="tallybook-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written stage tables)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, *parts)


def cluster_conf(input_bytes: int, executor_cores: int = 4,
                 target_partition_bytes: int = 256 * 1024 ** 2,
                 shuffled_fraction: float = 0.05, least: int = 200) -> dict[str, str]:
    """Starting settings for a cluster run over ``input_bytes`` of ledger data.

    Scan splits of ~256 MB. The shuffle width is sized to what is shuffled,
    not to the input: every large shuffle here carries pre-aggregated rows
    (the biggest are the product-level COGS aggregates, a few percent of the
    input), so ~256 MB per reducer of that, and ``least`` partitions at least;
    AQE coalesces further at run time.
    Skew-join splitting is on for the joins keyed by id or product.
    """
    shuffled = input_bytes * shuffled_fraction
    width = max(least, int(shuffled // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.executor.cores": str(executor_cores),
    }


def size_session(spark: SparkSession, paths: list[str]) -> None:
    """Apply ``cluster_conf`` for the files below ``paths`` to a running session.

    Settings fixed at launch (executor cores) stay the submitter's.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(hadoop).getContentSummary(p).getLength()
    for key, value in cluster_conf(total, least=max(8, spark.sparkContext.defaultParallelism)).items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
