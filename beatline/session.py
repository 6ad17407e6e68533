"""Session helpers: local sessions for tests and benches, and the shared
checkpoint folder (derived inputs, streaming state)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this package should have; on a cluster they go
# in spark-defaults or spark-submit, here they are applied to local sessions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole-stage code above HotSpot's JIT limit would run interpreted; above
    # this size Spark compiles the operators one by one instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for ``spark-submit`` sized to the input.

    Scan splits and shuffle partitions of ``partition_bytes`` each keep every
    task's data well inside executor memory; the shuffle partition count covers
    the case where the incidents themselves are shuffled (a join beyond the
    broadcast bound), and adaptive execution coalesces it down when only
    partial aggregates travel.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    conf = {k: v for k, v in RECOMMENDED_CONF.items() if not k.startswith("spark.ui")}
    conf.update({
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
    })
    return conf


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "beatline", **conf) -> SparkSession:
    """A ``local[cores]`` session with UI off and AQE on."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = dict(RECOMMENDED_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    settings["spark.driver.memory"] = "8g"
    settings["spark.sql.maxMetadataStringLength"] = "1000"  # plans name whole paths
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. On a cluster ``spark.checkpoint.dir``
    names a shared folder and is used as is; only when it is unset in local
    mode (tests) a fresh local folder is set."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext here
        if conf_dir:
            return conf_dir
        raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
    current = sc.getCheckpointDir() or conf_dir
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) on a cluster")
    path = tempfile.mkdtemp(prefix="beatline-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
