"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A session configured the way the jobs expect to run (tests, bench).

    Production clusters bring their own session; the jobs only rely on
    ``spark.sql.session.timeZone`` being explicit for the epoch-year job, and
    even that job computes its calendar fields in UTC arithmetic.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store), so it
    is read from the session.  Only on a local master (unit tests, a laptop) an
    unset one becomes a fresh local folder, registered as the checkpoint dir.
    """
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # not readable through the SQL conf on some deployments
        conf_dir = None
    try:
        sc = spark.sparkContext
    except Exception:  # Connect sessions have no SparkContext
        sc = None
    if sc is not None:
        conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
        if conf_dir:
            if sc.getCheckpointDir() is None:
                sc.setCheckpointDir(conf_dir)
            return conf_dir.rstrip("/")
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    elif conf_dir:
        return conf_dir.rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/tessera/{name}-{uuid.uuid4().hex[:12]}"


MB = 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.3,
               target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on
    ``total_cores`` cores.

    * initial shuffle partitions: enough for ~``target_partition_bytes`` of
      shuffle data each (the shuffle is taken as ``shuffle_fraction`` of the
      input after pruning and partial aggregation), at least two waves of
      tasks; AQE then coalesces small ones and splits skewed ones;
    * scan splits of 128 MB;
    * AQE with skew-join splitting and partition coalescing on.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    partitions = -(-partitions // total_cores) * total_cores      # whole waves
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * MB),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str], only_unset: bool = True) -> dict:
    """Set SQL settings on a running session; by default only those not set
    explicitly in the cluster's configuration (spark-defaults / --conf).
    Returns what was set."""
    explicit = spark.sparkContext.getConf()
    done = {}
    for key, value in conf.items():
        if only_unset and explicit.contains(key):
            continue
        spark.conf.set(key, value)
        done[key] = value
    return done
