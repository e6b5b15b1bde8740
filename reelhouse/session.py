"""Session helpers for scripts and tests (operators never change settings)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session with UTC time, AQE on and the web UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Call-site capture for error context walks the Python stack on every
        # DataFrame/Column call; off for scripts, where it dominates plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared path; it is read from the
    session, and a cluster session without it is an error. Only a local session
    (tests, scripts) without it gets a scratch folder, registered as the
    context's checkpoint folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = _LOCAL_FALLBACK.get(id(sc))
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a shared folder for checkpoints "
                "(a machine-local folder does not survive the loss of a node)"
            )
        path = tempfile.mkdtemp(prefix="reelhouse-ckpt-")
        _LOCAL_FALLBACK[id(sc)] = path
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_LOCAL_FALLBACK: dict[int, str] = {}
