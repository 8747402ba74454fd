"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job runs with; most of them decide values.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a repeated key in a JSON message takes its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    # HotSpot never compiles a method of more than 8000 bytecodes; a stage that large runs faster
    # as one generated class per operator than as one interpreted loop
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on an existing session and return it."""
    for name, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("emberlog")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave the setting out: executors on other machines could not read a
    temporary folder. Such a folder goes when the session's process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/emberlog-{label}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix=f"emberlog-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/data"
