"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import PurePosixPath
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts, splits skewed join partitions and
# switches to a broadcast only after it has seen the real size of a side.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "stockloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the recommended settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _path(uri: str) -> PurePosixPath:
    """The path of a URI or a plain path, without scheme and doubled slashes."""
    return PurePosixPath("/" + urlsplit(uri).path.strip("/"))


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder of its own; a cluster without
    the setting is an error, as other machines could not read such a folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        # Spark's own folder lies directly below the one that was set.
        if current is None or _path(current).parent != _path(named):
            context.setCheckpointDir(named)
    elif current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stockloom-checkpoint-"))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so that several readers can share it."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables written between two steps, beside the checkpoints."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4()}"
