"""Session presets.

Only settings a job may choose for itself live here. The master, executor sizes and
dynamic allocation belong to the launcher.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

#: Adaptive execution coalesces small shuffle partitions and splits skewed join partitions,
#: so the shuffle partition count may be set high on a cluster without hurting small inputs.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.network.timeout": "600s",
    "spark.executor.heartbeatInterval": "60s",
}


def object_store_conf(
    endpoint: str,
    *,
    path_style: bool = True,
    use_tls: bool = True,
    credentials_provider: str | None = None,
) -> dict[str, str]:
    """Settings for an S3-compatible store, to be passed when the session is *built*.

    Setting ``spark.hadoop.*`` on a live session does not reach the Hadoop configuration.
    Access keys are left to the credentials provider, so that none end up in code or plans.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(use_tls).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    return conf


def build_session(
    app_name: str = "reelpress",
    conf: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Session with the presets above; ``conf`` overrides them. ``master`` is for tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is missing it is a folder of the warehouse, unless that is on a machine's own disk (its
    default is the driver's working directory) and the session is not local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        own_disk = ":/" not in folder or folder.startswith("file:")
        if own_disk and not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir: executors may not share {folder}")
    return folder.rstrip("/")


def use_checkpoints(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the folder it writes to."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder
