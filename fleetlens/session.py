"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build(app: str = "fleetlens", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    from .functions import registry

    registry.register(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting uses its warehouse folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/__shared"
