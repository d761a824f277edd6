"""Session settings that the engine counts on."""

from pyspark.sql import SparkSession


def session(name: str = "tabularium", **settings: str) -> SparkSession:
    """A session with AQE and UTC; everything else is the cluster's own choice or in ``settings``."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
