"""Session settings the library is tuned for; any Spark session works without them."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Measured roll-ups (sizing.measured) and small dimensions; adaptive execution checks real sizes.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Checkpoints, where an operator uses them, are compressed and go when they are no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    # The marts plan over a hundred generated classes; the default cache of 100 recompiles them all.
    "spark.sql.codegen.cache.maxEntries": "4000",
    # Fused methods over rows this wide exceed what the JVM compiles and run interpreted.
    "spark.sql.codegen.maxFields": "40",
}


def builder(app_name: str = "deskmart", **extra: str) -> SparkSession.Builder:
    """A builder with :data:`SETTINGS`; ``extra`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        b = b.config(key, value)
    return b
