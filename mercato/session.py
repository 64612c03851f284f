"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings, safe to set on a session that already exists.
RUNTIME_CONF = {
    # A value that cannot be cast must fail the job, not become NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where a later operator wanted to reuse
    # its partitioning. The extra shuffle is only planned when skew is present.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

STARTUP_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "mercato",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A configured session; on a cluster leave ``master`` to spark-submit.

    ``shuffle_partitions`` is the starting count AQE coalesces from, so choose it
    for the largest shuffle (total shuffled bytes / ~128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**STARTUP_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
