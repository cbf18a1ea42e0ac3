"""A session with the settings that the operators expect."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for an application, so that their Python workers can load it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).parent
    out = Path(tempfile.mkdtemp()) / f"{root.name}-{app}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(out))
    _shipped.add(app)


@contextmanager
def settings(spark: SparkSession, **values):
    """Settings of the session (``__`` for dots) for as long as a block runs."""
    names = {k: k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    for k, v in values.items():
        spark.conf.set(names[k], str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(names[k]) if v is None else spark.conf.set(names[k], v)


def build_session(master: str | None = None, name: str = "spanguard", **conf) -> SparkSession:
    """UTC, adaptive execution with skew handling, and Arrow; further settings by keyword with ``__`` for dots."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark
