"""A session with the settings the plans count on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Adaptive execution broadcasts by measured size and splits hot keys; both are defaults, stated
# here because the joins rely on them. The query context would record a Python call site for
# each of the many small expressions of a rule. Two open files let a task that parts good rows from
# rejects write both without sorting its rows first.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_SHIPPED: set[str] = set()


def ship_package(session: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it on a path of their own.

    Spark's driver serves the file for as long as the session lasts.
    """
    if session.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(session.sparkContext.applicationId)
    package = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="veritable-")) / f"{package.name}.zip"
    with zipfile.ZipFile(packed, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    session.sparkContext.addPyFile(str(packed))
