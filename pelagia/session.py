"""Session defaults shared by the command line, the benchmark and the tests."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings every plan in this package relies on. Shuffle width, memory and the
#: checkpoint folder belong to the cluster and are left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(app: str = "pelagia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS, then whatever the caller adds."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that Python tasks can import it anywhere."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="pelagia-")) / "pelagia.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, str(path.relative_to(here.parent)))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
