"""The package's own code on the executors, in batches of bounded size."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Bytes of the rows that a Python worker is given at a time: texts are long, and a worker holds several copies.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application (as ``--py-files`` would).

    Also lowers the session's bound on the bytes of a batch, if it is higher than ``BATCH_BYTES``.
    """
    if int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "starmart.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
