"""Make the package importable on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Arrow batches are bounded in rows, and texts and polygons vary in size: 10,000 of them may take tens of MB in
#: the executor and several times that in its Python workers
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's code to the executors, once per application. Batches sent to Python are bounded in bytes,
    unless the session says otherwise."""
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="landgrid-package-")
        context.addPyFile(shutil.make_archive(os.path.join(folder, "landgrid"), "zip", HERE, "landgrid"))
        _shipped.add(context.applicationId)
    return spark
