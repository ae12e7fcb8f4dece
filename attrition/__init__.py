"""Customer attrition analytics on Spark."""

from __future__ import annotations

import os
import shutil
import tempfile

_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package's code to the executors, once per application.

    Jobs submitted with ``--py-files`` or with the package installed on every node need not call
    this. The archive stays on the driver, which serves it."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="attrition-code-"), "attrition")
        archive = shutil.make_archive(target, "zip", root_dir=root, base_dir="attrition")
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
