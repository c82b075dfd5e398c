"""A PySpark-native engine for specification, requirement and test-case analytics."""

from __future__ import annotations

import os
from pathlib import Path


def attach(spark) -> None:
    """Let Python workers import this package from where the driver has it.

    Where executors have other disks, the package is to be installed or shipped as with any PySpark job.
    """
    here = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH") or ""
    if here not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, path) if x)
