"""Where jobs put tables that only live between two steps."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse, which every executor reaches too. No
    setting is changed and no machine-local folder is used.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    return f"{spark.conf.get(WAREHOUSE).rstrip('/')}/_between_steps"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
