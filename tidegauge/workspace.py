"""Folders for intermediate files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTINGS = ("spark.checkpoint.dir", "spark.sql.warehouse.dir")


def work_dir(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A new folder path that every executor can reach.

    It lies in ``base``, else in the shared folder that the session names in
    ``spark.checkpoint.dir``, else in the warehouse. A warehouse on a local disk, as it is unless
    set, is refused on a cluster: there each machine would have one of its own.
    """
    named, warehouse = (spark.conf.get(x, None) or spark.sparkContext.getConf().get(x) for x in _SETTINGS)
    shared = base or named
    if not shared and warehouse:
        local = warehouse.startswith("file:") or ":/" not in warehouse
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"the warehouse {warehouse} is a local folder: set {_SETTINGS[0]}")
        shared = warehouse
    if not shared:
        raise ValueError(f"no shared folder: give base or set {_SETTINGS[0]}")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
