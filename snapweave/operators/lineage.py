"""Tables between steps, in the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a Parquet table of its own; any executor can read it again after another is lost.

    The folder is the session's spark.checkpoint.dir. Where none is set, a session on this machine alone (master local)
    gets a temporary one; any other is refused, for its executors share no local folder.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="snapweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/snapweave-steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
