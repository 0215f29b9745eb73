"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def stored(rows: DataFrame) -> DataFrame:
    """Writes rows below ``spark.checkpoint.dir`` and reads them back, which cuts the lineage and survives lost executors.

    Where that setting is absent, a local session gets a temporary folder of its own; on a cluster, whose machines would not
    share one, that is an error.
    """
    spark = rows.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="codexflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    where = f"{base.rstrip('/')}/codexflow-{uuid.uuid4().hex}"
    rows.write.parquet(where)
    return spark.read.schema(rows.schema).parquet(where)
