"""Re-sync request files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SYNC_REQUEST


def read_sync_request(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Requests, one object per line, or one array per file with ``array``; sExportTr may be missing."""
    return spark.read.schema(SYNC_REQUEST).option("recursiveFileLookup", True).option("multiLine", array).json(path)


def write_sync_request(requests: DataFrame, path: str, array: bool = False, per_array: int = 10_000) -> None:
    """Requests as one object per line, or with ``array`` as JSON arrays of at most ``per_array`` requests each."""
    if not array:
        requests.write.option("ignoreNullFields", False).json(path)
        return
    # Arrays are made of rows that a task has anyway, so no task gathers more than one array.
    place = F.monotonically_increasing_id()
    numbered = requests.select(F.struct(*[n for n in SYNC_REQUEST.names if n in requests.columns]).alias("_request"), place.alias("_at"))
    cut = numbered.withColumn("_task", F.shiftright("_at", 33)).withColumn("_part", F.floor((F.col("_at") - F.shiftleft("_task", 33)) / per_array))
    arrays = cut.groupBy("_task", "_part").agg(F.sort_array(F.collect_list(F.struct("_at", "_request"))).alias("_rows"))
    listed = F.to_json(F.transform("_rows", lambda r: r["_request"]), {"ignoreNullFields": "false"})
    arrays.select(F.concat_ws("-", "_task", "_part").alias("sPartxxxx"), listed.alias("value")).write.partitionBy("sPartxxxx").text(path)
