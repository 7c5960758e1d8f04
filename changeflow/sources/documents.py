"""Document bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a task hands on together.
TOGETHER = 16 << 20


def read_documents(spark: SparkSession, path: str, images: DataFrame) -> DataFrame:
    """Manifest rows with the bytes of their files (sImagePth/sImageNme); rows without a file are left out.

    The files below the path are listed without their bytes and joined with the manifest; then tasks read the bytes of the files
    that it names, no others. A manifest that Spark sees to be small is broadcast, so files stay dealt by their size. Spark's file
    sources pass over files of no bytes, so these count as missing. Paths are compared without the scheme and host.

    Tasks read through ``pyarrow.fs``, which needs a file system that it opens (local or mounted, HDFS, S3, GCS).
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    bare = F.regexp_replace("path", r"^[A-Za-z0-9]+:(//[^/]*)?", "")
    wanted = images.select(F.struct("*").alias("_row"), F.concat_ws("/", F.rtrim(F.col("sImagePth"), F.lit("/")), "sImageNme").alias("_path"))
    found = wanted.join(listed.select(bare.alias("_path"), F.col("path").alias("_uri")), "_path").select("_row", "_uri")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def content(uri: str) -> bytes:
            scheme, _, rest = uri.partition(":")
            files, where = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(uri)
            with files.open_input_stream(where, compression=None) as stream:
                return stream.read()

        for batch in batches:
            first, read, size = 0, [], 0
            for i, uri in enumerate(batch.column(1).to_pylist()):
                read.append(content(uri))
                size += len(read[-1])
                if size >= TOGETHER or i + 1 == batch.num_rows:
                    rows = batch.column(0).slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([rows, pa.array(read, pa.binary())], names=["_row", "content"])
                    first, read, size = i + 1, [], 0

    schema = T.StructType([found.schema["_row"], T.StructField("content", T.BinaryType())])
    told = found.mapInArrow(fetch, schema)
    return told.select(*[F.col("_row").getField(c).alias(c) for c in images.columns], "content")
