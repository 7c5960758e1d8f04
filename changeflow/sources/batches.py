"""Change batches: JSON files of change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import read_time, write_time
from ..schemas import CHANGE_FIELDS, CHANGE_TIMES

# Rows of one file in the line layout, and of one array in the array layout. No list holds more
# rows than an array, however large a batch is.
ROWS_PER_FILE, ROWS_PER_ARRAY = 1_000_000, 10_000


def field(entries: Column, name: str) -> Column:
    """A field of a JSON object, its name matched whatever the case; the last one counts, as in a JSON reader."""
    named = F.filter(entries, lambda e: F.lower(e["key"]) == name.lower())
    return F.try_element_at(named, F.lit(-1))["value"]


def change_columns(entries: Column) -> list[Column]:
    """The eight typed change columns out of an object's entries; other fields are skipped."""
    return [
        (read_time(field(entries, n)) if n in CHANGE_TIMES else field(entries, n)).alias(n) for n in CHANGE_FIELDS
    ]


def parse_change_arrays(files: DataFrame) -> DataFrame:
    """Whole array texts (sFileName, nFirstPos, value) to rows with the position in the file.

    A text that is not a JSON array fails the job; nothing is skipped in silence.
    """
    objects = F.from_json("value", "array<map<string,string>>", {"mode": "FAILFAST"})
    rows = files.select("sFileName", "nFirstPos", F.posexplode(objects).alias("_at", "_fields"))
    entries = F.map_entries("_fields")
    return rows.select(
        "sFileName", (F.col("nFirstPos") + F.col("_at")).cast("long").alias("pos"), *change_columns(entries)
    )


def read_change_batch(spark: SparkSession, path: str) -> DataFrame:
    """JSON-array batch files to sFileName, pos and the eight typed columns.

    A one-line array cannot be split, so a file is read by one task; the writer below keeps files
    short and names them by batch and first position, which is read back here. Files of other
    makers are named by batch alone and start at position 1.
    """
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    source = F.col("_metadata.file_path")
    batch = F.regexp_extract(source, r"sFileName=([^/]+)/", 1)
    plain = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.(json|jbr|txt))?(\.gz)?$", 1)
    first = F.regexp_extract(source, r"nFirstPos=(\d+)/", 1)
    return parse_change_arrays(
        texts.select(
            F.when(batch != "", batch).otherwise(plain).alias("sFileName"),
            F.when(first != "", first.cast("long")).otherwise(F.lit(1)).alias("nFirstPos"),
            "value",
        )
    )


def read_change_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batches in the line layout; rows carry their position, so files split freely."""
    fields = ", ".join(f"{n} string" for n in CHANGE_FIELDS)
    rows = spark.read.schema(f"pos bigint, {fields}, sFileName string").json(path)
    return rows.select(
        "sFileName", "pos", *[(read_time(F.col(n)) if n in CHANGE_TIMES else F.col(n)).alias(n) for n in CHANGE_FIELDS]
    )


def _texts(rows: DataFrame) -> list[Column]:
    return [(write_time(F.col(n)) if n in CHANGE_TIMES else F.col(n)).alias(n) for n in CHANGE_FIELDS]


def write_change_batch(
    rows: DataFrame, path: str, layout: str = "lines", rows_per_file: int | None = None, gathered: bool = False, level: str = "DEFAULT_COMPRESSION"
) -> None:
    """Write batch rows (sFileName, pos and the change columns), one folder per batch, gzip, fixed field order.

    ``lines``: one object per line with its position; a large batch is spread over many tasks by the
    rebalance hint, which also joins small ones. Rows that are ``gathered``, those of a batch in few tasks as
    ``dense_position`` leaves them, are written where they are, without that shuffle; ``level`` is that of gzip,
    such as ``BEST_SPEED``. ``array``: JSON arrays for readers of the array
    form. Every batch, long or short, is a folder of arrays named by the position of their first
    row (``nFirstPos``), each of at most ``rows_per_file`` rows.
    """
    rows_per_file = rows_per_file or (ROWS_PER_FILE if layout == "lines" else ROWS_PER_ARRAY)
    if layout == "lines":
        out = rows.select("sFileName", "pos", *_texts(rows))
        out = out if gathered else out.hint("rebalance", F.col("sFileName"))
        (
            out.write.partitionBy("sFileName")
            .option("maxRecordsPerFile", rows_per_file)
            .option("ignoreNullFields", False)
            .option("zlib.compress.level", level)
            .json(path, compression="gzip")
        )
        return
    first = (F.floor((F.col("pos") - 1) / rows_per_file) * rows_per_file + 1).alias("nFirstPos")
    arrays = (
        rows.groupBy("sFileName", first)
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.struct(*_texts(rows)).alias("row")))).alias("rows"))
        .select(
            "sFileName", "nFirstPos",
            F.to_json(F.transform("rows", lambda r: r["row"]), {"ignoreNullFields": "false"}).alias("value"),
        )
    )
    arrays.write.partitionBy("sFileName", "nFirstPos").text(path, compression="gzip")


def _of_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "length", F.md5("content").alias("md5")
    )


# The size is taken as a single-precision number, as it always was in the manifest.
def _kilobytes(length: Column) -> Column:
    return F.format_string("%.2f", length.cast("float").cast("double") / 1024.0)


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per written file: name, size in KB to two places, and the MD5 of its bytes."""
    return _of_files(spark, path).select(
        F.col("name").alias("sFileName"), _kilobytes(F.col("length")).alias("sFileSize"), F.col("md5").alias("sMD5Hashx")
    )


def batch_files(spark: SparkSession, path: str) -> DataFrame:
    """Per written batch: its size in KB, and the MD5 of its file's bytes.

    Of a batch in several files, the MD5 of the files' MD5s in the order of their paths, one per line. A
    batch of ten thousand files lists ten thousand hashes, no bytes.
    """
    of_batch = _of_files(spark, path).withColumn("sFileName", F.regexp_extract("path", r"sFileName=([^/]+)/", 1))
    files = of_batch.groupBy("sFileName").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("path", "md5"))).alias("files"))
    md5s = F.transform("files", lambda f: f["md5"])
    md5 = F.when(F.size("files") == 1, F.get("files", F.lit(0))["md5"]).otherwise(F.md5(F.array_join(md5s, "\n")))
    return files.select("sFileName", _kilobytes(F.col("length")).alias("sFileSize"), md5.alias("sMD5Hashx"))
