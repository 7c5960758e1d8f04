"""WARC archives of pages with a two-level capture index.

Level one is a list of captures sorted by the page's URL with its host reversed, cut into blocks of
``LINES`` lines that are compressed one by one. Level two is a sparse directory: the first key of each
block, and where the block lies. A lookup searches the directory, then the lines of one block, by
bisection, and reads the record's bytes only.

Of pages with equal payloads of at least ``LEAST_BYTES`` bytes, the one with the smallest page_id is
stored as a response, others as revisits that name it. Each record is a gzip member of its own.

Plan. Payload digests are summed per task before they are shuffled, and only those that occur more
than once are joined back; that join is Spark's, which broadcasts or splits hot digests. Pages are then
range-partitioned by key, so one task writes one archive with its part of the index, in key order, and
a host that holds a third of all pages is spread over many. Reading everything back goes block by
block and reads neighbouring records in one piece. Files lie in the shared folder and have the number
of the task's attempt in their names, so a task that runs again never touches what another wrote; only
files named in the directory count.

Cases: a null html is an empty payload, a null url an empty key. Rows without a page_id are responses
and never referred to, as are all payloads below the bound. Repeated rows are records of their own,
of which none is a revisit of another with its own page_id. Control characters in a URL are written
percent-encoded. Other columns are not stored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, settle
from .common import prepare

#: Lines of an index block, fewest bytes of a payload that is revisited, bytes read in one piece.
LINES, LEAST_BYTES, SPAN = 1000, 100, 1 << 22
#: Blocks that one task reads at most, about.
BLOCKS = 64
#: zlib's level for records and blocks.
LEVEL = 3
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DIRECTORY = "first_key string, last_key string, archive string, index string, offset bigint, length bigint, n_lines int"


def surt(url: Column) -> Column:
    """A URL as a sort key: the host's labels reversed, then port, path and query; scheme, user and fragment go."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#]*)([^#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    host, rest = F.lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def capture_key(url: Column, page_id: Column) -> Column:
    """The key of a capture: sorts by URL, then by page_id; unlike for different pages."""
    number = (page_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")
    return F.concat(surt(url), F.lit(" "), F.coalesce(F.lpad(number, 20, "0"), F.lit("")))


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to and refers_to_url (null for responses)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    large = rows.filter((F.col("payload_bytes") >= LEAST_BYTES) & F.col("page_id").isNotNull())
    firsts = large.groupBy("payload_digest").agg(F.min(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("first"), F.count("*").alias("n"))
    firsts = settle(firsts.filter("n > 1").drop("n"))
    told = rows.join(firsts, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= LEAST_BYTES) & (F.col("first.page_id") < F.col("page_id"))
    return told.select(
        "page_id", "url", F.when(~F.coalesce(revisit, F.lit(False)), F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("first.page_id")).alias("refers_to"), F.when(revisit, F.col("first.url")).alias("refers_to_url"),
    )


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def record_id(page_id: int | None, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {key}')}>"


def record(row: dict, date: str) -> bytes:
    """A WARC record: a response with the payload, or a revisit without."""

    def plain(url: str | None) -> str:
        return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or "")

    revisit = row["refers_to"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = http + b"\r\n" if revisit else http + f"Content-Length: {row['payload_bytes']}\r\n\r\n".encode() + row["payload"]
    head = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(row['page_id'], row['key'])}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {plain(row['url'])}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Target-URI: {plain(row['refers_to_url'])}", f"X-Refers-To-Page-Id: {row['refers_to']}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of a record by lower-case name, and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    return fields, rest[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives and index blocks of all pages into the folder; the directory, stored."""
    prepare(pages.sparkSession)
    rows = with_revisits(pages).withColumn("key", capture_key(F.col("url"), F.col("page_id")))
    rows = rows.repartitionByRange("key").sortWithinPartitions("key")
    names = [part.split()[0] for part in DIRECTORY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = place(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{root}/{task.partitionId():06d}-{task.taskAttemptId()}"
        archive = index = None
        blocks, lines, at, index_at = [], [], 0, 0
        try:

            def close_block() -> None:
                nonlocal lines, index_at
                packed = gzip.compress("\n".join(x for _, x in lines).encode(), LEVEL, mtime=0)
                index.write(packed)
                blocks.append((lines[0][0], lines[-1][0], f"{name}.warc.gz", f"{name}.cdx.gz", index_at, len(packed), len(lines)))
                index_at += len(packed)
                lines = []

            for batch in batches:
                for some in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                    for row in some.to_pylist():
                        if archive is None:
                            archive, index = files.open_output_stream(f"{name}.warc.gz", compression=None), files.open_output_stream(f"{name}.cdx.gz", compression=None)
                        packed = gzip.compress(record(row, date), LEVEL, mtime=0)
                        archive.write(packed)
                        lines.append((row["key"], f"{at} {len(packed)} {row['key'].encode().hex()}"))
                        at += len(packed)
                        if len(lines) == LINES:
                            close_block()
            if lines:
                close_block()
        finally:
            for file in (archive, index):
                if file is not None:
                    file.close()
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("offset", "length") else pa.int32() if n == "n_lines" else pa.string()) for n, c in zip(names, zip(*blocks))], names=names)

    return settle(rows.mapInArrow(run, DIRECTORY))


def block_lines(files: fs.FileSystem, index: str, offset: int, length: int) -> list[tuple[str, int, int]]:
    """The captures of a block: key, and where the record lies in the archive."""
    with files.open_input_file(index) as file:
        text = zlib.decompress(file.read_at(length, offset), 31).decode()
    lines = (line.split(" ") for line in text.split("\n"))
    return [(bytes.fromhex(key).decode(), int(at), int(n)) for at, n, key in lines]


def record_row(data: bytes, payload: bool) -> dict:
    fields, body = parsed(zlib.decompress(data, 31))
    revisit = fields["warc-type"] == "revisit"
    number = {k: int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id")}
    return {
        "page_id": number["x-page-id"], "url": fields["warc-target-uri"], "record_type": fields["warc-type"],
        "payload_bytes": None if revisit else len(body), "payload_digest": None if revisit else hashlib.sha256(body).hexdigest(),
        "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
        "refers_to": number["x-refers-to-page-id"], "refers_to_url": fields.get("warc-refers-to-target-uri"),
        "payload": body if payload and not revisit else None,
    }


_KINDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "stated_digest": pa.string(), "refers_to": pa.int64(), "refers_to_url": pa.string(), "payload": pa.binary()}
RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, stated_digest string, refers_to bigint, refers_to_url string, payload binary")


def read_all(directory: DataFrame, payload: bool = False) -> DataFrame:
    """Every record, through the index: RECORD. ``payload_digest`` is that of the bytes read, null for revisits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                files, _ = place(block["archive"])
                lines = block_lines(files, block["index"], block["offset"], block["length"])
                with files.open_input_file(block["archive"]) as file:
                    first = 0
                    while first < len(lines):
                        begin, last = lines[first][1], first
                        while last < len(lines) and lines[last][1] + lines[last][2] - begin <= max(SPAN, lines[first][2]):
                            last += 1
                        data = file.read_at(lines[last - 1][1] + lines[last - 1][2] - begin, begin)
                        rows = [record_row(data[at - begin : at - begin + n], payload) for _, at, n in lines[first:last]]
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_KINDS.items())))
                        first = last

    blocks = directory.select("archive", "index", "offset", "length")
    return blocks.repartition(reading_tasks(directory), "index", "offset").mapInArrow(run, RECORD)


def reading_tasks(directory: DataFrame) -> int:
    """Tasks that read archives: as many as a shuffle has, more where each would get over ``BLOCKS`` blocks, never more than blocks.

    The directory is tiny beside the archives that it stands for: a number that Spark took from its size would be one.
    """
    blocks = max(1, directory.count())
    usual = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(blocks, max(usual, -(-blocks // BLOCKS)))


def lookup(directory: DataFrame, captures: DataFrame, payload: bool = False) -> DataFrame:
    """Records of captures (url, page_id): the directory and one block are searched by bisection, then one range is read.

    A capture goes to the archive in whose range of keys it lies. The bounds of the archives, one
    row for each archive, are all that every task gets. Unknown captures give no row.
    """
    bounds = directory.groupBy("archive").agg(F.min("first_key").alias("first")).orderBy("first").collect()
    firsts, archives = [r["first"] for r in bounds], [r["archive"] for r in bounds]
    keys = captures.select(capture_key(F.col("url"), F.col("page_id").cast("long")).alias("key")).distinct()

    @F.pandas_udf("string")
    def archive_of(key: pd.Series) -> pd.Series:
        at = [bisect.bisect_right(firsts, k) - 1 for k in key]
        return pd.Series([archives[i] if i >= 0 else None for i in at], dtype=object)

    def find(blocks: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(blocks) and len(wanted):
            blocks = blocks.sort_values("first_key")
            first_keys = blocks["first_key"].tolist()
            files, _ = place(blocks["archive"].iloc[0])
            open_block, lines = -1, []
            with files.open_input_file(blocks["archive"].iloc[0]) as file:
                for key in sorted(wanted["key"]):
                    if (block := bisect.bisect_right(first_keys, key) - 1) < 0:
                        continue
                    if block != open_block:
                        found = blocks.iloc[block]
                        open_block, lines = block, block_lines(files, found["index"], int(found["offset"]), int(found["length"]))
                    at = bisect.bisect_left(lines, (key,))
                    if at < len(lines) and lines[at][0] == key:
                        rows.append(record_row(file.read_at(lines[at][2], lines[at][1]), payload))
        return pd.DataFrame(rows, columns=list(_KINDS)).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    placed = keys.withColumn("archive", archive_of("key")).filter("archive IS NOT NULL")
    # Both sides are dealt into the same given number of tasks, so the cogroup keeps it.
    tasks = reading_tasks(directory)
    blocks, placed = directory.repartition(tasks, "archive"), placed.repartition(tasks, "archive")
    return blocks.groupBy("archive").cogroup(placed.groupBy("archive")).applyInPandas(find, RECORD)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's payload is that of the record it refers to, which is looked up in the index.
    """
    spark: SparkSession = pages.sparkSession
    directory = write(pages, folder or new_folder(spark, "archives"))
    records = settle(read_all(directory).drop("payload", "url"))
    targets = records.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), F.col("refers_to_url").alias("url")).distinct()
    found = settle(lookup(directory, targets).select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")))
    out = records.join(found.dropDuplicates(["refers_to"]), "refers_to", "left")
    return out.select(
        "page_id", F.coalesce("payload_bytes", "n").alias("payload_bytes"), F.coalesce("payload_digest", "d").alias("payload_digest"),
        "record_type", "refers_to",
    )
