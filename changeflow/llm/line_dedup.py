"""Site-relative line dedup: lines that a large share of a site's pages carry are boilerplate.

Rows are grouped by host. The pages that hold a line, each counted once, are divided by the pages of
the host; a line above ``ratio`` that at least ``least_pages`` pages hold is dropped from all pages
of that host. Everything is DataFrame functions.

Plan. Lines are counted as 128-bit hashes, never as text. Counts are summed in each task before the
shuffle, so a line or host that a third of all rows hold sends one row per task. What is found becomes
one list for each host: as each of its lines is on more than ``ratio`` of the host's pages, it has at most
1 / ``ratio`` times as many entries as the host's average page has lines. The lists are stored, so
Spark knows their size: it broadcasts them when they are small, else it joins by host and splits hot
hosts, as the lists repeat for each part. Inside a row the lines found are then left out.

Cases: a null host is a host of its own; a null text has no lines and stays null; a text whose lines
all go becomes empty. Blank lines are never boilerplate and stay. Lines are compared without the white
space around them. Repeated rows count as so many pages. Other columns pass through; columns named
like the added ones are replaced.

With ``spare_copies``, where copies are still to be chosen among afterwards, a group of copies does not
make its own text boilerplate. Equal texts of a host are one page, in its pages too. What is found on them is
counted again, only on pages that stand alone: at least ``OWN`` percent of the characters of their different
lines are in lines not found. Near copies do not, as they share all but a few lines; so a line goes
for the sake of pages that differ otherwise, and then from every page. A text whose lines would all go stays
whole. The price: where fewer than ``least_pages`` pages of a host stand alone, its boilerplate stays. The
hashes of the lines of each different text are stored once for both counts, in place of a second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .common import row_of

#: A line is boilerplate on more than this share of a host's pages, and at least so many pages.
RATIO, LEAST_PAGES = 0.01, 5
#: Percent of a page's characters in lines of its own from which it stands alone; linked texts differ in less.
OWN = 20
ADDED = ("n_lines", "n_dropped")


def line_keys(text: Column) -> Column:
    """For each line two hashes of it trimmed, null for a blank one."""
    lines = F.split(text, "\n", -1)

    def key(line: Column) -> Column:
        trimmed = F.btrim(line, F.lit(" \t\n\v\f\r"))
        return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("h"), F.xxhash64(F.lit(1), trimmed).alias("g")))

    return F.transform(lines, key)


def common(lines: DataFrame, pages: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """For each host the list of the keys that so many of its pages hold; stored. Lines: one row for each page and key."""
    holding = lines.groupBy("_host", "_key").agg(F.count("*").alias("holding")).filter(F.col("holding") >= least_pages)
    found = holding.join(pages, "_host").filter(F.col("holding") > ratio * F.col("pages"))
    return settle(found.groupBy("_host").agg(F.collect_list("_key").alias("_drop")))


def common_beside_copies(rows: DataFrame, text: Column, ratio: float, least_pages: int) -> DataFrame:
    """As ``common`` over the different texts of each host, without what only copies have in common."""
    bare = F.transform(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\v\f\r"))))
    sized = F.transform(F.arrays_zip(line_keys(text).alias("key"), bare.alias("n")), lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n")))
    lines = F.array_distinct(F.filter(sized, lambda x: x["key"].isNotNull())).alias("_lines")
    whole = F.struct(F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")).alias("_text")
    different = settle(rows.select("_host", whole, lines).dropDuplicates(["_host", "_text"]).select("_host", "_lines"))

    pages = different.groupBy("_host").agg(F.count("*").alias("pages"))
    found = common(different.select("_host", F.explode("_lines.key").alias("_key")), pages, ratio, least_pages)

    def characters(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    held = F.filter("_lines", lambda x: F.array_contains("_drop", x["key"]))
    judged = different.join(found, "_host").select("_host", "_lines", held.alias("_held")).filter(F.size("_held") > 0)
    alone = judged.filter(100 * (characters(F.col("_lines")) - characters(F.col("_held"))) >= OWN * characters(F.col("_lines")))
    return common(alone.select("_host", F.explode("_held.key").alias("_key")), pages, ratio, least_pages)


def drop_boilerplate(
    documents: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, spare_copies: bool = False
) -> DataFrame:
    """All rows without the boilerplate lines of their host, with n_lines (before) and n_dropped."""
    names = [c for c in documents.columns if c not in ADDED]
    own = F.col("_text")
    rows = documents.select(
        F.struct(F.col(f"`{host}`").alias("name")).alias("_host"),
        F.col(f"`{text}`").cast("string").alias("_text"),
        row_of([c for c in names if c != text]),
    )
    if spare_copies:
        per_host = common_beside_copies(rows, own, ratio, least_pages)
    else:
        lines = rows.select("_host", F.explode(F.array_distinct(F.array_compact(line_keys(own)))).alias("_key"))
        per_host = common(lines, rows.groupBy("_host").agg(F.count("*").alias("pages")), ratio, least_pages)

    marked = rows.join(per_host, "_host", "left")
    dropped = F.coalesce(F.col("_drop"), F.array().cast(per_host.schema["_drop"].dataType))
    each = F.arrays_zip(F.split(own, "\n", -1).alias("line"), line_keys(own).alias("key"))
    marked = marked.withColumn("_each", F.when(F.size(dropped) > 0, each))
    keep = F.filter("_each", lambda x: x["key"].isNull() | ~F.array_contains(dropped, x["key"]))
    if spare_copies:
        keep = F.when(F.exists(keep, lambda x: x["key"].isNotNull()), keep).otherwise(F.col("_each"))
    marked = marked.withColumn("_keep", keep)
    cleaned = F.when(F.col("_each").isNull(), own).otherwise(F.array_join(F.transform("_keep", lambda x: x["line"]), "\n"))
    n_lines = F.when(own.isNull(), 0).otherwise(F.size(F.split(own, "\n", -1)))
    return marked.select(
        *[cleaned.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in names],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("_each") - F.size("_keep"), F.lit(0)).cast("long").alias("n_dropped"),
    )
