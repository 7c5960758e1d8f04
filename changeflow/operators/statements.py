"""From the text of a logged statement to typed changes.

The log holds the statements that changed a row: INSERT, REPLACE, UPDATE or DELETE with plain values, in
which a key is named by equality. They are cut by patterns, never run: ``parse_statements`` gives table, values
and key of each, or the reason why it cannot; ``table_changes`` turns those of one table into its columns;
``net_changes`` folds all changes of a key into one, which ``apply_net`` brings into the table.
All of it is made of built-in functions, inside one pass over the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.statement_text import BODY, COLUMN, HEAD, PAIR_PARTS, PAIRS, QUOTED, TUPLE, VALUE, VERBS, bare_name, plain_value
from ..session import settle
from .ingest import apply_changes

TEXTS = T.MapType(T.StringType(), T.StringType())


def _distinct(names: Column) -> Column:
    return F.size(F.array_distinct(F.transform(names, F.lower))) == F.size(names)


def _names(text: Column, pattern: str, group: int) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), bare_name)


def _values(text: Column, pattern: str, group: int) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), plain_value)


def parse_statements(log: DataFrame, statement: str = "sStatemnt") -> DataFrame:
    """Each change that the statements make: the log's row with verb, schema, table, values and key, or with the reason.

    ``nPartxxxx`` counts the tuples of one VALUES list from 1; all else has one part. ``mValuesxx`` maps columns to
    values as text, ``mKeyxxxxx`` the columns of the condition. ``sProblemx`` is null where both are good, and else

    - ``verb``, ``table``: no statement of the four kinds, or no table in it;
    - ``open quote``, ``several statements``, ``on duplicate``;
    - ``value``: something else than a literal, as a function or another column, or no values at all;
    - ``columns``: a column twice, none named, or another number of values than of columns;
    - ``no key``, ``condition``: an UPDATE or DELETE of rows that are not named by equality of columns and values.

    A null statement has the problem ``verb``. Names keep their letters' case.
    """
    text = F.coalesce(F.col(statement), F.lit(""))
    head = F.regexp_extract(text, HEAD, 0)
    rows = log.withColumns({"_head": head, "_rest": F.when(head != "", text.substr(F.length(head) + 1, F.length(text))).otherwise(text)})
    sound = F.regexp_like("_rest", F.lit(BODY))
    rows = rows.withColumns({
        "sVerbxxxx": F.upper(F.regexp_extract("_head", HEAD, 1)),
        "sSchemaxx": F.nullif(bare_name(F.regexp_extract("_head", HEAD, 2)), F.lit("")),
        "sTargetTb": F.nullif(bare_name(F.regexp_extract("_head", HEAD, 3)), F.lit("")),
        "_sound": (head != "") & sound,
        **{name: F.when(sound, F.regexp_extract("_rest", BODY, i)).otherwise("") for i, name in enumerate(("_sets", "_names", "_tuples", "_where"), 1)},
    })

    inserts, narrows = F.col("sVerbxxxx").isin("INSERT", "REPLACE"), F.col("sVerbxxxx").isin("UPDATE", "DELETE")
    sets, tuples, where = (F.col(c) != "" for c in ("_sets", "_tuples", "_where"))
    unquoted = F.regexp_replace(text, QUOTED, "?$1")
    rest = F.regexp_replace("_rest", QUOTED, "?$1")
    fits = F.regexp_like("_rest", F.lit(rf"(?is)^\s*+(?:SET\b\s*+{PAIRS})?\s*+(?:WHERE\b.*+)?$"))
    by_text = (
        F.when(~F.regexp_like(text, F.lit(rf"(?is)^\s*+(?:{'|'.join(VERBS)})\b")), "verb")
        .when(unquoted.rlike("['\"`]"), "open quote")
        .when(unquoted.rlike(r"(?s);\s*+\S"), "several statements")
        .when(F.col("_head") == "", "table")
        .when(rest.rlike(r"(?is)\bON\s+DUPLICATE\b"), "on duplicate")
        .when(inserts & rest.rlike(r"(?is)^\s*+VALUES?\b"), "columns")
        .when(narrows & fits, "condition")
        .otherwise("value")
    )
    by_form = (
        F.when(inserts & where | inserts & ~sets & ~tuples, "value")
        .when((F.col("sVerbxxxx") == "UPDATE") & (tuples | ~sets) | (F.col("sVerbxxxx") == "DELETE") & (tuples | sets), "value")
        .when(narrows & ~where, "no key")
    )
    rows = rows.withColumn("_problem", F.when(~F.col("_sound"), by_text).otherwise(by_form))

    # Names once, values by tuple; a statement with a problem is one part without either.
    columns = F.when(tuples, _names(F.col("_names"), rf"(?is){COLUMN}", 0)).otherwise(_names(F.col("_sets"), PAIR_PARTS, 1))
    one = F.array(_values(F.col("_sets"), PAIR_PARTS, 2))
    many = F.transform(F.regexp_extract_all("_tuples", F.lit(rf"(?is){TUPLE}"), F.lit(0)), lambda each: _values(each, rf"(?is){VALUE}", 0))
    none = F.array(F.array().cast("array<string>"))
    parts = F.when(F.col("_problem").isNotNull(), none).when(tuples, many).otherwise(one)
    rows = rows.withColumns({"_columns": columns, "_keys": _names(F.col("_where"), PAIR_PARTS, 1), "_known": _values(F.col("_where"), PAIR_PARTS, 2)})
    rows = rows.select("*", F.posexplode(parts).alias("_part", "_values"))
    problem = (
        F.when(F.col("_problem").isNotNull(), F.col("_problem"))
        .when((F.size("_values") != F.size("_columns")) | ~_distinct(F.col("_columns")), "columns")
        .when(~_distinct(F.col("_keys")) | F.exists("_known", F.isnull), "condition")
    )
    good = F.col("sProblemx").isNull()
    return (
        rows.withColumn("sProblemx", problem)
        .withColumn("mValuesxx", F.when(good, F.map_from_arrays("_columns", "_values")).cast(TEXTS))
        .withColumn("mKeyxxxxx", F.when(good, F.map_from_arrays("_keys", "_known")).cast(TEXTS))
        .select(
            *[F.col(f"`{c}`") for c in log.columns], (F.col("_part") + 1).alias("nPartxxxx"),
            "sVerbxxxx", "sSchemaxx", "sTargetTb", "mValuesxx", "mKeyxxxxx", "sProblemx",
        )
    )


def table_changes(parsed: DataFrame, table: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """Changes of one table, typed: the columns of ``schema``, ``aGivenxxx`` (the columns that a change names), ``sKindxxxx``
    (set, alter or drop), dModified, sTransNox, nPartxxxx and ``sProblemx``.

    Table and columns are found whatever their letters' case. An INSERT or REPLACE sets a whole row, columns that it does not name
    are null; an UPDATE alters the row of its key; a DELETE drops it. What was wrong with the text stays, and further problems are

    - ``unknown column``: one that the schema lacks;
    - ``key``: no or a null key, one of other columns than ``keys``, or an UPDATE that changes the key;
    - ``type``: a value that its column's type cannot hold.
    """
    folded = {f.name.lower(): f for f in schema.fields}
    own = parsed.filter(F.lower("sTargetTb") == table.lower())
    lower = lambda m: F.transform_keys(F.coalesce(F.col(m), F.create_map().cast(TEXTS)), lambda k, _: F.lower(k))
    own = own.withColumns({"_set": lower("mValuesxx"), "_at": lower("mKeyxxxxx")})
    narrows = F.col("sVerbxxxx").isin("UPDATE", "DELETE")
    own = own.withColumn("_all", F.when(narrows, F.map_concat(F.map_filter("_set", lambda k, _: ~F.array_contains(F.map_keys("_at"), k)), "_at")).otherwise(F.col("_set")))
    known = F.array(*[F.lit(k.lower()) for k in keys])
    typed = {f.name: F.col("_all")[low].try_cast(f.dataType) for low, f in folded.items()}
    named = F.map_keys("_all")
    misfits = [F.col("_all")[low].isNotNull() & typed[f.name].isNull() for low, f in folded.items()]
    misfit = F.array_contains(F.array(*misfits), True)
    same_key = F.size(F.array_except(F.map_keys("_at"), known)) + F.size(F.array_except(known, F.map_keys("_at"))) == 0
    changed = F.exists(F.map_keys("_set"), lambda k: F.array_contains(known, k))
    keyless = F.exists(known, lambda k: F.col("_all")[k].isNull())
    problem = (
        F.when(F.col("sProblemx").isNotNull(), F.col("sProblemx"))
        .when(F.size(F.array_except(named, F.array(*map(F.lit, folded)))) > 0, "unknown column")
        .when(keyless | narrows & (~same_key | changed), "key")
        .when(misfit, "type")
    )
    kind = F.when(F.col("sVerbxxxx") == "UPDATE", "alter").when(F.col("sVerbxxxx") == "DELETE", "drop").otherwise("set")
    given = F.array_compact(F.array(*[F.when(F.array_contains(named, low), F.lit(f.name)) for low, f in folded.items()]))
    return own.select(
        *[typed[f.name].alias(f.name) for f in schema.fields], given.alias("aGivenxxx"), kind.alias("sKindxxxx"),
        "dModified", "sTransNox", "nPartxxxx", problem.alias("sProblemx"),
    )


def net_changes(changes: DataFrame, schema: T.StructType, keys: list[str]) -> DataFrame:
    """What all changes of a key come to, by (dModified, sTransNox, nPartxxxx): one row for each key.

    The last setting or dropping counts (``sKindxxxx`` set or drop, or alter where there was neither), and of each column the last
    altering after it. One aggregate does it, which combines inside every task first, so a key with many changes costs no more
    than others. Altering a dropped row changes nothing. Changes with a problem take no part.
    """
    values = [f.name for f in schema.fields if f.name not in keys]
    order = F.struct("dModified", "sTransNox", "nPartxxxx")
    usable = changes.filter(F.col("sProblemx").isNull()).withColumn("_order", order)
    whole = F.max(F.when(F.col("sKindxxxx") != "alter", F.struct("_order", "sKindxxxx", *[F.col(v) for v in values]))).alias("_whole")

    def last(name: str) -> Column:
        gives = (F.col("sKindxxxx") == "alter") & F.array_contains("aGivenxxx", name)
        return F.max(F.when(gives, F.struct("_order", F.col(name).alias("value")))).alias(f"_last_{name}")

    net = usable.groupBy(*keys).agg(whole, *[last(v) for v in values])
    kind = F.coalesce(F.col("_whole.sKindxxxx"), F.lit("alter"))

    def after(name: str) -> Column:
        altered = F.col(f"_last_{name}")
        return altered.isNotNull() & (F.col("_whole").isNull() | (altered["_order"] > F.col("_whole._order")))

    given = F.array_compact(F.array(*[F.when(after(v), F.lit(v)) for v in values]))
    merged = [F.when(after(v), F.col(f"_last_{v}.value")).otherwise(F.col(f"_whole.{v}")).alias(v) for v in values]
    return net.select(*keys, *merged, kind.alias("sKindxxxx"), given.alias("aGivenxxx"))


def apply_net(target: DataFrame, net: DataFrame, keys: list[str]) -> DataFrame:
    """New target, by ``apply_changes``: rows set and dropped by key, and those altered that are there.

    Keys that are only altered meet the target's row in a join, in which the net changes are the small side; the target is not
    shuffled while they can be broadcast. Target keys are unique and not null.
    """
    net = settle(net)
    altered = net.filter("sKindxxxx = 'alter'").select(*keys, F.struct(*[F.col(c) for c in net.columns if c not in keys]).alias("_net"))
    values = [c for c in target.columns if c not in keys]
    overlaid = [F.when(F.array_contains("_net.aGivenxxx", v), F.col(f"_net.{v}")).otherwise(F.col(v)).alias(v) for v in values]
    rows = target.join(altered, keys).select(*keys, *overlaid, F.lit("upsert").alias("sActionxx"))
    whole = net.filter("sKindxxxx <> 'alter'").select(*keys, *values, F.when(F.col("sKindxxxx") == "set", "upsert").otherwise("delete").alias("sActionxx"))
    # One change for each key, so its place in the order does not matter.
    changes = rows.unionByName(whole).withColumns({"dModified": F.lit(0), "sTransNox": F.lit("")})
    return apply_changes(target, changes, keys).select(*target.columns)


def apply_statements(target: DataFrame, parsed: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """New target after all parsed statements of its table, in their order; those with a problem are left out."""
    return apply_net(target, net_changes(table_changes(parsed, table, target.schema, keys), target.schema, keys), keys)
