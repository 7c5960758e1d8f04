"""Patterns and expressions for the text of change statements: names, literals, and what lies where."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pieces of the patterns. Repeated groups are possessive, so that a long text takes no stack.
TICKED = r"`(?:[^`]++|``)++`"
NAME = rf"(?:{TICKED}|[\p{{L}}_$][\p{{L}}\p{{N}}_$]*+)"
COLUMN = rf"(?:{NAME}\s*+\.\s*+){{0,2}}{NAME}"
SINGLE, DOUBLE = r"'(?:[^'\\]++|\\.|'')*+'", r'"(?:[^"\\]++|\\.|"")*+"'
NUMBER = r"[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?"
VALUE = rf"(?:{SINGLE}|{DOUBLE}|{NUMBER}|(?:NULL|TRUE|FALSE)\b)"
PAIR = rf"{COLUMN}\s*+=\s*+{VALUE}"
PAIRS = rf"{PAIR}(?:\s*+,\s*+{PAIR})*+"
CONDITION = rf"(?:\(\s*+{PAIR}\s*+\)|{PAIR})"
CONDITIONS = rf"{CONDITION}(?:\s*+AND\b\s*+{CONDITION})*+"
NAMES = rf"{COLUMN}(?:\s*+,\s*+{COLUMN})*+"
TUPLE = rf"\(\s*+{VALUE}(?:\s*+,\s*+{VALUE})*+\s*+\)"

# Verbs and the words that may stand between verb and table.
VERBS = ("INSERT", "REPLACE", "UPDATE", "DELETE")
MODIFIERS = "LOW_PRIORITY|DELAYED|HIGH_PRIORITY|QUICK|IGNORE"

#: Verb, schema and table.
HEAD = rf"(?is)^\s*+({'|'.join(VERBS)})\s++(?:(?:{MODIFIERS})\s++)*+(?:INTO\s++|FROM\s++)?(?!(?:INTO|FROM|SET|VALUES?|WHERE)\b)(?:({NAME})\s*+\.\s*+)?({NAME})"
#: What follows: pairs, or names and tuples; then conditions.
BODY = (
    rf"(?is)^\s*+(?:SET\b\s*+({PAIRS})|\(\s*+({NAMES})\s*+\)\s*+VALUES?\b\s*+({TUPLE}(?:\s*+,\s*+{TUPLE})*+))?"
    rf"\s*+(?:WHERE\b\s*+({CONDITIONS}))?\s*+(?:LIMIT\s++1\b)?\s*+;?\s*+$"
)
PAIR_PARTS = rf"(?is)({COLUMN})\s*+=\s*+({VALUE})"
#: Quoted text and names; of a quote that nothing closes, all up to the end, with the quote as a group.
QUOTED = rf"(?is){SINGLE}|{DOUBLE}|{TICKED}|(['\"`]).*+"


def bare_name(name: Column) -> Column:
    """A name without back-ticks, of a qualified one the last part."""
    last = F.regexp_extract(name, rf"(?s)({NAME})$", 1)
    return F.when(last.startswith("`"), F.replace(last.substr(F.lit(2), F.length(last) - 2), F.lit("``"), F.lit("`"))).otherwise(last)


def plain_value(value: Column) -> Column:
    """What a literal stands for, as text; null for NULL.

    A doubled quote is one, and backslashes escape as usual in logged statements: ``\\%`` and ``\\_`` keep theirs.
    """
    quote = F.left(value, F.lit(1))
    inside = value.substr(F.lit(2), F.length(value) - 2)
    inside = F.when(quote == "'", F.replace(inside, F.lit("''"), F.lit("'"))).otherwise(F.replace(inside, F.lit('""'), F.lit('"')))

    def unescaped(part: Column) -> Column:
        for escape, meant in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ("\\b", "\b"), ("\\0", "\0"), ("\\Z", "\x1a")):
            part = F.replace(part, F.lit(escape), F.lit(meant))
        return F.regexp_replace(part, r"(?s)\\([^%_])", "$1")

    # Between escaped backslashes every other one begins an escape.
    inside = F.when(~inside.contains("\\"), inside).otherwise(F.array_join(F.transform(F.split(inside, r"\\\\"), unescaped), "\\"))
    word = F.upper(value)
    return (
        F.when(quote.isin("'", '"'), inside)
        .when(word == "NULL", F.lit(None).cast("string"))
        .when(word == "TRUE", "1")
        .when(word == "FALSE", "0")
        .otherwise(F.regexp_replace(value, r"^\+", ""))
    )


def map_text(texts: Column) -> Column:
    """A map as one text, ``name=value`` by name and joined by ``|``; a null value is a name alone."""
    entries = F.array_sort(F.map_entries(texts))
    return F.array_join(F.transform(entries, lambda e: F.coalesce(F.concat(e["key"], F.lit("="), e["value"]), e["key"])), "|")
