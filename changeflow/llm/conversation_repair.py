"""Repair of conversations' structure at least cost: which turns to keep, rerole, delete or insert.

A repaired conversation's roles, by their initials, are ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turns. Keeping a turn costs 0, giving it the role user or assistant 3, deleting it 4, inserting an empty
user or assistant turn 3; a truncated turn that is not deleted costs 3 more; blank and duplicate turns must go. Of
the cheapest edits those whose initials (D, I, K, R) come first in ASCII are taken.

Method: dynamic programming over a grammar. The pattern's automaton has four states; a turn is one of twelve symbols
(role s, u, a or other; sound, truncated or to be deleted) with a *transfer matrix*: for each pair of states the least
cost of bringing the automaton from one to the other, and the edits that do it (the audit). Matrices multiply by
min-plus, and as equally dear audits of the same turns are never prefixes of each other, the least audit of a whole is
made of least audits of its parts. So matrices of parts can be computed once and shared:

1. Conversations are cut into segments of ``SEGMENT`` turns, each a word of symbols; equal words are one.
2. Re-Pair compresses the distinct words, weighted by how often they occur: the most frequent pairs of neighbours
   become new symbols, some pairs without common symbols in each of ``ROUNDS`` passes. Only the pairs at the top
   come to the driver.
3. A matrix for each rule is evaluated bottom-up, its audits being ropes over those of its two halves, then one for
   each distinct word, and every segment takes that of its word.
4. Matrices of longer conversations multiply in a tree, ``TOGETHER`` neighbours at a time, so that a conversation
   with a third of all turns is no task's burden; only its audit, a value of the result, grows with it.

The audit goes back to the turns by segments, and gives the repaired ones. ``text_digests`` reads them in order, a row
at a time; the digest of one conversation is sequential by its definition.

Cases: null roles and texts are one space. Turns ascend, null ones first; rows alike in turn by role, then by the
SHA-256 of their text; rows alike in all are duplicates after the first. Null ids are one conversation. Conversations
without rows have none in the result. Roles with another initial (or none) must go or be reroled. Empty tables give
empty results. Columns other than the four named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import dense_position
from ..session import settle
from .common import map_batches, prepare

#: Turns of a word.
SEGMENT = 64
#: Matrices of a conversation that are multiplied by one call.
TOGETHER = 16
#: Passes of Re-Pair, and pairs looked at in each.
ROUNDS, PAIRS = 8, 16

# What separates words, what ends a sentence, and what the edits cost.
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

STATES = range(4)  # nothing yet, behind s, behind u, behind a
ACCEPTED = (0, 3)
#: Edits spelled so that they name the role too, in the order of their initials: I and J insert, R and S rerole to user and assistant.
INSERTS, ROWS = "IJ", "DKRS"
USER, ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
KEPT = {"s": {0: 1}, "u": USER, "a": ASSISTANT, "o": {}}
KINDS = ("sound", "truncated", "gone")

Rope = tuple | str
Matrix = list[list[tuple[int, Rope] | None]]


def letters(rope: Rope) -> Iterator[str]:
    """The strings of a rope from left to right."""
    pending = [rope]
    while pending:
        part = pending.pop()
        if isinstance(part, str):
            yield part
        else:
            pending += (part[1], part[0])


def first_of(a: Rope, b: Rope) -> Rope:
    """The lesser of two ropes, neither of which is the beginning of the other unless they are equal."""
    if a is b:
        return a
    x, y = letters(a), letters(b)
    one = two = ""
    while True:
        one = one or next(x, "")
        two = two or next(y, "")
        if not one or not two:
            return a
        common = min(len(one), len(two))
        if one[:common] != two[:common]:
            return a if one[:common] < two[:common] else b
        one, two = one[common:], two[common:]


def joined(a: Rope, b: Rope) -> Rope:
    return (a, b) if a and b else a or b


def product(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus: the cheapest way from state to state over both parts, the least audit on ties."""
    out: Matrix = [[None] * len(STATES) for _ in STATES]
    for p in STATES:
        for middle, one in enumerate(left[p]):
            if one is None:
                continue
            for q, two in enumerate(right[middle]):
                if two is None:
                    continue
                cost, best = one[0] + two[0], out[p][q]
                if best is None or cost < best[0]:
                    out[p][q] = (cost, joined(one[1], two[1]))
                elif cost == best[0]:
                    out[p][q] = (cost, first_of(best[1], joined(one[1], two[1])))
    return out


def inserting() -> Matrix:
    """Any number of inserted turns."""
    out: Matrix = [[None] * len(STATES) for _ in STATES]
    for p in STATES:
        state, audit = p, ""
        while out[p][state] is None:
            out[p][state] = (INSERT * len(audit), audit)
            audit += INSERTS[state == 2]
            state = ASSISTANT.get(state) or USER[state]
    return out


def editing(role: str, kind: str) -> Matrix:
    """One turn and the inserted ones behind it."""
    out: Matrix = [[None] * len(STATES) for _ in STATES]
    for p in STATES:
        out[p][p] = (DELETE, "D")
        if kind != "gone":
            more = TRUNCATED if kind == "truncated" else 0
            for edit, cost, moves in (("S", REROLE, ASSISTANT), ("R", REROLE, USER), ("K", 0, KEPT[role])):
                if p in moves:
                    out[p][moves[p]] = (cost + more, edit)
    return product(out, inserting())


def symbol_of(role: Column, kind: Column) -> Column:
    """A letter for each role and kind."""
    roles, kinds = F.array(*map(F.lit, KEPT)), F.array(*map(F.lit, KINDS))
    return F.char(F.lit(64) + (F.array_position(roles, role) - 1) * len(KINDS) + F.array_position(kinds, kind))


def rule_symbol(rule: int) -> str:
    return chr(0xE000 + rule)  # private use: 6400 of them


class Evaluator:
    """Matrices of symbols and rules, bottom-up, and of words."""

    def __init__(self, rules: list[str]):
        made = [editing(role, kind) for role in KEPT for kind in KINDS]
        self.matrices = {chr(65 + i): m for i, m in enumerate(made)}
        for i, pair in enumerate(rules):
            self.matrices[rule_symbol(i)] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def word(self, word: str) -> Matrix:
        out = self.matrices[word[0]]
        for symbol in word[1:]:
            out = product(out, self.matrices[symbol])
        return out


_ENTRY = T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
_MATRIX = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _flat(matrix: Matrix) -> list[dict | None]:
    return [e and {"cost": e[0], "audit": "".join(letters(e[1]))} for row in matrix for e in row]


def _square(entries: list[dict | None]) -> Matrix:
    n = len(STATES)
    return [[e and (e["cost"], e["audit"]) for e in entries[i : i + n]] for i in range(0, n * n, n)]


def pair_counts(word: str) -> Counter:
    """How often each pair of neighbours can be replaced in a word: pairs of one symbol do not overlap."""
    found, last, i = Counter(), None, 0
    for i in range(len(word) - 1):
        pair = word[i : i + 2]
        if pair == last and pair[0] == pair[1]:
            last = None
            continue
        found[pair] += 1
        last = pair
    return found


def grammar(words: DataFrame) -> list[str]:
    """Re-Pair over distinct words (``word``, ``n``): the rules, each a pair of symbols, made of earlier ones."""
    rules: list[str] = []

    def counted(batch: pa.RecordBatch) -> dict:
        total = Counter()
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for pair, times in pair_counts(word).items():
                total[pair] += n * times
        return {"pair": pa.array(list(total), pa.string()), "times": pa.array(list(total.values()), pa.int64())}

    for _ in range(ROUNDS):
        pairs = map_batches(words.select(compressed(F.col("word"), rules).alias("word"), "n"), counted, "pair string, times bigint")
        top = pairs.groupBy("pair").agg(F.sum("times").alias("times")).filter("times > 1").orderBy(F.desc("times"), "pair").limit(PAIRS).collect()
        taken: set[str] = set()
        for row in top:
            if not taken & set(row.pair):
                taken |= set(row.pair)
                rules.append(row.pair)
        if not top:
            break
    return rules


def compressed(word: Column, rules: list[str]) -> Column:
    """A word in the symbols of the grammar."""
    for i, pair in enumerate(rules):
        word = F.replace(word, F.lit(pair), F.lit(rule_symbol(i)))
    return word


def evaluated(words: DataFrame, rules: list[str]) -> DataFrame:
    """Distinct words with their ``matrix``, by the rules' matrices."""

    def work(batch: pa.RecordBatch) -> dict:
        evaluator = Evaluator(rules)
        return {"word": batch.column(0), "matrix": pa.array([_flat(evaluator.word(w)) for w in batch.column(1).to_pylist()], _MATRIX)}

    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("matrix", T.ArrayType(_ENTRY))])
    return map_batches(words.select("word", compressed(F.col("word"), rules).alias("_short")), work, schema)


def multiplied(parts: DataFrame) -> DataFrame:
    """One matrix for each conversation, of ``_conv``, ``_segment`` and ``matrix``, by a tree of products."""
    schema = T.StructType([parts.schema["_conv"], T.StructField("_segment", T.LongType()), parts.schema["matrix"]])

    def multiply(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["_segment"].to_pylist(), table["matrix"].to_pylist()))
        out = _square(rows[0][1])
        for _, entries in rows[1:]:
            out = product(out, _square(entries))
        return pa.table({"_conv": [key[0].as_py()], "_segment": [key[1].as_py()], "matrix": pa.array([_flat(out)], _MATRIX)})

    last = parts.agg(F.max("_segment")).first()[0] or 0
    if not last:
        return parts
    # Only conversations of several segments are multiplied.
    longer = settle(parts.filter("_segment > 0").select("_conv").distinct())
    products = parts.join(longer, "_conv", "left_semi")
    while last:
        products = products.groupBy("_conv", F.expr(f"_segment div {TOGETHER}L").alias("_group")).applyInArrow(multiply, schema)
        last //= TOGETHER
    return parts.join(longer, "_conv", "left_anti").unionByName(products)


def cheapest(matrix: Column) -> Column:
    """Cost and least audit of a whole conversation: from nothing, perhaps inserting first, to an accepted state."""
    before = inserting()[0]
    ways = [
        F.struct((matrix[p * len(STATES) + q]["cost"] + lead[0]).alias("cost"), F.concat(F.lit(lead[1]), matrix[p * len(STATES) + q]["audit"]).alias("audit"))
        for p, lead in enumerate(before) if lead is not None for q in ACCEPTED
    ]
    return F.array_min(F.filter(F.array(*ways), lambda way: way["cost"].isNotNull()))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with a fault in every fifth row or so, by the checksum of conversation and turn: a test of ``repair``.

    0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = (F.crc32(key.cast("binary")) % 20).alias("_fault")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), fault)
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter("_fault <> 0").withColumns({"text": text, "role": F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))})
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy", "_fault")


@dataclass
class Repaired:
    """``reports`` has a row for each conversation, ``messages`` the repaired turns in the order of ``place`` and ``part``."""

    reports: DataFrame
    messages: DataFrame


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Reports: the conversation's id, gaps, blank, duplicate, truncated, illegal, cost and audit. Messages: id, place, part, role, text."""
    prepare(conversations.sparkSession)
    given = [F.col(f"`{c}`") for c in (conv, turn, role, text)]
    # A text that is never null stands for the id.
    rows = settle(
        conversations.select(
            F.coalesce(F.concat(F.lit("="), given[0].cast("string")), F.lit("")).alias("_conv"),
            given[0].alias("_id"),
            given[1].alias("_turn"),
            F.coalesce(given[2].cast("string"), F.lit(" ")).alias("_role"),
            F.coalesce(given[3].cast("string"), F.lit(" ")).alias("_text"),
        )
    )
    rows = rows.withColumns({"_digest": F.unhex(F.sha2("_text", 256)), "_tie": F.monotonically_increasing_id()})
    rows = dense_position(rows, ["_conv"], "_turn", ["_role", "_digest", "_tie"], name="_place")
    rows = rows.withColumns({"_place": F.col("_place") - 1, "_segment": F.expr(f"(_place - 1) div {SEGMENT}L")})

    # Faults; the first row of each role and text is found by an aggregate, which no hot text keeps in one task.
    said = F.rtrim("_text", F.lit(SPACES))
    states = rows.select(
        "_conv", "_segment", "_place", "_role", "_digest", (said == "").alias("_blank"),
        (~F.right(said, F.lit(1)).isin(*".!?")).alias("_cut"),
    )
    first = states.groupBy("_conv", "_role", "_digest").agg(F.min("_place").alias("_first"))
    states = states.join(first, ["_conv", "_role", "_digest"])
    again = ~F.col("_blank") & (F.col("_first") < F.col("_place"))
    truncated = ~F.col("_blank") & ~again & F.col("_cut")
    initial = F.substring("_role", 1, 1)
    role_class = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    kind = F.when(F.col("_blank") | again, "gone").when(truncated, "truncated").otherwise("sound")
    states = states.select("_conv", "_segment", "_place", role_class.alias("_class"), symbol_of(role_class, kind).alias("_symbol"),
                           F.col("_blank").alias("blank"), again.alias("duplicate"), truncated.alias("truncated"))

    # The last turn of a segment is seen by the next one as well, for the pair of neighbours between them.
    seen_by = F.when((F.col("_place") + 1) % SEGMENT == 0, F.array("_segment", F.col("_segment") + 1)).otherwise(F.array("_segment"))
    states = states.withColumn("_by", F.explode(seen_by)).withColumn("_own", F.col("_by") == F.col("_segment"))
    count = lambda name: F.count_if(F.col("_own") & F.col(name)).alias(name)
    row = F.struct("_place", "_class", F.when(F.col("_own"), F.col("_symbol")).otherwise("").alias("_symbol"))
    words = states.groupBy("_conv", F.col("_by").alias("_segment")).agg(
        F.sort_array(F.collect_list(row)).alias("_rows"), count("blank"), count("duplicate"), count("truncated")
    )
    roles = F.array_join(F.col("_rows._class"), "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(roles) - 1, F.lit(1))), lambda i: F.substr(roles, i, F.lit(2)))
    illegal = F.size(F.filter(pairs, lambda pair: (F.length(pair) == 2) & ~pair.isin("su", "ua", "au"))).cast("long")
    words = words.withColumns({"word": F.array_join(F.col("_rows._symbol"), ""), "illegal": illegal}).drop("_rows").filter("word <> ''")
    words = settle(words)

    distinct = settle(words.groupBy("word").agg(F.count("*").alias("n")))
    matrices = settle(evaluated(distinct, grammar(distinct)))
    parts = words.select("_conv", "_segment", "word").join(matrices, "word").select("_conv", "_segment", "matrix")
    answers = multiplied(parts).select("_conv", cheapest(F.col("matrix")).alias("_best"))
    answers = settle(answers.select("_conv", F.col("_best.cost").alias("cost"), F.col("_best.audit").alias("_edits")))

    counts = words.groupBy("_conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    turns = rows.groupBy("_conv", "_turn").agg(F.first("_id").alias("_id")).groupBy("_conv").agg(
        F.first("_id").alias(conv), F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count("_turn"), F.lit(0)).cast("long").alias("gaps")
    )
    reports = turns.join(counts, "_conv").join(answers, "_conv")
    reports = reports.select(conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.translate("_edits", "JS", "IR").alias("audit"))

    # The edits of each segment, then of each turn: what is inserted before it, itself, and behind the last turn what is inserted there.
    turn_edits = f"[{INSERTS}]*[{ROWS}]"
    cut = F.regexp_extract_all("_edits", F.lit(f"(?:{turn_edits}){{1,{SEGMENT}}}(?:[{INSERTS}]*\\z)?"), F.lit(0))
    edits = answers.select("_conv", F.posexplode(cut).alias("_segment", "_edits")).withColumn("_segment", F.col("_segment").cast("long"))
    each = F.regexp_extract_all("_edits", F.lit(f"{turn_edits}(?:[{INSERTS}]*\\z)?"), F.lit(0))
    messages = rows.join(edits, ["_conv", "_segment"]).withColumn("_own", F.element_at(each, (F.col("_place") % SEGMENT + 1).cast("int")))
    messages = messages.select("*", F.posexplode(F.split("_own", "")).alias("part", "_edit")).filter("_edit not in ('', 'D')")
    given_role = F.when(F.col("_edit") == "K", F.col("_role")).when(F.col("_edit").isin("I", "R"), "user").otherwise("assistant")
    messages = messages.select(
        F.col("_id").alias(conv), F.col("_place").alias("place"), "part", given_role.alias(role),
        F.when(F.col("_edit").isin(*INSERTS), "").otherwise(F.col("_text")).alias(text),
    )
    return Repaired(reports, messages)


def text_digests(messages: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """SHA-256 of each conversation's messages, ``role:text`` joined by newlines: ``conv`` and ``digest``.

    Conversations lie sorted in their tasks, and a task reads one row after the other, whatever their length.
    """
    prepare(messages.sparkSession)
    line = F.concat(F.col(f"`{role}`"), F.lit(":"), F.col(f"`{text}`"))
    rows = messages.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit("")).alias("_conv"), F.col(f"`{conv}`").alias("_id"), "place", "part", line.alias("_line"))
    rows = rows.repartition("_conv").sortWithinPartitions("_conv", "place", "part").select("_conv", "_id", "_line")
    schema = T.StructType([T.StructField(conv, rows.schema["_id"].dataType), T.StructField("digest", T.StringType())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = state = None
        held = None  # the id of the conversation that is being read, as an array of one

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([held, pa.array([state.hexdigest()], pa.string())], names=schema.names)

        for batch in batches:
            for i, (key, line) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if key == present:
                    state.update(b"\n" + line.encode())
                    continue
                if state is not None:
                    yield ended()
                present, state, held = key, sha256(line.encode()), batch.column(1).slice(i, 1)
        if state is not None:
            yield ended()

    return rows.mapInArrow(digests, schema)
