"""Line-first cleaning of documents.

Every line with a word is judged by three rules; a line that fails is removed, blank lines stay:

- *punctuation*: it needs the end of a sentence, though a line of up to ``SHORT`` words may do without
  one; and symbols may not be as frequent as every third word, nor exclamations;
- *navigation*: separators of menus and tables (``|``, arrows, middle dots) may not be as frequent as
  every fifth word;
- *boilerplate*: it may not hold one of the phrases below, which sites put on all their pages, nor a sign of copyright with a
  year or the address of a licence.

Then the document is judged: it is rejected when the base rules fail (under 50 words, or over half of
the words in repeated windows of three) or when the lines removed hold more than ``MOST_LOST`` percent
of its words.

Cases: null, empty and blank texts have no words, fail the base rules and have an empty cleaned text
(null stays null). Lines are cut at ``\\n`` alone, words at the white space of ASCII. Repeated rows are
judged alike, each for itself. Other columns pass through untouched, also those with the names added
here, which are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, map_batches, mix, row_of, text_chunks, with_row, words_of

#: Most words of a line that needs no end of sentence; percent of the words that may be lost.
SHORT, MOST_LOST = 3, 50
#: Limits of the base rules: fewest words, and most percent of the words in repeated windows.
FEWEST_WORDS, MOST_REPEATED = 50, 50

# Marks that end a sentence in any script (closing quotes and brackets may follow), symbols, separators of menus.
ENDS = ".!?…:;‼‽⁇⁈⁉։؟۔܀܁܂߹।॥၊။።፧፨᙮᜵᜶។៕᠃᠉᥄᥅᪨᪩᪪᪫᭚᭛᭞᭟᰻᰼᱾᱿⸮⸼꓿꘎꘏꛳꛷꡶꡷꣎꣏꤯꧈꧉꩝꩞꩟꫰꫱꯫﹒﹖﹗！．？｡。"
CLOSERS = "\"'”’“‘»›)]}」』】》〉）］｝｣"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|›»→·•"
# Phrases of boilerplate in English, French, German and Spanish, in lower case.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript", "licensed under",
    "lorem ipsum", "privacy policy", "released under the", "share on facebook", "sign up for our newsletter", "skip to content",
    "subscribe to our newsletter", "terms of service", "terms of use", "use of cookies",
    "accepter les cookies", "activer javascript", "aller au contenu", "cliquez ici pour", "conditions générales", "mentions légales",
    "partager sur facebook", "politique de confidentialité", "tous droits réservés", "utilisation de cookies",
    "alle cookies akzeptieren", "alle rechte vorbehalten", "allgemeine geschäftsbedingungen", "auf facebook teilen", "datenschutzerklärung",
    "hier klicken", "newsletter abonnieren", "nutzungsbedingungen", "verwendung von cookies", "zum inhalt springen",
    "aceptar todas las cookies", "aviso legal", "compartir en facebook", "haga clic aquí", "ir al contenido", "política de cookies",
    "política de privacidad", "términos de uso", "todos los derechos reservados", "uso de cookies",
)
# Signs of boilerplate in any language: a sign of copyright and a year, or an address of a licence.
SIGNS = r"(?:©|\(c\)|copyright) *(?:19|20)[0-9][0-9]|creativecommons\.org/|opensource\.org/licenses|spdx-license-identifier"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]")
_END = re.compile(f"[{re.escape(ENDS)}][{re.escape(CLOSERS)}]*(?:[\\x20\\x09-\\x0D]|\\Z)")
_PHRASE = re.compile("|".join([*map(re.escape, BOILERPLATE), SIGNS]))

MEASURES = (
    "text string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lost_words bigint, n_punctuation bigint, n_navigation bigint, n_boilerplate bigint"
)


def failed_rule(line: str, n_words: int) -> str | None:
    """The first rule that a line with words fails, judged by the line alone."""
    if 3 * len(_SYMBOL.findall(line)) >= n_words and _SYMBOL.search(line) and len(_SEPARATOR.findall(line)) * 5 < n_words:
        return "punctuation"
    if 5 * len(_SEPARATOR.findall(line)) >= n_words:
        return "navigation"
    if 3 * line.count("!") >= n_words and n_words > SHORT:
        return "punctuation"
    if n_words > SHORT and not _END.search(line):
        return "punctuation"
    if _PHRASE.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    windows = mix(mix(mix(words[:-2]) + words[1:-1] * _BASE) + words[2:])
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(twice)] |= twice
    return int(covered.sum())


def line_rules(text: str) -> tuple[str, int, int, dict[str, int]]:
    """The text without failed lines, its repeated lines, the words lost, and the lines lost by rule."""
    kept, seen, repeated, lost = [], set(), 0, 0
    rules = {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    for line in text.split("\n"):
        n_words = len(_WORD.findall(line))
        if n_words:
            repeated += line in seen
            seen.add(line)
            if rule := failed_rule(line, n_words):
                rules[rule] += 1
                lost += n_words
                continue
        kept.append(line)
    return "\n".join(kept), repeated, lost, rules


def measured(texts: pa.Array) -> dict[str, list]:
    """The columns of MEASURES for an array of texts."""
    out: dict[str, list] = {part.split()[0]: [] for part in MEASURES.split(", ")}
    for first, last, data, bounds in text_chunks(texts):
        words, _, first_words = words_of(data, bounds, lower=False)
        for i in range(last - first):
            text, own = texts[first + i].as_py(), words[first_words[i] : first_words[i + 1]]
            cleaned, repeated, lost, rules = line_rules(text or "")
            out["text"].append(None if text is None else cleaned)
            out["n_words"].append(len(own))
            out["word_chars"].append(len(text) - sum(map(text.count, " \t\n\v\f\r")) if text else 0)
            out["n_symbols"].append(sum(map((text or "").count, SYMBOLS)))
            out["n_dup_lines"].append(repeated)
            out["n_repeat_words"].append(repeated_words(own))
            out["n_lost_words"].append(lost)
            for rule, lines in rules.items():
                out[f"n_{rule}"].append(lines)
    return out


def clean_lines(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows with the text cleaned, the measures of the whole text, base_failed and kept.

    The cleaned text takes the text's place. Nothing is shuffled.
    """
    names = [part.split()[0] for part in MEASURES.split(", ")][1:]
    others = [c for c in documents.columns if c != text_column and c not in {*names, "base_failed", "kept"}]
    rows = documents.select(row_of(others), F.col(f"`{text_column}`").cast("string").alias("_text"))

    def work(batch: pa.RecordBatch) -> dict:
        out = measured(batch.column(1))
        return {"_row": batch.column(0)} | {k: pa.array(v, pa.string() if k == "text" else pa.int64()) for k, v in out.items()}

    told = map_batches(rows, work, with_row(rows, MEASURES))
    base_failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    too_much = 100 * F.col("n_lost_words") > MOST_LOST * F.col("n_words")
    back = [F.col("text").alias(text_column) if c == text_column else F.col("_row").getField(c).alias(c) for c in documents.columns if c == text_column or c in others]
    return told.select(*back, *names, base_failed.alias("base_failed"), (~base_failed & ~too_much).alias("kept"))
