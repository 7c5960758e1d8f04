import collections
import re

from changeflow.llm import quality
from llm_helpers import awkward, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    words, lines = WORD.findall(text or ""), (text or "").split("\n")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    seen, same = set(), 0
    for line in lines:
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), same, len(repeated), base


def test_measures_equal_brute_force(spark):
    documents = awkward(spark).union(spark.createDataFrame([(20, "a b c\na b c\n# | <x>\n" * 30, "en", "a", 1)], awkward(spark).schema))
    out = quality.clean_lines(documents.withColumnRenamed("n_chars", "n_words"))
    given = collections.Counter((r.doc_id, *brute_force(r.text)) for r in documents.collect())
    got = collections.Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()
    )
    assert got == given
    assert all(not r.kept for r in out.filter("base_failed").collect())


def test_lines_fail_by_their_rules():
    assert quality.failed_rule("It ends well.", 3) is None
    assert quality.failed_rule("No end at all here", 5) == "punctuation"
    assert quality.failed_rule("Title", 1) is None
    assert quality.failed_rule("Home | News | Sport | More.", 7) == "navigation"
    assert quality.failed_rule("a### b*** c%%% d.", 4) == "punctuation"
    assert quality.failed_rule("BUY!! NOW!! CHEAP!! HERE!!", 4) == "punctuation"
    assert quality.failed_rule("Please read our Privacy Policy before you go on.", 9) == "boilerplate"
    assert quality.failed_rule("He said. Then it was cut off in the mid", 10) is None


def test_cleaning_and_rejection(spark):
    good, menu = prose("en", 120), "\n".join(["one | two | three | four | five"] * 8)
    documents = spark.createDataFrame(
        [(1, good + "\n" + menu, "x"), (2, good[:200] + "\n" + menu * 9, "y"), (3, good, "z"), (4, None, "n")], "doc_id int, text string, kept string"
    )
    out = {r.doc_id: r for r in quality.clean_lines(documents).collect()}
    assert out[1].kept and out[1].text == good and out[1].n_navigation == 8
    assert not out[2].kept
    assert out[3].kept and out[3].text == good and out[3].n_lost_words == 0
    assert out[4].text is None and not out[4].kept
    assert quality.clean_lines(documents.limit(0)).count() == 0


def test_sentences_and_phrases_of_other_scripts_and_languages():
    for line in ("यह एक पूरा वाक्य है।", "هل هذا سؤال كامل هنا؟", "یہ ایک مکمل جملہ ہے۔", "Sie sagte: „Das ist gut so.“", "这 是 一 个 句子。」", "ይህ ሙሉ ዓረፍተ ነገር ነው።"):
        assert quality.failed_rule(line, len(line.split())) is None, line
    for line in ("© 2020 Example and others.", "Tous droits réservés par nous.", "Es gilt die Datenschutzerklärung von uns.", "Todos los derechos reservados.", "Released under the MIT License."):
        assert quality.failed_rule(line, len(line.split())) == "boilerplate", line
    assert quality.failed_rule("In 2020 (c) was the third item of it.", 9) is None
