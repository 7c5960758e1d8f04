import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from changeflow.llm import packing
from llm_helpers import DOCUMENTS, awkward, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def padding(lengths, size):
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths)


def held(rows, texts, tokenizer, size, most_segments):
    """Every id of every text lies in one piece, and sequences are gapless and within their limits."""
    ids = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t in texts.items()}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for key, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[key])
            assert r.ids_crc32 == zlib.crc32(ids[key][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[key])
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and len(pieces) <= most_segments and {r.sequence_tokens for r in pieces} == {at}
        lengths.append(at)
    return lengths


def test_every_id_once_without_padding(spark, tokenizer):
    texts = {i: prose("en" if i % 2 else "fr", 5 + i * 13 % 700, i) for i in range(300)} | {500: None, 501: "", 502: "x" * 9000, 503: "  a \n b  <|endoftext|>"}
    documents = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCUMENTS)
    rows = packing.pack(documents.repartition(3), PATH).collect()
    lengths = held(rows, texts, tokenizer, 1024, 64)
    assert padding(lengths, 1024) == 0


def test_parts_are_tokenised_as_their_texts(tokenizer, monkeypatch):
    """With and without room to remember, also when a call brings nothing but odd texts."""
    rng = random.Random(1)
    marks = ["a", "b", " ", "  ", "\n", "é", "ß", "中", "1", "!", "'s", "\t", "the", " ", "\x1c", "🙂", ".", ",", ". ", ", ", " .", "\xa0", "\0", "<|endoftext|>", "2.", "x,"]
    for room in (0, 300):
        monkeypatch.setattr(packing, "REMEMBERED", room)
        tokens = packing.Tokens(PATH)
        calls = [["", ""], ["a b"], [" a", ""], ["a b"], ["\0"], ["a  b"], []]
        calls += [["".join(rng.choice(marks) for _ in range(rng.randrange(30))) for _ in range(20)] for _ in range(100)]
        for texts in calls:
            expected = [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert tokens.of(texts) == expected


def test_limits_on_segments_and_loss(spark, tokenizer):
    texts = {i: "hello there" for i in range(100)}
    documents = spark.createDataFrame([(i, t, 2) for i, t in texts.items()], "doc_id int, text string, bearing int")
    rows = packing.pack(documents.coalesce(1), PATH, limits=(64, 8, 64)).collect()
    held(rows, texts, tokenizer, 64, 8)
    rows = packing.pack(documents.coalesce(1), PATH, limits=(64, 64, 10), loss="bearing").collect()
    held(rows, texts, tokenizer, 64, 64)
    loss = collections.Counter()
    for r in rows:
        loss[r.sequence_id] += max(0, min(2, r.start + r.length) - r.start)
    assert max(loss.values()) <= 10


def test_awkward_rows(spark):
    documents = awkward(spark).withColumnRenamed("n_chars", "offset")
    rows = packing.pack(documents, PATH).collect()
    whole = packing.pack(documents.select("doc_id", "text"), PATH).collect()
    assert sum(r.length for r in rows) == sum(r.length for r in whole)
    firsts = [r for r in rows if r.start == 0]
    assert len(firsts) == documents.count()
    assert packing.pack(documents.limit(0), PATH).count() == 0


def test_words_merged_by_ranks_have_the_tokenizers_ids(tokenizer):
    """The fast way for words, the pieces of parts, and whole texts against the tokenizer itself."""
    tokens = packing.Tokens(PATH)
    assert tokens.ranked is not None
    words = sorted({w for lang in ("en", "fr") for w in prose(lang, 3000, 1).replace(".", "").split()} | {"Straße", "日本語", "çà", "ЖЁЛТЫЙ", "ⅷ", "ª"})
    words += [" " + w for w in words]
    assert list(tokens.of_words([w for w in words if w[w[:1] == " " :].isalpha()])) == list(tokens.encode([w for w in words if w[w[:1] == " " :].isalpha()]))
    rng = random.Random(1)
    signs = ["a", "b", " ", "  ", "\n", "\n\n", "é", "1", ".", ",", "!", "'", "'s", "\t", "the", "&&", "\x1c", "🙂", "中", " don't", "\r\n", "\xa0", "(", ")\n", "\0", "e\u0301"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        assert [np.frombuffer(x, "<u4").tolist() for x in tokens.of(some)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def test_other_vocabularies_take_the_slow_way():
    assert packing.Tokens(public_tokenizers.path("word_bpe_49k.json")).ranked is None


def plain_packing(amounts, limits):
    """The heuristic one step at a time: of (tokens, loss) the sequences, each a list of (example, start, length)."""
    left = [[i, 0, n, 1, loss] for i, (n, loss) in enumerate(amounts)]
    done, rest = [], []
    for item in left:
        while item[2] >= limits[0] and limits[2] >= min(item[4], limits[0]):
            done.append([(item[0], item[1], limits[0])])
            item[1], item[2], item[4] = item[1] + limits[0], item[2] - limits[0], max(0, item[4] - limits[0])
        if item[2]:
            rest.append(item)
    while rest:
        room, pieces = list(limits), []
        while rest and room[0] >= 1 and room[1] >= 1:
            worth = [sum(np.float64(a) / m * (r / m) for a, m, r in zip(item[2:], limits, room)) for item in rest]
            fitting = [k for k, item in enumerate(rest) if all(a <= r for a, r in zip(item[2:], room))]
            at = max(fitting or range(len(rest)), key=lambda k: (round(worth[k], 12), -k))
            item = rest[at]
            length = item[2]
            if not fitting:
                length = min(length - 1, room[0], room[2] if item[4] > room[2] else length)
                if length < 1:
                    break
            pieces.append((item[0], item[1], length))
            loss = min(item[4], length)
            room = [room[0] - length, room[1] - 1, room[2] - loss]
            if length == item[2]:
                rest.pop(at)
            else:
                item[1], item[2], item[4] = item[1] + length, item[2] - length, item[4] - loss
        done.append(pieces)
    return done


@pytest.mark.parametrize("limits", [(64, 8, 64), (64, 3, 64), (100, 20, 30)])
def test_the_heuristic_step_by_step(limits):
    rng = random.Random(sum(limits))
    amounts = [(n, rng.randrange(min(n, limits[2]) + 1)) for n in (rng.randrange(1, 90) for _ in range(200))]
    packer = packing.Packer(limits, 0)
    packer.add([(i, np.full(n, i, "<u4").tobytes(), loss) for i, (n, loss) in enumerate(amounts)])
    packer.fill(0)
    sequences = collections.defaultdict(list)
    for row, start, length, sequence, offset, _ in packer.placed:
        sequences[sequence].append((offset, row, start, length))
    want = plain_packing(amounts, limits)
    got = [[p[1:] for p in sorted(sequences[q])] for q in sorted(sequences)]
    assert got[: len(want) - 1] == want[:-1]  # the last one is cut at powers of two
    assert sum(length for q in got[len(want) - 1 :] for *_, length in q) == sum(length for *_, length in want[-1])
