import random
import re

import numpy as np
import pytest

from changeflow.llm import jaccard_join
from llm_helpers import DOCUMENTS, awkward, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_force(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                i, j = sorted((root(a), root(b)))
                up[j] = i
    return {i: (len(sets[i]), root(i)) for i in ids}


def result(documents, size, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.linked_components(documents, size=size, percent=percent).collect()}


def edited(rng, words, share):
    return [rng.choice(["zig", "zag", "zog"]) + str(rng.randrange(999)) if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    """Groups of near copies around the threshold, chains, and passages that unrelated texts share."""
    rng = random.Random(size)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for group in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 12, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            words = edited(rng, words, 0.01) if rng.random() < 0.5 else words
            extra = passage if rng.random() < 0.4 else []
            rows.append((len(rows), " ".join(edited(rng, words, rng.choice([0, 0.01, 0.03])) + extra)))
    rows += [(len(rows) + i, " ".join(passage[: 5 + i])) for i in range(20)]
    documents = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
    assert result(documents, size, percent) == brute_force(rows, size, percent)


def test_awkward_rows(spark):
    documents = awkward(spark)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = jaccard_join.linked_components(documents, size=4, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == brute_force(rows, 4, 85)
    # Rows without an id come back too, without a component.
    assert len(out) == len(rows) and all(r.component_id is None for r in out if r.doc_id is None)
    assert jaccard_join.linked_components(documents.limit(0)).count() == 0


def test_clashing_columns(spark):
    documents = spark.createDataFrame([(1, prose("en", 30), 7, 8, 9), (2, prose("en", 30), 7, 8, 9)], "doc_id int, text string, id int, node int, sigs int")
    assert result(documents, 5, 80) == {1: (result(documents, 5, 80)[1][0], 1), 2: (result(documents, 5, 80)[2][0], 1)}


def near_copies(rng, members, words=300, changed=4):
    """Sets of shingle hashes of copies with some words changed, around the threshold."""
    base = [rng.randrange(10**6) for _ in range(words)]
    sets = []
    for _ in range(members):
        text = list(base)
        for at in rng.sample(range(words), changed):
            text[at] = rng.randrange(10**6)
        grams = {hash(tuple(text[i : i + 4])) & (2**64 - 1) for i in range(words - 3)}
        sets.append(np.sort(jaccard_join.mix(np.array(sorted(grams), np.uint64))))
    return sets


def joined(count, links):
    up = list(range(count))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(count)]


def all_links(sets, percent, allowed=lambda i, j: True):
    found = []
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if allowed(i, j) and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                found.append((i, j))
    return found


@pytest.mark.parametrize("changed", [2, 4, 6])
def test_the_tree_finds_what_connects(changed):
    rng = random.Random(changed)
    sets = near_copies(rng, 90, 150, changed) + near_copies(rng, 60, 80, 2) + near_copies(rng, 30, 20, 1)
    rng.shuffle(sets)
    every, ones = np.ones((2, 2), bool), np.zeros(len(sets), int)
    links, tested = jaccard_join.search(sets, np.arange(len(sets)), 85, every, ones)
    exact = all_links(sets, 85)
    assert joined(len(sets), links) == joined(len(sets), exact)
    assert set(map(frozenset, links)) <= set(map(frozenset, exact)) and len(links) < len(sets)
    assert len(links) <= tested < len(sets) * (len(sets) - 1) // 4  # the bound and what is connected leave few
    # With components that are known nothing is found or tested again.
    assert jaccard_join.search(sets, np.array(joined(len(sets), exact)), 85, every, ones)[0] == []
    # Two sides that are only compared with each other.
    side, cross = np.array([i % 2 for i in range(len(sets))]), np.array([[False, True], [True, False]])
    links, _ = jaccard_join.search(sets, np.arange(len(sets)), 85, cross, side)
    assert joined(len(sets), links) == joined(len(sets), all_links(sets, 85, lambda i, j: i % 2 != j % 2))


def test_nodes_hold_their_points():
    rng = np.random.default_rng(1)
    at, n = rng.integers(0, 9, (200, 64)).astype(np.int32), rng.integers(1, 50, 200)
    tree = jaccard_join.Tree(at, n)
    assert sorted(tree.order) == list(range(200)) and tree.children[0] is not None
    for (a, z), children, corner, low, high in zip(tree.spans, tree.children, tree.corners, tree.low, tree.high):
        own = tree.order[a:z]
        assert (at[own].max(0) == corner).all() and n[own].min() == low and n[own].max() == high
        if children is None:
            assert z - a <= jaccard_join.LEAF
        else:
            assert [tree.spans[c] for c in children] == [(a, (a + z) // 2), ((a + z) // 2, z)]


def test_links_grow_with_the_members_not_their_square(spark, monkeypatch):
    """Rows that the search hands on for groups of near copies of two sizes, over several tiles."""
    monkeypatch.setattr(jaccard_join, "TILE", 40)
    handed = []
    plain = jaccard_join.tree_links

    def counting(*given):
        links = plain(*given)
        handed.append(links.count())
        return links

    monkeypatch.setattr(jaccard_join, "tree_links", counting)
    counts = []
    for members in (60, 240):
        rng = random.Random(members)
        words = [f"w{rng.randrange(10**5)}" for _ in range(200)]
        rows = []
        for i in range(members):
            text = list(words)
            for at in rng.sample(range(200), 2):
                text[at] = f"x{rng.randrange(10**5)}"
            rows.append((i, " ".join(text)))
        handed.clear()
        documents = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
        assert result(documents, 4, 85) == brute_force(rows, 4, 85)
        counts.append(sum(handed))
    assert 0 < counts[1] < 8 * counts[0]


def test_all_links_come_from_the_trees(spark, monkeypatch):
    """Without what the trees find there is no component of two different sets."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    documents = spark.createDataFrame([(i, " ".join(edited(rng, words, 0.005)), "en", "s", 1) for i in range(30)], DOCUMENTS)
    assert len({c for _, c in result(documents, 5, 80).values()}) < 10
    monkeypatch.setattr(jaccard_join, "search", lambda sets, *rest: ([], 0))
    texts = {r.text for r in documents.collect()}
    assert len({c for _, c in result(documents, 5, 80).values()}) == len(texts)


def test_sets_that_reach_the_threshold_share_a_signature():
    """For all sizes, with all differences at the limit: the partition that the buckets rest on is exact."""
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        for n in [*range(1, 60), 100, 333, 1000]:
            for _ in range(8):
                a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
                lost = rng.integers(0, n - -(-n * percent // 100) + 1)
                common = a[: n - lost]
                added = len(common) * 100 // percent - n
                extra = rng.integers(0, max(0, added) + 1)
                b = np.concatenate([common, rng.integers(0, 2**63, extra, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
                assert 100 * len(common) >= percent * (n + extra) or added < 0
                if 100 * len(common) >= percent * (n + extra):
                    one, other = (set(jaccard_join.signatures(np.sort(x), percent).tolist()) for x in (a, b))
                    assert one & other, (percent, n, lost, extra)


def test_unrelated_sets_that_share_a_little_rarely_meet():
    """Small groups, which agree by chance the more often the more sets there are, make no bucket."""
    rng = np.random.default_rng(7)
    common = rng.integers(0, 2**63, 30, dtype=np.uint64) * np.uint64(2)
    own = [rng.integers(0, 2**63, 330, dtype=np.uint64) * np.uint64(2) for _ in range(150)]
    told = [jaccard_join.signatures(np.sort(np.concatenate([common, x])), 80).tolist() for x in own]
    # The sets that differ most are of 360 and 450 (its own class), and of 360 and 291 (the class below).
    most = [jaccard_join.most_different(total, 80) + 1 for total in (810, 651)]
    assert all(len(sigs) == len(set(sigs)) <= sum(most) for sigs in told)
    met = sum(not set(a).isdisjoint(b) for i, a in enumerate(told) for b in told[:i])
    assert met < 0.04 * len(own) * (len(own) - 1) / 2, met


@pytest.mark.parametrize("most", [10**6, 7])
def test_components_of_links(spark, monkeypatch, most):
    """Joined by one task and by many."""
    monkeypatch.setattr(jaccard_join, "LINKS", most)
    rng = random.Random(2)
    links = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5)]
    got = {r.node: r.component for r in jaccard_join.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    names = sorted({x for link in links for x in link})
    up = joined(len(names), [(names.index(a), names.index(b)) for a, b in links])
    want = {x: names[up[i]] for i, x in enumerate(names)}
    assert {x: got.get(x, x) for x in names} == want
    assert jaccard_join.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
