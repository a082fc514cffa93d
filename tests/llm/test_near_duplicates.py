"""Signatures, pairs and groups against brute force."""

import random
import re

import numpy as np

from recordmill.llm.components import Forest, connected_components
from recordmill.llm.near_duplicates import NearDuplicates
from recordmill.llm.superminhash import packed, signatures
from recordmill.llm.words import WordHashes, gram_hashes, hashed_words

WORD = re.compile(r"[^\W_]+")


def grams(text, n):
    w = WORD.findall(text.lower())
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def likeness(a, b, n):
    x, y = grams(a, n), grams(b, n)
    return len(x & y) / len(x | y) if x | y else 0.0


def edited(words, rate, rng):
    out = []
    for w in words:
        r = rng.random()
        if r < rate / 3:
            continue
        out.append(rng.choice(VOCABULARY) if r < rate else w)
        if r > 1 - rate / 3:
            out.append(rng.choice(VOCABULARY))
    return out


VOCABULARY = [f"w{k}" for k in range(400)]


def corpus(seed=3, families=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [rng.choice(VOCABULARY) for _ in range(rng.randint(45, 200))]
        rows.append(" ".join(base))
        for _ in range(rng.randint(1, 5)):
            rows.append(" ".join(edited(base, rng.choice([0.01, 0.04, 0.08, 0.2]), rng)))
        rows.append(" ".join(base).upper() + " ...")  # the same words
    return list(enumerate(rows, 1))


def test_signature_estimates_likeness():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = hashes[:600], hashes[150:750]  # 450 shared of 750
    owner = np.repeat([0, 1], 600)
    order = np.concatenate([np.sort(a), np.sort(b)])
    sig = signatures(owner, order, 2, 192)
    assert np.isfinite(sig).all() and (sig < 192).all()
    assert abs((packed(sig)[0] == packed(sig)[1]).mean() - 0.6) < 0.12


def test_signature_does_not_depend_on_blocks_or_neighbours():
    texts = [" ".join(VOCABULARY[k : k + 60]) for k in range(0, 300, 30)]
    flat, offsets = hashed_words(texts, WordHashes())
    own, h = gram_hashes(flat, offsets, 3)
    whole, small = signatures(own, h, len(texts), 64), signatures(own, h, len(texts), 64, block=70)
    assert (whole == small).all() and (signatures(own, h, len(texts), 64, block=7) == whole).all()
    one_own, one_h = gram_hashes(*hashed_words(texts[4:5], WordHashes()), 3)
    assert (signatures(one_own, one_h, 1, 64)[0] == whole[4]).all()


def test_empty_set_has_no_signature():
    assert np.isinf(signatures(np.empty(0, np.int64), np.empty(0, np.uint64), 2, 8)).all()


def test_pairs_and_groups_equal_brute_force(spark):
    rows = corpus()
    found = NearDuplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.6, 3)
    got = {(r.a, r.b): r.likeness for r in found.pairs().collect()}
    want = {(i, j): likeness(a, b, 3) for i, a in rows for j, b in rows if i < j and likeness(a, b, 3) >= 0.6}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    groups = {r.id: r.class_id for r in found.groups().collect()}
    forest = Forest()
    for i, _ in rows:
        forest.find(i)
    for a, b in want:
        forest.union(a, b)
    assert groups == {i: forest.find(i) for i, _ in rows}


def test_default_is_five_words_and_four_fifths(spark):
    rows = corpus(5, 6)
    got = {(r.a, r.b) for r in NearDuplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text").pairs().collect()}
    assert got == {(i, j) for i, a in rows for j, b in rows if i < j and likeness(a, b, 5) >= 0.8}


def test_odd_rows(spark):
    long = " ".join(VOCABULARY * 300)
    rows = [(1, None, "x"), (2, "", "x"), (3, "  ", "x"), (4, "one two", "x"), (5, long, "x"), (6, long + " end", "x"), (7, "ONE, two", "x"), (8, "one two", "x"), (None, "one two", "x")]
    df = spark.createDataFrame(rows, "id long, text string, key string")
    found = NearDuplicates(df, "id", "text", 0.6, 3)
    pairs = {(r.a, r.b) for r in found.pairs().collect()}
    assert {(4, 7), (4, 8), (7, 8), (5, 6)} <= pairs  # the same words, however few, and a very long text
    assert {r.id for r in found.groups().collect()} == {1, 2, 3, 4, 5, 6, 7, 8}
    none = NearDuplicates(df.where("false"), "id", "text")
    assert none.pairs().count() == 0 and none.groups().count() == 0


def test_components_in_levels_equal_one_task(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 520)] + [(900, 900)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    one = {(r.node, r.root) for r in connected_components(df).collect()}
    levels = {(r.node, r.root) for r in connected_components(df, one_task_edges=0).collect()}
    forest = Forest()
    for a, b in edges:
        forest.union(a, b)
    assert one == levels == {(n, forest.find(n)) for e in edges for n in e}


def test_components_of_nothing(spark):
    df = spark.createDataFrame([(None, "a")], "a string, b string")
    assert connected_components(df).count() == 0 and connected_components(df, one_task_edges=0).count() == 0


def test_hot_band_is_not_paired(spark):
    """A third of all rows are near-copies of one text: the groups compare each with few others."""
    rng = random.Random(8)
    base = [rng.choice(VOCABULARY) for _ in range(80)]
    hot = [base[:k] + [f"x{k}"] + base[k + 1 :] for k in range(80)]
    rest = [[rng.choice(VOCABULARY) for _ in range(60)] for _ in range(160)]
    rows = [(k, " ".join(w)) for k, w in enumerate([*hot, *rest])]
    found = NearDuplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text", 0.6, 3)
    verified = []
    check = found._verified
    found._verified = lambda pairs: verified.append(check(pairs)) or verified[-1]
    classes = {r.id: r.class_id for r in found.groups().collect()}
    assert all(classes[k] == 0 for k in range(80)) and all(classes[k] == k for k in range(80, 240))
    assert sum(v.count() for v in verified) < 80 * 48 // 4 < 80 * 79 // 2
