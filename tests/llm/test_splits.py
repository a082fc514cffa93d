"""Splits by group, and records across splits, against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from recordmill.llm import data, split_groups
from recordmill.llm.fm_index import FMIndex, suffix_array
from recordmill.llm.split_overlap import near_pairs, same_keys

from .test_near_duplicates import corpus, likeness

def relations():
    return {"suite": data.key("s"), "package": data.key("p"), "dir": data.path_key("d")}


def rows():
    return [
        (1, "S1", "alpha", "tools/a"), (2, " s1 ", "beta", None), (3, None, "Beta", "tools\\b"), (4, None, None, "./tools//B/"), (5, "unknown", "n/a", "."),
        (6, None, None, None), (7, "", "gamma", "./"), (8, "S2", None, "x/y"), (9, "s2", "?", "z"), (10, None, "gamma", "TBD"),
    ]


def frame(spark, extra=()):
    return spark.createDataFrame([*rows(), *extra], "pos long, s string, p string, d string")


def test_related(spark):
    got = {r.id: r.group_key for r in split_groups.related(frame(spark), "pos", relations(), "package").collect()}
    assert got == {1: "alpha", 2: "alpha", 3: "alpha", 4: "alpha", 7: "gamma", 10: "gamma", 8: None, 9: None}


def test_path_forms(spark):
    paths = [("tools/a",), ("./tools/a",), ("Tools\\a\\",), ("//tools///a/",), (" tools/a ",), (".",), ("./",), ("..",), (None,)]
    got = [r.k for r in spark.createDataFrame(paths, "d string").select(data.path_key("d").alias("k")).collect()]
    assert got == ["tools/a"] * 5 + [None, None, "..", None]


def test_assignment_keeps_groups_and_shares(spark):
    rng = random.Random(1)
    extra = [(100 + k, f"g{rng.randint(0, 150)}", None, None) for k in range(1500)] + [(5000 + k, "hot", f"p{k % 7}", None) for k in range(700)]
    got = split_groups.assign(frame(spark, extra), "pos", relations()).collect()
    assert len(got) == len(rows()) + len(extra)
    of = {}
    for r in got:
        assert of.setdefault(r.group_root, r.split) == r.split
    sizes = Counter(r.split for r in got)
    for split, share in split_groups.TARGETS:
        assert abs(sizes[split] / len(got) - share) < 0.01


def test_greedy_plan_equals_one_by_one():
    rng = random.Random(4)
    for _ in range(40):
        sizes = sorted((rng.choice([1, 1, 1, 2, 3, 7, 30]) for _ in range(rng.randint(1, 200))), reverse=True)
        goal = {s: share * sum(sizes) for s, share in split_groups.TARGETS}
        have = dict.fromkeys(goal, 0)
        for n in sizes:
            have[min(goal, key=lambda s: (have[s] - goal[s], list(goal).index(s)))] += n
        plan = split_groups.greedy_plan(list(Counter(sizes).items()))
        bulk = Counter()
        for size, split, n in plan:
            bulk[split] += size * n
        assert sum(n for *_, n in plan) == len(sizes)
        assert all(abs(bulk[s] - have[s]) <= max(sizes) for s in goal)


def test_empty_tables(spark):
    empty = frame(spark).where("false")
    assert split_groups.related(empty, "pos", relations(), "package").count() == 0
    assert split_groups.assign(empty, "pos", relations()).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(3)
    for n, k in ((1, 1), (50, 2), (300, 3), (400, 400)):
        text = rng.integers(0, k, n)
        assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_index_finds_all_maximal_matches():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 6, n) for n in (40, 1, 25, 60)]
    query = [np.concatenate([rng.integers(1, 9, 5), texts[3][10:30], rng.integers(1, 9, 4)]), rng.integers(1, 6, 30)]
    pack = lambda parts: (np.concatenate(parts).astype(np.uint64), np.cumsum([0, *map(len, parts)]))
    index = FMIndex(*pack(texts))
    got = set(zip(*(x.tolist() for x in index.matches(*pack(query), 4)), strict=True))
    want = set()
    for q, words in enumerate(query):
        for t, held in enumerate(texts):
            for i in range(len(words)):
                for j in range(len(held)):
                    if i and j and words[i - 1] == held[j - 1]:
                        continue
                    n = 0
                    while i + n < len(words) and j + n < len(held) and words[i + n] == held[j + n]:
                        n += 1
                    if n >= 4:
                        want.add((q, t, i, j, n))
    assert got == want


def test_pairs_across_sides_equal_brute_force(spark):
    texts = corpus(7, 14)
    side = {i: i % 3 > 0 for i, _ in texts}
    df = spark.createDataFrame([(i, side[i], t) for i, t in texts], "id long, train boolean, text string")
    got = {(r.train, r.eval): r.likeness for r in near_pairs(df, 0.6, 3).collect()}
    want = {(i, j): likeness(a, b, 3) for i, a in texts for j, b in texts if side[i] and not side[j] and likeness(a, b, 3) >= 0.6}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_common_text_is_not_lost(spark, monkeypatch):
    """Texts made of sequences that very many evaluation texts hold are still paired."""
    from recordmill.llm import split_overlap

    monkeypatch.setattr(split_overlap, "COMMON", 2)
    base = " ".join(f"w{k}" for k in range(80))
    rows = [(k, k % 2 == 0, f"{base} end{k} of{k}") for k in range(24)] + [(100, True, " ".join(f"v{k}" for k in range(60)) + " " + " ".join(f"w{k}" for k in range(15)))]
    got = {(r.train, r.eval) for r in near_pairs(spark.createDataFrame(rows, "id long, train boolean, text string"), 0.6, 3).collect()}
    assert got == {(a, b) for a in range(0, 24, 2) for b in range(1, 24, 2)}


def test_pair_of_common_sequences_is_not_lost(spark, monkeypatch):
    """A pair meets whatever share of the training text's sequences very many evaluation texts hold."""
    from recordmill.llm import split_overlap

    monkeypatch.setattr(split_overlap, "COMMON", 2)
    part = lambda c, n: " ".join(f"{c}{k}" for k in range(n))
    want, rows = set(), [(1000 + k, False, part("w", 120) + " " + part(f"f{k}x", 300)) for k in range(6)]
    for own in range(50, 130, 2):
        # The words of its own come in runs of five, so its only sequences of six words in common are the common ones.
        runs = [part(f"r{own}y{k}z", 5) for k in range(own // 5)]
        text = [" ".join(f"{r} {s}{own}q{k}" for k, r in enumerate(runs)) + " " + part("w", 120) for s in "ab"]
        rows += [(own, True, text[0]), (own + 500, False, text[1])]
        if likeness(*text, 3) >= 0.6:
            want.add((own, own + 500))
    got = {(r.train, r.eval) for r in near_pairs(spark.createDataFrame(rows, "id long, train boolean, text string"), 0.6, 3).collect()}
    assert len(want) > 20 and got == want


def test_repeated_filler_does_not_lose_a_pair(spark):
    """Likeness counts distinct sequences: words repeated in one text only, and short matches, don't matter."""
    body = " ".join(f"w{k}" for k in range(60))
    short = [" ".join(f"{a}{b} {b}{a} x" for a in "abcdefgh" for b in "ijklm"), " ".join(f"{a}{b} {b}{a} x" for b in "ijklm" for a in "abcdefgh")]
    rows = [(1, True, body + " 0 1" * 200), (2, False, body), (3, True, short[0]), (4, False, short[1])]
    want = {(t, e) for t, side, a in rows if side for e, other, b in rows if not other and likeness(a, b, 3) >= 0.6}
    got = near_pairs(spark.createDataFrame(rows, "id long, train boolean, text string"), 0.6, 3).collect()
    assert (1, 2) in want and {(r.train, r.eval) for r in got} == want
    assert [r.matched_words for r in got if r.train == 1] == [60]


def test_odd_rows_across(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, ""), (3, True, "a b"), (4, False, "a b"), (None, True, "a b"), (5, None, "a b"), (3, True, "a b")], "id long, train boolean, text string")
    assert near_pairs(df, 0.6, 3).count() <= 1
    assert near_pairs(df.where("false")).count() == 0


def test_same_keys(spark):
    df = spark.createDataFrame([(1, True, "a", "x"), (2, False, "a", "x"), (3, False, "a", None), (4, False, "b", "x"), (1, True, "a", "x")], "id long, train boolean, k string, w string")
    assert [(r.train, r.eval) for r in same_keys(df, "k", "w").collect()] == [(1, 2)]
    assert same_keys(df.where(F.lit(False)), "k", "w").count() == 0


def test_sequences_are_sent_as_forty_bits_of_distinct_rows():
    import pyarrow as pa

    from recordmill.llm.split_overlap import _grams

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c d e f a b c", "x y"])], names=["id", "text"])
    got = pa.Table.from_batches(_grams(3)(iter([batch]))).to_pylist()
    assert len(got) == 6 and {(r["doc"], r["n"]) for r in got} == {(1, 6)} and all(0 <= r["gram"] < 1 << 40 for r in got)


def test_first_sequences_of_a_pair_meet_in_any_order():
    from recordmill.llm import split_overlap

    rng = np.random.default_rng(11)
    pairs = 0
    for _ in range(300):
        both, a, b = (np.unique(rng.integers(1, 1 << 63, n, np.uint64)) for n in rng.integers(1, 60, 3))
        x, y = np.union1d(both, a), np.union1d(both, b[: rng.integers(0, len(b))])
        # Levels in any order, only that those of an evaluation text aren't zero.
        levels = rng.integers(0, 4, split_overlap.COUNTERS, np.uint8)
        at = split_overlap._counters(y)
        levels[at] = np.maximum(levels[at], 1)
        likeness = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        for threshold in (0.3, 0.6, 0.8):
            if likeness >= threshold:
                sent, asked = split_overlap._first(np.zeros(len(x), np.int64), x, 1, levels, threshold, True)
                held, _ = split_overlap._first(np.zeros(len(y), np.int64), y, 1, levels, threshold, False)
                assert len(np.intersect1d(x[sent], y[held])) >= asked[0] > 0
                pairs += 1
    assert pairs > 100


def test_fewer_rows_are_shuffled_than_half_the_sequences(spark):
    rng = random.Random(8)
    text = lambda k: [f"w{k}x{rng.randint(0, 10**6)}" for _ in range(400)]
    held = {k: text(k) for k in range(30)}
    train = {100 + k: [*words[:380], *text(k)[:20]] for k, words in held.items()} | {200 + k: text(k) for k in range(60)}
    rows = [(k, k >= 100, " ".join(words)) for k, words in [*held.items(), *train.items()]]
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc.sc()

    def sent():
        context.listenerBus().waitUntilEmpty()
        stages = context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {s.stageId(): s.shuffleWriteRecords() for s in map(stages.apply, range(stages.size()))}

    before = sent()
    df = spark.createDataFrame(rows, "id long, train boolean, text string")
    got = {(r.train, r.eval) for r in near_pairs(df, 0.6, 3).collect()}
    assert got == {(100 + k, k) for k in held}
    assert sum(n for k, n in sent().items() if k not in before) < 398 * len(rows) // 2


def test_sides_beside_texts(spark):
    """Sides in a table of their own: a record on both, one on none, repeated rows, a record with two texts."""
    body = " ".join(f"w{k}" for k in range(60))
    texts = spark.createDataFrame([(1, body), (1, body), (2, body + " end"), (3, body), (4, body), (5, None), (6, "z " * 50), (6, body)], "id long, text string")
    sides = spark.createDataFrame([(1, True), (2, True), (2, False), (4, False), (4, False), (5, False), (9, True), (None, True), (6, None)], "id long, train boolean")
    got = [(r.train, r.eval) for r in near_pairs(texts, 0.6, 3, sides).collect()]
    assert sorted(got) == [(1, 2), (1, 4), (2, 4)]
