"""Near copies, repeated passages and benchmark passages against brute force."""

import random
from fractions import Fraction

import numpy as np

from callweave.llm import decontaminate, near_dedup, passages
from callweave.llm.components import components

WORDS = [a + b for a in "bcdfghklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]


def prose(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return words


def near_truth(rows, size, threshold):
    sets = {}
    for doc, text in rows:
        w = (text or "").lower().split()
        k = min(size, len(w))
        sets[doc] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in docs}


def test_near_duplicates(spark, docs_of):
    rng = random.Random(8)
    rows = [(i, " ".join(prose(rng, rng.randint(1, 60)))) for i in range(40)]
    for g in range(6):  # groups of copies with more and more edits: chains of links
        base = prose(rng, 120)
        rows += [(100 * (g + 1) + i, " ".join(edited(rng, base, rng.randint(0, 6)))) for i in range(14)]
    rows += [(900, "One two"), (901, "one  TWO"), (902, ""), (903, None), (904, " \n"), (905, rows[50][1])]
    for size in (4, 5):
        want = near_truth(rows, size, Fraction(4, 5))
        got = near_dedup.near_duplicates(docs_of(*rows), size=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_repeated_rows_and_missing_keys(docs_of):
    got = near_dedup.near_duplicates(docs_of((2, "a b c d e f"), (2, "a b c d e f"), (None, "q r s t u"),
                                             (1, "A b c d e f"))).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("1", "1", True), ("2", "1", False), ("2", "1", False), ("None", "None", True)]
    assert near_dedup.near_duplicates(docs_of((1, "a")).where("false")).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (3000, 800))
    union = np.unique(np.concatenate([a, b]))
    assert (near_dedup.merge(near_dedup.sketch(a), near_dedup.sketch(b)) == near_dedup.sketch(union)).all()
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(20):
            x = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64))
            common = int(2 * share / (1 + share) * 1000)
            y = np.concatenate([x[:common], rng.integers(0, 2**63, 1000 - common).astype(np.uint64)])
            true = common / (2000 - common)
            n = np.array([1000.0])
            errors.append(near_dedup.similarity(near_dedup.sketch(x)[None], near_dedup.sketch(y)[None], n, n)[0] - true)
        assert abs(np.mean(errors)) < 0.03


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages_hold_every_exact_repeat(docs_of):
    rng = random.Random(6)
    shared = [prose(rng, n) for n in (50, 55, 80, 200)]
    rows = []
    for i in range(60):
        words = prose(rng, rng.randint(0, 80))
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(shared)
        rows.append((i, " ".join(words).title()))
    rows += [(70, None), (71, ""), (72, rows[0][1]), (73, "again " * 300), (74, "again " * 300), (None, rows[0][1])]
    first, need = {}, {}
    for doc, text in rows:
        w = (text or "").lower().split()
        for j in range(len(w) - 49):
            if doc is not None and first.setdefault(tuple(w[j:j + 50]), doc) != doc:
                need.setdefault(doc, []).append(j)
    got = {}
    for r in passages.repeated_passages(docs_of(*rows)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end))
        assert r.n_words >= 50 and all(e < r.doc_id for e in r.earlier)
    assert set(got) == set(need) and {73, 72} & set(got) == {72}
    for doc, places in need.items():
        assert all(any(s <= j and j + 50 <= e for s, e in got[doc]) for j in places)


def test_fuzzy_passages(docs_of):
    rng = random.Random(7)
    base = prose(rng, 120)
    rows = [(1, " ".join(prose(rng, 40) + base)), (2, " ".join(edited(rng, base, 8) + prose(rng, 40))),
            (3, " ".join(prose(rng, 200)))]
    got = passages.repeated_passages(docs_of(*rows)).collect()
    assert [(r.doc_id, list(r.earlier)) for r in got] == [(2, [1])]
    assert got[0].n_words >= 90
    assert passages.repeated_passages(docs_of(*rows).where("false")).count() == 0


def test_two_repeats_with_different_words_between(docs_of):
    rng = random.Random(12)
    rows, want = [], {}
    for i, (first, gap, second) in enumerate(
            [(60, gap, 60) for gap in (10, 20, 35, 40, 45, 60, 100, 200)]
            + [(300, gap, 100) for gap in (61, 80, 120, 200)]):
        p, q = prose(rng, first), prose(rng, second)
        rows.append((2 * i, " ".join(p + prose(rng, gap) + q)))
        rows.append((2 * i + 1, " ".join(p + prose(rng, gap) + q)))
        want[2 * i + 1] = [(0, first), (first + gap, first + gap + second)]
        rows.append((100 + 2 * i, " ".join(prose(rng, 5) + rows[-1][1].split())))  # a gap on one side
        text = rows[-1][1].split()
        rows[-1] = (100 + 2 * i, " ".join(text[:5 + first] + text[5 + first + gap:]))
        want[100 + 2 * i] = [(5, 5 + first), (5 + first, 5 + first + second)]
    got = {}
    for r in passages.repeated_passages(docs_of(*rows)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end))
    for doc, spans in want.items():
        assert all(any(s <= x and y <= e for s, e in got.get(doc, [])) for x, y in spans), (doc, got.get(doc))


def test_prefix_maxima_and_chain():
    rng = random.Random(1)
    tree, kept = passages.PrefixMaxima(30), []
    for _ in range(200):
        at, value = rng.randrange(30), (rng.random(), rng.randrange(9))
        tree.put(at, value)
        kept.append((at, value))
        below = rng.randrange(31)
        assert tree.below(below) == max([v for a, v in kept if a < below], default=(float("-inf"), -1))
    a = [5, 9, 14, 100, 20, 26]
    b = [50, 54, 59, 60, 65, 71]
    assert passages.chain(a, b) == [(5, 26 + passages.SEED, 50, 71 + passages.SEED)]


def distance(item, text):
    prev = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        cur = [i]
        for j, y in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev)


def test_bit_parallel_distance():
    rng = random.Random(5)
    for _ in range(400):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 90)))
        assert decontaminate.Pattern(item).nearest(text) == distance(item, text)


def test_leaks_against_brute_force(spark, docs_of):
    rng = random.Random(9)
    items = [(i, " ".join(prose(rng, 14))) for i in range(8)] + [(8, None), (None, "x"), (9, "")]
    rows = []
    for i in range(40):
        text = " ".join(prose(rng, 20))
        if i % 2:
            item = list(items[i % 8][1])
            for _ in range(rng.randint(0, 7)):
                at = rng.randrange(len(item))
                item[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "é"])
            text += "\n " + "".join(item).upper().replace(" ", "  ") + " " + text[:30]
        rows.append((i, text))
    rows += [(50, None), (51, ""), (7, rows[7][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    normal = lambda t: decontaminate.normal((t or "").encode())
    want = sorted(
        (doc, i, distance(normal(t), normal(text))) for doc, text in rows for i, t in items
        if i is not None and t and distance(normal(t), normal(text)) <= int(len(normal(t)) * 0.05))
    for block in (1 << 20, 200):  # one block, and one block for each few items
        got = decontaminate.find_leaks(docs_of(*rows), bench, block=block).collect()
        assert sorted((r.doc_id, x.item, x.edits) for r in got for x in r.leaks) == want
        assert len(got) == len(rows) and got[0].SPANS == "x"
    assert want
    none = decontaminate.find_leaks(docs_of(*rows), bench.where("false")).collect()
    assert len(none) == len(rows) and not any(r.leaks for r in none)
