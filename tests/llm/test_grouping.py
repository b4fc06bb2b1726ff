"""Conversation repair, spelling variants and embedding near-dedup against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from callweave.llm import conversation_repair, embedding_dedup, spelling

TURNS = "conv_id long, turn long, role string, text string, EDIT string, place string"


def cheapest_repair(rows):
    """(cost, audit, text) over all sequences of edits, by a plain search over reading states.
    rows: (role, text, fault)."""
    reads = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {"u": "user", "a": "assistant"}

    def grown(front):
        """Insert turns before the next row, up to two (more never pay)."""
        for _ in range(2):
            for q, options in list(front.items()):
                for cost, audit, said in list(options):
                    for initial, to in reads[q].items():
                        if initial in names:
                            front.setdefault(to, set()).add(
                                (cost + 5, audit + "I", said + (names[initial] + ":",)))
        return front

    front = {0: {(0, "", ())}}
    for role, text, fault in rows:
        following = {}
        for q, options in grown(front).items():
            for cost, audit, said in options:
                following.setdefault(q, set()).add((cost + 2, audit + "D", said))
                if fault in ("blank", "duplicate"):
                    continue
                more = 5 if fault == "truncated" else 0
                for initial, to in reads[q].items():
                    if role[:1] == initial:
                        following.setdefault(to, set()).add(
                            (cost + more, audit + "K", said + (f"{role}:{text}",)))
                    if initial in names:
                        following.setdefault(to, set()).add(
                            (cost + more + 1, audit + "R", said + (f"{names[initial]}:{text}",)))
        front = {}
        for q, options in following.items():  # the best of them, far more than one
            front[q] = set(sorted(options)[:60])
    grown(front)
    return min(o for q in (0, 3) for o in front.get(q, ()))


def repair_truth(rows):
    """{conv: (blank, duplicate, truncated, illegal, cost, audit, sha256)}"""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ")
                      for c, t, r, x in rows if c == conv))
        seen, judged = set(), []
        for _, _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
            judged.append((role, text, fault))
        n = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, said = cheapest_repair(judged)
        out[conv] = (*n, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def conversations(rng):
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "User", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Why?", "Fine! ", "", " \n", None, f"Line {turn}.", "é…"])
            rows.append((conv, rng.choice([turn, turn, turn, None, 0]), role, text))
    rows += [(100, 1, "user", "Same.")] * 7 + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes.")]
    rows += [(101, t, "ua"[t % 2:][:1], f"Turn {t}{'.' * (t % 7 > 0)}") for t in range(90)]  # long
    return rows


@pytest.mark.parametrize("bits", [1, 8])
def test_conversations_equal_brute_force(spark, bits):
    """With two rows a piece, a conversation is combined over several rounds."""
    rows = conversations(random.Random(bits))
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    got = conversation_repair.repair(table.repartition(5), bits=bits)
    hashes = {r.conv_id: r.sha256 for r in conversation_repair.digests(got.turns).collect()}
    want = repair_truth(rows)
    found = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                         hashes.get(r.conv_id, hashlib.sha256(b"").hexdigest()))
             for r in got.verdicts.collect()}
    assert found == want


def test_repaired_turns(spark):
    table = spark.createDataFrame([
        (1, 0, "assistant", "Hello.", "", ""), (1, 3, "user", "Well.", "", ""),
        (2, None, "user", " ", "", "")], TURNS)
    got = conversation_repair.repair(table)
    turns = [(r.turn, r.role, r.text, r.edit) for r in got.turns.orderBy("place", "k").collect()]
    assert turns == [(0, "user", "Hello.", "R"), (3, "assistant", "Well.", "R")]
    assert {(r.conv_id, r.gaps, r.cost, r.audit) for r in got.verdicts.collect()} == {
        (1, 2, 2, "RR"), (2, 0, 2, "D")}
    none = conversation_repair.repair(table.where("false"))
    assert none.verdicts.count() == 0 and none.turns.count() == 0


def test_insertions_and_very_long_texts(spark):
    long = "word " * 400_000 + "."
    table = spark.createDataFrame([(1, 0, "user", long, "", ""), (1, 1, "user", long + "!", "", ""),
                                   (1, 2, "user", "c.", "", "")], TURNS)
    got = conversation_repair.repair(table)
    assert got.verdicts.first().audit == "DKR"
    said = [(r.role, r.text) for r in got.turns.orderBy("place", "k").collect()]
    assert said == [("user", long + "!"), ("assistant", "c.")]
    cell = conversation_repair.chart([conversation_repair.row_cell("s", "", 1)])
    assert conversation_repair.cheapest(cell) == (2, "D")


def near_truth(words):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(around, default=None)
        form = best[1] if best and -best[0] >= 2 * n else None
        out[w] = [form, n, len(around), -best[0] if form else None]
    for w, row in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        row.insert(1, at)
    return {w: tuple(r) for w, r in out.items()}


def spelled(rng, n):
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(30)]
    return [rng.choice(stems) + rng.choice(["", "", "a", "ba", "x"]) for _ in range(n)]


@pytest.mark.parametrize("long", [3, 2048])
def test_variants_equal_brute_force(spark, docs_of, long):
    """With lists of three words nearly every list is halved again."""
    rng = random.Random(5)
    rows = [(i, " ".join(spelled(rng, 60)).replace("ab", "Ab")) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "12 !"), (None, "Abaab abaab ABAAB"), (43, "Ünder ÜNDER Ünder"),
             (44, "prefixaaaa " * 3 + "prefixaaab " * 9 + "prefixaabb " * 40)]
    counts = {}
    for doc, text in rows:
        for run in spelling.RUN.findall("".join(c.lower() if c.isascii() else c for c in text or "")):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            w = run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]
            counts[w] = counts.get(w, 0) + 1
    want = near_truth({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = spelling.variants(docs_of(*rows), long=long).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert len(want) > 50 and any(r[1] != r[0] and r[0] for r in want.values())


def test_neighbours_and_empty_vocabulary(docs_of):
    rng = random.Random(3)
    for _ in range(100):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(40)})
        lcp = [0] + [spelling.shared(a, b, 99) for a, b in zip(words, words[1:])]
        truth = near_truth(dict.fromkeys(words, 1))
        found = dict.fromkeys(words, 0)
        for i, w in enumerate(words):
            for j in spelling.neighbours(words, i, lcp):
                found[w] += 1
                found[words[j]] += 1
        assert found == {w: r[3] for w, r in truth.items()}
    assert spelling.variants(docs_of((1, "abcde")).where("false")).count() == 0
    long = spelling.variants(docs_of((1, "y" * 60_000 + " " + "letters " * 200_000))).collect()
    assert [(r.word, r.n) for r in long] == [("letters", 200_000)]


def linked_truth(rows, threshold):
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in good}
    links = {i: [j for j in good if j != i and len(unit[i]) == len(unit[j])
                 and unit[i] @ unit[j] >= threshold] for i in good}
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = k if k is None else min(rows[j][0] for j in seen)
        out.append((str(k), len(links.get(i, ())), str(least), k is None or k == least))
    return sorted(out)


def vectors(rng, n, dims):
    rows = [(i, rng.normal(size=dims)) for i in range(n)]
    for g in range(12):  # groups of near copies, chained by growing noise
        base = rng.normal(size=dims)
        for _ in range(8):
            base = base + rng.normal(size=dims) * 0.12
            rows.append((1000 + len(rows), base))
    rows = [(int(k), [float(x) for x in v]) for k, v in rows]
    return rows + [(5, rows[0][1]), (6000, rows[-1][1]), (6001, [2 * x for x in rows[3][1]]),
                   (6002, None), (6003, []), (6004, [0.0] * dims), (6005, [None] + rows[0][1][1:]),
                   (6006, [float("nan")] + rows[0][1][1:]), (6007, [float("inf")] * dims),
                   (None, rows[1][1]), (6008, [1.0, 2.0]), (6009, [1.1, 2.0]),
                   (6010, [1e200 * x for x in rows[4][1]]), (6011, [1e-200 * x for x in rows[4][1]])]


@pytest.mark.parametrize("block", [3, 1024])
def test_vectors_equal_brute_force(spark, block):
    rows = vectors(np.random.default_rng(4), 150, 16)
    table = spark.createDataFrame(
        [(k, v, 1, 7) for k, v in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = embedding_dedup.near_vectors(table.repartition(3), recall=0.9999, block=block).collect()
    want = [(k, n, c, e) for k, n, c, e in linked_truth(
        [(k, [x / 1e200 if abs(x) > 1e100 else x for x in v] if v and None not in v else v)
         if k != 6011 else (k, rows[4][1]) for k, v in rows], 0.9)]
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == want
    assert sum(n for _, n, _, _ in want) > 100
    assert embedding_dedup.near_vectors(table.where("false")).count() == 0
    assert {(r.n_links, r.kept) for r in embedding_dedup.near_vectors(
        table.where("vec_id >= 6002 AND vec_id <= 6007")).collect()} == {(0, True)}


def test_recall_at_the_threshold():
    """Of pairs at exactly the threshold, 0.9 and more meet in a table."""
    rng = np.random.default_rng(1)
    sample = embedding_dedup.scaled(rng.normal(size=(4000, 64)))
    for n in (10_000, 1_000_000):
        bits, tables = embedding_dedup.table_sizes(n, 0.9, embedding_dedup.RECALL)
        q = embedding_dedup.Quantiser(sample[:2000], 64, bits, tables)
        a = sample[2000:]
        side = rng.normal(size=a.shape)
        side = embedding_dedup.scaled(side - (side * a).sum(axis=1, keepdims=True) * a)
        b = 0.9 * a + np.sqrt(1 - 0.81) * side
        assert (q.keys(a) == q.keys(b)).any(axis=1).mean() >= 0.9


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(3000, 32)) @ rng.normal(size=(32, 32))
    mean, matrix = embedding_dedup.learn(sample, 32, 0)
    signs = (sample - mean) @ matrix >= 0
    assert np.abs(signs.mean(axis=0) - 0.5).max() < 0.2
