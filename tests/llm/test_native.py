"""Quality rules and line dedup."""

import os
import random

import pytest
from pyspark.sql import functions as F

from callweave.llm import line_dedup, quality
from callweave.llm.catalog import ORACLE, QUERIES
from callweave.session import stage_run
from compare import connect, difference, spark_rows, sql_rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert difference(got, sql_rows(connect(SMALL), ORACLE[name])) is None


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_quality"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def repeated(words, size=5):
    wins = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    return len({i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(size)})


def test_quality_counts_and_edges(spark, docs_of):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(30)]
    texts += [None, "", " \n\t", "one", "a b c d e " * 4000, "x\ny\nx\nx\n\n", "é" * 30]
    docs = docs_of(*enumerate(texts), (3, texts[3]))
    got = quality.apply_rules(docs).orderBy("doc_id").collect()
    assert len(got) == len(texts) + 1
    for r in got:
        words = (texts[r.doc_id] or "").split()
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        if len(words) < 1000:
            assert r.n_repeat_words == repeated(words)
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
        assert r.clean_text == (None if texts[r.doc_id] is None else r.clean_text)
        assert r.SPANS == "x"
    assert next(r for r in got if r.doc_id == 35).n_dup_lines == 2
    assert quality.apply_rules(docs.where("false")).count() == 0


def test_line_rules(docs_of):
    clean = "This is a sentence about a river and its banks, long enough to stay."
    junk = "Buy*** now### cheap$$$ deals&&& here%%% today***"
    menu = "Home | About | Contact | Login | Help"
    rights = "Licensed under the Apache License, Version 2.0."
    shout = "READ THIS TEXT NOW OR NEVER PLEASE THANK YOU ALL"
    rows = quality.apply_rules(docs_of(
        (1, "\n".join([clean, junk, menu, rights, "", clean + " Again.", shout])), (2, "\n".join([junk] * 1 + [shout])),
        (3, clean + "\n" + rights), (4, rights + "\n" + "All rights reserved by the owner of it."),
    )).orderBy("doc_id").collect()
    assert rows[0].clean_text == "\n".join([clean, "", clean + " Again."])
    assert rows[0].n_lines_failed == 4
    assert [r.kept for r in rows] == [False, False, True, False]


def test_boilerplate_counts_as_lost(docs_of):
    page = "\n".join([f"Subscribe now to a{i} b{i} c{i} d{i} e{i}" for i in range(100)])
    prose = " ".join(f"word{i}" for i in range(60))
    got = quality.apply_rules(docs_of((1, page + "\nHello"), (2, "Licensed under the MIT licence\n" + prose),
                                      (3, "All rights reserved by the owners.\nonly five words are left")))
    assert [r.kept for r in got.orderBy("doc_id").collect()] == [False, True, False]
    page_of = got.where("doc_id = 1").first()
    assert page_of.lost_words == 800 and not page_of.base_failed


def brute_lines(rows):
    """Numbers of the removed lines by comparing every line with every earlier one."""
    seen, removed = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        out = []
        for i, line in enumerate((text or "").split("\n")):
            words = set(line.lower().split())
            if not words:
                continue
            if any(5 * len(words & o) >= 4 * len(words | o) for o in seen):
                out.append(i)
            seen.append(words)
        removed[doc] = out
    return removed


def test_line_dedup_against_brute_force(spark, docs_of):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randint(0, 9)) for _ in range(n)]
            for n in (1, 2, 4, 5, 10, 11, 20, 30)]

    def line():
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice("xyz") + str(rng.randint(0, 5))
        rng.shuffle(words)
        return rng.choice([" ".join(words), " ".join(words).upper(), ""])

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, rows[0][1]), (502, "one line only\n" * 50)]
    want = brute_lines(rows)
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs_of(*rows)).collect()}
    assert got == want
    texts = {r.doc_id: r for r in line_dedup.dedup_lines(docs_of(*rows)).collect()}
    for doc, text in rows:
        if text is None:
            assert texts[doc].text is None
        else:
            kept = [s for i, s in enumerate(text.split("\n")) if i not in want[doc]]
            assert texts[doc].text == "\n".join(kept) and texts[doc].n_removed == len(want[doc])
    assert texts[0].SPANS == "x"


def test_line_dedup_of_repeated_rows_and_empty_table(docs_of):
    twice = docs_of((1, "some words here\nmore of them"), (1, "some words here\nmore of them"),
                    (2, "some words here"))
    got = sorted((r.doc_id, r.n_removed) for r in line_dedup.dedup_lines(twice).collect())
    assert got == [(1, 0), (1, 0), (2, 1)]
    assert line_dedup.dedup_lines(twice.where("false")).count() == 0
    assert line_dedup.removed_lines(twice.where(F.lit(False))).count() == 0


def test_line_dedup_leaves_no_table_and_few_stages(spark, docs_of):
    before = {t.name for t in spark.catalog.listTables()}
    with stage_run(spark) as run:
        line_dedup.removed_lines(docs_of((1, "some words here\nmore of them"), (2, "More of them"))).collect()
        left = [n for n in os.listdir(run.path.removeprefix("file:")) if "released" not in n]
    assert {t.name for t in spark.catalog.listTables()} == before
    assert not any(n.partition("-")[2] in ("line-classes", "line-pairs", "line-rest") for n in left)


def test_long_unlike_lines_make_few_candidates(spark, docs_of, monkeypatch):
    """Long lines of common words share words of their prefixes without being alike."""
    made, write = {}, line_dedup.materialise

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialise", counted)
    rng = random.Random(5)
    lines = [rng.sample([f"w{i}" for i in range(200)], 100) for _ in range(120)]
    lines.append([*lines[7][5:], "x"])  # 95 of 101 words in common
    rows = [(i, " ".join(words)) for i, words in enumerate(lines)]
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs_of(*rows)).collect()}
    assert got == brute_lines(rows) and got[120] == [0]
    assert 1 <= made["line-pairs"] + made["line-rest"] < 400


def test_line_plans_stay_short(docs_of):
    """The driver keeps descriptions of plans; the counts of words are not printed in them."""
    docs = docs_of((1, "some words here\nmore of them"), (2, "x " * line_dedup.LONG_TEXT + "\nMore of them"))
    levels = line_dedup.materialise(line_dedup.rarity_levels(docs, "text"), "levels")
    counted = levels.selectExpr("size(levels) n", "size(filter(levels, x -> x > 1)) m").first()
    assert (counted.n, counted.m) == (1 << line_dedup.BUCKET_BITS, 4)  # x, more, of, them
    classes = line_dedup.line_classes(line_dedup.numbered_lines(docs, "doc_id", "text"), levels)
    assert classes.count() == 4
    assert len(classes._jdf.queryExecution().toString()) < 100_000


def test_frequent_lines_are_matched_with_few_words(docs_of):
    """Lines without rare words, of sizes in the ratio 4/5, that share only late words of a prefix."""
    rows = [(i, " ".join(f"w{j}" for j in range(40) if j % 10 != i % 10 or j < 4)) for i in range(20)]
    rows += [(50 + i, " ".join([f"w{j}" for j in range(40)] + [f"u{i}_{j}" for j in range(i)])) for i in range(12)]
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs_of(*rows)).collect()}
    assert got == {d: sorted(n) for d, n in brute_lines(rows).items()}


def test_candidate_texts_are_cut_from_their_own_documents_only(docs_of, monkeypatch):
    """Not every line of every document becomes a row again to look up the candidates' texts."""
    plans, write = [], line_dedup.materialise

    def seen(df, name):
        if name == "line-texts":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(line_dedup, "materialise", seen)
    rows = [(1, "first line here\n\nof two\twords\n"), (2, "none\n" * 50), (None, "a line\nno key"),
            (3, None), (4, "here FIRST line\nNO key\nwords of  two")]
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs_of(*rows)).collect()}
    assert got == {1: [], 2: list(range(1, 50)), None: [], 3: [], 4: [0, 1, 2]}
    assert len(plans) == 2 and not any("posexplode" in p for p in plans)
