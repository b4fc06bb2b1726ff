"""Empty tables, clashing columns, very long texts and ties of the text operators, and plain
versions of the language and toxicity scores."""

import math
import random

import pytest
import zstandard

from callweave.llm import (
    decontaminate, language_id, lm_score, near_dedup, passages, secret_scan, toxicity,
)

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(200_000))
CLASH = ("doc_id long, text string, leaks int, spans int, score string, predicted string, n_hits string, "
         "lang_pred int, rejected int")


@pytest.fixture(scope="module")
def clashing(spark):
    """A table whose columns have the names of the operators' own."""
    rows = [(1, "An item of the benchmark is here.", *[None] * 7), (2, None, *[None] * 7), (3, "", *[None] * 7),
            (4, LONG, *[None] * 7), (4, LONG, *[None] * 7)]
    return spark.createDataFrame(rows, CLASH)


def outputs(spark, docs):
    items = spark.createDataFrame([(7, "an item of the benchmark is here"), (8, None)], "item_id long, text string")
    return {
        "leaks": decontaminate.find_leaks(docs, items), "secrets": secret_scan.find_secrets(docs),
        "model": lm_score.score(docs, docs.where("doc_id <> 3")),
        "language": language_id.identify(docs, {"en": b"word and the", "xx": b"word and the"}),
        "near": near_dedup.near_duplicates(docs), "passages": passages.repeated_passages(docs),
        "toxic": toxicity.score(docs, []),
    }


def test_empty_tables(spark, clashing):
    for name, df in outputs(spark, clashing.where("false")).items():
        assert df.count() == 0, name


def test_clashing_columns_and_long_texts(spark, clashing):
    got = {n: df.collect() for n, df in outputs(spark, clashing).items()}
    for name in ("leaks", "secrets", "model", "language", "near", "toxic"):
        assert len(got[name]) == 5, name
    leaks = {r.doc_id: len(r.leaks) for r in got["leaks"]}
    assert leaks == {1: 1, 2: 0, 3: 0, 4: 0}
    assert all(isinstance(r.score, float) for n in ("model", "language", "toxic") for r in got[n])
    assert {r.doc_id: r.n_tokens for r in got["model"]}[4] == 400_001
    tied = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in got["language"]}
    assert tied[1] == ("en", 0.0, True) and tied[2][0] == "und"  # of equal languages the first
    assert {r.doc_id: r.component_id for r in got["near"]} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_language_equals_plain_compression(docs_of):
    rng = random.Random(2)
    books = {lang: " ".join(rng.choice(words) for _ in range(400)).encode() for lang, words in {
        "a": ["river", "stone", "bridge", "under"], "b": ["fluss", "stein", "brücke", "unter"]}.items()}
    texts = [" ".join(rng.choice(["river", "stein", "unter", "Bridge", "x1"]) for _ in range(rng.randint(1, 40)))
             for _ in range(25)] + ["river " * 5000, "123", "!"]
    got = language_id.identify(docs_of(*enumerate(texts)), books).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        data, sizes = text.lower().encode(), {}
        for lang, book in sorted(books.items()):
            flags = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            primed = zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[lang] = sum(len(zstandard.ZstdCompressor(level=6, dict_data=primed, **flags).compress(
                data[i:i + 8192])) for i in range(0, len(data), 8192))
        best = min(sizes, key=lambda k: (sizes[k], k))
        other = min(v for k, v in sizes.items() if k != best)
        assert r.lang_pred == best and r.score == pytest.approx(1 - sizes[best] / other, abs=0.03)


def test_toxicity_equals_a_plain_matcher(docs_of):
    rng = random.Random(7)
    lexicon = [("scum", True, 1.5), ("idiot", False, 0.8), ("tra", False, 0.2)]
    pieces = ["scum", "SCUM", "5cum", "idiots", "idiot", "midiot", "trash", "extra", "word", "white trash", "s c u m"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    spared = ("white trash",)
    entries = [type("E", (), {"text": t, "whole": w, "weight": x})() for t, w, x in lexicon]
    got = toxicity.score(docs_of(*enumerate(texts)), entries, exceptions=spared).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        t, total, hits = toxicity.fold(text), 0.0, 0
        free = [(i, i + len(p)) for p in map(toxicity.fold, spared) for i in range(len(t)) if t.startswith(p, i)
                and not (i and t[i - 1].isalpha()) and not t[i + len(p):i + len(p) + 1].isalpha()]
        for entry, whole, weight in lexicon:
            for i in range(len(t)):
                end = i + len(entry)
                if t.startswith(entry, i) and not (i and t[i - 1].isalpha()) and not (
                        whole and t[end:end + 1].isalpha()) and not any(a <= i and end <= b for a, b in free):
                    total, hits = total + weight, hits + 1
        want = 1 - math.exp(-total / (1 + math.log1p(len(text.split()) / 200))) if hits else 0.0
        assert r.n_hits == hits and r.score == pytest.approx(want)
