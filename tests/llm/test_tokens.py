"""BPE encoding against the library, and its parts."""

import hashlib
import random

import numpy as np
import pytest

from callweave.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(bpe.tokenizer_file())


TEXTS = ["", " ", "  a  b", "a\n\nb ", "\x1c\x1d a\x1e", "don't they'RE I'D", "<|endoftext|>x <|endoftext|>",
         "a" * 3000, "aaaa bbbb" * 200, "日本語 テスト", "½ ² Ⅷ 123", "x​y z\u0085", "\x00\x01", "end "]


def test_encoding_is_that_of_the_library(model, library):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abc deTHE.,\n 12é ß漢 '") for _ in range(60)) for _ in range(800)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0x300, 0xD7FF)]))
                      for _ in range(25)) for _ in range(400)]
    for text, packed in zip(texts, model.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert model.decode(packed).decode("utf-8", "replace") == library.decode(
            ids, skip_special_tokens=False)


def test_memory_that_is_started_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    small = bpe.Bpe(bpe.tokenizer_file())
    text = "many different words stand in this text, more than are remembered"
    for _ in range(3):
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids


def test_pairs_are_compatible_where_merging_keeps_them(model):
    rng = random.Random(5)
    some = rng.sample(sorted(model.ids.values()), 300)
    a, b = (np.array([rng.choice(some) for _ in range(3000)]) for _ in "ab")
    for x, y, good in zip(a.tolist(), b.tolist(), model.compatible(a, b)):
        assert good == (model.merge(model.bytes[x] + model.bytes[y]) == [x, y])


def test_rows(spark, docs_of, library):
    rows = [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, "x" * 20_000)]
    got = bpe.encode(docs_of(*rows), bpe.tokenizer_file()).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted(
        (str(i), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert all(r.decoded == (dict(rows)[r.doc_id] or "") and r.SPANS == "x" for r in got)
    assert bpe.encode(docs_of(*rows).where("false"), bpe.tokenizer_file()).count() == 0


def test_query_digests(spark, library):
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    for r in bpe.op7_bpe(spark, root).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
