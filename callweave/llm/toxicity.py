"""Toxicity by a weighted lexicon.

Texts are folded (homoglyphs, digits and signs that stand for letters), an Aho-Corasick
automaton finds lexicon entries and exception phrases in one pass, and the weights of the
entries found outside exceptions are summed and normalised by length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from callweave.llm.text import SPACE, bucket, documents, slices, utf8, with_columns
from callweave.sources.tables import read_table

#: Digits and signs that stand for letters, then Cyrillic and Greek look-alikes.
FOLD_FROM = "0134578@$" + "аеіјорсухѕһ" + "αεικνορτυχ"
FOLD_TO = "oieastbas" + "aeijopcyxsh" + "aeiknoptux"
#: Phrases in which a lexicon entry says nothing about the text.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum",
              "not stupid", "not an idiot", "not worthless", "no loser")
_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)


@dataclass(frozen=True)
class Entry:
    """A lexicon entry: a whole word, or the beginning of words."""

    text: str
    whole: bool
    weight: float


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


def folded(text: Column) -> Column:
    """As ``fold``, in Spark."""
    return F.translate(F.lower(text), FOLD_FROM, FOLD_TO)


def least_run(text: Column, seed: int, n: int = 3) -> Column:
    """Least hash of the runs of ``n`` words: equal for most near copies, else hardly ever."""
    split = F.split(F.trim(text), SPACE)
    return F.array_min(F.element_at(F.transform(F.array(split), lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))),
        lambda i: F.xxhash64(F.lit(seed), F.slice(w, i, n)))), 1))


def learn_lexicon(docs: DataFrame, labels: DataFrame, rows: int = 20_000, entries: int = 400,
                  support: float = 0.015, begun: float = 0.03, least: int = 6,
                  log_odds: float = 4.5) -> list[Entry]:
    """Entries and weights from a bounded sample of labelled documents.

    Of ``labels`` (doc_id, toxic) the ``rows`` first in a hash order are used. Of documents with
    the same label and the same least hash of their three-word runs one counts (by two hashes
    in turn), so a document copied exactly or nearly teaches no words of its own. A word enters where it occurs in at least ``support`` of the toxic documents (and in
    ``least``), a beginning of words of 4 to 8 letters where its words occur in ``begun`` of
    them, and where the smoothed log-odds reach ``log_odds``; at most ``entries`` enter. Without toxic or without clean documents the
    lexicon is empty.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    toxic = (F.col("toxic") > 0).cast("long")
    texts = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .select(toxic.alias("toxic"), folded(F.col("text")).alias("text"))
    )
    for seed in (1, 2):
        texts = (texts.groupBy("toxic", least_run(F.col("text"), seed).alias("like"))
                 .agg(F.max("text").alias("text")).drop("like"))
    found = texts.select("toxic", F.explode(F.array_distinct(
        F.split("text", r"[^\p{L}]+"))).alias("word")).where(F.length("word") > 2)
    words = found.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    totals = texts.agg(F.sum("toxic"), F.count("*")).first()
    n_toxic, n_clean = int(totals[0] or 0), int(totals[1] - (totals[0] or 0))
    if not n_toxic or not n_clean:
        return []
    lengths = F.filter(F.array(*[F.lit(k) for k in range(4, 9)]), lambda k: k < F.length("word"))
    starts = words.select("t", "n", F.explode(
        F.transform(lengths, lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("word"))
    counts = (
        words.select("word", "t", "n", F.lit(True).alias("whole"))
        .unionByName(starts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
                     .select("word", "t", "n", F.lit(False).alias("whole")))
    )
    odds = (F.log((F.col("t") + 0.5) / (n_toxic + 1.0))
            - F.log((F.col("n") - F.col("t") + 0.5) / (n_clean + 1.0)))
    best = (
        counts.where(F.col("t") >= F.greatest(
            F.lit(float(least)), F.when(F.col("whole"), support).otherwise(begun) * n_toxic))
        .withColumn("odds", odds).where(F.col("odds") >= log_odds)
        .orderBy(F.desc("t"), F.desc("whole"), "word").limit(8 * entries).collect()
    )
    return pick_entries([(r["word"], r["whole"], r["t"], r["odds"]) for r in best], entries)


def pick_entries(found: list[tuple[str, bool, int, float]], entries: int) -> list[Entry]:
    """Shortest beginnings first; what a kept beginning covers is left out."""
    kept: list[tuple[int, Entry]] = []
    starts: set[str] = set()
    by_word = {w: t for w, whole, t, _ in found if whole}
    for word, whole, t, odds in sorted(found, key=lambda x: (x[1], len(x[0]), x[0])):
        if any(word[:k] in starts for k in range(1, len(word) + 1)):
            continue
        if not whole and any(w.startswith(word) and c >= 0.9 * t for w, c in by_word.items()):
            continue  # one word makes up nearly all of it: the word itself is the entry
        if not whole:
            starts.add(word)
        kept.append((t, Entry(word, whole, float(odds))))
    kept.sort(key=lambda x: (-x[0], x[1].text))
    return [e for _, e in kept[:entries]]


class Matcher:
    def __init__(self, lexicon: list[tuple[str, bool, float]], exceptions: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for entry, whole, weight in lexicon:
            self.automaton.add_word(entry, (len(entry), whole, weight))
        for phrase in map(fold, exceptions):
            self.automaton.add_word(phrase, (len(phrase), True, None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries at word borders, outside exception phrases."""
        if self.empty:
            return []
        found, spared, n = [], [], len(text)
        for last, (size, whole, weight) in self.automaton.iter(text):
            start, end = last + 1 - size, last + 1
            if start and text[start - 1].isalpha():
                continue
            if whole and end < n and text[end].isalpha():
                continue
            (spared if weight is None else found).append((start, end, weight))
        return [h for h in found if not any(s <= h[0] and h[1] <= e for s, e, _ in spared)]


def toxicity(weights: float, n_words: int, words_per_unit: float = 200.0) -> float:
    """Score from summed weights: the sum is divided by a slowly growing measure of length."""
    return 1.0 - math.exp(-weights / (1.0 + math.log1p(n_words / words_per_unit)))


def score(docs: DataFrame, lexicon: list[Entry], text: str = "text",
          exceptions: tuple[str, ...] = EXCEPTIONS, threshold: float = 0.7) -> DataFrame:
    """Every row with ``score`` (0 to 1), ``predicted`` (score >= threshold) and ``n_hits``.

    A missing or empty text, and any text with an empty lexicon, has score 0. Columns of
    ``docs`` with these names are replaced. Rows are treated one by one and whole.
    """
    names = ("score", "predicted", "n_hits")
    gone = tuple(c for c in docs.columns if c.lower() in names)
    schema = T.StructType([f for f in docs.schema.fields if f.name not in gone] + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("n_hits", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(
        ([(e.text, e.whole, e.weight) for e in lexicon], tuple(exceptions)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*shared.value)
        for batch in slices(batches, text):
            scores, hits = [], []
            for raw in utf8(batch, text):
                found = matcher.hits(fold(raw.decode())) if raw else []
                hits.append(len(found))
                scores.append(toxicity(sum(w for _, _, w in found), len(raw.split()))
                              if found else 0.0)
            yield with_columns(batch, {
                "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32()),
                "n_hits": pa.array(hits, pa.int64())}, gone)

    return docs.mapInArrow(run, schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of a third of the ids are held out from learning."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = read_table(spark, "labels", root=sf_dir).select("doc_id", "toxic")
    held_out = bucket(F.col("doc_id"), 3) == 1
    lexicon = learn_lexicon(docs, labels.where(~held_out))
    return score(docs, lexicon).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "n_hits")
