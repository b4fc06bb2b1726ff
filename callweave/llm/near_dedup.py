"""MinHash near-dedup with SetSketch registers.

A document is the set of its word shingles. Its sketch holds, for each register, the least of
exponentially distributed hash values over the set, on a logarithmic scale and truncated to 16
bits: sketches of two sets merge by taking maxima, and equal registers are as likely as the
sets are similar. Bands of registers give candidates, the counts of greater, equal and less
registers give the similarity by maximum likelihood, and links are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from callweave.llm.components import components
from callweave.llm.text import column, documents, folded_words, slices, utf8
from callweave.session import materialise

REGISTERS, BAND = 128, 4
#: Base and rate of the logarithmic scale, and the largest register.
BASE, RATE, TOP = 1.001, 20.0, 65_535
#: Candidates estimated this far below the threshold (six standard errors) are left out.
SLACK = 0.21
_RNG = np.random.default_rng(20)
_XOR = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, size)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:n - k + 1 + i]
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(by)
    return np.unique(out ^ (out >> np.uint64(31)))


def sketch(hashes: np.ndarray, rows: int = 512) -> np.ndarray:
    """The registers of a set that is not empty."""
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(top), rows):
        block = (top[i:i + rows, None] ^ _XOR) * _MUL
        np.minimum(least, block.min(axis=0), out=least)
    value = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarities of pairs of sketches (rows) by maximum likelihood, the set sizes
    being known: how often a register is greater, less or equal depends on the similarity."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        rest = np.clip(1 - up - down, 1e-12, 1.0)
        return more * np.log(up) + less * np.log(down) + same * np.log(rest)

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one maximum
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = likelihood(x) > likelihood(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(doc, body, n_shingles, sketch) of every row: ``body`` names the sequence of words."""
    schema = T.StructType([
        T.StructField("doc", T.LongType()), T.StructField("body", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bodies, sizes, found = [], [], []
            for raw in utf8(batch, "text"):
                words = folded_words(raw)
                hashes = shingles(words, size)
                bodies.append(md5(b" ".join(words)).digest() if words else None)
                sizes.append(len(hashes))
                found.append(sketch(hashes).tobytes() if words else None)
            yield pa.RecordBatch.from_pydict({
                "doc": column(batch, "doc"), "body": pa.array(bodies, pa.binary()),
                "n_shingles": pa.array(sizes, pa.int64()), "sketch": pa.array(found, pa.binary())})

    return docs.select(F.col(key).cast("long").alias("doc"),
                       F.col(text).alias("text")).mapInArrow(run, schema)


def bands(nodes: DataFrame) -> DataFrame:
    """(band, doc): the hash of each band of registers, with the band's number in it."""
    width = 2 * BAND
    hashed = [F.xxhash64(F.lit(i), F.substring("sketch", 1 + i * width, width))
              for i in range(REGISTERS // BAND)]
    return nodes.select("doc", F.explode(F.array(*hashed)).alias("band"))


def estimated(pairs: DataFrame, nodes: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold and whose estimate comes near it."""
    side = nodes.select("doc", "n_shingles", "sketch")
    joined = (
        pairs.join(side.toDF("a", "n_a", "s_a"), "a").join(side.toDF("b", "n_b", "s_b"), "b")
        .where((F.least("n_a", "n_b") * threshold.denominator
                >= F.greatest("n_a", "n_b") * threshold.numerator))
    )
    least = float(threshold) - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(column(batch, c).to_pylist()), "<u2")
                    .reshape(-1, REGISTERS) for c in ("s_a", "s_b"))
            sizes = [column(batch, c).to_numpy().astype(float) for c in ("n_a", "n_b")]
            good = pa.array(similarity(a, b, *sizes) >= least)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "a").filter(good), column(batch, "b").filter(good)], ["a", "b"])

    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    joined = (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
              .select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            good, held, of = [], None, None
            for x, y in zip(utf8(batch, "text_a"), utf8(batch, "text_b")):
                if x != held:
                    held, of = x, shingles(folded_words(x), size)
                other = shingles(folded_words(y), size)
                common = len(np.intersect1d(of, other, assume_unique=True))
                union = len(of) + len(other) - common
                good.append(common * threshold.denominator >= union * threshold.numerator)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "a").filter(keep), column(batch, "b").filter(keep)], ["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def star(members: DataFrame, by: str) -> DataFrame:
    """Pairs of each group's first document (in the order ``by``) with its others."""
    heads = members.groupBy("band").agg(
        F.min_by("doc", by).alias("head"), F.count("*").alias("n")).where("n > 1")
    return (members.join(heads, "band").where("doc <> head")
            .select(F.least("doc", "head").alias("a"), F.greatest("doc", "head").alias("b"))
            .distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                    threshold: Fraction = Fraction(4, 5), rounds: int = 2) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Documents whose shingle sets have a Jaccard similarity of ``threshold`` or more are linked;
    ``component_id`` is the least key that links reach. Equal sequences of words are linked at
    once. Of the others, candidates share a band of registers (a pair at 0.8 misses all bands
    with probability 5e-8). Within a band group no list of all pairs is made: every document is
    compared with one head, for ``rounds`` choices of heads. The documents of groups that then
    still hold several components are joined by their rarest shingles (an exact prefix filter),
    so that pairs which cannot reach the threshold are hardly formed.

    Rows without words (or text) have size 0, are linked with nothing and are their own
    component. Rows with the same key are one document, linked by any of their texts. Rows
    without key get no component and are kept. An empty table gives no rows.
    """
    of_rows = materialise(sketches(docs, key, text, size), "sketches")
    bodies = (
        of_rows.where("body IS NOT NULL").groupBy("body")
        .agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles"),
             F.first("sketch").alias("sketch")).where("doc IS NOT NULL")
    )
    nodes = materialise(bodies, "nodes")
    grouped = bands(nodes)
    shared = grouped.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = materialise(grouped.join(shared, "band"), "members")
    involved = members.select("doc").distinct()
    texts = materialise(
        docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
        .join(involved, "doc", "left_semi"), "texts")

    def test(pairs: DataFrame, name: str) -> DataFrame:
        near = materialise(estimated(pairs, nodes, threshold), f"near-{name}")
        return materialise(confirmed(near, texts, size, threshold), f"links-{name}")

    links, open_members, labels = None, members, None
    orders = [F.col("doc")] + [F.xxhash64(F.lit(i), "doc") for i in range(1, rounds)]
    for i, order in enumerate(orders):
        found = test(star(open_members.withColumn("by", order), "by"), f"star{i}")
        links = found if links is None else links.unionByName(found)
        labels = materialise(components(links), "labels")
        open_members = materialise(_unsettled(open_members, labels), "open")
        if open_members.isEmpty():
            break
    else:
        inner = texts.join(open_members.select("doc").distinct(), "doc", "left_semi")
        entries = materialise(rare_shingles(inner, size, threshold), "rare-shingles")
        rest = _across(entries, labels, threshold)
        links = links.unionByName(test(rest, "rest"))
        labels = materialise(components(links), "labels")
    named = of_rows.select("doc", "n_shingles", "body")
    by_body = bodies_with_label(nodes, of_rows, labels)
    out = named.join(by_body, "body", "left").select(
        F.col("doc").alias(key), "n_shingles",
        F.coalesce("component", "doc").alias("component_id"))
    return out.withColumn("kept", F.coalesce(
        F.col(key) == F.col("component_id"), F.col(key).isNull()))


def bodies_with_label(nodes: DataFrame, rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(body, component) of every sequence of words."""
    own = (rows.where("body IS NOT NULL").groupBy("body").agg(F.min("doc").alias("doc")))
    return (own.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
            .select("body", F.coalesce("component", "doc").alias("component")))


def rare_shingles(texts: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """(h, doc, n, i) of the rarest shingles of each text, which any text similar enough must
    share in part: with n shingles ordered by the number of texts that have them, those at the
    places i up to ``(1 - threshold) * n``. Shingles of one text alone only take up places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [folded_words(raw) for raw in utf8(batch, "text")]
            found = [shingles(w, size) for w in words]
            n = [len(h) for h in found]
            bodies = np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words], np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(column(batch, "doc").to_numpy(), n)),
                pa.array(np.repeat(bodies.view(np.int64), n)), pa.array(np.repeat(n, n)),
                pa.array(np.concatenate(found).view(np.int64))], ["doc", "body", "n", "h"])

    every = texts.select("doc", "text").mapInArrow(run, "doc long, body long, n long, h long")
    several = every.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = every.join(several, "h").groupBy("doc", "body", "n").agg(
        F.array_sort(F.collect_set(F.struct("df", "h"))).alias("got"))
    placed = shared.select("doc", "n", (F.col("n") - F.size("got")).alias("alone"),
                           F.posexplode("got").alias("at", "x"))
    i = F.col("alone") + F.col("at")
    return placed.where(i * threshold.denominator <= F.col("n") * (
        threshold.denominator - threshold.numerator)).select("x.h", "doc", "n", i.alias("i"))


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, doc, label, main) of the groups that still hold several components. Of two
    documents the one with the head was the only pair."""
    named = members.select("band", "doc").join(
        labels.select(F.col("node").alias("doc"), "component"), "doc", "left"
    ).select("band", "doc", F.coalesce("component", "doc").alias("label"))
    sizes = named.groupBy("band", "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("band").agg(
        F.count("*").alias("n_labels"), F.sum("n").alias("n_docs"),
        F.max_by("label", "n").alias("main")).where("n_labels > 1 AND n_docs > 2")
    return named.join(open_.select("band", "main"), "band")


def _across(entries: DataFrame, labels: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs in different components that can reach the threshold t.

    Two sets of sizes n and m need t / (1 + t) * (n + m) shingles in common, so they share one
    among the places of each that leave as many. For each shingle, documents outside the
    component that has it most often are compared with all others that have it.
    """
    named = entries.join(labels.select(F.col("node").alias("doc"), "component"), "doc", "left")
    named = named.withColumn("label", F.coalesce("component", "doc")).drop("component")
    per_label = named.groupBy("h", "label").agg(F.count("*").alias("k"))
    mixed = per_label.groupBy("h").agg(
        F.count("*").alias("labels"), F.max_by("label", "k").alias("main")).where("labels > 1")
    members = named.join(mixed.select("h", "main"), "h")

    def side(name: str) -> DataFrame:
        return members.select("h", "main", *[
            F.col(c).alias(f"{name}_{c}") for c in ("doc", "label", "n", "i")])

    t, q = threshold.numerator, threshold.numerator + threshold.denominator
    needed = (F.col("x_n") + F.col("y_n")) * t
    both = side("x").where("x_label <> main").drop("main").join(side("y").drop("main"), "h")
    return (
        both.where((F.col("x_label") != F.col("y_label"))
                   & ((F.col("x_n") - F.col("x_i")) * q >= needed)
                   & ((F.col("y_n") - F.col("y_i")) * q >= needed)
                   & (F.least("x_n", "y_n") * threshold.denominator
                      >= F.greatest("x_n", "y_n") * t))
        .select(F.least("x_doc", "y_doc").alias("a"), F.greatest("x_doc", "y_doc").alias("b"))
        .distinct()
    )


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near copies among all documents on four-word shingles."""
    return near_duplicates(documents(spark, sf_dir), size=4)
