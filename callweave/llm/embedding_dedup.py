"""Embedding near-dedup with iterative quantisation.

A rotation of the principal components is learned so that the signs of the rotated vectors are
balanced codes with little loss (iterative quantisation). Several rotations give one long code;
pieces of the code are the keys of Hamming tables, and vectors that share a key are reranked by
the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.llm.components import components
from callweave.llm.text import column
from callweave.session import materialise
from callweave.sources.tables import read_table

#: Components (numbers) of the sample that a rotation is learned from, and rounds of learning.
FIT_NUMBERS, ROUNDS = 2_000_000, 25
#: Wanted share of the pairs at exactly the threshold that meet in a table; nearer ones meet
#: more often.
RECALL = 0.97
#: Vectors of a large key that one task compares with as many others.
BLOCK = 1024


def table_sizes(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits of a key, number of tables). Keys are a few bits wider than needed to tell ``n``
    vectors apart; a bit of two vectors at the angle a differs with a probability of a / pi, and
    there are enough tables for the recall at the threshold."""
    bits = min(30, max(8, ceil(log2(max(n, 2))) + 2))
    same = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(1 - recall) / log(1 - same))


def learn(sample: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, matrix) of one quantiser of at most ``bits`` bits: principal components, then the
    rotation that brings them nearest to their signs."""
    dims = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    main = vectors[:, ::-1][:, :min(bits, dims)]
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(main.shape[1],) * 2))[0]
    projected = centred @ main
    for _ in range(ROUNDS):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(signs.T @ projected)
        rotation = (u @ vt).T
    return mean, main @ rotation


class Quantiser:
    """Rotations learned from unit vectors of ``dims`` components, for ``tables`` keys of
    ``bits`` bits. Vectors of another length get random rotations, always the same ones."""

    def __init__(self, sample: np.ndarray, dims: int, bits: int, tables: int):
        self.dims, self.bits, self.tables = dims, bits, tables
        self.parts = self._parts(sample, dims)

    def _parts(self, sample: np.ndarray, dims: int) -> list[tuple[np.ndarray, np.ndarray]]:
        parts, got = [], 0
        while got < self.bits * self.tables:
            parts.append(learn(sample, 1 << 30, len(parts)))
            got += parts[-1][1].shape[1]
        return parts

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The key of each table for each row."""
        dims = unit.shape[1]
        parts = self.parts if dims == self.dims else self._parts(np.eye(dims), dims)
        signs = np.concatenate([(unit - mean) @ matrix >= 0 for mean, matrix in parts], axis=1)
        # neighbouring bits of a key come from different places of the rotation
        used = signs[:, :self.bits * self.tables].reshape(len(unit), self.tables, self.bits)
        return (used.astype(np.int64) << np.arange(self.bits)).sum(axis=2).astype(np.int32)


def fit(classes: DataFrame, bits: int, tables: int, numbers: int = FIT_NUMBERS) -> Quantiser | None:
    """Rotations for the commonest length, learned from rows of least hash, as many as make up
    ``numbers`` components; None without rows."""
    common = classes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None
    dims = common["d"]
    rows = (classes.where(F.size("v") == dims).orderBy(F.xxhash64("v"), "node")
            .limit(max(1, numbers // dims)).select("v").toPandas()["v"])
    sample = np.array([np.asarray(v, float) for v in rows])
    return Quantiser(scaled(sample), dims, bits, tables)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; the largest component is divided out first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def vector_classes(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(node, vec, copies, v) of the distinct usable vectors: ``node`` is a number, ``vec`` the
    least key. Rows without key are left out."""
    v = F.col(vector).cast("array<double>")
    usable = (F.col(key).isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0))
    grouped = rows.where(usable).groupBy(v.alias("v")).agg(
        F.min(F.col(key).cast("long")).alias("vec"), F.count("*").alias("copies"))
    return materialise(grouped.select(
        F.monotonically_increasing_id().alias("node"), "vec", "copies", "v"), "vector-classes")


def _arrays(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows) of the vectors of a batch, for each length."""
    lists = column(batch, name)
    sizes = lists.value_lengths().to_numpy()
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, flat.reshape(len(at), d)


def table_keys(classes: DataFrame, quantiser: Quantiser) -> DataFrame:
    """(node, t, k): each vector's key in each table; ``t`` has the vector's length as well."""
    shared = classes.sparkSession.sparkContext.broadcast(quantiser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                nodes = column(part, "node").to_numpy()
                for at, rows in _arrays(part, "v"):
                    keys = q.keys(scaled(rows))
                    yield pa.RecordBatch.from_pydict({
                        "node": pa.array(np.repeat(nodes[at], q.tables)),
                        "t": pa.array(np.tile(np.arange(q.tables, dtype=np.int64), len(at))
                                      + (rows.shape[1] << 16)),
                        "k": pa.array(keys.ravel())})

    return classes.select("node", "v").mapInArrow(run, "node long, t long, k int")


def blocks(entries: DataFrame, size: int) -> DataFrame:
    """(t, k, i, j, half, node): the entries of each key, dealt out so that every two meet once.

    Up to ``size`` entries are one block. A larger key is cut into blocks by a hash of the node,
    and each pair of blocks is a piece of work of its own; ``half`` tells the two apart.
    """
    counts = entries.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    cut = entries.join(counts, ["t", "k"]).withColumn(
        "of", F.ceil(F.col("n") / size).cast("int")).withColumn(
        "b", F.pmod(F.xxhash64("node"), F.col("of")).cast("int"))
    return cut.select("t", "k", "node", "b", F.explode(F.sequence(
        F.lit(0), F.col("of") - 1)).alias("other")).select(
        "t", "k", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"),
        (F.col("b") > F.col("other")).alias("half"), "node")


def compared(pieces: DataFrame, classes: DataFrame, quantiser: Quantiser,
             threshold: float) -> DataFrame:
    """(node, k, root) of the vectors with links: ``k`` rows are linked in this piece of work,
    and links lead to ``root``. A pair is counted in the first table in which it meets, so no
    list of pairs is made."""
    shared = classes.sparkSession.sparkContext.broadcast(quantiser)
    joined = pieces.join(classes.select("node", "copies", "v"), "node").select(
        "t", "k", "i", "j", "half", "node", "copies", "v")
    dealt = joined.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value

        def found(held: list) -> pa.RecordBatch | None:
            t, _, i, j = held[0][:4]
            half, node, copies = (np.array([h[c] for h in held]) for c in (4, 5, 6))
            rows = scaled(np.array([h[7] for h in held], float))
            left, right = (np.flatnonzero(~half), np.flatnonzero(half)) if i != j else (
                np.arange(len(node)),) * 2
            links = np.zeros(len(node), np.int64)
            root, keys = np.arange(len(node)), None
            for s in range(0, len(left), 256):
                a = left[s:s + 256]
                near = rows[a] @ rows[right].T >= threshold
                if i == j:
                    near &= a[:, None] != right[None, :]
                x, y = np.nonzero(near)
                if not len(x):
                    continue
                keys = q.keys(rows)[:, :(t & 0xFFFF)] if keys is None else keys
                x, y = a[x], right[y]
                first = np.ones(len(x), bool)
                for u in range(0, len(x), 100_000):  # in no earlier table
                    first[u:u + 100_000] = ~(keys[x[u:u + 100_000]] == keys[y[u:u + 100_000]]).any(axis=1)
                x, y = x[first], y[first]
                np.add.at(links, x, copies[y])
                if i != j:
                    np.add.at(links, y, copies[x])
                for p, r in zip(x.tolist(), y.tolist()):
                    p, r = _root(root, p), _root(root, r)
                    root[max(p, r)] = min(p, r)
            got = np.flatnonzero(links)
            if not len(got):
                return None
            return pa.RecordBatch.from_pydict({
                "node": pa.array(node[got]), "k": pa.array(links[got]),
                "root": pa.array(node[[_root(root, int(p)) for p in got]])})

        held: list = []
        for batch in batches:
            names = batch.schema.names
            for row in zip(*(column(batch, c).to_pylist() for c in names)):
                if held and row[:4] != held[0][:4]:
                    if (out := found(held)) is not None:
                        yield out
                    held = []
                held.append(row)
        if held and (out := found(held)) is not None:
            yield out

    return dealt.mapInArrow(run, "node long, k long, root long")


def _root(root: np.ndarray, p: int) -> int:
    while root[p] != p:
        root[p] = root[root[p]]
        p = root[p]
    return int(p)


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 threshold: float = 0.9, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Rows whose vectors have a cosine of ``threshold`` or more (in double precision) and meet in
    a table are linked; equal vectors always are. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the least key that links reach, ``kept`` tells the row with
    that key. Vectors of different lengths are not compared. Vectors that are missing, empty,
    zero or hold missing or non-finite components, and rows without key, link with nothing and
    are their own component (without key: none, and kept). Rows that repeat a key are several
    vectors. An empty table gives no rows.
    """
    classes = vector_classes(rows, key, vector)
    bits, tables = table_sizes(classes.count(), threshold, recall)
    quantiser = fit(classes, bits, tables)
    named = rows.select(F.col(key).cast("long").alias("vec"),
                        F.col(vector).cast("array<double>").alias("v"))
    if quantiser is None:
        return named.select(
            F.col("vec").alias(key), F.lit(0).cast("long").alias("n_links"),
            F.col("vec").alias("component_id"), F.lit(True).alias("kept"))
    entries = materialise(table_keys(classes, quantiser), "table-keys")
    found = materialise(
        compared(blocks(entries, block), classes, quantiser, threshold), "vector-links")
    links = found.groupBy("node").agg(F.sum("k").alias("k"))
    ends = classes.select("node", F.struct("vec", "node").alias("e"))  # the least has the least key
    edges = found.select("node", "root").where("node <> root").distinct() \
        .join(ends.toDF("node", "a"), "node").join(ends.toDF("root", "b"), "root")
    reached = components(edges).select(
        F.col("node.node").alias("node"), F.col("component.vec").alias("least"))
    judged = classes.join(links, "node", "left").join(reached, "node", "left").select(
        F.col("v").alias("_v"), F.coalesce("least", "vec").alias("_component"),
        (F.col("copies") - 1 + F.coalesce("k", F.lit(0))).alias("_links"))
    usable = named.join(judged, F.col("vec").isNotNull() & (F.col("v") == F.col("_v")), "left")
    component = F.coalesce("_component", "vec")
    return usable.select(
        F.col("vec").alias(key), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec") == component, F.lit(True)).alias("kept"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all vectors."""
    return near_vectors(read_table(spark, "embeddings", root=sf_dir))


OP13_SQL = """
WITH v AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e
    FROM embeddings
), good AS (
    SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v
    WHERE vec_id IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON len(a.e) = len(b.e) AND a.r <> b.r
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach AS (
    WITH RECURSIVE w AS (
        SELECT a, b FROM link UNION SELECT w.a, link.b FROM w JOIN link ON w.b = link.a)
    SELECT w.a, min(v.vec_id) AS least FROM w JOIN v ON w.b = v.r GROUP BY w.a
), degree AS (
    SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links,
       least(v.vec_id, r.least) AS component_id,
       coalesce(v.vec_id = least(v.vec_id, r.least), true) AS kept
FROM v LEFT JOIN degree d ON d.a = v.r LEFT JOIN reach r ON r.a = v.r
"""
