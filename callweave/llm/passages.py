"""Substring dedup by collinear chaining.

Seeds are minimizers of word k-mers. Every seed links its occurrences to the first one, so a
passage that many documents share costs one pair for each of them. The seeds of two documents
are chained in order with gap costs, the best predecessor coming from a Fenwick tree of prefix
maxima, and chains are extended and aligned to find passages that repeat exactly or nearly.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from callweave.llm.decontaminate import Pattern
from callweave.llm.text import column, documents, folded_words, slices, utf8
from callweave.session import materialise

#: Words of a seed, and of the window of which it is the least: any exact repeat of
#: ``SEED + WINDOW - 1`` words has a seed in common.
SEED, WINDOW = 6, 12
#: Cost of each word of a gap, in seeds.
GAP_COST = 0.02
#: Words of a chain to be looked at, and between chains that are joined at the end.
SHORTEST, BETWEEN = 20, 6
#: Words a chain is extended by at most on each side.
REACH = 200
#: Involved documents up to this many are sent to all tasks as a list of ids.
SMALL_IDS = 4_000_000


def kmers(words: list[bytes]) -> np.ndarray:
    """Hashes of the k-mers."""
    n = len(words) - SEED + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for i in range(SEED):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(27))


def minimizers(h: np.ndarray) -> np.ndarray:
    """Places of the least k-mer of every window (the first of equal ones)."""
    if len(h) <= WINDOW:
        return np.array([int(np.argmin(h))]) if len(h) else np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    return np.unique(np.argmin(view, axis=1) + np.arange(len(view)))


def numbered(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and their places. A seed that a text has before gets a second name with its
    number, so that texts which repeat themselves can still be laid side by side."""
    order = np.argsort(h[at], kind="stable")
    keys = h[at][order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    number = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    again = number > 0
    extra = (keys[again] ^ number[again].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([h[at], extra]), np.concatenate([at, at[order][again]])


def seeds(docs: DataFrame) -> DataFrame:
    """(seed, doc, pos) of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            doc, found, places = [], [], []
            for d, raw in zip(column(batch, "doc").to_pylist(), utf8(batch, "text")):
                h = kmers(folded_words(raw))
                keys, at = numbered(h, minimizers(h))
                found.append(keys)
                places.append(at)
                doc.append(np.full(len(at), d, np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(doc)),
                pa.array(np.concatenate(places).astype(np.int32))], ["seed", "doc", "pos"])

    return docs.mapInArrow(run, "seed long, doc long, pos int")


class PrefixMaxima:
    """Fenwick tree of maxima over the places 0..n-1."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def below(self, at: int) -> tuple[float, int]:
        """The greatest value at a place less than ``at``."""
        found = self.best[0]
        while at > 0:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


def chain(first: list[int], pos: list[int]) -> list[tuple[int, ...]]:
    """Chains of seeds that follow each other in both documents, as runs without wide gaps:
    (from, to) in the first document, (from, to) in the other one, and the same of the next
    run. Seeds come in the order of ``pos``.

    A chain scores one for each seed less ``GAP_COST`` for each word between seeds on either
    side. With that cost added back by place, the best predecessor is a prefix maximum.
    """
    places = sorted(set(first))
    tree, n = PrefixMaxima(len(places)), len(pos)
    score, before, waiting = [0.0] * n, [-1] * n, []
    for i in range(n):
        while waiting and pos[waiting[0]] < pos[i]:  # only lesser places in both count
            j = waiting.pop(0)
            tree.put(bisect_left(places, first[j]),
                     (score[j] + GAP_COST * (first[j] + pos[j]), j))
        value, j = tree.below(bisect_left(places, first[i]))
        score[i] = 1.0
        if j >= 0:
            linked = 1.0 + value - GAP_COST * (first[i] + pos[i])
            if linked > 1.0:
                score[i], before[i] = linked, j
        waiting.append(i)
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        j, own = i, []
        while j >= 0 and not used[j]:
            used[j] = True
            own.append(j)
            j = before[j]
        if len(own) > 1 and pos[i] + SEED - pos[own[-1]] >= SHORTEST:
            out.append(_runs([first[j] for j in own[::-1]], [pos[j] for j in own[::-1]]))
    return out


def _runs(first: list[int], pos: list[int]) -> tuple[int, ...]:
    """Seeds of a chain in order, as runs: neighbouring seeds of an exact repeat are at most
    ``WINDOW`` words apart."""
    cuts = [i for i in range(1, len(pos))
            if max(first[i] - first[i - 1], pos[i] - pos[i - 1]) > WINDOW]
    return tuple(x for s, e in zip([0, *cuts], [*cuts, len(pos)])
                 for x in (first[s], first[e - 1] + SEED, pos[s], pos[e - 1] + SEED))


def chains(met: DataFrame) -> DataFrame:
    """(lead, doc, runs) of the chains between each seed's first document and the others that
    have it."""
    lead = met.groupBy("seed").agg(F.min(F.struct("doc", "pos")).alias("first"))
    linked = met.join(lead, "seed").where("doc <> first.doc").select(
        F.col("first.doc").alias("lead"), "doc", F.col("first.pos").alias("a"),
        F.col("pos").alias("b"))
    dealt = linked.repartition("lead", "doc").sortWithinPartitions("lead", "doc", "b", "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key, a, b, rows):
            if len(a) > 1:
                rows.extend((*key, c) for c in chain(a, b))

        key, a, b = None, [], []
        for batch in batches:
            rows: list[tuple] = []
            cols = [column(batch, c).to_numpy() for c in ("lead", "doc", "a", "b")]
            if not batch.num_rows:
                continue
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            cuts = [0, *new.tolist(), batch.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                at = (int(cols[0][s]), int(cols[1][s]))
                if at != key:
                    flush(key, a, b, rows)
                    key, a, b = at, [], []
                a += cols[2][s:e].tolist()
                b += cols[3][s:e].tolist()
            yield _rows(rows)
        rows = []
        flush(key, a, b, rows)
        yield _rows(rows)

    return dealt.mapInArrow(run, "lead long, doc long, runs array<int>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
    cols = list(zip(*rows)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["lead", "doc", "runs"])


def extend(a: list[bytes], b: list[bytes], i: int, j: int, step: int) -> tuple[int, int]:
    """Go on from the words before (``step`` -1) or at (1) places i and j while words agree; one
    word may differ, be missing or be added where the four after it agree again."""
    def same(x: int, y: int) -> bool:
        return 0 <= x < len(a) and 0 <= y < len(b) and a[x] == b[y]

    off = -1 if step < 0 else 0
    while True:
        if same(i + off, j + off):
            i, j = i + step, j + step
            continue
        for di, dj in ((1, 1), (1, 0), (0, 1)):
            x, y = i + off + di * step, j + off + dj * step
            if all(same(x + t * step, y + t * step) for t in range(4)):
                i, j = i + di * step, j + dj * step
                break
        else:
            return i, j


def matched(a: list[bytes], b: list[bytes], runs: list[tuple[int, int, int, int]],
            identity: float) -> Iterator[tuple[int, int, int]]:
    """(start, end, edits) in ``b`` of a chain of runs, extended and aligned; where it differs
    too much, of its parts on both sides of its widest gap."""
    todo = [runs]
    while todo:
        part = todo.pop()
        s, start = extend(a, b, part[0][0], part[0][2], -1)
        e, end = extend(a, b, part[-1][1], part[-1][3], 1)
        if end - start < SHORTEST:
            continue
        if a[s:e] == b[start:end]:
            edits = 0
        else:
            edits = Pattern(b[start:end]).nearest(a[s:e])
        if edits <= (1 - identity) * (end - start):
            yield start, end, edits
        elif len(part) > 1:
            cut = max(range(1, len(part)), key=lambda i: max(
                part[i][0] - part[i - 1][1], part[i][2] - part[i - 1][3]))
            todo += [part[:cut], part[cut:]]


def aligned(found: DataFrame, docs: DataFrame, identity: float) -> DataFrame:
    """(lead, doc, start, end, edits) in words of ``doc``: chains extended and aligned."""
    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out, offset = [], []
            for raw, runs in zip(utf8(batch, "text"), column(batch, "runs").to_pylist()):
                at = max(0, runs[0] - REACH)
                out.append(b" ".join(folded_words(raw)[at:runs[-3] + REACH]))
                offset.append(at)
            keep = {c: column(batch, c) for c in ("lead", "doc", "runs")}
            yield pa.RecordBatch.from_pydict({
                **keep, "off": pa.array(offset, pa.int32()), "part": pa.array(out, pa.binary())})

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            cols = [column(batch, c).to_pylist() for c in ("lead", "doc", "runs", "off", "part")]
            for lead, doc, flat, off, part, raw in zip(*cols, utf8(batch, "text")):
                runs = [(flat[i] - off, flat[i + 1] - off, flat[i + 2], flat[i + 3])
                        for i in range(0, len(flat), 4)]
                rows += [(lead, doc, *m) for m in matched(
                    part.split(b" "), folded_words(raw), runs, identity)]
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["lead", "doc", "start", "end", "edits"])

    texts = docs.select("doc", "text")
    sides = found.join(texts.withColumnRenamed("doc", "lead"), "lead").select(
        "lead", "doc", "runs", "text").mapInArrow(
            trim, "lead long, doc long, runs array<int>, off int, part binary")
    return sides.join(texts, "doc").select(
        "lead", "doc", "runs", "off", "part", "text").mapInArrow(
            align, "lead long, doc long, start int, end int, edits int")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      min_words: int = 50, identity: float = 0.8) -> DataFrame:
    """(key, start, end, n_words, edits, earlier): passages that repeat an earlier document.

    ``start`` and ``end`` (exclusive) count words of the row's text, ``earlier`` lists the keys
    of the documents that hold the passage or parts of it before, in the order of keys; a
    passage has ``min_words`` words or more and at least ``identity`` of them agree. Each seed
    is compared with its first document only: later holders of one passage are not paired with
    each other, and every one of them is reported. Words are folded to lower case (A-Z).

    Rows without key, text or enough words take no part; rows that repeat a key are one
    document, compared by any of their texts; repeats within one document are not reported.
    """
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where(
        F.col("doc").isNotNull() & F.col("text").isNotNull())
    all_seeds = seeds(named)
    shared = all_seeds.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    met = materialise(all_seeds.join(shared, "seed").select("seed", "doc", "pos"), "seeds")
    found = materialise(chains(met), "chains")
    ids = found.select(F.explode(F.array("lead", "doc")).alias("doc")).distinct()
    ids = materialise(ids, "chained")
    few = ids.count() <= SMALL_IDS
    texts = materialise(
        named.join(F.broadcast(ids) if few else ids, "doc", "left_semi"), "texts")
    spans = aligned(found, texts, identity).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "edits", "lead"))).alias("spans"))
    return _joined(spans).where(F.col("n_words") >= min_words).withColumnRenamed("doc", key)


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of a document that overlap or nearly touch, as one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, got in zip(column(batch, "doc").to_pylist(),
                                column(batch, "spans").to_pylist()):
                open_: list | None = None
                for s in got:
                    if open_ and s["start"] <= open_[1] + BETWEEN:
                        open_[1] = max(open_[1], s["end"])
                        open_[2] = max(open_[2], s["edits"])
                        open_[3].add(s["lead"])
                        continue
                    if open_:
                        out.append((doc, *open_))
                    open_ = [s["start"], s["end"], s["edits"], {s["lead"]}]
                out.append((doc, *open_))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_pydict({
                "doc": pa.array(cols[0], pa.int64()), "start": pa.array(cols[1], pa.int32()),
                "end": pa.array(cols[2], pa.int32()),
                "n_words": pa.array([e - s for s, e in zip(cols[1], cols[2])], pa.int32()),
                "edits": pa.array(cols[3], pa.int32()),
                "earlier": pa.array([sorted(x) for x in cols[4]], pa.list_(pa.int64()))})

    return spans.mapInArrow(
        run, "doc long, start int, end int, n_words int, edits int, earlier array<long>")


def op6_passages(spark, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier document."""
    return repeated_passages(documents(spark, sf_dir))
