"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k is cut into k + 1 pieces: a passage within k edits of it
holds at least one piece unchanged. Pieces are found by exact search, and the text around each
hit is verified with Myers' bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from callweave.llm.text import documents, slices, utf8, with_columns
from callweave.sources.tables import read_table

#: Edits that count as the same passage, as a share of an item's length.
ERROR_RATE = 0.05
#: Bytes of item text that are searched in one pass over the documents.
BLOCK_BYTES = 4 << 20


def normal(text: bytes) -> str:
    """A-Z in lower case, runs of ASCII white space as one space."""
    return b" ".join(text.lower().split()).decode()


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length, with their offsets."""
    n = errors + 1
    at = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:])]


class Pattern:
    """Myers' bit-parallel matching of one item; Python integers hold words of any length."""

    def __init__(self, item: str):
        self.size = len(item)
        self.mask = (1 << self.size) - 1
        self.last = 1 << (self.size - 1)
        self.where: dict[str, int] = {}
        for i, c in enumerate(item):
            self.where[c] = self.where.get(c, 0) | (1 << i)

    def nearest(self, text: str, enough: int = 0) -> int:
        """Least edit distance between the item and any stretch of ``text``."""
        get, mask, last = self.where.get, self.mask, self.last
        plus, minus, distance = mask, 0, self.size
        best = distance
        for c in text:
            eq = get(c, 0)
            down = eq | minus
            across = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (~(across | plus) & mask)
            low = plus & across
            if up & last:
                distance += 1
            elif low & last:
                distance -= 1
                if distance < best:
                    best = distance
                    if best <= enough:
                        break
            up, low = (up << 1) & mask, (low << 1) & mask
            plus, minus = low | (~(down | up) & mask), up & down
        return best


class Search:
    """Exact search for the pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, int(len(t) * rate)) for i, t in items if t]
        self.patterns: dict[int, Pattern] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, errors) in enumerate(self.items):
            for at, piece in cut(t, errors):
                places.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def leaks(self, text: str) -> list[tuple[int, int]]:
        """(item, edits) of the items that ``text`` holds within their budgets."""
        if self.empty:
            return []
        best: dict[int, int] = {}
        tried: dict[int, list[tuple[int, int]]] = {}
        for last, (size, found) in self.automaton.iter(text):
            for n, at in found:
                _, item, errors = self.items[n]
                if best.get(n, errors + 1) == 0:
                    continue
                start = last + 1 - size - at - errors
                lo, hi = max(0, start), start + len(item) + 2 * errors
                if any(a <= lo and hi <= b for a, b in tried.get(n, ())):
                    continue
                tried.setdefault(n, []).append((lo, hi))
                if n not in self.patterns:
                    self.patterns[n] = Pattern(item)
                edits = self.patterns[n].nearest(text[lo:hi])
                if edits <= errors and edits < best.get(n, errors + 1):
                    best[n] = edits
        return sorted((self.items[n][0], e) for n, e in best.items())


def blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``size`` bytes, read one after the other."""
    held, total = [], 0
    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("t"))
    for row in rows.where("k IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        item = normal(bytes(row["t"]))
        if held and total + len(item) > size:
            yield held
            held, total = [], 0
        held.append((row["k"], item))
        total += len(item)
    if held:
        yield held


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text", rate: float = ERROR_RATE,
               block: int = BLOCK_BYTES) -> DataFrame:
    """Every row with ``leaks``: (item, edits) of each item found, in the order of items.

    An item of length n (case and white space folded) is found where a passage of the text is
    within ``int(rate * n)`` edits of it. Items are broadcast in blocks of about ``block``
    bytes, and every block is searched in all rows, so a benchmark of any size is searched in
    bounded memory. A text that is missing or empty, and an empty benchmark, give no leaks;
    items without key or text are not searched. A column of ``docs`` named ``leaks`` is
    replaced. Rows are treated one by one.
    """
    gone = tuple(c for c in docs.columns if c.lower() == "leaks")
    leak = T.StructType([T.StructField("item", T.LongType()), T.StructField("edits", T.LongType())])
    kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int64())]))
    kept = [f for f in docs.schema.fields if f.name not in gone]
    out = docs.select(*[F.col(f"`{f.name}`") for f in kept],
                      F.array().cast(T.ArrayType(leak)).alias("leaks"))
    schema = T.StructType([*kept, T.StructField("leaks", T.ArrayType(leak))])

    def searching(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(shared.value, rate)
            for batch in slices(batches, text):
                before = batch.column(batch.schema.names.index("leaks")).to_pylist()
                found = [old + [{"item": i, "edits": e} for i, e in search.leaks(normal(raw or b""))]
                         for old, raw in zip(before, utf8(batch, text))]
                yield with_columns(batch, {"leaks": pa.array(found, kind)}, ("leaks",))
        return run

    for part in blocks(items, item_key, item_text, block):
        shared = docs.sparkSession.sparkContext.broadcast(part)
        out = out.mapInArrow(searching(shared), schema)
    return out


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    """One row for each benchmark item found in a document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_leaks(docs, read_table(spark, "benchmark", root=sf_dir))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item").alias("item_id"), F.col("leak.edits").alias("edits"))
