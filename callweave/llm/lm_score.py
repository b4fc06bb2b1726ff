"""Language-model scoring with a log-frequency Bloom filter.

The filter holds each n-gram of the training texts once for every level of its quantised count,
so that a count is read by probing level after level until one is missing. Every counted n-gram
is in it, those seen once too: it has ten bits for each insertion, however many there are, in
blocks of 512 bits, each n-gram in one block. Counting is a Spark aggregate over all training
texts. The filter is broadcast in parts of bounded size, and a task goes through them one by one
for a few million tokens at a time; the tokens that make up a stated share of all tokens are
broadcast as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from callweave.llm.text import bucket, column, documents, folded_words, slices, utf8
from callweave.session import materialise

#: Blocks of a part of the filter (2 to this power), bits of a block, probes of an n-gram and level.
BLOCK_BITS, WIDTH, PROBES = 19, 512, 4
#: Shards of the filter (2 to this power): each has blocks for its own insertions.
SHARD_BITS = 12
#: Insertions a block has on average: ten bits for each.
CAPACITY = WIDTH // 10
#: Tokens that a task holds while it goes through the parts of the filter.
HOLD = 1_000_000
#: Counts are quantised to levels 1, 2, .. that grow by this factor.
GROWTH = 1.5
LEVELS = 60
#: Tokens with at least this share of all training tokens are broadcast: at most its inverse.
SHARE = 1 / 4_000_000
#: Weight of the bigram estimate against the unigram estimate.
BIGRAM_WEIGHT = 0.4
#: Added to every token's count.
ADDED = 0.1
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts one after the other, an end token after each, and the
    place of each text's end."""
    words = [folded_words(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    out = np.empty(int(sizes.sum()) + len(words), np.uint64)
    out[ends] = END
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws),
                             np.uint64, int(sizes.sum()))
    return out, ends


def before(token: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token before each one; a text begins after the start mark."""
    prev = np.concatenate(([START], token[:-1]))
    prev[ends[:-1] + 1] = START
    return prev


def unigram_keys(token: np.ndarray) -> np.ndarray:
    return mix(token * _A + _B)


def bigram_keys(prev: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(prev * _A + token * _B + _C)


def level(count: np.ndarray) -> np.ndarray:
    """Level of a count of 1 or more."""
    return np.minimum(LEVELS, 1 + np.floor(
        np.log(np.maximum(count, 1)) / np.log(GROWTH) + 1e-9)).astype(np.int64)


def probes(keys: np.ndarray, at: np.ndarray | int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bit) of each probe of a key's level, within the key's block."""
    g = mix(keys + np.asarray(at).astype(np.uint64) * _C)
    for i in range(PROBES):
        place = (g >> np.uint64(16 * i)) & np.uint64(WIDTH - 1)
        yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def blocks_of(keys: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The block of each key among ``n``, by its first 32 bits."""
    return ((keys >> np.uint64(32)) * np.asarray(n).astype(np.uint64)
            >> np.uint64(32)).astype(np.int64)


def shards_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SHARD_BITS)).astype(np.int64)


def expected_counts(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of each level; 0 for level 0."""
    edge = np.ceil(GROWTH ** np.arange(LEVELS + 1) - 1e-6)
    return np.concatenate(([0.0], np.sqrt(edge[:-1] * (edge[1:] - 1))))[levels]


class LogFrequencyBloom:
    """Blocks of some shards, ``first`` and ``n`` being the first block and the number of blocks
    of every shard; without these all blocks are one shard."""

    def __init__(self, bits: np.ndarray, first: np.ndarray | None = None,
                 n: np.ndarray | None = None):
        self.bits, self.first, self.n = bits, first, n

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The last of the levels 1, 2, .. found without a gap; 0 for an unknown key."""
        out = np.zeros(len(keys), np.int64)
        if self.n is None:
            live, blocks = np.arange(len(keys)), blocks_of(keys, len(self.bits))
        else:
            shard = shards_of(keys)
            blocks = self.first[shard] + blocks_of(keys << np.uint64(SHARD_BITS), self.n[shard])
            live = np.flatnonzero(self.n[shard])
        for at in range(1, LEVELS + 1):
            found = np.ones(len(live), bool)
            for word, bit in probes(keys[live], at):
                found &= (self.bits[blocks[live], word] & bit) != 0
            live = live[found]
            if not live.size:
                break
            out[live] = at
        return out


def filled(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Blocks of a shard: as many as its insertions need, and all of these are made."""
    n = level(counts)
    bits = np.zeros((max(1, -(-int(n.sum()) // CAPACITY)), WIDTH // 64), np.uint64)
    blocks = blocks_of(keys << np.uint64(SHARD_BITS), len(bits))
    for at in range(1, int(n.max(initial=0)) + 1):
        live = n >= at
        for word, bit in probes(keys[live], at):
            np.bitwise_or.at(bits, (blocks[live], word), bit)
    return bits


def count_ngrams(texts: DataFrame, hold: int = 4_000_000) -> DataFrame:
    """(grams, h, c) of the training texts; ``grams`` is 1 or 2. Tokens are held up to ``hold``
    at a time and counted before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(grams: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            for i in range(0, len(keys), 100_000):
                k = keys[i:i + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "grams": pa.array(np.full(len(k), grams, np.int32)),
                    "h": pa.array(k.view(np.int64)), "c": pa.array(n[i:i + 100_000])})

        one, two, held = [], [], 0
        for batch in slices(batches, "text"):
            token, ends = tokens(utf8(batch, "text"))
            one.append(token)
            two.append(bigram_keys(before(token, ends), token))
            held += len(token)
            if held >= hold:
                yield from counted(1, one)
                yield from counted(2, two)
                one, two, held = [], [], 0
        if held:
            yield from counted(1, one)
            yield from counted(2, two)

    return texts.select("text").mapInArrow(run, "grams int, h long, c long")


def build(grams: DataFrame) -> DataFrame:
    """Unigram counts (kind 0: h, c) and filter shards (kind 1: h is the shard, bits) in one
    table. N-grams are dealt out by their shard, summed, and all set."""
    shard = F.expr(f"shiftrightunsigned(IF(grams = 1, k, h), {64 - SHARD_BITS})").cast("int")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = column(batch, "h").to_numpy().view(np.uint64)
            one = column(batch, "grams").to_numpy() == 1
            k = np.where(one, unigram_keys(h), h)
            yield pa.RecordBatch.from_pydict({
                "grams": column(batch, "grams"), "h": column(batch, "h"),
                "c": column(batch, "c"), "k": pa.array(k.view(np.int64))})

    summed = (
        grams.mapInArrow(keyed, "grams int, h long, c long, k long")
        .select("grams", "h", "c", shard.alias("shard"))
        .repartition("shard").groupBy("shard", "grams", "h").agg(F.sum("c").alias("c"))
        .sortWithinPartitions("shard").select("shard", "grams", "h", "c")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind, h, c=None, bits=None):
            n = len(h)
            return pa.RecordBatch.from_pydict({
                "kind": pa.array([kind] * n, pa.int32()), "h": pa.array(h, pa.int64()),
                "c": pa.array([None] * n if c is None else c, pa.int64()),
                "bits": pa.array([bits] * n, pa.binary())})

        def shard_row(last, held):
            keys, counts = (np.concatenate(x) for x in zip(*held))
            return rows(1, [last], bits=filled(keys, counts).tobytes())

        last, held = -1, []
        for batch in batches:
            if not batch.num_rows:
                continue
            shards = column(batch, "shard").to_numpy()
            h = column(batch, "h").to_numpy().view(np.uint64)
            c = column(batch, "c").to_numpy()
            one = column(batch, "grams").to_numpy() == 1
            if one.any():
                yield rows(0, h[one].view(np.int64), c[one])
            keys = np.where(one, unigram_keys(h), h)
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for s, e in zip(cuts, cuts[1:]):
                if held and shards[s] != last:
                    yield shard_row(last, held)
                    held = []
                last = int(shards[s])
                held.append((keys[s:e], c[s:e]))
        if held:
            yield shard_row(last, held)

    return summed.mapInArrow(run, "kind int, h long, c long, bits binary")


def parts(model: DataFrame) -> list:
    """Broadcasts of (first, n, bits): shards of together about 2^BLOCK_BITS blocks, read by the
    driver one after the other."""
    out, size, held = [], 0, {}

    def send() -> None:
        n = np.zeros(1 << SHARD_BITS, np.int64)
        first = np.zeros(1 << SHARD_BITS, np.int64)
        n[list(held)] = [len(b) for b in held.values()]
        first[list(held)] = np.cumsum(n[list(held)]) - n[list(held)]
        out.append(model.sparkSession.sparkContext.broadcast(
            (first, n, np.concatenate(list(held.values())))))

    for r in model.where("kind = 1").select("h", "bits").toLocalIterator():
        bits = np.frombuffer(r["bits"], np.uint64).reshape(-1, WIDTH // 64)
        if held and size + len(bits) > 1 << BLOCK_BITS:
            send()
            size, held = 0, {}
        held[r["h"]] = bits
        size += len(bits)
    if held:
        send()
    return out


def levels_in(parts: list, keys: np.ndarray) -> np.ndarray:
    """Levels of the keys, one part of the filter in memory at a time."""
    out = np.zeros(len(keys), np.int64)
    for part in parts:
        first, n, bits = part.value
        own = np.flatnonzero(n[shards_of(keys)])
        out[own] = LogFrequencyBloom(bits, first, n).levels(keys[own])
        if len(parts) > 1:
            del bits
            part.__dict__.pop("_value", None)  # a worker reads it from its file again
    return out


def score(docs: DataFrame, training: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tokens are the words in lower case (A-Z) and one end token for each text; a missing text
    counts as empty and so has the end token only. ``base_score`` is exact: the log10
    probability of the tokens from their counts in ``training``, each with ``ADDED`` added.
    ``score`` is that of the interpolated bigram model in the filter. Without training texts
    every token has the same probability. Columns of ``docs`` with these names are replaced,
    those that begin with ``_lm_`` are left out; repeated rows are scored one by one.
    """
    spark = docs.sparkSession
    model = materialise(build(count_ngrams(training.select(F.col(text).alias("text")))), "ngrams")
    unigrams = model.where("kind = 0").select("h", "c")
    n_train, n_types = unigrams.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_texts = unigrams.where(F.col("h") == int(END.view(np.int64))).agg(F.sum("c")).first()[0] or 0
    frequent = (unigrams.where(F.col("c") >= max(2.0, n_train * SHARE)).toPandas()
                .sort_values("h", kind="stable"))
    bloom = parts(model)
    shared = spark.sparkContext.broadcast(
        (frequent["h"].to_numpy(np.int64), frequent["c"].to_numpy(np.int64)))
    floor = n_train + ADDED * (n_types + 1)
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [f for f in docs.schema.fields
            if f.name.lower() not in names and not f.name.lower().startswith("_lm_")]
    added = "row", "n", "known", "base", "model", "rare", "times"
    schema = T.StructType([*kept, *[T.StructField(f"_lm_{n}", t) for n, t in zip(added, (
        T.StringType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(),
        T.ArrayType(T.LongType()), T.ArrayType(T.LongType())))]])
    kept_names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        keys, counts = shared.value

        def modelled(held: list) -> Iterator[pa.RecordBatch]:
            """Batches with the score of the filter, which is read once for all of them."""
            token = np.concatenate([t for _, t, _ in held])
            prev = np.concatenate([before(t, ends) for _, t, ends in held])
            types, place = np.unique(token, return_inverse=True)
            single = expected_counts(levels_in(bloom, unigram_keys(types)))
            p1 = (single + ADDED) / floor
            at_prev = np.minimum(np.searchsorted(types, prev), len(types) - 1)
            context = np.where(prev == START, n_texts, single[at_prev])
            both = expected_counts(levels_in(bloom, bigram_keys(prev, token)))
            weight = np.where(context > 0, BIGRAM_WEIGHT, 0.0)
            p2 = np.minimum(1.0, both / np.maximum(context, 1.0))
            log_p = np.log10(np.minimum(1.0, weight * p2 + (1 - weight) * p1[place]))
            at = 0
            for out, t, ends in held:
                doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
                out["_lm_model"] = pa.array(
                    np.bincount(doc, log_p[at:at + len(t)], len(ends)).astype(float))
                at += len(t)
                yield pa.RecordBatch.from_pydict({f.name: out[f.name] for f in schema.fields})

        waiting, size = [], 0
        for batch in slices(batches, text):
            token, ends = tokens(utf8(batch, text))
            n = len(ends)
            doc = np.repeat(np.arange(n), np.diff(ends, prepend=-1))
            types, place = np.unique(token.view(np.int64), return_inverse=True)
            at = np.minimum(np.searchsorted(keys, types), max(len(keys) - 1, 0))
            known = (keys[at] == types) if len(keys) else np.zeros(len(types), bool)
            held = counts[at] if len(keys) else np.zeros(len(types))
            exact = np.log10((held + ADDED) / floor)
            seen = known[place]
            base = np.bincount(doc[seen], exact[place[seen]], n)
            rare_doc, rare = doc[~seen], token.view(np.int64)[~seen]
            order = np.lexsort((rare, rare_doc))
            rare_doc, rare = rare_doc[order], rare[order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rare)))
            offsets = np.searchsorted(rare_doc[first], np.arange(n + 1)).astype(np.int32)
            out = {c: column(batch, c) for c in kept_names}
            out |= {
                "_lm_row": pa.array([uuid.uuid4().hex for _ in range(n)]),
                "_lm_n": pa.array(np.diff(ends, prepend=-1)),
                "_lm_known": pa.array(np.bincount(doc[seen], minlength=n)),
                "_lm_base": pa.array(base.astype(float)),
                "_lm_rare": pa.ListArray.from_arrays(offsets, pa.array(rare[first])),
                "_lm_times": pa.ListArray.from_arrays(offsets, pa.array(times)),
            }
            waiting.append((out, token, ends))
            size += len(token)
            if len(bloom) < 2 or size >= HOLD:
                yield from modelled(waiting)
                waiting, size = [], 0
        if waiting:
            yield from modelled(waiting)

    scored = materialise(
        docs.select(*[f"`{c}`" for c in kept_names]).mapInArrow(run, schema), "scored")
    rare = scored.where(F.size("_lm_rare") > 0).select(
        "_lm_row", F.explode(F.arrays_zip("_lm_rare", "_lm_times")).alias("r")
    ).select("_lm_row", F.col("r._lm_rare").alias("h"), F.col("r._lm_times").alias("times"))
    log_p = F.log10((F.coalesce("c", F.lit(0)) + ADDED) / floor)
    rest = (
        rare.join(unigrams, "h", "left").groupBy("_lm_row")
        .agg(F.sum(F.col("times") * log_p).alias("_lm_rest"),
             F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("_lm_more"))
    )
    return scored.join(rest, "_lm_row", "left").select(
        *[f"`{c}`" for c in kept_names], F.col("_lm_n").alias("n_tokens"),
        (F.col("_lm_known") + F.coalesce("_lm_more", F.lit(0))).alias("n_known"),
        F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("_lm_base") + F.coalesce("_lm_rest", F.lit(0.0))).alias("base_score"),
        F.col("_lm_model").alias("score"))


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    """Scores of every document; a tenth of the ids is held out from training."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = bucket(F.col("doc_id"), 10) == 0
    return score(docs, docs.where(~held_out)).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
