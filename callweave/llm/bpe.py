"""BPE encoding and decoding: speculate and verify.

A greedy longest match proposes the tokens of a word. A sequence of tokens is the exact
result of merging if, and only if, no two neighbours would have been merged otherwise; this is
tested for all neighbours of all new words at once, on arrays. Only words with a failing pair
go through exact merging.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from callweave.llm.text import column, documents, slices, utf8, with_columns

#: Fixed value: the published splitting pattern of byte-level BPE.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A space next to other white space.
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]
UNEVEN = [p for w in _WHITE for p in {" " + w, w + " "}]
#: Words, and chunks between spaces, that a worker remembers before it starts anew.
REMEMBERED = 700_000
#: Bytes up to which a word is merged by search in a list.
SHORT = 40
_NEVER = np.iinfo(np.int64).max


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    letters stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Bpe:
    """A byte-level BPE model of a ``tokenizers`` file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, letters = spec["model"], {v: k for k, v in byte_letters().items()}
        raw = {w: bytes(letters[c] for c in w) for w in model["vocab"]}
        self.ids = {raw[w]: i for w, i in model["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *special.values()])
        self.bytes = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for word, i in special.items():
            self.bytes[i] = word.encode()
        self.special = {w: np.uint32(i).tobytes() for w, i in special.items()}
        self.split = regex.compile(
            "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
        ) if special else None
        self.reach: dict[bytes, int] = {}  # length of the longest token by its first two bytes
        for b in self.ids:
            self.reach[b[:2]] = max(len(b), self.reach.get(b[:2], 1))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ia, ib, whole = self.ids[raw[a]], self.ids[raw[b]], self.ids[raw[a] + raw[b]]
            self.merges[ia, ib] = (rank, whole)
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, ia, ib
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.size = size
        self.pair_keys = np.append(keys[order], _NEVER)
        self.pair_ranks = np.append(
            np.array([r for r, _ in self.merges.values()], np.int64)[order], _NEVER)
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.words = regex.compile(PATTERN)

    def propose(self, word: bytes) -> list[int]:
        """Longest token first, from left to right."""
        out, at, n, ids, reach = [], 0, len(word), self.ids, self.reach
        while at < n:
            for end in range(min(n, at + reach.get(word[at:at + 2], 1)), at, -1):
                if (i := ids.get(word[at:end])) is not None:
                    out.append(i)
                    at = end
                    break
            else:
                raise ValueError(f"no token for byte {word[at]}")
        return out

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether exact merging keeps the border between neighbours ``a`` and ``b``.

        The merges that made both are undone from the last one on. Where the two parts that
        then touch could have been merged earlier than the merge just undone, the border
        would not have lasted; of equal merges the left one comes first.
        """
        a, b = a.copy(), b.copy()
        good = self._pair_rank(a, b) == _NEVER
        live = np.flatnonzero(good)
        while live.size:
            x, y = a[live], b[live]
            rx, ry = self.rank[x], self.rank[y]
            undo_left = rx > ry
            limit = np.where(undo_left, rx, ry)
            open_ = limit >= 0
            live, x, y, undo_left, limit = (v[open_] for v in (live, x, y, undo_left, limit))
            x = np.where(undo_left, self.right[x], x)
            y = np.where(undo_left, y, self.left[y])
            rank = self._pair_rank(x, y)
            bad = np.where(undo_left, rank < limit, rank <= limit)
            good[live[bad]] = False
            a[live], b[live] = x, y
            live = live[~bad]
        return good

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the pair of least rank first, the leftmost among equals."""
        ids = [self.ids[word[i:i + 1]] for i in range(len(word))]
        return self._merge_long(ids) if len(ids) > SHORT else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.merges.get, (_NEVER, -1)
        pairs = [get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i:i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        merges, heap = self.merges, []
        for i in range(len(ids) - 1):
            if m := merges.get((ids[i], ids[i + 1])):
                heap.append((m[0], i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = merges[x, y][1], -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                if m := merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """Encode words, all together."""
        proposed = [self.propose(w.encode()) for w in new]
        lengths = np.array([len(p) for p in proposed], np.int64)
        flat = np.array([i for p in proposed for i in p], np.int64)
        owner = np.repeat(np.arange(len(new)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[place]
        for k in np.unique(owner[inner[~good]]).tolist():
            proposed[k] = self.merge(new[k].encode())
        return {w: np.array(p, "<u4").tobytes() for w, p in zip(new, proposed)}

    def recall(self, words: set[str]) -> dict[str, bytes]:
        """A mapping with the ids of at least these words; what it holds is bounded."""
        new = words - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, words
        if new:
            self.known.update(self.learn(list(new)))
        return self.known

    def recall_spaced(self, chunks: set[str]) -> dict[str, bytes]:
        """As ``recall``, for chunks that follow a single space: the ids include it."""
        new = chunks - self.spaced.keys()
        if len(self.spaced) + len(new) > REMEMBERED:
            self.spaced, new = {}, chunks
        if new:
            parts = {c: self.words.findall(" " + c) for c in new}
            known = self.recall(set().union(*parts.values()))
            self.spaced.update((c, b"".join([known[w] for w in p])) for c, p in parts.items())
        return self.spaced

    def _cut(self, text: str) -> list[str | bytes]:
        """Stretches of text, and the packed ids of special tokens between them."""
        if self.split is None or not self.split.search(text):
            return [text]
        out, at = [], 0
        for m in self.split.finditer(text):
            out += [text[at:m.start()], self.special[m[0]]]
            at = m.end()
        return [*out, text[at:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as little-endian unsigned 32-bit integers.

        Where a text has single spaces only, each space begins a word, so the chunks between
        spaces can be remembered as they are; other stretches are split by the pattern.
        """
        cut = [self._cut(t) for t in texts]
        chunks, words, found = set(), set(), {}
        for stretch in {s for c in cut for s in c if isinstance(s, str)}:
            if stretch[:1] == " " or stretch[-1:] == " " or any(
                    map(stretch.__contains__, UNEVEN)):
                found[stretch] = (self.words.findall(stretch), [])
            else:
                head, *rest = stretch.split(" ")
                found[stretch] = (self.words.findall(head), rest)
            words.update(found[stretch][0])
            chunks.update(found[stretch][1])
        spaced = self.recall_spaced(chunks).__getitem__
        known = self.recall(words).__getitem__
        return [b"".join([s if isinstance(s, bytes) else
                          b"".join(map(known, found[s][0])) + b"".join(map(spaced, found[s][1]))
                          for s in c]) for c in cut]

    def decode(self, packed: bytes) -> bytes:
        get = self.bytes.__getitem__
        return b"".join(map(get, np.frombuffer(packed, "<u4").tolist()))


def _model(shared: dict) -> Bpe:
    """The model, kept with the broadcast value so that a worker's next task finds its words."""
    if "model" not in shared:
        shared["model"] = Bpe(shared["source"])
    return shared["model"]


def tokenizer_file() -> str:
    """The installed byte-level vocabulary, read on the driver (a file of fixed size)."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row with its token ids and what they decode to.

    ``tokenizer`` is the content of a byte-level BPE file; it is broadcast, and has a fixed
    size. Added columns (a column of ``docs`` with such a name is replaced): ``token_ids``,
    the ids as little-endian unsigned 32-bit integers in one binary value, ``n_tokens``, and
    ``decoded``, the text the ids give back. A missing text counts as empty: no ids, empty
    decoded text. Special tokens that occur in a text get their own ids. Rows are treated one
    by one, so repeated ids or rows stay as they are, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"source": tokenizer})
    names = ("token_ids", "n_tokens", "decoded")
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    schema = T.StructType([*kept, T.StructField("token_ids", T.BinaryType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        gone = tuple(f for f in docs_names if f.lower() in names)
        for batch in slices(batches, text):
            ids = model.encode([(t or b"").decode() for t in utf8(batch, text)])
            yield with_columns(batch, {
                "token_ids": pa.array(ids, pa.binary()),
                "n_tokens": pa.array([len(p) // 4 for p in ids], pa.int64()),
                "decoded": pa.array([model.decode(p).decode("utf-8", "replace") for p in ids],
                                    pa.string()),
            }, gone)

    docs_names = tuple(docs.columns)
    return docs.mapInArrow(run, schema)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode(docs, tokenizer_file()).select(
        "doc_id", "n_tokens",
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
