"""Spelling variant grouping over the sorted vocabulary.

Words that one edit (insertion, deletion or replacement of a code point) turns into each other
are found by scanning sorted word lists with a banded edit matrix: the rows of a word are kept
for the prefix it shares with the word before it, and a range of words whose shared prefix
already needs more than one edit is skipped.

Lists are kept short without losing a pair: where one edit lies between two words, they agree in
the first half of the shorter one or in all that follows it. Each word joins the list of its
first half and the list of its last half (read backwards); lists that are still long are halved
again in the part where the edit must lie.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.text import column, documents, slices, utf8
from callweave.session import materialise

#: A run of letters once A-Z are in lower case.
RUN = re.compile("[a-zÀ-ÿ]+")
#: One in so many (document, run) pairs is damaged.
DAMAGE = 97
MIN_LETTERS, MIN_COUNT = 5, 3
#: Lists of more words than this are halved again.
LIST_WORDS = 2048
#: Distinct words a task counts before it sends them on.
HOLD = 200_000
LAST = "\U0010FFFF"


def damaged(doc: int | None, run: str, start: int) -> str:
    """The run, without one code point where the checksum of ``<doc>:<run>`` says so; ``start``
    is the checksum of ``<doc>:``."""
    h = zlib.crc32(run.encode(), start)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text",
               min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the distinct damaged runs of all whole texts that have ``min_letters`` code
    points and occur ``min_count`` times. A missing text has no runs; a missing key counts as
    the empty text in the checksum; rows that repeat a document count again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "word": pa.array(list(counts), pa.string()),
                "n": pa.array(list(counts.values()), pa.int64())})

        held: Counter = Counter()
        for batch in slices(batches, "text"):
            for doc, raw in zip(column(batch, "doc").to_pylist(), utf8(batch, "text")):
                if not raw:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(RUN.findall(raw.lower().decode())).items():
                    word = damaged(doc, word, start)
                    if len(word) >= min_letters:
                        held[word] += n
            if len(held) >= HOLD:
                yield rows(held)
                held = Counter()
        if held:
            yield rows(held)

    counted = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")) \
        .mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def halved(entries: DataFrame) -> DataFrame:
    """Two lists for each entry, one of which has any pair of the entry's list.

    An entry is (w, n, short, lo, hi, cap): ``w`` agrees with all words of its list in the first
    ``lo`` and the last ``hi`` code points, the shorter words of the list have ``short``, and
    pairs that agree in the first ``cap`` belong to another list.
    """
    half = F.floor((F.col("short") - F.col("lo") - F.col("hi")) / 2).cast("int")
    rest = F.col("short") - F.col("lo") - F.col("hi") - half
    sides = F.array(
        F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"),
                 F.col("cap").alias("cap"), F.lit(False).alias("back")),
        F.struct(F.col("lo").alias("lo"), (F.col("hi") + rest).alias("hi"),
                 F.least("cap", F.col("lo") + half).alias("cap"), F.lit(True).alias("back")))
    return entries.select("w", "n", "short", F.explode(sides).alias("s")).select(
        "w", "n", "short", "s.lo", "s.hi", "s.cap", "s.back", _list("s.lo", "s.hi").alias("g"))


def _list(lo: str, hi: str) -> Column:
    """A number for the list; two lists may share one, which ``scan`` sorts out."""
    return F.xxhash64("short", lo, hi, F.expr(f"left(w, {lo})"), F.expr(f"right(w, {hi})"))


def lists(words: DataFrame, long: int = LIST_WORDS) -> DataFrame:
    """Entries of all lists. A word is in lists in which it is the shorter or the longer one.
    Lists above ``long`` are halved while the part of the edit has two code points or more; a
    list that cannot be halved has at most all letters and pairs of letters in one place."""
    entries = halved(words.select(
        F.col("word").alias("w"), "n", F.explode(F.array(
            F.length("word"), F.length("word") - 1)).alias("short"), F.lit(0).alias("lo"),
        F.lit(0).alias("hi"), F.lit(1 << 30).alias("cap")).where("short > 1"))
    done = None
    while True:
        entries = materialise(entries, "spelling-lists")
        large = materialise(entries.groupBy("g").agg(
            F.count("*").alias("k"), F.max(F.col("short") - F.col("lo") - F.col("hi")).alias("m"))
            .where((F.col("k") > long) & (F.col("m") > 1)).select("g"), "spelling-large")
        if large.isEmpty():
            return entries if done is None else done.unionByName(entries)
        short = entries.join(large, "g", "left_anti").select(entries.columns)
        done = short if done is None else done.unionByName(short)
        entries = halved(entries.join(large, "g", "left_semi"))


def shared(a: str, b: str, most: int) -> int:
    """Length of the common prefix, up to ``most``."""
    k, most = 0, min(most, len(a), len(b))
    while k < most and a[k] == b[k]:
        k += 1
    return k


def neighbours(words: list[str], at: int, lcp: list[int]) -> Iterator[int]:
    """Places after ``at`` of the words within one edit of ``words[at]``.

    ``words`` are sorted and ``lcp[i]`` is what words i - 1 and i share. A row of the band is
    (x, y, z): the edits that turn a prefix of i letters into i - 1, i and i + 1 letters of the
    word, 2 standing for more than one. The rows of the word against itself begin the scan.
    """
    word = words[at]
    n = len(word)
    rows = [(1, 0, 1)] * (n + 2)  # rows[i]: after i letters of the current word
    rows[0], rows[n] = (2, 0, 1), (1, 0, 2)
    i, current = at + 1, word
    known = lcp[i] if i < len(words) else 0
    while i < len(words):
        current = words[i]
        depth, dead, m = known, 0, len(current)
        x, y, z = rows[depth]
        while depth < m:
            c = current[depth]
            a = min(x + (word[depth - 1] != c if 0 < depth <= n else 1), y + 1, 2)
            b = min(y + (word[depth] != c), z + 1, a + 1, 2) if depth < n else 2
            z = min(z + (word[depth + 1] != c), b + 1, 2) if depth + 1 < n else 2
            x, y = a, b
            depth += 1
            if depth > n + 1 or (x > 1 and y > 1 and z > 1):
                dead = depth
                break
            rows[depth] = (x, y, z)
        if dead:  # no word that begins with these letters is near
            following = bisect_left(words, current[:dead] + LAST, i + 1)
            if following >= len(words):
                return
            known = shared(current, words[following], dead)
            i = following
            continue
        if abs(m - n) <= 1 and (x, y, z)[n - m + 1] == 1:
            yield i
        i += 1
        if i < len(words):
            known = lcp[i]


def scan(rows: list[tuple]) -> dict[str, list]:
    """For each word of one list the number of near words that this list owns, and the best:
    [number, n, word] by largest n, then least word. ``rows`` are (w, n, short, lo, hi, cap,
    back) of the entries with one number."""
    groups: dict[tuple, dict[str, int]] = {}
    for w, n, short, lo, hi, cap, back in rows:  # one group but for lists that share a number
        key = (short, lo, hi, cap, back, w[:lo], w[len(w) - hi:])
        groups.setdefault(key, {})[w] = n
    out: dict[str, list] = {}
    for (short, _, _, cap, back, _, _), counts in groups.items():
        if len(counts) < 2:
            continue
        words = sorted(w[::-1] for w in counts) if back else sorted(counts)
        lcp = [0] + [shared(a, b, len(a)) for a, b in zip(words, words[1:])]
        for at, s in enumerate(words):
            for other in neighbours(words, at, lcp):
                a, b = (s[::-1], words[other][::-1]) if back else (s, words[other])
                if min(len(a), len(b)) != short or shared(a, b, cap) >= cap:
                    continue
                for one, two in ((a, b), (b, a)):
                    best = (-counts[two], two)
                    held = out.get(one)
                    if held is None:
                        out[one] = [1, best]
                    else:
                        held[0] += 1
                        held[1] = min(held[1], best)
    return out


def near_words(words: DataFrame, long: int = LIST_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of every word with a near word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[tuple]) -> list[tuple]:
            return [(w, k, -n, b) for w, (k, (n, b)) in scan(held).items()] if len(held) > 1 else []

        def rows(out: list[tuple]) -> pa.RecordBatch:
            w, k, n, b = zip(*out)
            return pa.RecordBatch.from_pydict({
                "word": pa.array(w, pa.string()), "k": pa.array(k, pa.int64()),
                "n": pa.array(n, pa.int64()), "best": pa.array(b, pa.string())})

        last, held, out = None, [], []
        for batch in batches:
            for g, *row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if g != last:
                    out += found(held)
                    last, held = g, []
                held.append(row)
            if out:
                yield rows(out)
                out = []
        if out := found(held):
            yield rows(out)

    entries = lists(words, long)
    several = entries.groupBy("g").agg(F.count("*").alias("k")).where("k > 1").select("g")
    kept = entries.join(several, "g", "left_semi")
    dealt = kept.select("g", "w", "n", "short", "lo", "hi", "cap", "back") \
        .repartition("g").sortWithinPartitions("g")
    part = dealt.mapInArrow(run, "word string, k long, n long, best string")
    return part.groupBy("word").agg(
        F.sum("k").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "best")).alias("b")
    ).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to. Each round doubles the
    steps taken; a form has at least twice the count of its word, so rounds are few."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = materialise(now.join(step, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            "spelling-roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text",
             long: int = LIST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A word's form is its near word of largest count (ties: the smallest in code-point order) if
    that count is at least twice its own, else missing; its root is the last word that forms
    lead to, itself if it has none. Empty tables and texts give no words. See ``vocabulary``.
    """
    words = materialise(vocabulary(docs, key, text), "vocabulary")
    near = materialise(near_words(words, long), "near-words")
    good = F.col("best_n") >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"))
    table = materialise(joined, "word-forms")
    ends = roots(table.where("form IS NOT NULL"))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(documents(spark, sf_dir).select("doc_id", "text"))


#: The checksum is written out bit by bit, as the SQL engine has no function for it.
OP12_SQL = r"""
WITH entry AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
        FROM (SELECT unnest(range(256)) AS i))
), run AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r,
           count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r
          FROM documents)
    GROUP BY ALL
), byte AS (
    SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS x FROM run
), summed AS (
    SELECT r, n, xor(list_reduce(list_transform(range(length(x) // 2),
                lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
    FROM byte, entry
), word AS (
    SELECT w AS word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 97 = 0
            THEN substring(r, 1, (h % length(r))::INT) || substring(r, (h % length(r))::INT + 2)
            ELSE r END AS w FROM summed)
    WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3
), cut AS (
    SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS c
    FROM (SELECT *, unnest(range(length(word))) AS i FROM word)
), near AS (
    SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i
    WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.c = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.c = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(m) AS top, arg_min(other, (-m, other)) AS other
    FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN top >= 2 * w.n THEN other END AS form,
           CASE WHEN top >= 2 * w.n THEN top END AS form_n
    FROM word w LEFT JOIN best USING (word)
), chain AS (
    WITH RECURSIVE c AS (
        SELECT word, form AS tip FROM formed WHERE form IS NOT NULL
        UNION ALL
        SELECT c.word, f.form FROM c JOIN formed f ON f.word = c.tip WHERE f.form IS NOT NULL)
    SELECT c.word, c.tip FROM c JOIN formed f ON f.word = c.tip WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(tip, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN chain USING (word)
"""
