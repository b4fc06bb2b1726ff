"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words (lower case). Two lines match at a Jaccard similarity of 4/5 or
more; a line that matches an earlier one goes. Equal lines are one class, known by its first
place. For classes, words are ordered by rarity, only the prefix that any match must touch is
joined, and length and position filters leave few candidates, which are verified in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callweave.llm.quality import let, split_words
from callweave.llm.text import SPACE, documents, free_name
from callweave.session import materialise, release

#: Two sets of sizes n and m match with at least SHARED / WHOLE * (n + m) words in common
#: (similarity 4/5); of n words the first n // PREFIX + 1 in any order hold a common one.
SHARED, WHOLE, PREFIX = 4, 9, 5
#: Words are counted for their rarity in 2 to this power buckets of their hash: the table of
#: these counts goes to all tasks as a scalar and has one byte for each bucket. A frequent word
#: outweighs what shares its bucket, however large the vocabulary is.
BUCKET_BITS = 20
#: Texts of more characters are cut into lines before their words are counted.
LONG_TEXT = 1 << 16
#: Candidate classes up to this many bytes are sent to all tasks to pick out their texts.
SMALL_BYTES = 32 << 20

#: A word's number is its level of rarity (7 bits) before this many bits of its hash.
HASH_BITS, LEVELS_PER_DOUBLING = 56, 4


def numbered_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, body, line_no, line) of every line with a word; ``body`` tells apart different
    texts under one key."""
    return (  # the text ends below the explode: a long one is not repeated for each line
        docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("body"),
                    F.split(F.col(text), "\n", -1).alias("lines"))
        .select("doc", "body", F.posexplode("lines").alias("line_no", "line"))
        .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    )


def word_set(line: Column) -> Column:
    return F.array_distinct(split_words(F.lower(line)))


def word_hashes(line: Column) -> Column:
    return F.transform(split_words(F.lower(line)), lambda w: F.xxhash64(w))


def rarity_levels(docs: DataFrame, text: str) -> DataFrame:
    """One row, one array of bytes: for each bucket of words the logarithm of its count.

    The array is put together by the tasks from stretches of 4,096 buckets.
    """
    pieces = F.when(F.length(text) <= LONG_TEXT, F.array(F.col(text))).otherwise(
        F.split(F.col(text), "\n", -1))
    counts = (  # words are hashed outside of lambda functions, which Spark does not compile
        docs.select(F.explode(pieces).alias("piece"))
        .select(F.explode(F.split(F.lower("piece"), SPACE)).alias("word")).where("word <> ''")
        .groupBy(F.xxhash64("word").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).alias("b"))
        .agg(F.count("*").alias("n"))
    )
    level = F.least(F.lit(120), 1 + F.floor(F.log2("n") * LEVELS_PER_DOUBLING))
    every = docs.sparkSession.range(1 << BUCKET_BITS).join(counts, F.col("id") == F.col("b"), "left")

    def in_order(place: str, value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(place, value))), lambda x: x[value])

    stretches = every.withColumn("level", F.when(F.col("n") > 0, level).otherwise(1).cast("tinyint")) \
        .groupBy(F.shiftright("id", 12).alias("s")).agg(in_order("id", "level").alias("levels"))
    return stretches.groupBy().agg(F.flatten(in_order("s", "levels")).alias("levels"))


def ordered_words(line: Column, levels: Column) -> Column:
    """Numbers for the words of a line, ascending from rare to frequent."""
    def number(level: Column, h: Column) -> Column:
        place = h.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")
        return F.shiftleft(F.get(level, place).cast("long"), HASH_BITS).bitwiseOR(
            F.shiftrightunsigned(h, 64 - HASH_BITS))

    return let(levels, lambda level: F.sort_array(F.array_distinct(
        F.transform(word_hashes(line), lambda h: number(level, h)))))


def one_bit(number: Column) -> Column:
    """One of 64 bits for a word, by the number's low bits."""
    return F.call_function("shiftleft", F.lit(1).cast("long"),
                           number.bitwiseAND(F.lit(63)).cast("int"))


def parities(words: Column) -> list[Column]:
    """(bits, more): 128 bits that each tell whether an odd number of the words falls on them.
    Two sets differ in at least as many words as bits, however long they are."""
    def half(which: int) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(
            F.when(x.bitwiseAND(F.lit(64)) == which * 64, one_bit(x)).otherwise(0)))

    return [half(0).alias("bits"), half(1).alias("more")]


def line_classes(lines: DataFrame, levels: DataFrame) -> DataFrame:
    """(class, first, n, prefix, bits, more, id) of the distinct lines; ``first`` is their first
    place, ``bits`` and ``more`` are the ``parities`` of their words.

    ``levels`` are read as a scalar: a literal of that size would be printed in hexadecimal, again
    and again, wherever the driver describes the plan.
    """
    numbered = lines.withColumn("levels", levels.scalar()).select(
        F.unhex(F.md5("line")).alias("class"), F.struct("doc", "line_no", "body").alias("place"),
        let(ordered_words(F.col("line"), F.col("levels")), lambda w: F.struct(
            F.size(w).alias("n"),
            F.slice(w, F.lit(1), F.floor(F.size(w) / PREFIX).cast("int") + 1).alias("prefix"),
            *parities(w),
        )).alias("words"))
    return numbered.groupBy("class").agg(
        F.min("place").alias("first"), F.first("words").alias("words")
    ).select("class", "first", "words.*", F.xxhash64("class").alias("id"))


def postings(classes: DataFrame, *also: str) -> DataFrame:
    """(word, id, at, bits, more) of every prefix word; ``at`` is the size of the set, the word's
    place and ``mark`` (0 or 1), as one number to keep rows narrow. Words are known by a short
    hash here; what it mixes up only adds candidates."""
    size = F.shiftleft(F.col("n").cast("long"), 32)
    return classes.select(
        "id", "n", "mark", "bits", "more", *also, F.posexplode("prefix").alias("i", "word")).select(
        F.hash("word").alias("word"), "id",
        size.bitwiseOR(F.col("i") * 2 + F.col("mark")).alias("at"), "bits", "more", *also)


def _may_match(x: str, y: str) -> Column:
    """Whether two postings of one word can belong to a match.

    The bits of the word sets do not differ in more places than words may differ; with ``o``
    words needed in common, the first common word is among the first ``n - o + 1`` of each
    (prefix), sizes are in the ratio 4/5 or nearer (length), and the words before the common
    one, that one and those after it suffice (position). The first test leaves few pairs.
    """
    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def place(side: str) -> Column:
        return F.shiftright(c(side, "at").bitwiseAND(F.lit((1 << 32) - 1)), 1)

    n, m = (F.shiftright(c(side, "at"), 32) for side in (x, y))
    i, j = place(x), place(y)
    unlike = sum(F.bit_count(c(x, b).bitwiseXOR(c(y, b))) for b in ("bits", "more"))
    needed = F.ceil((n + m) * SHARED / WHOLE)
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return ((unlike * WHOLE <= (n + m) * (WHOLE - 2 * SHARED)) & (c(x, "id") != c(y, "id"))
            & (F.least(n, m) * PREFIX >= F.greatest(n, m) * (PREFIX - 1))
            & (i <= n - needed) & (j <= m - needed) & (most >= needed))


def _ordered_pair(x: str, y: str) -> list[Column]:
    return [F.least(f"{x}.id", f"{y}.id").alias("a"), F.greatest(f"{x}.id", f"{y}.id").alias("b")]


def head_pairs(classes: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of each class with the first class of each of its prefix words.
    The first one is carried along each word, so rows are moved once and not joined. Of n words the
    first n // WHOLE + 1 are enough for matches of one size; others are left to ``open_pairs``."""
    line = Window.partitionBy("word").orderBy(F.col("doc").isNotNull(), "doc", "id")
    entries = postings(classes.withColumns({
        "doc": F.col("first.doc"), "mark": F.lit(0),
        "prefix": F.slice("prefix", F.lit(1), F.floor(F.col("n") / WHOLE).cast("int") + 1),
    }), "doc").select(
        F.struct("id", "at", "bits", "more").alias("x"), "word", "doc", "id")
    return entries.withColumn("h", F.first("x").over(line)).where(_may_match("x", "h")) \
        .select(*_ordered_pair("x", "h")).distinct()


def open_pairs(classes: DataFrame, gone: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of the classes that are not in ``gone`` with every class that has a
    word of their prefix. The postings are moved once: both sides of the join read the same
    ones, so the mark of a class is a part of ``at`` and its test has both sides in it (a test of
    one side would be made before the move, and make it another one)."""
    ids = gone.select(F.col("id").alias("g")).distinct()
    ids = F.broadcast(ids) if gone.count() * 64 <= SMALL_BYTES else ids
    marked = classes.join(ids, F.col("id") == F.col("g"), "left").withColumn(
        "mark", F.when(F.col("g").isNull(), 0).otherwise(1))
    entries = postings(marked)
    open_ = (F.col("x.id") != F.col("y.id")).cast("long") > F.col("x.at").bitwiseAND(F.lit(1))
    return entries.alias("x").join(entries.alias("y"), "word") \
        .where(open_ & _may_match("x", "y")).select(*_ordered_pair("x", "y")).distinct()


def texts_of(docs: DataFrame, key: str, text: str, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, class, first, line) of the candidate classes.

    One line of each is taken from its document; documents without one are not cut into lines.
    The list of wanted lines is broadcast where it is small by count, else both sides are shuffled.
    """
    wanted = materialise(
        classes.join(ids, "id", "left_semi").select("class", "first", "id"), "wanted")
    small = wanted.count() * 64 <= SMALL_BYTES
    asked = wanted.groupBy(F.col("first.doc").alias("w_doc"), F.col("first.body").alias("w_body")).agg(
        F.collect_list(F.struct("first.line_no", "class", "id")).alias("asked"))
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("body"))
    picked = let(F.split("text", "\n", -1), lambda lines: F.transform("asked", lambda x: F.struct(
        x["id"].alias("id"), x["class"].alias("class"),
        F.struct("doc", x["line_no"].alias("line_no"), "body").alias("first"),
        F.get(lines, x["line_no"]).alias("line"))))
    found = rows.join(
        F.broadcast(asked) if small else asked,
        F.col("doc").eqNullSafe(F.col("w_doc")) & (F.col("body") == F.col("w_body"))
    ).select(F.explode(picked).alias("found")).select("found.*")
    texts = materialise(
        found.dropDuplicates(["class"]), "line-texts")
    release(wanted)
    return texts


def matches(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Classes that match an earlier one, verified on the full word sets."""
    def side(name: str) -> DataFrame:
        return texts.select(*[F.col(c).alias(f"{name}_{c}") for c in ("id", "class", "first", "line")])

    a, b = word_set(F.col("x_line")), word_set(F.col("y_line"))
    both = found.join(side("x"), F.col("a") == F.col("x_id")).join(
        side("y"), F.col("b") == F.col("y_id"))
    return both.where(
        F.size(F.array_intersect(a, b)) * WHOLE >= (F.size(a) + F.size(b)) * SHARED
    ).select(F.explode(F.array(F.when(F.col("x_first") < F.col("y_first"), F.struct(
        F.col("y_class").alias("class"), F.col("y_id").alias("id"))).otherwise(F.struct(
            F.col("x_class").alias("class"), F.col("x_id").alias("id"))))).alias("later")
    ).select("later.class", "later.id").distinct()


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, kept_lines) of every text with a kept line: numbers of the lines that stay.

    Lines are ordered by key (a missing one first), then number. A line without a word is not
    judged. Of equal lines the first stays unless it matches an earlier line, whether that
    one stays or not. Lines are first compared with the first line of each of their words, so
    that most repeats are settled; what is left is compared with every line of its words.
    Rows that repeat a key and text are one document.
    """
    levels = materialise(rarity_levels(docs, text), "line-levels")
    classes = materialise(
        line_classes(numbered_lines(docs, key, text), levels), "line-classes")
    release(levels)
    first = materialise(head_pairs(classes), "line-pairs")
    gone = _verified(first, docs, key, text, classes)
    rest = materialise(
        open_pairs(classes, gone).join(first, ["a", "b"], "left_anti"), "line-rest")
    release(first)
    more = _verified(rest, docs, key, text, classes)
    release(rest)
    every = gone.unionByName(more).select("class").distinct()
    kept = materialise(
        classes.join(every, "class", "left_anti").groupBy("first.doc", "first.body")
        .agg(F.array_sort(F.collect_list("first.line_no")).alias("kept_lines")), "kept-lines")
    release(classes, gone, more)
    return kept


def _verified(
    found: DataFrame, docs: DataFrame, key: str, text: str, classes: DataFrame
) -> DataFrame:
    """``matches`` of candidate pairs, whose texts are looked up first, as a written stage."""
    ids = found.select(F.col("a").alias("id")).unionByName(
        found.select(F.col("b").alias("id"))).distinct()
    texts = texts_of(docs, key, text, classes, ids)
    later = materialise(matches(found, texts), "line-matches")
    release(texts)
    return later


def _judged(text: Column) -> Column:
    """Numbers of the lines with a word."""
    return F.filter(F.transform(F.split(text, "\n", -1), lambda s, i: F.when(
        s.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, removed) of every row: how many lines have a word, and the numbers (from
    0) of those that go. A missing text has no lines. See ``find_repeats``."""
    kept = find_repeats(docs, key, text)
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("body"),
                       F.coalesce(_judged(F.col(text)), F.array().cast("array<int>")).alias("judged"))
    none = F.array().cast("array<int>")
    return rows.alias("r").join(kept.alias("k"), F.col("r.doc").eqNullSafe(F.col("k.doc"))
                                & (F.col("r.body") == F.col("k.body")), "left").select(
        F.col("r.doc").alias(key), F.size("judged").alias("n_lines"),
        F.array_except("judged", F.coalesce("kept_lines", none)).alias("removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with the text left after removal, and ``n_lines`` and
    ``n_removed`` (columns of these names are replaced). Lines without a word stay where they
    are; a missing text stays missing. See ``find_repeats``."""
    kept = find_repeats(docs, key, text).select(
        F.col("doc").alias("_kept_doc"), F.col("body").alias("_kept_body"), "kept_lines")
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    lines_name = free_name(rows, "kept_lines")
    kept = kept.withColumnRenamed("kept_lines", lines_name)
    joined = rows.join(kept, F.col(key).eqNullSafe(F.col("_kept_doc"))
                       & (F.xxhash64(text) == F.col("_kept_body")), "left")
    none = F.array().cast("array<int>")
    gone = F.array_except(F.coalesce(_judged(F.col(text)), none), F.coalesce(lines_name, none))
    left = let(gone, lambda g: F.array_join(F.transform(F.filter(F.transform(
        F.split(F.col(text), "\n", -1), lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
        lambda x: ~F.array_contains(g, x["i"])), lambda x: x["s"]), "\n"))
    return joined.select(
        *[F.when(F.col(text).isNotNull(), left).alias(c) if c == text else F.col(f"`{c}`")
          for c in names],
        F.size(F.coalesce(_judged(F.col(text)), none)).alias("n_lines"),
        F.size(gone).alias("n_removed"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line."""
    found = removed_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"))


OP1_SQL = r"""
WITH line AS (
    SELECT doc_id, i - 1 AS line_no, ls[i] AS s FROM (
        SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
    WHERE regexp_matches(ls[i], '[^\x20\x09-\x0D]')
), class AS (
    SELECT s, min(struct_pack(d := doc_id, n := line_no)) AS first,
           list_distinct(list_filter(string_split_regex(lower(s), '[\x20\x09-\x0D]+'),
                                     lambda x: x <> '')) AS ws
    FROM line GROUP BY s
), word AS (
    SELECT first, len(ws) AS n, unnest(ws) AS w FROM class
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY first ORDER BY df, w) AS r
    FROM (SELECT *, count(*) OVER (PARTITION BY w) AS df FROM word)
), candidate AS (
    SELECT DISTINCT a.first AS fa, b.first AS fb
    FROM ranked a JOIN ranked b ON a.w = b.w AND a.first < b.first
    WHERE a.r <= a.n // 5 + 1 AND b.r <= b.n // 5 + 1
      AND least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4
), gone AS (
    SELECT DISTINCT fb AS first
    FROM candidate JOIN class a ON a.first = fa JOIN class b ON b.first = fb
    WHERE len(list_intersect(a.ws, b.ws)) * 9 >= (len(a.ws) + len(b.ws)) * 4
), kept AS (
    SELECT first.d AS doc_id, first.n AS line_no FROM class ANTI JOIN gone USING (first)
), flag AS (
    SELECT l.doc_id, l.line_no, k.doc_id IS NULL AS dropped
    FROM line l LEFT JOIN kept k ON l.doc_id = k.doc_id AND l.line_no = k.line_no
)
SELECT d.doc_id, count(f.line_no)::BIGINT AS n_lines,
       count(f.line_no) FILTER (WHERE f.dropped)::BIGINT AS n_removed,
       coalesce(string_agg(f.line_no::VARCHAR, ',' ORDER BY f.line_no)
                FILTER (WHERE f.dropped), '') AS removed
FROM documents d LEFT JOIN flag f ON d.doc_id = f.doc_id GROUP BY d.doc_id
"""
