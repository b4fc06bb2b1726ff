"""Line-first quality rules, with DataFrame functions only.

Each line is judged by itself: punctuation and case, navigation, boilerplate. Failing lines
are removed, and a document that loses too much of its text this way is rejected. Counts over
the whole text (short texts, words in repeated windows) reject a document beforehand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from callweave.llm.text import SPACE, documents, free_name

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Line rules. Marks are symbols and repeated exclamation or question marks.
MAX_MARKS_PER_WORD = 0.5
MAX_UPPER_SHARE = 0.6
MIN_LETTERS_FOR_CASE = 20
MIN_SEPARATORS = 3
MAX_WORDS_PER_SEPARATOR = 3.0
#: Openings and phrases of lines that belong to a page or a licence, not to its text.
BOILERPLATE = (
    r"(?i)^\W*(all rights reserved|copyright|\(c\) |©|cookie policy|privacy policy"
    r"|terms of (use|service)|sign (in|up)\b|log ?in\b|subscribe (now|to)|click here|read more"
    r"|share (this|on)|follow us|skip to (main )?content|back to top"
    r"|(licensed|released) under (the|an?) |this work is licensed under )"
)
#: Share of the characters outside white space that a document may lose to the line rules.
MAX_LOST = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words which occurs twice or more.

    Hashes of the windows tell whether any can repeat; only then the windows themselves are
    sorted, and neighbours compared.
    """
    def exact(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (size - 1))
        windows = F.sort_array(F.transform(
            starts, lambda i: F.struct(F.concat_ws(" ", F.slice(w, i, size)).alias("w"),
                                       i.alias("i"))))
        return let(windows, lambda s: let(
            F.sort_array(F.filter(F.transform(s, lambda x, k: F.when(
                (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]), x["i"])),
                lambda i: i.isNotNull())),
            lambda at: F.aggregate(
                F.transform(at, lambda i, k: F.least(
                    F.lit(size), F.coalesce(F.get(at, k + 1) - i, F.lit(size)))),
                F.lit(0), lambda a, n: a + n)))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)),
                             lambda i: F.xxhash64(F.slice(w, i, size)))
        return F.when(F.size(w) < size, F.lit(0)).otherwise(F.when(
            let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)
        ).otherwise(exact(w)))

    return let(words, counted).cast("long")


def line_verdict(line: Column) -> Column:
    """0 for a line that passes (a blank one always does), 1 for punctuation, case and
    navigation, 2 for boilerplate."""
    n_words = F.size(split_words(line))
    marks = _count(line, SYMBOLS) + _count(line, "!?")
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    separators = _count(line, "|>»•·")
    return let(n_words, lambda n: (
        F.when(n == 0, 0)
        .when((marks > n * MAX_MARKS_PER_WORD)
              | ((letters >= MIN_LETTERS_FOR_CASE) & (upper > letters * MAX_UPPER_SHARE))
              | ((separators >= MIN_SEPARATORS)
                 & (n <= (separators + 1) * MAX_WORDS_PER_SEPARATOR)), 1)
        .when(line.rlike(BOILERPLATE), 2).otherwise(0)))


def _inked(lines: Column) -> Column:
    """Characters outside white space of an array of lines."""
    return F.length(F.regexp_replace(F.array_join(lines, ""), SPACE, "")).cast("long")


def apply_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its counts, ``clean_text``, ``base_failed`` and ``kept``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` describe
    the whole text; ``n_lines_failed``, ``lost_chars``, ``boilerplate_chars`` and ``lost_words``
    what the line rules removed (characters by the boilerplate rule apart, words by all rules);
    ``clean_text`` is the text without failing lines. A row is ``kept`` if it passes the base
    rules, loses at most ``MAX_LOST`` of its characters to the line rules, and has ``MIN_WORDS``
    words left. A missing text counts as having no words: counts 0, ``clean_text``
    NULL, not kept. Columns of ``docs`` with these names are replaced. Rows are treated one by
    one, so repeated rows stay as they are.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words, lines = split_words(t), F.split(t, "\n", -1)
    with_word = F.filter(lines, lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    judged = F.transform(
        lines, lambda s: F.struct(s.alias("line"), line_verdict(s).alias("verdict")))

    def of(j: Column, verdict: int) -> Column:
        return F.transform(F.filter(j, lambda x: x["verdict"] == verdict), lambda x: x["line"])

    result = let(judged, lambda j: F.struct(
        F.array_join(of(j, 0), "\n").alias("clean"), _inked(of(j, 1)).alias("lost"),
        _inked(of(j, 2)).alias("boilerplate"),
        F.size(split_words(F.array_join(F.concat(of(j, 1), of(j, 2)), " "))).cast("long")
        .alias("words"),
        F.size(F.filter(j, lambda x: x["verdict"] > 0)).cast("long").alias("failed")))
    found = free_name(docs, "line_rules")
    lost = F.col("lost_chars") + F.col("boilerplate_chars")
    return (
        docs.withColumn(found, result)
        .withColumns({
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            "n_symbols": _count(t, SYMBOLS).cast("long"),
            "n_dup_lines": let(with_word, lambda s: F.size(s) - F.size(F.array_distinct(s)))
            .cast("long"),
            "n_repeat_words": repeated_words(words),
            "clean_text": F.when(F.col(text).isNotNull(), F.col(found)["clean"]),
            "n_lines_failed": F.col(found)["failed"], "lost_chars": F.col(found)["lost"],
            "boilerplate_chars": F.col(found)["boilerplate"], "lost_words": F.col(found)["words"],
        }).drop(found)
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
            100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (lost <= F.col("word_chars") * MAX_LOST)
                    & (F.col("n_words") - F.col("lost_words") >= MIN_WORDS))
    )


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_lines_failed", "lost_chars", "boilerplate_chars", "lost_words", "base_failed", "kept"]


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return apply_rules(documents(spark, sf_dir).select("doc_id", "text")).select(*COLUMNS)


OP2_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM d
), word AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w
), win AS (
    SELECT doc_id, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN concat_ws(' ', w,
           lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS g
    FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
    SELECT doc_id, i FROM win WHERE g IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), rep AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM again CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id
), line AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM d
), fact AS (
    SELECT doc_id, s, len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n,
           length(regexp_replace(s, '[^#*$%&|<>!?]', '', 'g')) AS marks,
           length(regexp_replace(s, '[^\p{L}]', '', 'g')) AS letters,
           length(regexp_replace(s, '[^\p{Lu}]', '', 'g')) AS upper_case,
           length(regexp_replace(s, '[^|>»•·]', '', 'g')) AS seps,
           length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g')) AS inked
    FROM line
), verdict AS (
    SELECT *, CASE WHEN n = 0 THEN 0
        WHEN marks > n * 0.5 OR (letters >= 20 AND upper_case > letters * 0.6)
             OR (seps >= 3 AND n <= (seps + 1) * 3.0) THEN 1
        WHEN regexp_matches(s, '""" + BOILERPLATE + r"""') THEN 2 ELSE 0 END AS v
    FROM fact
), per AS (
    SELECT doc_id, count(*) FILTER (WHERE n > 0) - count(DISTINCT s) FILTER (WHERE n > 0) AS dup,
           count(*) FILTER (WHERE v > 0) AS failed,
           coalesce(sum(inked) FILTER (WHERE v = 1), 0)::BIGINT AS lost,
           coalesce(sum(inked) FILTER (WHERE v = 2), 0)::BIGINT AS boiler,
           coalesce(sum(n) FILTER (WHERE v > 0), 0)::BIGINT AS gone
    FROM verdict GROUP BY doc_id
), all_counts AS (
    SELECT w.doc_id, len(ws)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           dup::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
           failed::BIGINT AS n_lines_failed, lost AS lost_chars, boiler AS boilerplate_chars, gone AS lost_words
    FROM w JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND lost_chars + boilerplate_chars <= word_chars * 0.5
       AND n_words - lost_words >= 10 AS kept
FROM all_counts
"""
