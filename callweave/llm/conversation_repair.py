"""Conversation structure repair by weighted interval parsing (CYK).

A conversation is right when its roles read: perhaps a system turn, then pairs of user and
assistant. The repair grammar is in Chomsky normal form with one symbol for each pair of states
(p, q) of that reading: a span of rows with this symbol takes the reading from p to q. Rules are
``(p, q) -> (p, r) (r, q)`` and, for one row, its edits (keep, rerole, delete) after any inserted
turns (the insertion closure). A chart cell holds for each symbol the least cost and, of its
audits (the initials of the edits), the ASCII-least.

Cells are combined bottom-up by span length. A symbol says all that a span's neighbours need, so
every split of a span gives the same cell and one split is enough. That the least audit of a cell
is enough, too: of two audits of one cell and cost none is a beginning of the other, because what
it has more would be insertions, which cost.

A conversation of any length is cut into pieces of bounded size; their cells are made by separate
tasks and combined in further rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from callweave.llm.text import column
from callweave.session import materialise
from callweave.sources.tables import read_table

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: The reading: state before, initial of the role, state after.
READS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a piece, and pieces that are combined in one step, as a power of two.
PIECE_BITS = 8
WHITE = " \t\n\x0b\x0c\r"

Cell = dict[tuple[int, int], tuple[int, str]]


def better(cell: Cell, symbol: tuple[int, int], cost: int, audit: str) -> None:
    if symbol not in cell or (cost, audit) < cell[symbol]:
        cell[symbol] = (cost, audit)


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                better(out, (p, q), cost + more, audit + rest)
    return out


def _insertions() -> Cell:
    """Cell of no row at all: any number of inserted turns."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    one = {(p, q): (INSERT, "I") for (p, role), q in READS.items() if role in NAMES}
    while True:
        longer = dict(cell)
        for symbol, value in combined(cell, one).items():
            better(longer, symbol, *value)
        if longer == cell:
            return cell
        cell = longer


INSERTIONS = _insertions()


def row_cell(initial: str, fault: str, copies: int) -> Cell:
    """The cell of a row that stands ``copies`` times (all but the first are duplicates), with
    the turns that may be inserted before it."""
    gone, cost = "D" * copies, DELETE * copies
    cell: Cell = {(p, p): (cost, gone) for p in STATES}
    if fault not in ("blank", "duplicate"):
        stays = cost - DELETE + (TRUNCATED if fault == "truncated" else 0)
        for (p, role), q in READS.items():
            if role == initial:
                better(cell, (p, q), stays, "K" + gone[1:])
            if role in NAMES:
                better(cell, (p, q), stays + REROLE, "R" + gone[1:])
    return combined(INSERTIONS, cell)


def chart(cells: list[Cell]) -> Cell:
    """The cell of the whole span, by spans of doubling length."""
    while len(cells) > 1:
        cells = [combined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i]
                 for i in range(0, len(cells), 2)]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation, whose end may have inserted turns too."""
    whole = combined(cell, INSERTIONS)
    return min(whole[START, q] for q in ENDS if (START, q) in whole)


def cut(parts: list[tuple[int, Cell]], state: int, audit: str) -> list[tuple[int, str]]:
    """(state before, audit) of each part of a span that has ``audit`` from ``state`` on; a part
    is the number of its rows and its cell. Turns inserted after the last row go to it."""
    out, at = [], 0
    for i, (rows, cell) in enumerate(parts):
        end, left = at, rows
        while left:
            left -= audit[end] != "I"
            end += 1
        own = audit[at:end]
        out.append((state, own if i + 1 < len(parts) else audit[at:]))
        state = next((q for q in STATES if cell.get((state, q), (0, None))[1] == own), state)
        at = end
    return out


def edits(rows: list[tuple[int, str, int]], state: int, audit: str) -> Iterator[tuple]:
    """(at, lead, edit, role, tail) of rows (at, initial, copies): roles of the turns inserted
    before and after, and the row's edit and new role (None: its own)."""
    def step(role: str | None = None) -> str:
        nonlocal state
        role = role or next(r for (p, r) in READS if p == state and r in NAMES)
        state = READS[state, role]
        return NAMES.get(role)

    i = 0
    for k, (at, initial, copies) in enumerate(rows):
        lead, tail, role = [], [], None
        while audit[i] == "I":
            lead.append(step())
            i += 1
        edit = audit[i]
        i += copies
        if edit == "K":
            step(initial)
        elif edit == "R":
            role = step()
        if k + 1 == len(rows):
            tail = [step() for _ in audit[i:]]
        yield at, lead, edit, role, tail


# Cells in columns: one cost and one audit for each symbol, missing where there is none.
SYMBOLS = [(p, q) for p in STATES for q in STATES]
COUNTS = ("letters", "blank", "duplicate", "truncated", "illegal")
SPAN = ", ".join([f"{c} long" for c in COUNTS] + [
    "first string", "last string", "costs array<long>", "audits array<string>"])


def _columns(cell: Cell) -> tuple[list, list]:
    got = [cell.get(s, (None, None)) for s in SYMBOLS]
    return [c for c, _ in got], [a for _, a in got]


def _cell(costs: list, audits: list) -> Cell:
    return {s: (c, a) for s, c, a in zip(SYMBOLS, costs, audits) if c is not None}


def _illegal(a: str, b: str) -> int:
    return a + b not in ("su", "ua", "au")


def _span(parts: list[dict]) -> dict:
    """Counts and cell of neighbouring spans as one."""
    costs, audits = _columns(chart([_cell(p["costs"], p["audits"]) for p in parts]))
    between = sum(_illegal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
    out = {c: sum(p[c] for p in parts) for c in COUNTS}
    return out | {"illegal": out["illegal"] + between, "first": parts[0]["first"],
                  "last": parts[-1]["last"], "costs": costs, "audits": audits}


def _row_span(row: dict) -> dict:
    costs, audits = _columns(row_cell(row["initial"], row["fault"], row["copies"]))
    n, fault = row["copies"], row["fault"]
    return {"letters": n, "blank": n if fault == "blank" else 0,
            "duplicate": n if fault == "duplicate" else 0 if fault == "blank" else n - 1,
            "truncated": int(fault == "truncated"),
            "illegal": (n - 1) * _illegal(row["initial"], row["initial"]),
            "first": row["initial"], "last": row["initial"], "costs": costs, "audits": audits}


def _mapped(df: DataFrame, f, names: list[str], schema: T.StructType) -> DataFrame:
    """Rows made from each row's columns ``names``, with column ``c`` carried over; ``f`` yields
    dicts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for s in range(0, big.num_rows, 500):
                batch = big.slice(s, 500)
                places, out = [], []
                for i, row in enumerate(zip(*(column(batch, n).to_pylist() for n in names))):
                    for made in f(*row):
                        places.append(i)
                        out.append(made)
                carried = column(batch, "c").take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_pydict({"c": carried} | {
                    n: pa.array([o[n] for o in out], kinds[n]) for n in kinds})

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {x.name: to_arrow_type(x.dataType) for x in schema.fields if x.name != "c"}
    return df.select("c", *names).mapInArrow(run, schema)


def faults(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, turn, role, text, copies, fault) of the distinct rows: ``copies`` of each are alike."""
    space = F.lit(" ")
    grouped = materialise(
        rows.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("turn"),
                    F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"))
        .groupBy("c", "turn", "role", "text").agg(F.count("*").alias("copies"))
        .withColumn("said", F.unhex(F.sha2(F.concat(
            F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))), "turns")
    # Turn of the first row that says the same; the join back is by turn, so that one text said
    # in very many turns is not one key.
    order = F.struct(F.col("turn").isNotNull(), "turn")
    first = grouped.groupBy(F.col("c").alias("c1"), F.col("said").alias("said1")).agg(
        F.min_by("turn", order).alias("turn1"))
    on = (F.col("c").eqNullSafe(F.col("c1")) & (F.col("said") == F.col("said1"))
          & F.col("turn").eqNullSafe(F.col("turn1")))
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    return grouped.join(first, on, "left").select(
        "c", "turn", "role", "text", "copies",
        F.when(bare == "", "blank").when(F.col("said1").isNull(), "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))


class Repair(NamedTuple):
    """``verdicts``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every
    conversation with rows. ``turns``: (conv, place, k, turn, role, text, edit) of the repaired
    turns in the order of (place, k); inserted ones have no turn and an empty text."""

    verdicts: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", bits: int = PIECE_BITS) -> Repair:
    """Cheapest repair of each conversation to the roles ``(s?(ua)+)?``.

    Rows are taken by turn (missing first), equal turns by role and text. Missing roles and texts
    count as one space, rows without conversation are one conversation, other columns are
    ignored. A row's first fault counts: blank, duplicate of an earlier row (role and text),
    truncated (no mark at its end). Keeping costs 0, a new role 1, deleting 2, inserting an empty
    turn 5, and a truncated row that stays 5 more; blank rows and duplicates must go. Of equally
    cheap repairs that with the ASCII-least initials is taken. An empty table gives no rows.
    """
    order = ["c", "turn", "role", "text"]
    kind = T.StructField("c", rows.schema[conv].dataType)
    ordered = materialise(
        faults(rows, conv, turn, role, text).repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*order, "copies", "fault", F.left("role", F.lit(1)).alias("initial"),
                F.monotonically_increasing_id().alias("at")), "ordered-turns")
    pieces = ordered.groupBy("c", F.shiftright("at", bits).alias("piece")).agg(F.array_sort(
        F.collect_list(F.struct("at", "initial", "fault", "copies"))).alias("rows"))
    span = T._parse_datatype_string(SPAN).fields
    levels = [materialise(_mapped(
        pieces, lambda piece, rows: [_span([_row_span(r) for r in rows]) | {
            "piece": piece, "rows": [(r["at"], r["initial"], r["copies"]) for r in rows]}],
        ["piece", "rows"], T.StructType([kind, *T._parse_datatype_string(
            "piece long, rows array<struct<at: long, initial: string, copies: long>>").fields, *span])),
        "pieces")]
    schema = T.StructType([kind, *T._parse_datatype_string("piece long").fields, *span])
    fields = F.struct("piece", *[f.name for f in span])

    def parts_of(level: DataFrame, by: Column) -> DataFrame:
        return level.groupBy("c", by.alias("above")).agg(
            F.array_sort(F.collect_list(fields)).alias("parts"))

    shift = bits
    while (levels[-1].groupBy("c").count().agg(F.max("count")).first()[0] or 0) > 1 << bits:
        levels.append(materialise(_mapped(
            parts_of(levels[-1], F.shiftright("piece", bits)),
            lambda above, parts: [_span(parts) | {"piece": above}], ["above", "parts"], schema),
            "pieces"))
        shift += bits

    def judged(parts: list[dict]) -> list[dict]:
        whole = _span(parts)
        cost, audit = cheapest(_cell(whole["costs"], whole["audits"]))
        return [{c: whole[c] for c in COUNTS} | {
            "cost": cost, "audit": audit, "below": _below(parts, START, audit)}]

    below = "below array<struct<piece: long, state: int, audit: string>>"
    roots = materialise(_mapped(
        parts_of(levels[-1], F.lit(0)), judged, ["parts"], T.StructType([kind, *T._parse_datatype_string(
            ", ".join(f"{c} long" for c in COUNTS) + f", cost long, audit string, {below}").fields])),
        "verdicts")
    down = roots.select("c", F.explode("below").alias("b")).select("c", "b.*")
    for level in reversed(levels[:-1]):
        pairs = parts_of(level, F.shiftright("piece", bits)).join(
            down.withColumnsRenamed({"c": "c1", "piece": "p1"}),
            F.col("c").eqNullSafe(F.col("c1")) & (F.col("above") == F.col("p1")))
        down = _mapped(pairs, lambda parts, state, audit: [
            {"piece": p, "state": s, "audit": a} for p, s, a in _below(parts, state, audit)],
            ["parts", "state", "audit"], T.StructType([kind, *T._parse_datatype_string(
                "piece long, state int, audit string").fields]))
    own = levels[0].select("c", "piece", "rows").join(
        down.withColumnsRenamed({"c": "c1", "piece": "p1"}),
        F.col("c").eqNullSafe(F.col("c1")) & (F.col("piece") == F.col("p1")))
    names = ("place", "lead", "edit", "new_role", "tail")
    edited = _mapped(own, lambda rows, state, audit: [dict(zip(names, e)) for e in edits(
        [(r["at"], r["initial"], r["copies"]) for r in rows], state, audit)],
        ["rows", "state", "audit"], T.StructType([kind, *T._parse_datatype_string(
            "place long, lead array<string>, edit string, new_role string, tail array<string>"
        ).fields])).drop("c")
    return Repair(_verdicts(ordered, roots, conv), _turns(ordered, edited, conv))


def _below(parts: list[dict], state: int, audit: str) -> list[tuple[int, int, str]]:
    got = cut([(p["letters"], _cell(p["costs"], p["audits"])) for p in parts], state, audit)
    return [(p["piece"], s, a) for p, (s, a) in zip(parts, got)]


def _verdicts(ordered: DataFrame, roots: DataFrame, conv: str) -> DataFrame:
    gaps = ordered.groupBy(F.col("c").alias("c1"), "turn").agg(F.lit(1)).groupBy("c1").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return roots.join(gaps, F.col("c").eqNullSafe(F.col("c1"))).select(
        F.col("c").alias(conv), "gaps", *COUNTS[1:], "cost", "audit")


def _turns(ordered: DataFrame, edited: DataFrame, conv: str) -> DataFrame:
    def inserted(c: str) -> Column:
        return F.transform(c, lambda r: F.struct(
            F.lit(None).cast("long").alias("turn"), r.alias("role"), F.lit("").alias("text"),
            F.lit("I").alias("edit")))

    own = F.array(F.struct("turn", F.coalesce("new_role", "role").alias("role"), "text", "edit"))
    kept = F.when(F.col("edit") == "D", F.slice(own, 1, 0)).otherwise(own)
    joined = ordered.join(edited, F.col("at") == F.col("place"))
    return joined.select(F.col("c").alias(conv), "place", F.posexplode(
        F.concat(inserted("lead"), kept, inserted("tail"))).alias("k", "t")).select(
        conv, "place", "k", "t.*")


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, sha256) of ``role:text`` of the repaired turns, joined by line ends. A digest runs
    from the first to the last turn, so one task reads a conversation, turn by turn."""
    kind = turns.schema[conv].dataType
    lines = turns.select(F.col(conv).alias("c"), "place", "k", F.concat("role", F.lit(":"), "text")
                         .alias("line")).repartition("c").sortWithinPartitions("c", "place", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            done = []
            convs = column(batch, "c")
            for c, line in zip(convs.to_pylist(), column(batch, "line").cast(pa.binary()).to_pylist()):
                if held is None or c != last:
                    if held is not None:
                        done.append((last, held.hexdigest()))
                    last, held = c, hashlib.sha256(line)
                else:
                    held.update(b"\n" + line)
            if done:
                yield rows(done, convs.type)
        if held is not None:
            yield rows([(last, held.hexdigest())], convs.type)

    def rows(done: list, c_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            conv: pa.array([c for c, _ in done], c_type),
            "sha256": pa.array([h for _, h in done], pa.string())})

    return lines.select("c", "line").mapInArrow(run, T.StructType([
        T.StructField(conv, kind), T.StructField("sha256", T.StringType())]))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the checksum of ``conv_id:turn``; missing values
    count as one space."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(d == 4, "user").otherwise(known("role")).alias("role"),
        F.when(d == 1, "").when(d == 2, F.regexp_replace(known("text"), "[.!?]", ""))
        .otherwise(known("text")).alias("text"),
        F.explode(F.when(d == 0, F.array().cast("array<int>")).when(
            d == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    ).drop("_copy")


def op11_conversations(spark, sf_dir: str) -> DataFrame:
    """Repair of every damaged conversation."""
    rows = read_table(spark, "conversations", root=sf_dir)
    repaired = repair(damaged(rows))
    verdicts = materialise(repaired.verdicts, "conversation-verdicts")
    hashes = digests(repaired.turns).withColumnRenamed("conv_id", "c2")
    every = rows.select(F.col("conv_id").alias("c0")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(verdicts, F.col("c0").eqNullSafe(F.col("conv_id")), "left")
        .join(hashes, F.col("c0").eqNullSafe(F.col("c2")), "left")
        .select(F.col("c0").alias("conv_id"),
                *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


#: The cheapest path through the reading, turn by turn; the checksum is written out bit by bit.
OP11_SQL = r"""
WITH RECURSIVE entry AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
        FROM (SELECT unnest(range(256)) AS i))
), filled AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x
    FROM conversations
), summed AS (
    SELECT *, xor(list_reduce(list_transform(range(length(x) // 2),
                lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS d
    FROM filled, entry
), row_ AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
    FROM summed WHERE d <> 0
), placed AS (
    SELECT *, row_number() OVER w AS i, lead(role) OVER w AS next_role,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
    FROM row_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), judged AS (
    SELECT *, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd'
                   WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
           next_role IS NOT NULL AND left(role, 1) || left(next_role, 1) NOT IN ('su', 'ua', 'au') AS bad
    FROM placed
), counted AS (
    SELECT conv_id, max(i) AS last_i,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
           count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE bad) AS illegal
    FROM judged GROUP BY conv_id
), step(p, q, role) AS (VALUES
    (0, 1, 's'), (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')
), pad(p, q, cost, audit, said) AS (VALUES
    (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'),
    (2, 3, 5, 'I', chr(10) || 'assistant:'), (3, 2, 5, 'I', chr(10) || 'user:'),
    (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), edit AS (
    SELECT conv_id, i, p.q AS p, p.q AS q, 2 AS cost, 'D' AS audit, '' AS said
    FROM judged, (SELECT DISTINCT q FROM pad) p
    UNION ALL
    SELECT conv_id, i, p, q, CASE WHEN fault = 't' THEN 5 ELSE 0 END, 'K', chr(10) || j.role || ':' || text
    FROM judged j JOIN step s ON left(j.role, 1) = left(s.role, 1) WHERE fault IN ('', 't')
    UNION ALL
    SELECT conv_id, i, p, q, CASE WHEN fault = 't' THEN 6 ELSE 1 END, 'R', chr(10) || s.role || ':' || text
    FROM judged j, step s WHERE s.role <> 's' AND fault IN ('', 't')
), move AS (
    SELECT conv_id, i, pad.p, e.q, min(struct_pack(cost := pad.cost + e.cost, audit := pad.audit || e.audit,
                                                   said := pad.said || e.said)) AS m
    FROM edit e JOIN pad ON pad.q = e.p GROUP BY ALL
), path AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS q, struct_pack(cost := 0, audit := '', said := '') AS m FROM counted
    UNION ALL
    SELECT n.conv_id, n.i, n.q, min(struct_pack(cost := path.m.cost + n.m.cost,
        audit := path.m.audit || n.m.audit, said := path.m.said || n.m.said)) AS m
    FROM path JOIN move n ON n.conv_id IS NOT DISTINCT FROM path.conv_id AND n.i = path.i + 1 AND n.p = path.q
    GROUP BY n.conv_id, n.i, n.q
), best AS (
    SELECT c.conv_id, min(struct_pack(cost := m.cost + pad.cost, audit := m.audit || pad.audit,
                                      said := m.said || pad.said)) AS m
    FROM path JOIN counted c ON c.conv_id IS NOT DISTINCT FROM path.conv_id AND path.i = c.last_i
    JOIN pad ON pad.p = path.q AND pad.q IN (0, 3) GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.m.cost, 0)::BIGINT AS cost,
       coalesce(b.m.audit, '') AS audit, sha256(coalesce(substring(b.m.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
