"""Lookups in validity-dated tables and membership tests over key sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from callweave.operators.intervals import all_pairs
from callweave.operators.ordered import KeyLine
from callweave.operators.skew import HOT_ROWS, HOT_ROWS_SETTING, find_hot

# A map of at most so many versions, and so many of one key, goes to every task; a larger one is
# swept with the facts on the time line of its keys.
FEW_VERSIONS, FEW_OF_A_KEY = 10_000, 64


def _usable(mapping: DataFrame, start: str, end: str, window) -> DataFrame:
    """Versions that a fact of the window (first day, last day) can meet."""
    if window is None:
        return mapping
    lo, hi = (F.lit(d).cast("date") for d in window)
    return mapping.where((F.to_date(start) <= hi) & (F.to_date(end) >= lo))


def _few(versions: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the versions are so few that facts need not be moved to meet them. Below a low
    limit for large keys the line is taken."""
    limit = min(FEW_VERSIONS, int(versions.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS))))
    if versions.limit(limit + 1).count() > limit:
        return False
    most = versions.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return most is None or most <= FEW_OF_A_KEY


def _same_kinds(facts: DataFrame, mapping: DataFrame, on: Sequence[tuple[str, str]]) -> bool:
    return all(facts.schema[f].dataType == mapping.schema[m].dataType for f, m in on)


def _meet(facts, versions, on, time, start, end, closed_end, null_safe) -> DataFrame:
    """Left join of the facts with few versions, which are broadcast. Names differ."""
    kinds = {facts.schema[time].dataType, versions.schema[start].dataType, versions.schema[end].dataType}
    moment = (lambda c: F.col(c)) if len(kinds) == 1 else (lambda c: F.col(c).cast("timestamp_ntz"))
    at, to = moment(time), moment(end)
    inside = (moment(start) <= at) & ((at <= to) if closed_end else (at < to))
    return facts.join(F.broadcast(versions), reduce(lambda a, b: a & b, [
        F.col(f).eqNullSafe(F.col(v)) if null_safe else F.col(f) == F.col(v) for f, v in on], inside), "left")


def scd_lookup(
    facts: DataFrame,
    mapping: DataFrame,
    on: Sequence[tuple[str, str]],
    time: str,
    start: str,
    end: str,
    *,
    closed_end: bool = False,
    window: tuple[object, object] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left lookup: mapping rows of the key valid at ``time``; overlaps give several rows.

    Valid means ``start <= time < end``, or ``<= end`` with ``closed_end``. Facts and the ends of
    the versions are swept in order of time, so a fact only meets versions that are valid, and a
    key with many versions or facts is cut (see ``all_pairs``). ``window`` (first day, last day of
    the facts) leaves out versions no fact can meet. Facts with a missing key go round the joins
    unless ``null_safe``. Few versions (``FEW_VERSIONS``) go to every task instead, so that wide
    facts are not moved. Mapping columns must not clash with fact columns; key, start and end
    are dropped.
    """
    names = {c: f"_m_{c}" for c in {start, end, *[m for _, m in on]}}
    versions = _usable(mapping, start, end, window).withColumnsRenamed(names)
    values = [c for c in mapping.columns if c not in names]
    pairs = [(f, names[m]) for f, m in on]
    if _same_kinds(facts, versions, pairs) and _few(versions, [m for _, m in pairs]):
        found = _meet(facts, versions, pairs, time, names[start], names[end], closed_end, null_safe)
        return found.select(*facts.columns, *values)
    found = all_pairs(versions, facts, [(m, f) for f, m in pairs], names[start], names[end],
                      time, keep="points", closed_end=closed_end, null_safe=null_safe)
    return found.select(*facts.columns, *values)


def winning_pieces(
    mapping: DataFrame, keys: Sequence[str], start: str, end: str, values: Sequence[str],
    closed_end: bool = False,
) -> DataFrame:
    """Disjoint pieces (keys, ``_from``, ``_to``, values) of each key's time, with the values of
    the version that is valid there; of several the last by (start, end, values).

    One sweep over the versions of a key in that order. Of the versions still open only those
    that outlast all later ones are held, on a stack; when the last one ends, the next below it
    goes on. So there are at most two pieces for each version, however many overlap.
    """
    kind = "timestamp_ntz"
    to = F.col(end).cast(kind)
    to = to + F.expr("INTERVAL '0.000001' SECOND") if closed_end else to
    rows = mapping.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          F.col(start).cast(kind).alias("_from"), to.alias("_to"),
                          *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]) \
        .where("_from < _to")
    names = rows.columns[:len(keys)]
    shown = rows.columns[len(keys) + 2:]
    dealt = rows.distinct().repartition(*names).sortWithinPartitions(*names, "_from", "_to", *shown)
    schema = rows.schema

    def run(batches):
        import pyarrow as pa

        open_, out, last, at = [], [], None, None

        def until(moment):
            """Pieces up to a moment; None is the end of time."""
            nonlocal at
            while open_ and (moment is None or open_[-1][0] <= moment):
                stop, row = open_.pop()
                if at < stop:
                    out.append((*last, at, stop, *row))
                    at = stop
            if open_ and moment is not None and at < moment:
                out.append((*last, at, moment, *open_[-1][1]))

        def made(kinds):
            done = pa.RecordBatch.from_arrays(
                [pa.array(c, k) if not pa.types.is_timestamp(k) else pa.array(c, pa.int64()).cast(k)
                 for c, k in zip(zip(*out), kinds.types)], schema=kinds)
            out.clear()
            return done

        kinds = None
        for batch in batches:
            kinds = batch.schema
            columns = [c.cast(pa.int64()).to_pylist() if pa.types.is_timestamp(c.type) else c.to_pylist()
                       for c in batch.columns]
            for row in zip(*columns):
                key, since, stop = row[:len(keys)], row[len(keys)], row[len(keys) + 1]
                if key != last:
                    until(None)
                    last, at = key, since
                until(since)
                at = since
                while open_ and open_[-1][0] <= stop:
                    open_.pop()
                open_.append((stop, row[len(keys) + 2:]))
            if out:
                yield made(kinds)
        until(None)
        if out:
            yield made(kinds)

    pieces = dealt.mapInArrow(run, schema)
    return pieces.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "_from", "_to",
                         *[F.col(n).alias(v) for n, v in zip(shown, values)])


def scd_lookup_last(
    facts: DataFrame,
    mapping: DataFrame,
    on: Sequence[tuple[str, str]],
    time: str,
    start: str,
    end: str,
    values: Sequence[str],
    *,
    closed_end: bool = True,
    window: tuple[object, object] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left lookup that keeps one mapping row, the last by (start, end, values).

    The versions are cut into disjoint pieces first (``winning_pieces``); pieces and facts go on
    one time line per key and the nearest earlier piece is carried along, so a fact meets one
    piece however many versions overlap. The pieces of few versions go to every task instead.
    """
    names = [f"_k{i}" for i in range(len(on))]
    versions, m_keys = _usable(mapping, start, end, window), [m for _, m in on]
    pieces = winning_pieces(versions, m_keys, start, end, values, closed_end)
    if _same_kinds(facts, versions, on) and _few(versions, m_keys):
        shown = [f"_m_{c}" for c in pieces.columns]  # keys, _from, _to, values
        found = _meet(facts, pieces.toDF(*shown), list(zip([f for f, _ in on], shown)), time,
                      "_m__from", "_m__to", False, null_safe)
        return found.select(*facts.columns, *[F.col(f"_m_{v}").alias(v) for v in values])
    placed = facts.select(*[F.col(f).alias(n) for n, (f, _) in zip(names, on)],
                          F.col(time).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"),
                          F.xxhash64(*facts.columns).alias("_id"),
                          F.struct(*facts.columns).alias("_fact"))
    marks = pieces.select(*[F.col(m).alias(n) for n, (_, m) in zip(names, on)],
                          F.col("_from").alias("_t"), F.lit(0).alias("_kind"),
                          F.struct("_to", *values).alias("_piece"))
    both = placed.unionByName(marks, allowMissingColumns=True)
    hot = find_hot(both if null_safe else both.dropna(subset=names), names)
    line = KeyLine(both, names, ["_t", "_kind", "_id"], hot=hot,
                   null_keys="group" if null_safe else "never").run(last={"_near": F.col("_piece")})
    valid = F.col("_t") < F.col("_near._to")
    return line.rows().where("_kind = 1").select(
        "_fact.*", *[F.when(valid, F.col(f"_near.{v}")).alias(v) for v in values])


def key_set(*columns: tuple[DataFrame, str], name: str = "key") -> DataFrame:
    """Distinct union of key columns, NULL left out. Each branch is reduced before the
    union, so a value repeated over a third of the rows is shuffled once per task."""
    parts = [df.select(F.col(c).alias(name)).dropna() for df, c in columns]
    return reduce(DataFrame.unionByName, parts).distinct()


def semi(df: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    return _filter_join(df, keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose key is not in ``keys``; rows with a missing key stay."""
    return _filter_join(df, keys, on, "left_anti")


def _filter_join(df, keys, on, how):
    right = keys.select(*[F.col(r).alias(f"_f{i}") for i, (_, r) in enumerate(on)]).distinct()
    cond = reduce(lambda a, b: a & b, [df[l] == right[f"_f{i}"] for i, (l, _) in enumerate(on)])
    return df.join(right, cond, how)


def any_key_member(
    df: DataFrame,
    id_cols: Sequence[str],
    candidates: Sequence[tuple[str, Sequence[Column]]],
    keys: dict[str, DataFrame],
) -> DataFrame:
    """Rows of which any candidate key is in the key set of its kind.

    ``candidates``: (kind, expressions giving a key or NULL); ``keys``: one-column key sets
    by kind. Only (id, kind, key) is exploded and shuffled; the wide rows are filtered by
    the ids found.
    """
    entries = [
        F.struct(F.lit(kind).alias("kind"), e.cast("string").alias("key"))
        for kind, exprs in candidates for e in exprs
    ]
    long = df.select(*id_cols, F.explode(F.array(*entries)).alias("_c")) \
        .select(*id_cols, "_c.kind", "_c.key").where(F.col("key").isNotNull())
    wanted = reduce(DataFrame.unionByName, [
        k.select(F.lit(kind).alias("kind"), F.col(k.columns[0]).cast("string").alias("key"))
        for kind, k in keys.items()
    ]).distinct()
    ids = long.join(wanted, ["kind", "key"], "left_semi").select(*id_cols).distinct()
    renamed = ids.select(*[F.col(c).alias(f"_i_{c}") for c in id_cols])
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(renamed[f"_i_{c}"]) for c in id_cols])
    return df.join(renamed, cond, "left_semi")


def expand_entities(df: DataFrame, entity: str, member: str, active: DataFrame) -> DataFrame:
    """All (entity, member) pairs of entities that have a member in ``active``.

    The link runs over the entity key as a semi-join, so no member pairs are formed.
    """
    entities = semi(df, active, [(member, active.columns[0])]).select(entity)
    return semi(df, entities, [(entity, entity)]).select(entity, member).distinct()


def left_join_known(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
) -> DataFrame:
    """Left join of tables with different column names, in which rows with a missing key go
    round the join: they match nothing, and would all meet in one task. Where a text is the only
    key, they are dealt out by a text of their own instead, so that ``left`` is read once."""
    cond = reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in on])
    texts = [left.schema[l].dataType == right.schema[r].dataType == StringType() for l, r in on]
    hashable = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    if texts == [True]:
        (l, r), = on
        dealt = F.coalesce(left[l], F.xxhash64(*[left[c] for c in hashable]).cast("string"))
        return left.join(right, (dealt == right[r]) & cond, "left")
    known = reduce(lambda a, b: a & b, [F.col(l).isNotNull() for l, _ in on])
    joined = left.where(known).join(right, cond, "left")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.unionByName(left.where(~known).select("*", *none))


def join_suffix(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left",
    suffix: str = "_y", null_safe: bool = False, around: bool = False,
) -> DataFrame:
    """Join that keeps the left names and adds ``suffix`` to clashing right columns; the
    right key columns are dropped. With ``around`` the rows of a left join that have a missing
    key go round it."""
    if around:
        known = reduce(lambda a, b: a & b, [F.col(l).isNotNull() for l, _ in on])
        joined = join_suffix(left.where(known), right, on, how, suffix)
        rest = left.where(~known)
        return joined.unionByName(rest.select("*", *[
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in joined.schema.fields[len(left.columns):]]))
    drop = {r for _, r in on}
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns})
    pairs = [(left[l], right[f"_r_{r}"]) for l, r in on]
    cond = reduce(
        lambda a, b: a & b, [l.eqNullSafe(r) if null_safe else l == r for l, r in pairs]
    )
    names = [c[3:] for c in right.columns if c[3:] not in drop]
    return left.join(right, cond, how).select(
        *[left[c] for c in left.columns],
        *[right[f"_r_{c}"].alias(c + suffix if c in left.columns else c) for c in names],
    )
