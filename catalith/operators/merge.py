"""Keyed merge, scoped replace and cascading delete.

Spark's file tables have no in-place update, so a merge is an expression over the
current frame and a frame of changes whose result is written as a new version.
Changes are folded per key with map-side combined aggregates only; a key with a
third of all changes costs one partial row per task, not one large group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import lacks_text

ACTION = "_action"
_CUR, _CHG, _N = "__cur", "__chg", "__n"


@dataclass(frozen=True)
class Policy:
    """How one column combines with its changes.

    ``folds`` maps partial names to aggregates over the ordered changes of a key;
    ``update`` and ``insert`` build the new value from the current column and them.
    """

    folds: Callable[[Column, Column], Mapping[str, Column]]
    update: Callable[[Column, Mapping[str, Column]], Column]
    insert: Callable[[Mapping[str, Column]], Column]


def _latest(value: Column, order: Column, when: Column | None = None) -> Column:
    return F.max_by(value, order) if when is None else F.max_by(F.when(when, value), F.when(when, order))


def _earliest(value: Column, order: Column, when: Column | None = None) -> Column:
    return F.min_by(value, order) if when is None else F.min_by(F.when(when, value), F.when(when, order))


def incoming() -> Policy:
    """The last change wins, NULL included."""
    return Policy(lambda v, o: {"last": _latest(v, o)}, lambda c, p: p["last"], lambda p: p["last"])


def keep() -> Policy:
    """The first written value stays."""
    return Policy(lambda v, o: {"first": _earliest(v, o)}, lambda c, p: c, lambda p: p["first"])


def coalesce_incoming() -> Policy:
    """The last non-NULL change, else the current value."""
    return Policy(
        lambda v, o: {"last": _latest(v, o, v.isNotNull())},
        lambda c, p: F.coalesce(p["last"], c),
        lambda p: p["last"],
    )


def non_empty() -> Policy:
    """The last non-empty change, else the current value, else what was first written."""
    return Policy(
        lambda v, o: {"last": _latest(v, o, F.length(v) > 0), "first": _earliest(v, o)},
        lambda c, p: F.coalesce(p["last"], c),
        lambda p: F.coalesce(p["last"], p["first"]),
    )


def counter() -> Policy:
    """Current count plus one per change."""
    return Policy(
        lambda v, o: {"n": F.count(F.lit(1))},
        lambda c, p: F.coalesce(c, F.lit(0)) + p["n"],
        lambda p: p["n"],
    )


def sticky(value: str) -> Policy:
    """Once ``value`` is reached it stays; otherwise the last change wins."""

    def folded(p: Mapping[str, Column]) -> Column:
        return F.when(F.coalesce(p["any"], F.lit(False)), F.lit(value)).otherwise(p["last"])

    return Policy(
        lambda v, o: {"any": F.bool_or(v == value), "last": _latest(v, o)},
        lambda c, p: F.when(c == value, c).otherwise(folded(p)),
        folded,
    )


def fill_if_missing() -> Policy:
    """A present text stays; a missing one takes the first present change."""

    def folded(p: Mapping[str, Column]) -> Column:
        return F.coalesce(p["present"], p["last"])

    return Policy(
        lambda v, o: {"present": _earliest(v, o, ~lacks_text(v)), "last": _latest(v, o)},
        lambda c, p: F.when(lacks_text(c), folded(p)).otherwise(c),
        folded,
    )


def now(run_ts: Column) -> Policy:
    """The run timestamp on every touched row."""
    return Policy(lambda v, o: {}, lambda c, p: run_ts, lambda p: run_ts)


def constant(value) -> Policy:
    """A fixed value on every touched row."""
    return Policy(lambda v, o: {}, lambda c, p: F.lit(value), lambda p: F.lit(value))


def map_merge() -> Policy:
    """Marker policy for map columns: shallow merge of all changes in order, later keys win."""
    return _MAP_MERGE


_MAP_MERGE = Policy(lambda v, o: {}, lambda c, p: c, lambda p: F.lit(None))


def _folded_maps(changes: DataFrame, keys: Sequence[str], column: str, order: Column) -> DataFrame:
    """Last value per (key, map key), rebuilt as one map per key; bounded by distinct map keys."""
    entries = changes.select(*keys, order.alias("__o"), F.explode(column).alias("__k", "__v"))
    last = entries.groupBy(*keys, "__k").agg(F.max_by("__v", "__o").alias("__v"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__k", "__v"))).alias(f"__m_{column}"))


def merge_upsert(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    policies: Mapping[str, Policy],
    order_by: Sequence[str],
    *,
    insert: bool = True,
    update: bool = True,
    changed_when: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``current`` after all ``changes``, with an ``_action`` per row: insert, update or keep.

    ``order_by`` must order the changes of one key totally.  Columns without a
    policy keep their current value and are NULL on insert.  A NULL in a key
    matches nothing, so such a change is always a new row.  ``insert=False`` only
    updates, ``update=False`` only inserts.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    columns = [c for c in current.columns if c not in keys]
    whole_key = F.lit(True)
    for k in keys:
        whole_key = whole_key & F.col(k).isNotNull()

    aggregates: list[Column] = []
    for name, policy in policies.items():
        value = F.col(name) if name in changes.columns else F.lit(None)
        for part, agg in policy.folds(value, order).items():
            aggregates.append(agg.alias(f"__p_{name}_{part}"))
    keyed = changes.where(whole_key)
    folded = keyed.groupBy(*keys).agg(F.lit(True).alias(_CHG), F.count(F.lit(1)).alias(_N), *aggregates)
    map_columns = [n for n, p in policies.items() if p is _MAP_MERGE]
    for name in map_columns:
        folded = folded.join(_folded_maps(keyed, keys, name, order), list(keys), "left")

    marked = current.withColumn(_CUR, F.lit(True))
    both = marked.join(folded, list(keys), "full_outer" if insert else "left")
    cur, chg = F.coalesce(_CUR, F.lit(False)), F.coalesce(_CHG, F.lit(False))
    action = F.when(~cur, "insert").when(chg & F.lit(update), "update").otherwise("keep")

    def value_of(name: str) -> Column:
        if name not in policies:
            return F.col(name)
        policy = policies[name]
        if policy is _MAP_MERGE:
            incoming_map, old = F.col(f"__m_{name}"), F.col(name)
            kept = F.map_filter(old, lambda k, _v: ~F.map_contains_key(incoming_map, k))
            updated = (
                F.when(incoming_map.isNull(), old)
                .when(old.isNull(), incoming_map)
                .otherwise(F.map_concat(kept, incoming_map))
            )
            inserted = incoming_map
        else:
            parts = {p: F.col(f"__p_{name}_{p}") for p in policy.folds(F.lit(None), F.lit(None))}
            updated, inserted = policy.update(F.col(name), parts), policy.insert(parts)
        return F.when(action == "insert", inserted).when(action == "update", updated).otherwise(F.col(name))

    merged = both.select(
        *keys, *[value_of(c).cast(current.schema[c].dataType).alias(c) for c in columns], action.alias(ACTION)
    )
    if not insert:
        return merged
    loose = changes.where(~whole_key)
    alone = loose.select(
        *[F.col(k).cast(current.schema[k].dataType).alias(k) for k in keys],
        *[_single(changes, policies, c).cast(current.schema[c].dataType).alias(c) for c in columns],
        F.lit("insert").alias(ACTION),
    )
    return merged.unionByName(alone)


def _single(changes: DataFrame, policies: Mapping[str, Policy], name: str) -> Column:
    """Inserted value of a change that stands alone."""
    if name not in policies:
        return F.lit(None)
    policy = policies[name]
    value = F.col(name) if name in changes.columns else F.lit(None)
    if policy is _MAP_MERGE:
        return value
    parts: dict[str, Column] = {}
    for part in policy.folds(F.lit(None), F.lit(None)):
        parts[part] = F.lit(1) if part == "n" else F.lit(False) if part == "any" else value
    return policy.insert(parts)


def insert_only(current: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``current`` plus the first change of every unknown key."""
    policies = {c: keep() for c in current.columns if c not in keys}
    return merge_upsert(current, changes, keys, policies, order_by, update=False)


def action_counts(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per action, the load summary."""
    return merged.groupBy(*by, ACTION).agg(F.count(F.lit(1)).alias("row_count"))


def partial_update(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    order_by: Sequence[str],
    run_ts: Column,
    *,
    stamp: str = "updated_at",
    stamp_always: bool = False,
) -> DataFrame:
    """Non-NULL fields of the changes replace the current ones.

    The timestamp moves on every touched row with ``stamp_always``, else only on
    rows where a change carried at least one field.  Unknown keys are ignored.
    """
    rows = changes if stamp_always else changes.where(F.coalesce(*fields).isNotNull())
    policies: dict[str, Policy] = {f: coalesce_incoming() for f in fields}
    policies[stamp] = now(run_ts)
    return merge_upsert(current, rows, keys, policies, order_by, insert=False)


def replace_scope(current: DataFrame, fresh: DataFrame, scope: Sequence[str], scopes: DataFrame | None = None) -> DataFrame:
    """Rows of the touched scopes are replaced by ``fresh``; other rows stay.

    ``scopes`` names the scopes to clear; by default those that occur in ``fresh``.
    """
    cleared = (fresh if scopes is None else scopes).select(*scope).distinct()
    return current.join(cleared, list(scope), "left_anti").unionByName(fresh)


Reference = tuple[str, Mapping[str, str], str]


def delete_order(stores: Sequence[str], references: Sequence[Reference]) -> tuple[list[list[str]], list[Reference]]:
    """Levels of stores, those that nothing refers to first, and the references cut for it.

    A reference whose child name starts with ``?`` sets NULL and needs no order.  Where
    only cycles are left, their first remaining reference is cut, so it has to be set to
    NULL before.
    """
    held = [r for r in references if not r[0].startswith("?") and r[0] != r[2]]
    left, levels, cut = list(stores), [], []
    while left:
        inside = [r for r in held if r[0] in left and r[2] in left]
        level = [s for s in left if all(r[2] != s for r in inside)]
        if level:
            levels.append(level)
            left = [s for s in left if s not in level]
            continue
        # a reference on a cycle: follow children until a store comes again
        store, seen = left[0], []
        while store not in seen:
            seen.append(store)
            store = next(r[0] for r in inside if r[2] == store)
        first = next(r for r in inside if r[2] == store and r[0] in seen[seen.index(store) :])
        held.remove(first)
        cut.append(first)
    return levels, cut


def delete_marks(frames: Mapping[str, DataFrame], root: str, doomed: DataFrame, root_keys: Sequence[str], references: Sequence[Reference]) -> dict[str, DataFrame]:
    """Every frame at or below ``root`` with a flag ``__gone``, parents marked before children.

    Needs references without cycles below the root; the order of ``references`` is free.
    """

    def marked(rows: DataFrame, parents: DataFrame, link: Sequence[str]) -> DataFrame:
        flagged = rows.join(parents.distinct().withColumn("__hit", F.lit(True)), list(link), "left")
        gone = F.coalesce(F.col("__gone"), F.lit(False)) if "__gone" in rows.columns else F.lit(False)
        return flagged.select(*[F.col(c) for c in rows.columns if c != "__gone"], (gone | F.col("__hit").isNotNull()).alias("__gone"))

    levels, cut = delete_order(list(frames), references)
    if cut:
        raise ValueError(f"references in a cycle: {sorted({r[0] for r in cut})}")
    marks = {root: marked(frames[root], doomed.select(*root_keys), root_keys)}
    for parent in [s for level in reversed(levels) for s in level]:
        for child, link, above in references:
            if above != parent or parent not in marks or child.startswith("?"):
                continue
            keys = marks[parent].where("__gone").select(*[F.col(p).alias(c) for c, p in link.items()])
            marks[child] = marked(marks.get(child, frames[child]), keys, list(link))
    return marks


def delete_counts(marks: Mapping[str, DataFrame]) -> DataFrame:
    """(store, deleted, kept) of marked frames, one pass over each."""
    counts = None
    for store, rows in marks.items():
        gone = F.col("__gone").cast("long")
        part = rows.agg(F.coalesce(F.sum(gone), F.lit(0)).alias("deleted"), F.coalesce(F.sum(1 - gone), F.lit(0)).alias("kept"))
        part = part.select(F.lit(store).alias("store"), "deleted", "kept")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def clean_up(frames: Mapping[str, DataFrame], references: Sequence[Reference], keep: Sequence[str] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """Empty every store but those to keep; the stores, and (step, store, deleted) in order."""
    levels, _ = delete_order(list(frames), references)
    steps, left = None, dict(frames)
    for step, level in enumerate(levels):
        for store in level:
            if store in keep:
                continue
            left[store] = frames[store].where(F.lit(False))
            part = frames[store].agg(F.count(F.lit(1)).alias("deleted")).select(F.lit(step).alias("step"), F.lit(store).alias("store"), "deleted")
            steps = part if steps is None else steps.unionByName(part)
    return left, steps


def delete_cascade(
    frames: Mapping[str, DataFrame],
    root: str,
    doomed: DataFrame,
    root_keys: Sequence[str],
    references: Sequence[Reference],
) -> dict[str, DataFrame]:
    """Delete rows of ``root`` and everything below them.

    ``references`` lists ``(child, {child column: parent column}, parent)`` in any order;
    a reference whose child name starts with ``?`` sets its columns to NULL instead of
    deleting the row.
    """
    marks = delete_marks(frames, root, doomed, root_keys, references)
    left = {s: marks[s].where("NOT __gone").drop("__gone") if s in marks else frames[s] for s in frames}
    for child, link, parent in references:
        if not child.startswith("?") or parent not in marks:
            continue
        child = child[1:]
        parents = marks[parent].where("__gone").select(*[F.col(p).alias(c) for c, p in link.items()]).distinct()
        flagged = left[child].join(parents.withColumn("__gone", F.lit(True)), list(link), "left")
        left[child] = flagged.select(
            *[F.when(F.col("__gone"), F.lit(None)).otherwise(F.col(c)).alias(c) if c in link else F.col(c) for c in frames[child].columns]
        )
    return left
