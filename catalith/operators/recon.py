"""Reconciliation of a source graph with its migrated target.

Every check returns ``(category, test, source, target, status)`` with text values.

``differences`` and ``summary`` do not join the two sides.  Ids are dealt into ranges of
their hash, every range gets an order-free digest on each side, and only rows of ranges
whose digests differ are compared one by one.  The digest of a range is its number of
rows, the XOR of a 64-bit hash and the sum of 32 bits of another one, folded in the map
tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.values import primary_label
from catalith.operators.graph import chain_counts

# The ontology chains.
ONTOLOGY_CHAINS = (
    ("SUBCLASS_OF",),
    ("SUBCLASS_OF", "SUBCLASS_OF"),
    ("PART_OF",),
    ("INSTANCE_OF",),
    ("FLOWS_INTO",),
    ("NEXT_PROCESS",),
)
RANGES = 4_096
MAX_RANGES = 1_048_576  # differing ranges are broadcast: one long each


def _result(df: DataFrame, category: Column, test: Column, ok: Column) -> DataFrame:
    return df.select(
        category.alias("category"),
        test.alias("test"),
        F.col("source").cast("string").alias("source"),
        F.col("target").cast("string").alias("target"),
        F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
    )


def totals(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the named frames on both sides."""
    counts = None
    for side, frames in (("source", source), ("target", target)):
        for name in source:
            total = frames[name].agg(F.count(F.lit(1)).alias("n"))
            row = total.select(F.lit(name).alias("k"), F.lit(side).alias("side"), "n")
            counts = row if counts is None else counts.unionByName(row)
    both = counts.groupBy("k").agg(
        *[F.max(F.when(F.col("side") == side, F.col("n"))).alias(side) for side in ("source", "target")]
    )
    return _result(both, F.lit("counts"), F.col("k"), F.col("source") == F.col("target"))


def _top(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.orderBy(F.col("source").desc(), F.col("combo")).limit(n)


def labels(
    source: DataFrame,
    target: DataFrame,
    combinations: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Label groups of the source against the target's single label.

    ``source(labels)``, ``target(label)``.  A group of one label must match
    exactly; a group of several is counted under its last label, where other
    groups may add to it, so the target may be larger.  A target label that no source
    group leads to is a row of its own with source 0.  ``combinations`` and ``groups``
    cut the report to the most frequent ones; by default it is whole.
    """
    combos = source.groupBy(F.array_join("labels", "+").alias("combo"), primary_label("labels").alias("label"), F.size("labels").alias("n")).agg(
        F.count(F.lit(1)).alias("source")
    )
    combos = _top(combos, combinations)
    counted = target.groupBy("label").agg(F.count(F.lit(1)).alias("target"))

    def part(rows: DataFrame, category: str, ok: Column) -> DataFrame:
        joined = rows.join(counted, "label", "left").withColumn("target", F.coalesce("target", F.lit(0)))
        return _result(joined, F.lit(category), F.concat(F.lit("label:"), F.col("combo")), ok)

    single = part(_top(combos.where(F.col("n") == 1), groups), "labels_single", F.col("source") == F.col("target"))
    multi = part(_top(combos.where(F.col("n") > 1), groups), "labels_multi", F.col("target") >= F.col("source"))
    known = source.select(primary_label("labels").alias("label")).distinct()
    only = counted.join(known, "label", "left_anti").select(F.lit(0).alias("source"), F.col("label").alias("combo"), "target")
    extra = _result(only, F.lit("labels_target_only"), F.concat(F.lit("label:"), F.col("combo")), F.lit(False))
    return single.unionByName(multi).unionByName(extra)


def types(source: DataFrame, target: DataFrame, top: int | None = None) -> DataFrame:
    """Edge counts per type of either side; ``top`` cuts the report to the most frequent source types."""
    left = source.groupBy(F.col("type").alias("combo")).agg(F.count(F.lit(1)).alias("source"))
    right = target.groupBy(F.col("type").alias("combo")).agg(F.count(F.lit(1)).alias("target"))
    joined = left.join(right, "combo", "full_outer") if top is None else _top(left, top).join(right, "combo", "left")
    rows = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("source", "target")})
    return _result(rows, F.lit("rel_types"), F.concat(F.lit("rel:"), F.col("combo")), F.col("source") == F.col("target"))


def chains(source: DataFrame, target: DataFrame, patterns: Sequence[Sequence[str]] = ONTOLOGY_CHAINS) -> DataFrame:
    """Path counts along type chains."""
    left = chain_counts(source, patterns).withColumnRenamed("paths", "source")
    right = chain_counts(target, patterns).withColumnRenamed("paths", "target")
    return _result(left.join(right, "chain"), F.lit("paths"), F.col("chain"), F.col("source") == F.col("target"))


def properties(
    source: DataFrame, target: DataFrame, columns: Sequence[str] = ("name",), sample: int | None = None
) -> DataFrame:
    """Property values matched by id: on the first ``sample`` ids, or on all rows with ``None``."""
    rows = source.where(F.col("name").isNotNull()).select("id", *columns)
    if sample is not None:
        rows = rows.orderBy("id").limit(sample)
    left = rows.select("id", F.to_json(F.struct(*columns)).alias("source"))
    right = target.select("id", F.to_json(F.struct(*columns)).alias("target"))
    joined = left.join(right, "id", "left")
    shown = joined.withColumn("target", F.coalesce("target", F.lit("NOT FOUND")))
    return _result(shown, F.lit("properties"), F.concat(F.lit("node:"), F.col("id")), F.col("source") == F.col("target"))


def result_summary(results: DataFrame) -> DataFrame:
    """Passed, failed and total checks."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def tagged_nodes(source: DataFrame, target: DataFrame, columns: Sequence[str] = ("name",)) -> DataFrame:
    """Both sides as one frame ``(migrated, id, labels, label, ..columns)``."""
    left = source.select(F.lit(False).alias("migrated"), "id", "labels", F.lit(None).cast("string").alias("label"), *columns)
    return left.unionByName(target.select(F.lit(True).alias("migrated"), "id", "label", *columns), allowMissingColumns=True)


def _with_values(nodes: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    if not 0 < ranges <= MAX_RANGES:
        raise ValueError(f"ranges must be 1 to {MAX_RANGES}")
    rows = nodes.withColumns(
        {
            "__range": F.pmod(F.xxhash64("id"), F.lit(ranges)),
            "__value": F.to_json(F.struct(*columns)),
            "__named": F.col("name").isNotNull(),
        }
    )
    return rows.withColumns(
        {
            "__xor": F.xxhash64("id", "__value"),
            "__sum": F.xxhash64(F.lit("sum"), "__value", "id").bitwiseAND(F.lit(0xFFFFFFFF)),
        }
    )


def _sides() -> dict[str, Column]:
    return {"source": ~F.col("migrated"), "target": F.col("migrated")}


def _digests() -> list[Column]:
    out = []
    for name, side in _sides().items():
        here = side & F.col("__named")
        out.append(F.count_if(here).alias(f"{name}_n"))
        out.append(F.coalesce(F.bit_xor(F.when(here, F.col("__xor"))), F.lit(0)).alias(f"{name}_xor"))
        out.append(F.coalesce(F.sum(F.when(here, F.col("__sum"))), F.lit(0)).alias(f"{name}_sum"))
    return out


def _folded() -> list[Column]:
    """Digests of parts of a range, put together."""
    out = []
    for name in _sides():
        out += [F.sum(f"{name}_n").alias(f"{name}_n"), F.bit_xor(f"{name}_xor").alias(f"{name}_xor"), F.sum(f"{name}_sum").alias(f"{name}_sum")]
    return out


def _equal() -> Column:
    parts = [F.col(f"source_{p}") == F.col(f"target_{p}") for p in ("n", "xor", "sum")]
    return parts[0] & parts[1] & parts[2]


def _by_id(rows: DataFrame, differing: DataFrame) -> DataFrame:
    """``(id, source, target)`` of the source ids in the differing ranges, which are at most ``MAX_RANGES`` longs."""
    inside = rows.join(F.broadcast(differing.select("__range")), "__range", "left_semi")
    both = inside.groupBy("id").agg(
        F.max(F.when(~F.col("migrated") & F.col("__named"), F.col("__value"))).alias("source"),
        F.max(F.when(F.col("migrated"), F.col("__value"))).alias("target"),
    )
    return both.where(F.col("source").isNotNull())


def differences(nodes: DataFrame, columns: Sequence[str] = ("name",), ranges: int = RANGES) -> DataFrame:
    """The failing rows of ``properties`` over all rows, from ``tagged_nodes``.

    An id is a key of each side; a repeated one counts once, with its largest value.
    Rows without a name are not asked for, as there.
    """
    rows = _with_values(nodes, columns, ranges)
    differing = rows.groupBy("__range").agg(*_digests()).where(~_equal())
    shown = _by_id(rows, differing).withColumn("target", F.coalesce("target", F.lit("NOT FOUND")))
    found = _result(shown, F.lit("properties"), F.concat(F.lit("node:"), F.col("id")), F.col("source") == F.col("target"))
    return found.where(F.col("status") == "FAIL")


def summary(nodes: DataFrame, rels: DataFrame, columns: Sequence[str] = ("name",), ranges: int = RANGES) -> DataFrame:
    """``result_summary`` of ``totals``, ``types``, ``labels`` and ``properties``, whole, without building their rows.

    ``nodes`` are ``tagged_nodes`` and ``rels(migrated, type)``.  One pass counts nodes by
    (label group, range) with digests, which are then put together by label group and by
    range; a second one reads the ranges that differ.  Ids are keys, and a null type is a
    type like others.
    """
    label = F.when(F.col("migrated"), F.col("label")).otherwise(primary_label("labels"))
    rows = _with_values(nodes, columns, ranges).withColumns(
        {
            "label": label,
            "__combo": F.when(~F.col("migrated"), F.array_join("labels", "+")),
            "__size": F.when(~F.col("migrated"), F.size("labels")),
        }
    )
    counted = rows.groupBy("label", "__combo", "__size", "__range").agg(
        *[F.count_if(side).alias(name) for name, side in _sides().items()], *_digests()
    )
    none = F.lit(None)
    as_label = F.struct(F.lit(True).alias("by_label"), F.col("label"), F.col("__combo"), F.col("__size"), none.cast("bigint").alias("__range"))
    as_range = F.struct(
        F.lit(False).alias("by_label"), none.cast("string").alias("label"), none.cast("string").alias("__combo"), none.cast("int").alias("__size"), F.col("__range")
    )
    measures = [c for c in counted.columns if c not in ("label", "__combo", "__size", "__range")]
    grouped = (
        counted.select(F.explode(F.array(as_label, as_range)).alias("k"), *measures)
        .groupBy("k")
        .agg(F.sum("source").alias("source"), F.sum("target").alias("target"), *_folded())
        .select("k.*", *measures)
        .groupBy("by_label", "label", "__range")
        .agg(
            F.sum("source").alias("source"),
            F.sum("target").alias("target"),
            *_folded(),
            F.collect_list(F.when(F.col("__size") > 0, F.struct("__size", "source"))).alias("combos"),
        )
    )

    def holds(c: Column) -> Column:
        return ((c["__size"] == 1) & (c["source"] == F.col("target"))) | ((c["__size"] > 1) & (c["source"] <= F.col("target")))

    by_label = F.col("by_label")
    scored = grouped.withColumns(
        {
            "total": F.when(by_label, F.size("combos") + F.when(F.col("source") == 0, 1).otherwise(0)).when(_equal(), F.col("source_n")).otherwise(0),
            "passed": F.when(by_label, F.size(F.filter("combos", holds))).when(_equal(), F.col("source_n")).otherwise(0),
        }
    )
    node_rows = scored.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("passed", "total")],
        *[F.coalesce(F.sum(F.when(by_label, F.col(c))), F.lit(0)).alias(c) for c in ("source", "target")],
    )
    types = rels.groupBy("type").agg(*[F.count_if(side).alias(name) for name, side in _sides().items()])
    rel_rows = types.agg(
        F.count_if(F.col("source") == F.col("target")).alias("passed"),
        F.count(F.lit(1)).alias("total"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("source", "target")],
    )
    # each of the two totals is a check of its own
    sized = node_rows.unionByName(rel_rows).select(
        (F.col("passed") + F.when(F.col("source") == F.col("target"), 1).otherwise(0)).alias("passed"), (F.col("total") + 1).alias("total")
    )
    single = _by_id(rows, grouped.where(~by_label & ~_equal()))
    value_rows = single.agg(F.count_if(F.col("source") == F.col("target")).alias("passed"), F.count(F.lit(1)).alias("total"))
    out = sized.unionByName(value_rows).agg(F.sum("passed").alias("passed"), F.sum("total").alias("total"))
    return out.select("passed", (F.col("total") - F.col("passed")).alias("failed"), "total")
