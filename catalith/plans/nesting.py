"""Nested child arrays of bounded size, in one shape for every size.

A parent's children are sorted by the item fields and cut into consecutive ranges of at
most ``max_items``: the rows ``part`` 0, 1, .. of the parent.  Nothing is dropped, and
the parts put end to end are the whole sorted list.  Most parents have part 0 alone.

The children are stored first, so that they are derived once however often they are read.
Where no parent has more than ``max_items`` of them, one aggregation follows.

Only parents with more children than that are numbered, and none of them meets in one
task: their distinct items, with how often each occurs, are dealt into slices of the item
order, numbered within a slice, and shifted by the sizes of the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.plans.lineage_cut import stored

MAX_ITEMS = 20_000

# Children of a parent that may meet in one task as one array.
MAX_FEW = 100_000


SLICES = 128


def nest(
    child: DataFrame,
    keys: Sequence[str],
    item: Sequence[str | Column],
    name: str,
    max_items: int = MAX_ITEMS,
    distinct: bool = False,
    few: bool = False,
) -> DataFrame:
    """``(keys, part, name)`` with ``name`` an array of structs sorted by the item fields.

    ``few`` says that no parent has more than ``MAX_FEW`` children (``sizing.parent_sizes``):
    they are neither stored nor counted then, and an array longer than a part is cut.
    """
    if few:
        rows = child.select(*keys, F.struct(*item).alias("__item"))
        nested = (rows.distinct() if distinct else rows).groupBy(*keys).agg(F.array_sort(F.collect_list("__item")).alias("__items"))
        ends = F.sequence(F.lit(0), ((F.size("__items") - 1) / max_items).cast("int"))
        parts = F.transform(ends, lambda i: F.slice("__items", i * max_items + 1, max_items))
        whole = F.when(F.size("__items") <= max_items, F.array("__items")).otherwise(parts)
        return nested.select(*keys, F.posexplode(whole).alias("part", name))
    items = stored(child.select(*keys, F.struct(*item).alias("__item")), "children")
    if items.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_items).isEmpty():
        rows = items.distinct() if distinct else items
        nested = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("__item")).alias(name))
        return nested.select(*keys, F.lit(0).alias("part"), name)
    times = F.lit(1).cast("long") if distinct else F.count(F.lit(1))
    once = items.groupBy(*keys, "__item").agg(F.max(times) if distinct else times).toDF(*keys, "__item", "__times")
    sizes = once.groupBy(*keys).agg(F.sum("__times").alias("__n"), F.count(F.lit(1)).alias("__kinds"))
    large = sizes.where(F.col("__n") > max_items).drop("__n")
    few = _beside(once, large, keys, "left_anti").withColumn("part", F.lit(0))
    placed = few.unionByName(_in_parts(once, large, keys, max_items))
    copies = F.flatten(F.collect_list(F.array_repeat("__item", F.col("__times").cast("int"))))
    return placed.groupBy(*keys, "part").agg(F.array_sort(copies).alias(name))


def _beside(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys, where two missing keys are equal; the columns of ``other`` come second."""
    named = other.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in other.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(named, same, how).drop(*[f"__{k}" for k in keys])


def _in_parts(once: DataFrame, large: DataFrame, keys: Sequence[str], max_items: int) -> DataFrame:
    """``(keys, __item, __times, part)`` of the children of large parents.

    Items whose hash is divisible by a ``SLICES``-th of the parent's distinct items bound
    the slices, so the bounds are the same whenever they are computed.
    """
    own = _beside(once, large, keys, "inner")
    step = F.greatest(F.floor(F.col("__kinds") / SLICES), F.lit(1))
    picked = own.where(F.pmod(F.xxhash64("__item"), step) == 0)
    bounds = picked.groupBy(*keys).agg(F.array_sort(F.collect_list("__item")).alias("__bounds"))
    before = F.size(F.filter("__bounds", lambda bound: bound <= F.col("__item")))
    dealt = _beside(own, bounds, keys, "left").select(*keys, "__item", "__times", F.when(F.col("__bounds").isNull(), 0).otherwise(before).alias("__slice"))
    inside = Window.partitionBy(*keys, "__slice").orderBy("__item").rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.withColumn("__at", F.coalesce(F.sum("__times").over(inside), F.lit(0)))
    totals = dealt.groupBy(*keys, "__slice").agg(F.sum("__times").alias("__total"))
    ahead = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*keys, "__slice", F.coalesce(F.sum("__total").over(ahead), F.lit(0)).alias("__ahead"))
    start = F.col("__at") + F.col("__ahead")
    placed = _beside(numbered, shift, [*keys, "__slice"], "left").select(*keys, "__item", start.alias("__first"), (start + F.col("__times")).alias("__end"))
    part = F.explode(F.sequence(F.floor(F.col("__first") / max_items), F.floor((F.col("__end") - 1) / max_items)))
    parted = placed.withColumn("part", part)
    copies = F.least("__end", (F.col("part") + 1) * max_items) - F.greatest("__first", F.col("part") * max_items)
    return parted.select(*keys, "__item", copies.alias("__times"), F.col("part").cast("int").alias("part"))


def attach(parent: DataFrame, nested: dict[str, DataFrame], keys: Sequence[str], how: str = "left") -> DataFrame:
    """Parents with the ``nest`` output of every name, matched by part.

    A parent has as many rows as its longest list has parts; a list that has ended, or
    that the parent lacks, is an empty array.  With ``how="inner"`` parents without any
    list are left out.
    """
    rows = None
    for frame in nested.values():
        rows = frame if rows is None else rows.join(frame, [*keys, "part"], "full_outer")
    out = parent.join(rows, list(keys), how).withColumn("part", F.coalesce("part", F.lit(0)))
    empty = {n: F.array().cast(f.schema[n].dataType) for n, f in nested.items()}
    return out.withColumns({n: F.coalesce(n, e) for n, e in empty.items()})
