"""Cosine search for batches of request vectors.

A request batch that fits the closure limit is multiplied against every Arrow
batch of the corpus inside the scan tasks: no shuffle of vectors, and only the
``k`` best ids per request leave a task.  A larger batch is cut, with the corpus,
into blocks of fixed size; every (request block, corpus block) cell is one
cogrouped task.  Both ways are exact and end in the same ranking.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from catalith.functions import vectors as V
from catalith.functions.text import cut_text, is_valid, or_default
from catalith.plans.sizing import MAX_CLOSURE_FLOATS

REQUEST_BLOCK = 2_048
CORPUS_BLOCK = 16_384

# Default result sizes and similarity floors.
DEFAULT_TABLES_K = 5
DEFAULT_COLUMNS_K = 10
DEFAULT_QUERIES_K = 3
CACHE_HIT_SIMILARITY = 0.85
SEMANTIC_FLOOR = 0.3
FUSION_FETCH, FUSION_KEEP, FUSION_FLOOR = 20, 5, 0.3
INTENT_WEIGHT, QUESTION_WEIGHT = 0.6, 0.4


def vector_topk(
    corpus: DataFrame,
    requests: DataFrame,
    k: int = DEFAULT_TABLES_K,
    *,
    id_col: str = "id",
    vector_col: str = "embedding",
    request_id: str = "qid",
    request_vector: str = "vector",
    floor: float | None = None,
    group_col: str | None = None,
    request_groups: str | None = None,
    max_closure_floats: int = MAX_CLOSURE_FLOATS,
) -> DataFrame:
    """``(request id, id, similarity, rank)``: the ``k`` nearest rows of every request.

    ``floor`` drops pairs below a similarity before the limit.  With ``group_col``
    and ``request_groups`` (an array column) a request only sees rows of its groups.
    Missing and zero vectors never match; ties go to the lower id.
    """
    has_groups = group_col is not None and request_groups is not None
    wanted = [request_id, request_vector] + ([request_groups] if has_groups else [])
    asked = requests.select(*wanted).where(F.col(request_vector).isNotNull())
    stored = corpus.select(id_col, vector_col, *([group_col] if has_groups else []))
    stored = stored.where(F.col(vector_col).isNotNull())
    schema, ddl = _hit_types(requests, request_id, corpus, id_col)

    block = _small_requests(asked, max_closure_floats)
    if block is not None:
        pairs = stored.mapInArrow(V.scan(block, k, floor, schema), ddl)
    else:
        pairs = _blocked(stored, asked, k, floor, schema, ddl)
    return _ranked(pairs, request_id, id_col, k)


def _hit_types(requests: DataFrame, request_id: str, corpus: DataFrame, id_col: str) -> tuple[pa.Schema, str]:
    types = [(request_id, requests.schema[request_id].dataType), (id_col, corpus.schema[id_col].dataType)]
    ddl = ", ".join(f"`{n}` {t.simpleString()}" for n, t in types) + ", sim double"
    return pa.schema([pa.field(n, to_arrow_type(t)) for n, t in types] + [pa.field("sim", pa.float64())]), ddl


def _ranked(pairs: DataFrame, request_id: str, id_col: str, k: int) -> DataFrame:
    window = Window.partitionBy(request_id).orderBy(F.col("sim").desc(), F.col(id_col).asc())
    ranked = pairs.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select(request_id, id_col, F.col("sim").alias("similarity"), "rank")


def _requests(table: pa.Table) -> V.Requests:
    groups = None
    if table.num_columns > 2:
        groups = [{str(v) for v in (g or [])} for g in table.column(2).to_pylist()]
    return V.Requests(table.column(0).to_pylist(), V.unit_rows(V.to_matrix(table.column(1))), groups)


def _small_requests(asked: DataFrame, max_floats: int) -> V.Requests | None:
    """The request block when it fits the closure limit; reads at most that many rows."""
    head = asked.limit(REQUEST_BLOCK + 1).toArrow()
    if head.num_rows > REQUEST_BLOCK:
        return None
    block = _requests(head)
    return block if block.unit.size <= max_floats else None


def _blocked(stored, asked, k, floor, schema, ddl) -> DataFrame:
    def kernel(block: V.Requests, rows: pa.Table):
        running = V.Running(block, k, floor)
        groups = rows.column(2).to_pylist() if rows.num_columns > 2 else None
        running.add(rows.column(0).to_pylist(), V.to_matrix(rows.column(1)), groups)
        return [running.batch(schema)]

    return _cells(stored, asked, kernel, schema, ddl)


def _cells(stored: DataFrame, asked: DataFrame, kernel, schema: pa.Schema, ddl: str) -> DataFrame:
    """Run ``kernel`` on fixed-size request and corpus blocks, one cogrouped cell per block pair."""
    request_blocks = max(1, -(-asked.count() // REQUEST_BLOCK))
    corpus_blocks = max(1, -(-stored.count() // CORPUS_BLOCK))

    def placed(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64(df.columns[0]), F.lit(own_n)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        return df.select(own_block.alias(own), copies.alias(other), *df.columns)

    left = placed(asked, "rb", request_blocks, "cb", corpus_blocks)
    right = placed(stored, "cb", corpus_blocks, "rb", request_blocks)
    return _cogrouped(left, right, ["rb", "cb"], kernel, schema, ddl)


def _cogrouped(left: DataFrame, right: DataFrame, keys: list[str], kernel, schema: pa.Schema, ddl: str) -> DataFrame:
    def cell(requests: pa.Table, rows: pa.Table) -> pa.Table:
        if not requests.num_rows or not rows.num_rows:
            return schema.empty_table()
        block = _requests(requests.drop_columns(keys))
        return pa.Table.from_batches(kernel(block, rows.drop_columns(keys)), schema)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, ddl)


def _probed_blocks(stored: DataFrame, asked: DataFrame, k: int, floor: float | None, schema: pa.Schema, ddl: str, request_block: int, corpus_block: int) -> DataFrame:
    """Pairs of ``stored(id, vector, cell)`` and ``asked(request, vector, cell)`` within each cell.

    Rows and requests of a cell are cut into blocks by hash, so a hot cell is many tasks.
    The numbers of blocks are one row for each cell, at most ``MAX_CENTRES``.
    """
    rows = stored.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / corpus_block).alias("__rows"))
    asks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / request_block).alias("__asks"))
    sizes = F.broadcast(rows.join(asks, "cell"))

    def placed(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        block = F.pmod(F.xxhash64(df.columns[0]), F.col(own_n)).alias(own)
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_n) - 1)).alias(other)
        return df.join(sizes, "cell").select("cell", block, copies, *df.columns[:2])

    def kernel(block: V.Requests, part: pa.Table):
        running = V.Running(block, k, floor)
        running.add(part.column(0).to_pylist(), V.to_matrix(part.column(1)), None)
        return [running.batch(schema)]

    left, right = placed(asked, "rb", "__asks", "cb", "__rows"), placed(stored, "cb", "__rows", "rb", "__asks")
    keys = ["cell", "rb", "cb"]
    order = lambda df: df.select(*keys, *[c for c in df.columns if c not in keys])
    return _cogrouped(order(left), order(right), keys, kernel, schema, ddl)


def vector_topk_filtered(corpus: DataFrame, requests: DataFrame, k: int, condition=None, **names) -> DataFrame:
    """Top-k over the rows that satisfy ``condition`` and are not marked invalid."""
    rows = corpus if condition is None else corpus.where(condition)
    if "is_valid" in rows.columns:
        rows = rows.where(is_valid("is_valid"))
    return vector_topk(rows, requests, k, **names)


def vector_topk_with_parent(
    children: DataFrame,
    parents: DataFrame,
    requests: DataFrame,
    k: int = DEFAULT_COLUMNS_K,
    *,
    parent_key: str = "table_id",
    parent_columns: Iterable[str] = (),
    valid_parents_only: bool = False,
    id_col: str = "id",
    **names,
) -> DataFrame:
    """Child hits with their parent.

    By default a hit without a parent stays (left join).  With
    ``valid_parents_only`` children of missing or invalid parents, and invalid
    children, are out before the ranking.
    """
    rows = children
    if valid_parents_only:
        if "is_valid" in rows.columns:
            rows = rows.where(is_valid("is_valid"))
        rows = rows.join(parents.where(is_valid("is_valid")).select(parent_key), parent_key, "left_semi")
    hits = vector_topk(rows, requests, k, id_col=id_col, **names)
    keyed = hits.join(children.select(id_col, parent_key), id_col)
    return keyed.join(parents.select(parent_key, *parent_columns), parent_key, "left")


def similar_cached(corpus, requests, k=DEFAULT_QUERIES_K, min_similarity=CACHE_HIT_SIMILARITY, **names) -> DataFrame:
    """Similar stored queries: the similarity floor applies before the limit."""
    return vector_topk(corpus, requests, k, floor=min_similarity, **names)


def semantic_table_search(
    tables: DataFrame, requests: DataFrame, k: int = 10, min_similarity: float = SEMANTIC_FLOOR, **names
) -> DataFrame:
    """Described tables by similarity: limit first, then the floor; four decimals, description cut to 200."""
    id_col = names.get("id_col", "id")
    described = tables.where(F.length("description") > 0)
    hits = vector_topk(described, requests, k, **names).where(F.col("similarity") >= min_similarity)
    shown = tables.select(
        id_col,
        "name",
        or_default("schema_name", "public").alias("schema_name"),
        cut_text("description", 200).alias("description"),
    )
    return hits.join(shown, id_col).withColumn("similarity", F.round("similarity", 4))


def vector_topk_per_group(
    corpus: DataFrame,
    requests: DataFrame,
    k: int,
    *,
    group_col: str,
    id_col: str = "id",
    vector_col: str = "embedding",
    request_id: str = "qid",
    request_vector: str = "vector",
    request_groups: str | None = None,
    max_closure_floats: int = MAX_CLOSURE_FLOATS,
) -> DataFrame:
    """The ``k`` best rows inside every group, for every request.

    With ``request_groups`` (an array column) a request sees its candidate groups
    alone, and only those are multiplied.  A task keeps ``k`` rows per (request,
    group) over all its batches.
    """
    rows = corpus.select(id_col, group_col, vector_col).where(F.col(vector_col).isNotNull())
    asked = requests.select(request_id, request_vector, *([] if request_groups is None else [request_groups]))
    asked = asked.where(F.col(request_vector).isNotNull())
    types = [
        (request_id, requests.schema[request_id].dataType),
        (group_col, corpus.schema[group_col].dataType),
        (id_col, corpus.schema[id_col].dataType),
    ]
    ddl = ", ".join(f"`{n}` {t.simpleString()}" for n, t in types) + ", sim double"
    schema = pa.schema([pa.field(n, to_arrow_type(t)) for n, t in types] + [pa.field("sim", pa.float64())])
    block = _small_requests(asked, max_closure_floats)
    if block is not None:
        scored = rows.mapInArrow(_group_scan(block, k, schema), ddl)
    else:

        def kernel(block: V.Requests, table: pa.Table):
            return list(_group_scan(block, k, schema)(table.to_batches()))

        scored = _cells(rows, asked, kernel, schema, ddl)
    order = [F.col("sim").desc(), F.col(id_col).asc()]
    window = Window.partitionBy(request_id, group_col).orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.withColumnRenamed("sim", "similarity")


def _group_scan(block: V.Requests, k: int, schema: pa.Schema):
    """``mapInArrow`` function over ``(id, group, vector)`` batches."""

    def run(batches):
        running = V.RunningGroups(block, k)
        for b in batches:
            if b.num_rows:
                running.add(b.column(0).to_pylist(), b.column(1).to_pylist(), V.to_matrix(b.column(2)))
        yield from running.batches(schema)

    return run


def vector_fusion(
    corpus: DataFrame,
    requests: DataFrame,
    *,
    id_col: str = "id",
    question_vector: str = "question_vector",
    intent_vector: str = "intent_vector",
    corpus_question: str = "embedding",
    corpus_intent: str = "intent_embedding",
    best_run: str = "best_run",
    request_id: str = "qid",
    fetch: int = FUSION_FETCH,
    keep: int = FUSION_KEEP,
    min_similarity: float = FUSION_FLOOR,
) -> DataFrame:
    """Question and intent hits joined by id; a request without an intent vector uses the question alone."""
    names = {"id_col": id_col, "request_id": request_id, "floor": min_similarity}
    by_question = vector_topk(
        corpus, requests, fetch, request_vector=question_vector, vector_col=corpus_question, **names
    ).select(request_id, id_col, F.col("similarity").alias("question_score"))
    by_intent = vector_topk(
        corpus, requests, fetch, request_vector=intent_vector, vector_col=corpus_intent, **names
    ).select(request_id, id_col, F.col("similarity").alias("intent_score"))
    both = by_question.join(by_intent, [request_id, id_col], "full_outer").select(
        request_id,
        id_col,
        F.coalesce("question_score", F.lit(0.0)).alias("question_score"),
        F.coalesce("intent_score", F.lit(0.0)).alias("intent_score"),
    )
    has_intent = requests.select(request_id, F.col(intent_vector).isNotNull().alias("has_intent"))
    blend = F.lit(INTENT_WEIGHT) * F.col("intent_score") + F.lit(QUESTION_WEIGHT) * F.col("question_score")
    scored = (
        both.join(has_intent, request_id)
        .withColumn("score", F.round(F.when(F.col("has_intent"), blend).otherwise(F.col("question_score")), V.DECIMALS))
        .join(corpus.select(id_col, best_run), id_col)
    )
    order = [F.col("score").desc(), F.coalesce(best_run, F.lit(0)).desc(), F.col(id_col).asc()]
    window = Window.partitionBy(request_id).orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= keep)
    return ranked.select(request_id, id_col, "question_score", "intent_score", "score", "rank")


def fit_cells(corpus: DataFrame, cells: int, *, vector_col: str = "embedding", seed: int = 17) -> DataFrame:
    """``(cell, centre)``: k-means centres of the unit vectors, for approximate search."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = F.col(vector_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    unit = corpus.where(F.col(vector_col).isNotNull()).select(F.transform(v, lambda x: x / norm).alias("u"), norm.alias("n"))
    features = unit.where(F.col("n") > 0).select(array_to_vector("u").alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(features)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return corpus.sparkSession.createDataFrame(rows, "cell int, centre array<double>")


MAX_CENTRES = 65_536


def _check_centres(centres: DataFrame) -> None:
    size = centres.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("centre")), F.lit(0)).alias("floats")).first()
    if size["n"] > MAX_CENTRES or size["floats"] > MAX_CLOSURE_FLOATS:
        raise ValueError(f"{size['n']} centres with {size['floats']} numbers are too many for one task")


def assign_cells(corpus: DataFrame, centres: DataFrame, *, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """``corpus`` with the nearest ``cell``; written partitioned by cell, probes prune files.

    The centres are the request side of a top-1 scan per row, so the assignment is
    one pass of matrix products in the scan tasks.  They travel in the task closure: at
    most ``MAX_CENTRES`` of them, with ``MAX_CLOSURE_FLOATS`` numbers in all.
    """
    _check_centres(centres)
    table = centres.orderBy("cell").toArrow()
    cells = table.column(0).to_pylist()
    unit = V.unit_rows(V.to_matrix(table.column(1)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in corpus.schema) + ", cell int"
    position = corpus.columns.index(vector_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                nearest = (V.unit_rows(V.to_matrix(b.column(position))) @ unit.T).argmax(axis=1)
                cell = pa.array([cells[i] for i in nearest], pa.int32())
                yield pa.RecordBatch.from_arrays([*b.columns, cell], names=[*b.schema.names, "cell"])

    return corpus.where(F.col(vector_col).isNotNull()).mapInArrow(run, ddl)


def vector_topk_approx(
    celled: DataFrame,
    centres: DataFrame,
    requests: DataFrame,
    k: int = DEFAULT_TABLES_K,
    probes: int = 4,
    *,
    id_col: str = "id",
    vector_col: str = "embedding",
    request_id: str = "qid",
    request_vector: str = "vector",
    floor: float | None = None,
    max_closure_floats: int = MAX_CLOSURE_FLOATS,
    request_block: int = REQUEST_BLOCK,
    corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """Approximate top-k: every request looks only into its ``probes`` nearest cells, exactly.

    A request is multiplied with the rows of the cells that it probes and no others, in
    any batch size: a batch that fits the closure limit in the scan tasks, a larger one in
    blocks of each cell.  The numbers of the probed cells, at most ``MAX_CENTRES``, come to
    the driver and are a filter on ``cell``, so the scan of rows stored by cell
    (``sources/cells.py``) skips the files of others.  A join would not: the ranked probes
    are a window, whose broadcast the pruning subquery of the scan cannot reuse.
    ``centres`` may be any vectors, k-means ones or given ones.
    """
    _check_centres(centres)
    near = vector_topk(
        centres, requests, probes, id_col="cell", vector_col="centre", request_id=request_id, request_vector=request_vector
    ).select(request_id, "cell")
    asked = requests.select(request_id, request_vector).where(F.col(request_vector).isNotNull())
    stored = celled.select(id_col, vector_col, "cell").where(F.col(vector_col).isNotNull())
    probed_cells = [r["cell"] for r in near.select("cell").distinct().collect()]
    stored = stored.where(F.col("cell").isin(probed_cells))
    schema, ddl = _hit_types(requests, request_id, celled, id_col)
    probed = near.groupBy(request_id).agg(F.collect_set(F.col("cell").cast("string")).alias("cells"))
    block = _small_requests(asked.join(probed, request_id), max_closure_floats)
    if block is not None:
        pairs = stored.mapInArrow(V.scan(block, k, floor, schema), ddl)
    else:
        by_cell = asked.join(near, request_id).select(request_id, request_vector, "cell")
        pairs = _probed_blocks(stored, by_cell, k, floor, schema, ddl, request_block, corpus_block)
    return _ranked(pairs, request_id, id_col, k)


def recall(exact: DataFrame, approximate: DataFrame, *, request_id: str = "qid", id_col: str = "id") -> DataFrame:
    """Share of the exact hits that the approximate search found, per request."""
    found = approximate.select(request_id, id_col).withColumn("hit", F.lit(1))
    joined = exact.select(request_id, id_col).join(found, [request_id, id_col], "left")
    return joined.groupBy(request_id).agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 4).alias("recall"))


def embedding_counts(stores: dict[str, DataFrame], vector_col: str = "embedding") -> DataFrame:
    """Rows per embedding store."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("store"), "row_count")
        for name, df in stores.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


