"""Query-log statistics, history pages and value mappings.

Canonical frames: ``queries(query_id, question, status, created_at, ..)``,
``table_usage(query_id, table_id)``, ``column_usage(query_id, column_id,
usage_type)``, ``mappings(mapping_id, natural_value, code_value, column_fqn,
usage_count, verified)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions.text import fold, strip_ws
from catalith.plans.nesting import attach, nest
from catalith.plans.ranking import top_per_group

# Report sizes, weights and request limits.
TABLE_REPORT, COLUMN_REPORT, SAMPLE_QUESTIONS = 20, 30, 3
TABLE_WEIGHT = 2
OVERLAP_LIMIT, PAGE_SIZE = 5, 20
SEEK_FROM = 10_000
MAPPING_LIMIT, LOOKUP_LIMIT = 20, 10
GRAM = 3


def completed(queries: DataFrame) -> DataFrame:
    return queries.where(F.col("status") == "completed")


def table_usage(queries: DataFrame, usage: DataFrame, tables: DataFrame, limit: int | None = TABLE_REPORT) -> DataFrame:
    """Completed-query count per table with up to three of its newest questions.

    Counts are aggregated before the ranking; sample questions are looked up only
    for the tables of the report.
    """
    done = completed(queries).select("query_id", "question", "created_at")
    uses = usage.select("query_id", "table_id").distinct().join(done, "query_id")
    counts = uses.groupBy("table_id").agg(F.count(F.lit(1)).alias("usage_count"))
    named = counts.join(tables.select("table_id", "schema_name", F.col("name").alias("table_name")), "table_id")
    if limit is not None:
        named = named.orderBy(F.col("usage_count").desc(), F.col("table_id")).limit(limit)
    newest = top_per_group(
        uses.join(named.select("table_id"), "table_id", "left_semi"),
        ["table_id"],
        [F.col("created_at").desc(), F.col("query_id").asc()],
        SAMPLE_QUESTIONS,
    )
    samples = newest.groupBy("table_id").agg(F.array_sort(F.collect_set("question")).alias("sample_questions"))
    return named.join(samples, "table_id", "left")


def column_usage(queries: DataFrame, usage: DataFrame, columns: DataFrame, limit: int | None = COLUMN_REPORT) -> DataFrame:
    """Completed-query count per column and usage type."""
    done = completed(queries).select("query_id")
    counts = (
        usage.join(done, "query_id", "left_semi")
        .groupBy("column_id", "usage_type")
        .agg(F.count(F.lit(1)).alias("usage_count"))
    )
    if limit is not None:
        known = counts.join(columns.select("column_id"), "column_id", "left_semi")
        counts = known.orderBy(F.col("usage_count").desc(), F.col("column_id"), F.col("usage_type")).limit(limit)
    return counts.join(columns.select("column_id", F.col("name").alias("column_name")), "column_id")


def query_overlap(
    queries: DataFrame,
    table_use: DataFrame,
    column_use: DataFrame,
    wanted_tables: DataFrame,
    wanted_columns: DataFrame,
    limit: int | None = OVERLAP_LIMIT,
) -> DataFrame:
    """Completed queries by overlap: twice the matched tables plus the matched columns, newest on ties.

    ``wanted_tables(table_id)`` and ``wanted_columns(column_id)`` may be of any size.
    """
    tables = (
        table_use.join(wanted_tables.select("table_id").distinct(), "table_id", "left_semi")
        .groupBy("query_id")
        .agg(F.count_distinct("table_id").alias("tm"))
    )
    columns = (
        column_use.join(wanted_columns.select("column_id").distinct(), "column_id", "left_semi")
        .groupBy("query_id")
        .agg(F.count_distinct("column_id").alias("cm"))
    )
    matches = tables.join(columns, "query_id", "full_outer")
    score = F.coalesce("tm", F.lit(0)) * TABLE_WEIGHT + F.coalesce("cm", F.lit(0))
    rows = completed(queries).join(matches, "query_id").withColumn("score", score).drop("tm", "cm")
    if limit is None:
        return rows
    return rows.orderBy(F.col("score").desc(), F.col("created_at").desc(), F.col("query_id")).limit(limit)


def recent_queries(queries: DataFrame, limit: int = OVERLAP_LIMIT) -> DataFrame:
    """Newest completed queries with score 0."""
    newest = completed(queries).orderBy(F.col("created_at").desc(), F.col("query_id")).limit(limit)
    return newest.withColumn("score", F.lit(0))


def child_counts(parents: DataFrame, key: str, children: dict[str, DataFrame]) -> DataFrame:
    """Parents with one count column per child frame; every child is aggregated once, before its join."""
    out = parents
    for name, child in children.items():
        counted = child.groupBy(key).agg(F.count(F.lit(1)).alias(name))
        out = out.join(counted, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def history_page(
    queries: DataFrame,
    usage: DataFrame,
    tables: DataFrame,
    page: int = 1,
    page_size: int = PAGE_SIZE,
    status: str | None = None,
    seek_from: int = SEEK_FROM,
) -> DataFrame:
    """One page of the history, newest first, with the table names of every query.

    The page is cut first; usage rows meet only its queries.  A page that ends after row
    ``seek_from`` is found by ``page_rows``, an earlier one by one sort with a limit.
    """
    rows = queries if status is None else queries.where(F.col("status") == status)
    first = (page - 1) * page_size
    if first + page_size > seek_from:
        cut = page_rows(rows, first, page_size)
    else:
        cut = rows.orderBy(F.col("created_at").desc(), F.col("query_id")).offset(first).limit(page_size)
    used = usage.join(cut.select("query_id"), "query_id", "left_semi")
    names = used.join(tables.select("table_id", "name"), "table_id").select("query_id", "name")
    return attach(cut, {"tables": nest(names, ["query_id"], ["name"], "tables")}, ["query_id"])


def page_rows(rows: DataFrame, first: int, size: int, unit: str = "hour") -> DataFrame:
    """Rows ``first`` to ``first + size`` in the order newest first, then by id.

    Rows are counted by time range; only the ranges that hold the page are numbered, each
    by itself, from the count of all newer ranges on.  One row for each range is ordered
    as a whole.  Rows without a time come last, as one range.
    """
    ranged = rows.withColumn("__range", F.date_trunc(unit, "created_at"))
    newer = Window.orderBy(F.col("__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    placed = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(newer), F.lit(0)))
    holds = placed.where((F.col("__ahead") < first + size) & (F.col("__ahead") + F.col("__n") > first))
    near = ranged.join(holds.select(F.col("__range").alias("__own"), "__ahead"), F.col("__range").eqNullSafe(F.col("__own")))
    inside = Window.partitionBy("__range").orderBy(F.col("created_at").desc(), F.col("query_id"))
    place = F.row_number().over(inside) + F.col("__ahead")
    numbered = near.withColumn("__place", place)
    return numbered.where((F.col("__place") > first) & (F.col("__place") <= first + size)).select(*rows.columns)


def history_total(queries: DataFrame) -> DataFrame:
    """Row count per status and for all statuses together."""
    rolled = queries.rollup("status").agg(F.count(F.lit(1)).alias("total"), F.grouping("status").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "all").otherwise(F.col("status")).alias("status"), "total")


# ---------------------------------------------------------------- value mappings


def containing(values: DataFrame, value_col: str, terms: DataFrame, term_col: str) -> DataFrame:
    """Join of values and terms where the lowered value contains the lowered term.

    Every distinct lowered value is exploded into its distinct grams of length one, two and
    three; a term meets them through its rarest gram, an equi-join.  The literal
    containment test then decides, so the result is exact.  An exploded side is many times
    its file, so none of them may be picked for a broadcast by the size of the file.
    """
    text, word = F.lower(value_col), F.lower(term_col)

    def grams(c: Column, size: int) -> Column:
        n = F.length(c)
        starts = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substr(c, i, F.lit(size)))

    all_grams = F.array_distinct(F.concat(*[grams(F.col("__text"), n) for n in range(1, GRAM + 1)]))
    texts = values.where(F.col(value_col).isNotNull()).select(text.alias("__text")).distinct()
    left = texts.withColumn("__gram", F.explode(all_grams))
    asked = terms.where(F.length(term_col) > 0)
    own = F.col("__word")
    whole = F.when(F.length(own) < GRAM, F.array(own)).otherwise(grams(own, GRAM))
    counts = left.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    words = asked.select(word.alias("__word")).distinct().select("__word", F.explode(F.array_distinct(whole)).alias("__gram"))
    rarest = (
        words.hint("merge").join(counts, "__gram", "left")
        .groupBy("__word")
        .agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram").alias("g"))).alias("__best"))
        .select("__word", F.col("__best.g").alias("__gram"))
    )
    hits = left.hint("merge").join(rarest, "__gram").where(F.contains("__text", "__word")).select("__text", "__word")
    found = values.withColumn("__text", text).join(hits, "__text")
    return found.join(asked.withColumn("__word", word), "__word").drop("__text", "__word")


def _first_of_values(rows: DataFrame, limit: int) -> DataFrame:
    """The first mappings of every value; a list of ``limit`` mappings holds no others."""
    known = rows.where(F.col("natural_value").isNotNull())
    return top_per_group(known, ["natural_value"], [F.col("usage_count").desc(), F.col("mapping_id").asc()], limit)


def value_mapping(
    mappings: DataFrame,
    terms: DataFrame,
    columns: DataFrame | None = None,
    *,
    limit: int = MAPPING_LIMIT,
    verified_only: bool = False,
    fallback: bool = True,
    max_terms: int | None = None,
) -> DataFrame:
    """Mappings of each request's terms, by usage; ``terms(request_id, term)``.

    Exact matches first.  Only a request whose terms have no exact match at all
    falls back to substring matches.  A request gets at most ``limit`` mappings, so only
    the first ``limit`` of each value are joined with the requests.
    """
    rows = mappings.where(F.coalesce("verified", F.lit(False))) if verified_only else mappings
    asked = terms.select("request_id", strip_ws("term").alias("term")).where(F.length("term") > 0).distinct()
    if max_terms is not None:
        asked = top_per_group(asked, ["request_id"], [F.col("term")], max_terms)
    exact = _first_of_values(rows, limit).join(asked.withColumnRenamed("term", "natural_value"), "natural_value")
    found = exact.select("request_id", *mappings.columns, F.lit("exact").alias("match"))
    if fallback:
        rest = asked.join(exact.select("request_id").distinct(), "request_id", "left_anti")
        once = _first_of_values(rows.distinct(), limit)
        near = containing(once, "natural_value", rest, "term").select("request_id", *mappings.columns).distinct()
        found = found.unionByName(near.withColumn("match", F.lit("substring")))
    order = [F.col("usage_count").desc(), F.col("mapping_id").asc()]
    top = top_per_group(found, ["request_id"], order, limit)
    if columns is None:
        return top
    names = columns.select(fold("fqn").alias("__fqn"), F.col("name").alias("column_name"))
    return top.withColumn("__fqn", fold("column_fqn")).join(names, "__fqn", "left").drop("__fqn")


def find_value_mapping(mappings: DataFrame, words: DataFrame, limit: int = LOOKUP_LIMIT) -> DataFrame:
    """Substring lookup of every word of ``words(word)``, by usage."""
    rows = _first_of_values(mappings, limit)
    hits = containing(rows, "natural_value", words.select("word").distinct(), "word")
    return top_per_group(hits, ["word"], [F.col("usage_count").desc(), F.col("mapping_id").asc()], limit)


# ---------------------------------------------------------------- glossary and calendar


def terms_with_tags(
    terms: DataFrame,
    links: dict[str, DataFrame],
    search: str | None = None,
    per_glossary: int | None = None,
) -> DataFrame:
    """Terms with one sorted name array per link frame ``(term_id, name)``.

    A missing description is empty, a missing status ``Draft`` and missing synonyms an
    empty list, where the terms have these columns.
    """
    defaults = {"description": F.lit(""), "status": F.lit("Draft"), "synonyms": F.array().cast("array<string>")}
    terms = terms.withColumns({c: F.coalesce(c, d) for c, d in defaults.items() if c in terms.columns})
    rows = terms if not search else terms.where(F.contains(fold("name"), F.lit(search.lower())))
    if per_glossary is not None:
        rows = top_per_group(rows, ["glossary"], [F.col("name"), F.col("term_id")], per_glossary)
    return attach(rows, {name: nest(link, ["term_id"], ["name"], name) for name, link in links.items()}, ["term_id"])


def calendar_detail(calendars: DataFrame, days: dict[str, DataFrame], key: str = "calendar") -> DataFrame:
    """Calendars with one sorted day array per day frame ``(calendar, day, ..)``."""
    nested = {}
    for name, frame in days.items():
        nested[name] = nest(frame, [key], ["day", *[c for c in frame.columns if c not in (key, "day")]], name)
    return attach(calendars, nested, [key])

