"""Conditional, JSON, map and type-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions.text import blank, col

# Fixed values.
SECRET_KEYS = (
    "password",
    "passwd",
    "pwd",
    "secret",
    "token",
    "api_key",
    "apikey",
    "user",
    "username",
    "userid",
)
VECTOR_KEYS = ("embedding", "vector")
VECTOR_LENGTH = 128
AGGREGATE_NAMES = ("AVG", "SUM", "COUNT", "MAX", "MIN")


def status_rank(c: str | Column) -> Column:
    s = F.lower(F.trim(blank(c)))
    return F.when(s == "completed", 0).when(s == "error", 2).otherwise(1)


def usage_type(purpose: str | Column) -> Column:
    """Usage class of a free-text purpose, first match wins."""
    p = F.upper(F.coalesce(F.nullif(col(purpose), F.lit("")), F.lit("SELECT")))
    aggregate = F.lit(False)
    for word in AGGREGATE_NAMES:
        aggregate = aggregate | F.contains(p, F.lit(word))
    return (
        F.when(F.contains(p, F.lit("FILTER")) | F.contains(p, F.lit("WHERE")), "FILTERS")
        .when(F.contains(p, F.lit("GROUP")), "GROUPS_BY")
        .when(aggregate, "AGGREGATES")
        .when(F.contains(p, F.lit("JOIN")), "JOINS_ON")
        .otherwise("SELECTS")
    )


def last_steps(steps: str | Column) -> Column:
    """JSON of the last ten steps with three fields each, reasoning cut to 400; blank when none."""
    s = col(steps)
    tail = F.slice(s, F.greatest(F.size(s) - 9, F.lit(1)), F.lit(10))
    small = F.transform(
        tail,
        lambda x: F.struct(
            x["iteration"].alias("iteration"),
            x["tool_name"].alias("tool_name"),
            F.substring(blank(x["reasoning"]), 1, 400).alias("reasoning"),
        ),
    )
    return F.when(F.coalesce(F.size(s), F.lit(0)) > 0, F.to_json(small, {"ignoreNullFields": "false"})).otherwise("")


def type_text(data_type, udt, char_len, precision, scale) -> Column:
    """Readable type of a harvested column, e.g. ``varchar(20)`` or ``numeric(10,2)``."""
    base, u = blank(data_type), blank(udt)
    n, p, s = col(char_len), col(precision), col(scale)

    def sized(word: str, *args: Column) -> Column:
        inner = F.concat_ws(",", *[a.cast("string") for a in args])
        return F.concat(F.lit(word + "("), inner, F.lit(")"))

    return (
        F.when((base == "character varying") & (n > 0), sized("varchar", n))
        .when((base == "character") & (n > 0), sized("char", n))
        .when((base == "numeric") & p.isNotNull() & s.isNotNull(), sized("numeric", p, s))
        .when((base == "numeric") & p.isNotNull(), sized("numeric", p))
        .when((u != "") & (u != base) & (base != ""), F.concat(base, F.lit("("), u, F.lit(")")))
        .when((u != "") & (base == ""), u)
        .otherwise(base)
    )


def safe_identifier(c: str | Column) -> Column:
    """Letters, digits and underscores only, never with a leading digit."""
    clean = F.regexp_replace(col(c), "[^a-zA-Z0-9_]", "_")
    return F.when(clean.rlike("^[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)


def primary_label(labels: str | Column) -> Column:
    arr = col(labels)
    some = F.coalesce(F.size(arr), F.lit(0)) > 0
    return F.when(some, safe_identifier(F.try_element_at(arr, F.lit(-1)))).otherwise("UnknownNode")


def untagged(c: str | Column) -> Column:
    """Text of a tagged graph value without its vertex, edge, path or numeric tag."""
    return F.regexp_replace(F.trim(col(c)), "::(vertex|edge|path|numeric)$", "")


def graph_value(c: str | Column) -> Column:
    """Tagged graph value as VARIANT: JSON when it parses, else the bare text."""
    text = untagged(c)
    bare = F.regexp_replace(text, '^"+|"+$', "").cast("variant")
    return F.coalesce(F.try_parse_json(text), bare)


def without_secrets(source: str | Column) -> Column:
    return F.map_filter(col(source), lambda k, _v: ~F.lower(k).isin(*SECRET_KEYS))


def secret_keys(source: str | Column) -> Column:
    return F.array_sort(F.filter(F.map_keys(col(source)), lambda k: F.lower(k).isin(*SECRET_KEYS)))


def without_vectors(props: str | Column) -> Column:
    """Drop vector-like properties: those with a vector's name, and lists of 128 values or more.

    ``props`` is a map of JSON texts.
    """

    def keep(k: Column, v: Column) -> Column:
        length = F.coalesce(F.json_array_length(v), F.lit(0))
        return ~F.lower(k).isin(*VECTOR_KEYS) & (length < VECTOR_LENGTH)

    return F.map_filter(col(props), keep)


def typed_without_vectors(props: str | Column) -> Column:
    """``without_vectors`` for a VARIANT object; null stays null."""
    entries = col(props).cast("map<string,variant>")
    length = lambda v: F.coalesce(F.json_array_length(F.to_json(v)), F.lit(0))
    kept = F.map_filter(entries, lambda k, v: ~F.lower(k).isin(*VECTOR_KEYS) & (length(v) < VECTOR_LENGTH))
    return F.to_variant_object(kept)


def safe_properties(props: str | Column) -> Column:
    """Property map with sanitised keys and without NULL values; the last of equal keys wins."""
    named = F.transform(
        F.filter(F.map_entries(col(props)), lambda e: e["value"].isNotNull()),
        lambda e: F.struct(safe_identifier(e["key"]).alias("key"), e["value"].alias("value")),
    )
    latest = F.aggregate(
        named,
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _v: k != e["key"]), F.create_map(e["key"], e["value"])),
    )
    return latest


def merge_maps(current: str | Column, incoming: str | Column) -> Column:
    """Shallow merge of two maps; the incoming side wins on shared keys."""
    cur, inc = col(current), col(incoming)
    kept = F.map_filter(cur, lambda k, _v: ~F.map_contains_key(inc, k))
    return F.when(cur.isNull(), inc).when(inc.isNull(), cur).otherwise(F.map_concat(kept, inc))


def yes_no(c: str | Column) -> Column:
    """NULL and blank count as YES."""
    return F.upper(F.coalesce(F.nullif(col(c), F.lit("")), F.lit("YES"))) == "YES"


def json_or_empty(c: str | Column) -> Column:
    """Parsed JSON list, or an empty list when the text is missing or malformed."""
    return F.coalesce(F.try_parse_json(col(c)), F.parse_json(F.lit("[]")))


def property_summary(properties: str | Column) -> Column:
    """``name -> {type, description, required}`` of a property definition array."""
    entries = F.transform(
        F.filter(col(properties), lambda p: p["name"].isNotNull()),
        lambda p: F.struct(
            p["name"].alias("key"),
            F.struct(
                F.coalesce(p["type"], F.lit("string")).alias("type"),
                blank(p["description"]).alias("description"),
                F.coalesce(p["required"], F.lit(False)).alias("required"),
            ).alias("value"),
        ),
    )
    return F.map_from_entries(entries)


def epoch_millis(c: str | Column, dtype: str = "timestamp") -> Column:
    """Milliseconds since 1970, rounded down; a zone-free timestamp is read as UTC."""
    if dtype == "timestamp_ntz":
        return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(c)) / 1000)
    return F.unix_millis(col(c))


def iso_date(c: str | Column) -> Column:
    return F.try_to_date(col(c), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(col(c), "yyyy-MM-dd")
