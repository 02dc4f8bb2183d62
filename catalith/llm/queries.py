"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import alignment, audit, chat, kernel, langid, lexicon, metricjoin, neardup, packing, quality, suffixes, tokenfile, toxicity, vptree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(kernel.prepared(spark), folder)

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


@query("op10_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; learned without the third of four folds."""
    docs = table(spark, folder, "documents")
    out = kernel.held_out(F.col("doc_id"), 4, 2)
    profiles = langid.learn(docs.where(~out))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "lead")


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; labels of one of five folds are not learned."""
    docs = table(spark, folder, "documents")
    model = quality.learn(docs, table(spark, folder, "labels"))
    found = quality.score(docs, model)
    return found.select("doc_id", kernel.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op8_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; labels of one of five folds are not learned."""
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", kernel.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_packing")
def best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in the training sequences."""
    parts = kernel.stored(packing.cut_pieces(table(spark, folder, "documents"), byte_tokenizer()), "pieces")
    return packing.pack(parts)


@query("op6_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and checksums of all documents, decoded from the written files."""
    return tokenfile.read(tokenfile.write(table(spark, folder, "documents"), byte_tokenizer()))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_lexicon_bpe")
def lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and checksums of the ids and the decoded text of every document."""
    docs = table(spark, folder, "documents")
    return lexicon.digests(docs, word_tokenizer(), lexicon.build(docs, word_tokenizer()))


@query("op3_minhash_near_dedup")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document; the least id of a class is kept."""
    return neardup.classes(table(spark, folder, "documents"))


@query("op2_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    found = suffixes.deduplicate(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_vantage_point_search")
def vantage_point_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth, by cosine."""
    vectors = table(spark, folder, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0))


@query("op9_metric_join")
def metric_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector at cosine 0.9 or more."""
    return metricjoin.links(table(spark, folder, "embeddings"))


_ORDERS = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
firsts AS (SELECT t, min(doc_id) AS first_id FROM docs GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT w.part, [len(w.ws) < 100, 100 * len(list_distinct(w.ws)) < 80 * len(w.ws),
    100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 10 * length(w.t),
    regexp_matches(w.t, '[#$%&*|]'), coalesce(w.doc_id > f.first_id, false)] AS f,
    coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic
  FROM worded w JOIN firsts f ON f.t = w.t LEFT JOIN marks m ON m.doc_id = w.doc_id),
folded AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f),
letters AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s AS step, ascii(substr(o, s, 1)) - 64 AS filter FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
fates AS (
  SELECT g.part, s.o, g.f, g.n, g.good, g.toxic, min(CASE WHEN g.f[s.filter] THEN s.step ELSE 6 END) AS gone
  FROM folded g, steps s GROUP BY g.part, s.o, g.f, g.n, g.good, g.toxic),
counted AS (
  SELECT t.part, s.o AS filter_order, s.step, s.filter,
    sum(CASE WHEN t.gone > s.step THEN t.n ELSE 0 END) AS kept,
    sum(CASE WHEN t.gone = s.step THEN t.n ELSE 0 END) AS removed,
    sum(CASE WHEN t.gone < s.step AND t.f[s.filter] THEN t.n ELSE 0 END) AS redundant,
    sum(CASE WHEN t.f[s.filter] AND len(list_filter(t.f, lambda x: x)) = 1 THEN t.n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN t.gone = s.step THEN t.good ELSE 0 END) AS good_lost,
    sum(CASE WHEN t.gone = s.step THEN t.toxic ELSE 0 END) AS toxic_lost
  FROM fates t JOIN steps s ON s.o = t.o GROUP BY t.part, s.o, s.step, s.filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""


@query("op12_filter_audit", _ORDERS)
def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What every filter removes, repeats and loses in all 120 orders, for every language."""
    masked = audit.masks(table(spark, folder, "documents"))
    return audit.audit(audit.weighted(masked, table(spark, folder, "labels")))


# A conversation in a second layout whose texts are control strings.
PROBE = '{"messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"}, {"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}'
_TURNS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT conv_id, turn, role, text, length(regexp_replace(text, E, '\1\2\\\3', 'g')) AS n,
    length(regexp_replace(role, E, '\1\2\\\3', 'g')) AS r FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 ELSE 17 + r END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
""".replace("E,", r"'([<\[])(\\*)(s>|/s>|INST\]|/INST\]|ROLE\]|/ROLE\])',")


@query("op13_chat_format", _TURNS)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted and masked form."""
    rows = chat.canonical(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    probe = chat.turns_of(chat.records(spark.createDataFrame([(-7, PROBE)], "conv_id long, record string")))
    return chat.read(kernel.stored(chat.formatted(rows.unionByName(probe)), "chat"))


def piece_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers' ids in every document, scored over the corpus."""
    return alignment.align(table(spark, folder, "documents"), byte_tokenizer(), piece_tokenizer())
