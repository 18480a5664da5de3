"""The operators' queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stocktide.session import materialize
from stocktide.sources.tables import read_table

from . import ann, chat, collocations, decontam, hardneg, lm, packing, quality, simhash, substrings, tokencount, toxicity, urls
from .text import fold

#: The rules of the URL query, as (verdict, host and path).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: The tokenizers of the packing and the counting query, by their names among the public ones.
TOKENIZER, COUNTED = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Fixed value: the token limit of the counting query.
LIMIT = 1024

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learnt from four folds of five."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text").withColumn("train", fold("doc_id") != 1)
    scored = lm.score(docs)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without windows of 35 words that start twice."""
    cut = substrings.remove_repeats(read_table(spark, folder, "documents"))
    kept = F.array_join(F.filter(F.split(F.coalesce("kept_text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), " ")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"), "intervals")


@query
def op3_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of each row whose id is divisible by 20."""
    return ann.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 ids."""
    return digests(packing.pack(read_table(spark, folder, "documents"), tokenizer_path()))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of document and benchmark item, where the document holds the item."""
    return decontam.contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query
def op6_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page."""
    return urls.judge(read_table(spark, folder, "pages"), URL_RULES)


@query
def op7_conversation_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.render(read_table(spark, folder, "conversations"))


ORACLES["op7_conversation_prefixes"] = f"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM turns
), whole AS (
    SELECT conv_id, count(*) AS n, list(role || chr(0) || text ORDER BY pos) AS lines FROM placed GROUP BY conv_id
), beginnings AS (
    SELECT lines[1:k] AS lines, max(n) AS longest FROM (SELECT lines, n, unnest(range(1, n + 1)) AS k FROM whole) GROUP BY 1
), kept AS (
    SELECT min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS copies
    FROM whole JOIN beginnings USING (lines) WHERE longest = n GROUP BY lines
)
SELECT conv_id, (pos - 1) // {chat.PART_TURNS} AS part, n_turns, copies,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY pos) AS text
FROM placed JOIN kept USING (conv_id)
GROUP BY ALL
"""


@query
def op8_random_indexing(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, with labels learnt from four folds of five."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").where(fold("doc_id") != 0)
    scored = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), quality.fit(docs, labels).score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op9_simhash_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


@query
def op10_compression_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, with labels learnt from four folds of five."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").where(fold("doc_id") != 0)
    scored = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), toxicity.fit(docs, labels).score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_packed_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Negatives of each row whose id is divisible by 100, for its five positives."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hardneg.mine(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


ORACLES["op11_packed_hard_negatives"] = f"""
WITH rows AS (
    SELECT row_number() OVER (ORDER BY vec_id, label) AS nth, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor({hardneg.SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.nth AS anchor, a.vec_id AS anchor_id, b.nth, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.nth <> b.nth AND len(a.v) = len(b.v)
), positives AS (
    SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, nth) <= {hardneg.POSITIVES}
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.vec_id, n.nth) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
  AND {hardneg.LOW_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {hardneg.HIGH_PERCENT} * p.score
QUALIFY rank <= {hardneg.NEGATIVES}
"""


@query
def op12_parsed_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(read_table(spark, folder, "documents"))


ORACLES["op12_parsed_collocations"] = f"""
WITH pieces AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents
), lines AS (
    SELECT lang, list_filter(string_split_regex(unnest(pieces), '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS (
    SELECT lang, size, array_to_string(words[pos : pos + size - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM lines, (SELECT unnest([1, 2, 3]) AS size)) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang
), split AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM grams WHERE size > 1 AND f >= {collocations.MIN_COUNT}
), cuts AS (
    SELECT s.lang, s.size, s.phrase, s.a, s.k, x.f AS l, y.f AS r,
      CAST(CAST({collocations.MILLION} AS HUGEINT) * s.a * s.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM split s JOIN grams x ON x.lang = s.lang AND x.phrase = array_to_string(s.w[1 : s.k], ' ')
    JOIN grams y ON y.lang = s.lang AND y.phrase = array_to_string(s.w[s.k + 1 : s.size], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covers AS (
    SELECT lang, phrase, max(a) AS cover FROM (
      SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM split WHERE size = 3 AND k = 1) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) LEFT JOIN covers USING (lang, phrase)
WHERE cover IS NULL OR 100 * cover < {collocations.COVER_PERCENT} * a
QUALIFY rank <= {collocations.TOP}
"""


@query
def op13_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, and how many characters of each hold 1024 of them."""
    counted = tokencount.count_tokens(read_table(spark, folder, "documents"), tokenizer_path(COUNTED))
    stored = materialize(counted, "prefix_counts")
    return stored.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), tokencount.fits(LIMIT).alias("chars_in_limit")
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The whole corpus pipeline."""
    return corpus_pipeline.run(spark, folder)
