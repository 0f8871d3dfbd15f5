"""One query per operator over its whole table, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import (
    chat, language_id, lm_scoring, mixing, near_dedup, packing, periodic_runs, quality, sentence_pieces, suffix_dedup, token_alignment,
    token_files, topk,
)
from paperloom.llm.common import WORD_PATTERN, documents, id_crc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


_UPPER = "".join(map(chr, range(65, 91)))
_FOLDED = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{WORD_PATTERN}')"
_NEAR = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2),
  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT reach.a AS r, min(d.doc_id) AS low FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(c.low, d.doc_id)) AS kept FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN c ON d.r = c.r
"""


@query("op1_near_duplicates", _NEAR)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return near_dedup.near_duplicates(docs, shingle=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_repeated_bytes")
def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir).select("doc_id", "text"))


@query("op3_mix_sources", mixing.oracle())
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"), carry_text=False)
    return mixed.select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), F.round("_factor", 6).alias("weight"),
        F.round("_chance", 6).alias("probability"), F.col("_kept").alias("kept"),
    )


_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, d.v) DESC, d.vec_id) AS rank
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 5
"""


@query("op4_top_k", _TOP)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.search(rows, F.col("vec_id") % 50 == 0)


def _escaped(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for control in chat.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


_FIXED = len(chat.OPEN + chat.MIDDLE + chat.CLOSE)
_CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length({_escaped("role")}) + length({_escaped("text")}) + {_FIXED}) AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant') AS n_examples FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars, n_examples FROM c
"""


@query("op5_chat_format", _CHAT)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    words = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", words), (-7, 1, "assistant", words)], rows.schema)
    path = chat.write_chat(chat.format_turns(rows.unionByName(extra)))
    return chat.read_back(spark.read.parquet(path))


@query("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 2,048 words; neither two copies of a text nor two documents of a source share one."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return packing.pack(docs, packing.word_tokens(), source=F.col("source"), cluster=F.md5("text"))


@query("op7_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lm_scoring.scored(docs, id_crc() % 10 != 0)


_WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')"
_QUALITY = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
k AS MATERIALIZED (SELECT r, list_transform(range(1, len(w) - 1), lambda i: struct_pack(i := i, g := w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM d),
g AS (SELECT r, u.i AS i, u.g AS g FROM (SELECT r, unnest(g) AS u FROM k)),
many AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + unnest([0, 1, 2]) AS at FROM many) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD_PATTERN}') GROUP BY r),
c AS MATERIALIZED (SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN covered ON d.r = covered.r LEFT JOIN dup ON d.r = dup.r),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS MATERIALIZED (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM b WHERE source IS NOT NULL GROUP BY source),
m AS MATERIALIZED (SELECT sum(n) AS n, sum(f) / sum(n) AS mean, sum(n * (f / n) * (f / n)) / sum(n) AS square, count(*) AS hosts FROM h),
s AS MATERIALIZED (SELECT n, mean, greatest(square - mean * mean - mean * (1 - mean) * hosts / n, 0) AS spread FROM m),
p AS MATERIALIZED (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1.0), n) ELSE n END AS weight FROM s),
v AS (SELECT source, (f + mean * weight) / (n + weight) AS host_rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(host_rate >= 0.5, false) AS kept, round(host_rate, 9) AS host_rate
FROM b LEFT JOIN v ON b.source = v.source
"""


@query("op8_quality_rules", _QUALITY)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))


@query("op9_token_files")
def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    manifest = token_files.write_tokens(docs, token_files.token_folder(spark), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(spark, manifest)


@query("op10_language_id")
def identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = id_crc() % 3 == 1
    return language_id.identify(docs, ~held_out, columns=(F.col("doc_id"), held_out.alias("held_out")))


@query("op11_token_alignment")
def align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.document_scores(token_alignment.blocks(documents(spark, sf_dir).select("doc_id", "text"), *files))


@query("op12_sentence_pieces")
def encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentence_pieces.digests(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + length(k)), lambda i: ascii(k[i])::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
_RUNS = f"""
WITH k AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, {_CRC} AS h FROM k),
p AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h),
m AS MATERIALIZED (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
  lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM p),
x AS MATERIALIZED (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS w FROM m),
s AS (SELECT a.r, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.r = b.r AND a.w = b.w AND b.i > a.i WHERE 3 * (b.i - a.i) <= a.n),
o AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS o FROM s)
  GROUP BY r, q, o HAVING count(*) + q >= greatest(24, 3 * q)),
u AS MATERIALIZED (SELECT r, s, l, min(q) AS q FROM o GROUP BY r, s, l),
e AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
  arg_min({{'s': s, 'l': l, 'q': q}}, {{'x': -l / q, 's': s, 'q': q}}) AS best FROM u GROUP BY r),
d AS (SELECT DISTINCT u.r, x.i FROM u JOIN x ON x.r = u.r AND x.i >= u.s + u.q AND x.i < u.s + u.l),
c AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS kept FROM x ANTI JOIN d USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.q::BIGINT AS period,
  (1000 * best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM m LEFT JOIN e USING (r) LEFT JOIN c USING (r)
"""


@query("op13_periodic_runs", _RUNS)
def find_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return periodic_runs.report(periodic_runs.periodic_runs(periodic_runs.planted(docs, id_crc())))
