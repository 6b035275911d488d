"""The queries ``opN_<name>``: each applies one operator to its whole table.

A query only derives the digest columns it reports from the operator's output.
``public_tokenizers`` is needed by the two tokenising queries alone; the
operators take file paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.llm import (bpe, chat, decontaminate, minhash, packing, pii, quality, resample, secrets, sharding, topk,
                          toxicity, whiten)
from drawlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


MAX_TOKENS = 4096


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens. Document and attention
    capacities are those that 4096 tokens imply, so tokens alone decide how few
    sequences suffice and the other two only steer the choice."""
    import public_tokenizers
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  MAX_TOKENS)
    return packing.pack_best_fit(pieces.select("doc_id", "piece", "start", "length",
                                               F.crc32("ids").alias("ids_crc32")), MAX_TOKENS)


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocab, public_tokenizers.PATTERN)
    return bpe.decode(ids, vocab, decimal_col="ids_text").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_minhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op5_exact_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
WHERE rank <= 5""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.integer_vector(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)


@query("op6_chat_formatting", r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev,
             replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>') AS safe FROM t),
k AS (SELECT *, CASE WHEN prev IS NULL THEN role IN ('system', 'user') WHEN prev = 'user' THEN role = 'assistant'
                ELSE prev IN ('system', 'assistant') AND role = 'user' END AS ok FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(4 + length(role) + 2 + length(safe) + 9)::BIGINT AS formatted_chars, bool_and(ok) AS valid
FROM k GROUP BY conv_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out_column().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_by_labels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "quality_rules.*")


@query("op9_personal_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    told = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform("base", lambda s: told(s["kind"], s))
    added = F.transform("added", lambda s: told(F.lit("term"), s))
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in pii.KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, added), ",").alias("spans"))


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    kept = F.filter("secrets", lambda s: s["kept"])
    return found.select("doc_id", F.size("secrets").cast("long").alias("n_candidates"),
                        F.size(kept).cast("long").alias("n_secrets"),
                        F.array_join(F.transform(kept, lambda s: F.concat_ws(
                            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


#: Lower-case words of ASCII letters, digits and characters beyond ASCII.
_PLAIN_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op11_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS words FROM
        (SELECT item_id, unnest(CASE WHEN len(w) <= 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda k: w[k:k + 9]) END) AS x
         FROM b WHERE len(w) > 0)),
u AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS words FROM
        (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d CROSS JOIN (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
m AS (SELECT r, n, k, item_id FROM u JOIN p USING (n, words)),
h AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS word FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_importance_resampling", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT {_PLAIN_WORDS} AS w FROM benchmark),
f AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS x FROM d),
g AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS x FROM b),
bytes AS (SELECT list_transform(range(0, 256), lambda k: list_reduce(list_concat([k], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of),
x AS (SELECT x, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, octet_length(encode(x))),
            lambda k: ('0x' || substr(hex(encode(x)), 2 * k + 1, 2))::BIGINT)),
            lambda c, v: xor(c >> 8, crc_of[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT x FROM f UNION SELECT x FROM g), bytes),
s AS (SELECT bucket, count(*) AS s FROM f JOIN x USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM g JOIN x USING (x) GROUP BY bucket),
gain AS (SELECT k.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT count(*) FROM f)::DOUBLE + 10000)
                / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT count(*) FROM g)::DOUBLE + 10000))))::BIGINT AS gain
         FROM (SELECT DISTINCT bucket FROM x) k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
m AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS total FROM f JOIN x USING (x) JOIN gain USING (bucket) GROUP BY r),
o AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
             coalesce((total - (((total % n_features) + n_features) % n_features)) // n_features, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (r)),
c AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM o),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM c WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (25 * (SELECT count(*) FROM k)) // 100 THEN place END AS rank
FROM c LEFT JOIN k USING (r)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")
