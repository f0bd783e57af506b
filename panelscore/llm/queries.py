"""The registered queries of the operators, one an operator, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.llm import (chat, language, lm, mixing, packing, passages, pieces, prefixes, quality, search, simhash,
                            toxicity, whitening)
from panelscore.llm.common import remainder, session, stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(_table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    labelled = language.sample(docs, ~held_out)
    predicted = language.predict(docs.select("doc_id", "text"), labelled)
    return predicted.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", "toxic"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


#: The tool of the conversations: each turn of a user calls it, the turn after it by the assistant is the result, and the
#: next turn of the user refers to that result.
REPLY = {"reply": {"text": ("string", True), "turn": ("integer", True)}}


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a turn. Turns without conversation or number have no identifier and are linked to nothing."""
    turns = _table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"))
    calls = turns.where("role = 'user'").select(
        "conv_id", F.col("turn").alias("place"), F.concat(name, "turn").alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"), F.concat(name, F.col("turn") - 2).alias("refers_to"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("place"), F.concat(name, F.col("turn") - 1).alias("call_id"),
        F.col("text").alias("content"))
    linked = chat.link(calls, results, REPLY).select(
        "conv_id", F.col("place").alias("turn"), "sort_place", "level", "kind", "call_id", "status",
        F.concat_ws("; ", "errors").alias("errors"), "json")
    others = turns.where("role is null or role not in ('user', 'assistant')").select(
        "conv_id", "turn", F.col("turn").alias("sort_place"), F.lit(0).alias("level"), F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"), F.lit("plain").alias("status"), F.lit("").alias("errors"),
        chat.message_json(F.col("role"), F.col("text")).alias("json"))
    return linked.unionByName(others)


#: A turn never comes before what it refers to here, since its number is higher: places stay, levels are 0.
OP5_SQL = """
WITH calls AS (SELECT conv_id, turn AS place, 'call_' || conv_id || '_' || turn AS call_id, text
               FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, turn AS place, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text
            FROM conversations WHERE role = 'assistant'),
nc AS (SELECT conv_id, call_id, count(*) AS n_calls FROM calls GROUP BY ALL),
nr AS (SELECT conv_id, call_id, count(*) AS n_results FROM results GROUP BY ALL)
SELECT c.conv_id, c.place AS turn, c.place AS sort_place, CAST(0 AS INTEGER) AS level, 'call' AS kind, c.call_id,
       CASE WHEN coalesce(n_calls, 0) > 1 OR coalesce(n_results, 0) > 1 THEN 'repeated'
            WHEN n_results IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       concat_ws('; ', CASE WHEN c.text IS NULL THEN 'missing text' END, CASE WHEN c.place IS NULL THEN 'missing turn' END)
       AS errors,
       '{"role":"assistant","tool_calls":[{"arguments":{'
       || concat_ws(',', '"text":' || to_json(c.text), '"turn":' || c.place) || '}'
       || coalesce(',"id":' || to_json(c.call_id), '') || ',"name":"reply"}]}' AS json
FROM calls c LEFT JOIN nc USING (conv_id, call_id) LEFT JOIN nr USING (conv_id, call_id)
UNION ALL
SELECT r.conv_id, r.place, r.place, CAST(0 AS INTEGER), 'result', r.call_id,
       CASE WHEN coalesce(n_calls, 0) > 1 OR coalesce(n_results, 0) > 1 THEN 'repeated'
            WHEN n_calls IS NULL THEN 'orphan' ELSE 'linked' END,
       '', '{' || concat_ws(',', '"content":' || to_json(r.text), '"role":"tool"', '"tool_call_id":' || to_json(r.call_id))
       || '}'
FROM results r LEFT JOIN nr USING (conv_id, call_id) LEFT JOIN nc USING (conv_id, call_id)
UNION ALL
SELECT conv_id, turn, turn, CAST(0 AS INTEGER), 'message', NULL, 'plain', '',
       '{' || concat_ws(',', '"content":' || to_json(text), '"role":' || to_json(role)) || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 7) == 2
    codes, words = lm.train(docs, ~held_out)
    scored = lm.score(docs, codes, words, docs.where(~held_out).count())
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


#: Neighbours that the search returns for each query.
TOP_K = 10


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = stage(_table(spark, sf_dir, "embeddings").where("embedding is not null").select(
        F.col("vec_id").alias("id"), search.sign_code(F.col("embedding")).alias("code")), "search-coded")
    return search.top_k(coded, coded.where("id % 100 = 0"), TOP_K).select(
        F.col("query_id").alias("vec_id"), "rank", F.col("id").alias("neighbour_id"), "distance")


OP7_SQL = f"""
WITH coded AS (SELECT vec_id, [CASE WHEN embedding[i] > 0 THEN '1' ELSE '0' END FOR i IN range(1, 65)] AS bits
               FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
     codes AS (SELECT DISTINCT vec_id, array_to_string(bits, '') AS code FROM coded),
     pairs AS (SELECT q.vec_id, d.vec_id AS neighbour_id, CAST(hamming(q.code, d.code) AS INTEGER) AS distance
               FROM codes q JOIN codes d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id) AS nth FROM pairs)
SELECT vec_id, CAST(nth AS INTEGER) AS rank, neighbour_id, distance FROM ranked WHERE nth <= {TOP_K}
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.deal(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "shards")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.cluster(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    measured = quality.measure(docs, quality.fit(docs, quality.trusted_ids(labels)))
    return measured.drop("row")


#: The tokenizer of op11; the file may lie elsewhere, see ``packing.pieces``.
PACK_TOKENIZER = "word_bpe_49k.json"


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))
    digests = found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(digests)


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.symbols(_table(spark, sf_dir, "conversations"))
    return prefixes.trie(*prefixes.rebuilt(turns))


#: The CRC-32 of an id: its bytes are put in, each followed by eight shifts (-1). Prefixes are named by MD5 chains.
OP12_SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
           length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL),
ordered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, s) AS pos FROM turns),
convs AS (SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([
              [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR d IN string_split(c::VARCHAR, '')])),
              lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 6 AS h
          FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
    SELECT v.c, o.pos, o.s, o.chars FROM convs v JOIN ordered o ON o.c = v.c - v.c % 100 AND o.pos <= v.h
    UNION ALL SELECT v.c, o.pos + 6, o.s, o.chars FROM convs v JOIN ordered o ON o.c = v.c AND o.pos > v.h),
numbered AS (SELECT c, s, chars, row_number() OVER (PARTITION BY c ORDER BY pos) AS d FROM rebuilt),
places AS (
    SELECT c, 0::BIGINT AS d, '' AS p, NULL::VARCHAR AS up, 0::BIGINT AS chars FROM convs
    UNION ALL
    SELECT n.c, n.d, md5(q.p || n.s), q.p, n.chars FROM places q JOIN numbered n ON n.c = q.c AND n.d = q.d + 1),
ends AS (SELECT p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha
         FROM (SELECT c, arg_max(p, d) AS p FROM places GROUP BY c) GROUP BY p),
nodes AS (SELECT p, any_value(up) AS up, any_value(d) AS d, min(c) AS c, count(*) AS n, any_value(chars) AS chars
          FROM places GROUP BY p),
children AS (SELECT up AS p, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
valued AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children k USING (p)),
below AS (SELECT a.p, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n - 1) * v.chars) AS saved
          FROM valued v JOIN places a ON a.c = v.c AND a.d <= v.d GROUP BY a.p)
SELECT v.c AS conv_id, v.d AS depth, u.c AS parent_conv_id, v.n AS n_convs, v.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM valued v JOIN below b USING (p) LEFT JOIN nodes u ON u.p = v.up LEFT JOIN ends e ON e.p = v.p
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(_table(spark, sf_dir, "embeddings"))
    # beyond 64 bits, which takes over ten million distinct vectors, the deviation is null
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_language": op2_language,
        "op3_toxicity": op3_toxicity,
        "op4_pieces": op4_pieces,
        "op5_chat": op5_chat,
        "op6_lm": op6_lm,
        "op7_search": op7_search,
        "op8_mixing": op8_mixing,
        "op9_passages": op9_passages,
        "op10_quality": op10_quality,
        "op11_packing": op11_packing,
        "op12_prefixes": op12_prefixes,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat": OP5_SQL,
        "op7_search": OP7_SQL,
        "op12_prefixes": OP12_SQL,
    }
