"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import (
    ann, chat, mixing, near_dup, packing, pieces, repair, segments, suffix_dedup, token_file, topk, toxicity, url_filter,
)
from txnlake.llm.common import arrow_rows, read_table

#: Rules of the URL query: (action, host, path).
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 128)
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
        "conv_id long, turn long, role string, text string",
    )
    messages = rows.unionByName(planted).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.chat_digest(chat.read_chats(chat.format_chats(messages)))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 128)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    read = token_file.token_file(docs, tokenizer_file("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 256)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.score_toxicity(docs, labels).drop("th")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(spark, pages, URL_RULES)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 256)
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 128)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    packed = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), 2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with faults planted by a checksum of conv_id and turn."""
    conv, turn, role, text = (repair.one_space(c) for c in ("conv_id", "turn", "role", "text"))
    draw = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    broken = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return (
        rows.withColumn("draw", draw)
        .where("draw <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(draw == 4, "user").otherwise(role).alias("role"),
            broken.alias("text"),
            F.explode(F.when(draw == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 512)
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.with_unsaid(repair.repair_conversations(damaged(rows)), rows)


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 128)
    docs, model = read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("piece_bpe_32k.model")
    read = pieces.decode_documents(pieces.encode_documents(docs, model), model)
    return read.select(
        "doc_id",
        F.col("n_pieces").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        "span_bytes",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrow_rows(spark, 64)
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return segments.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_token_file": op3_token_file,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_toxicity": op5_toxicity,
    "op6_url_filters": op6_url_filters,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_source_mix": op9_source_mix,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_hard_negatives": op13_hard_negatives,
}

def _controls(text: str) -> str:
    """How many characters escaping adds: one a backslash, one a control string."""
    marks = [("\\", 1), ("<|", 2), ("<s>", 3), ("</s>", 4), ("[INST]", 6), ("[/INST]", 7)]
    return " + ".join(f"(length({text}) - length(replace({text}, '{m}', ''))) // {n}" for m, n in marks)


_CHATS = f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
        UNION ALL
        SELECT -7, i, role, '</s>[INST] ok [/INST]'
        FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(i, role)),
    chats AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t) AS turns,
               coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t)
                        FILTER (WHERE r = 'assistant'), '') AS loss,
               CAST(sum({len(chat.TURN + chat.BODY + chat.END)} + length(r) + length(t)
                        + {_controls("r")} + {_controls("t")}) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars FROM chats"""

_TOP_K = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
    SELECT q.vec_id AS query_id,
           CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, v.e) DESC,
                v.vec_id) AS INTEGER) AS rank,
           v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
    FROM v JOIN v AS q ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
    QUALIFY rank <= 5"""


def _values(rows: list[tuple]) -> str:
    quote = lambda x: str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows) + ")"


def _urls() -> str:
    domains = _values([(a, h, p, h + p) for a, h, p in URL_RULES])
    listed = enumerate(url_filter.PATTERN_RULES)
    patterns = _values([(i, a, p, url_filter.pattern_regex(p)) for i, (a, p) in listed])
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH split AS (
        SELECT page_id, url,
               translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1),
                         '{upper}', '{lower}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path,
               row_number() OVER () AS i
        FROM pages),
    domain AS (
        SELECT i, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.action, length(r.rule)) AS action
        FROM split JOIN {domains} AS r(action, host, path, rule)
            ON (split.host = r.host OR ends_with(split.host, '.' || r.host))
            AND starts_with(split.path, r.path)
        GROUP BY i),
    pattern AS (
        SELECT i, arg_max(p.rule, length(p.rule) * 1000 - p.n) AS rule,
               arg_max(p.action, length(p.rule) * 1000 - p.n) AS action
        FROM split JOIN {patterns} AS p(n, action, rule, regex) ON regexp_matches(url, p.regex)
        GROUP BY i)
    SELECT page_id, host, path, domain.rule, pattern.rule AS pattern_rule,
           coalesce(domain.action, pattern.action, 'allow') AS verdict
    FROM split LEFT JOIN domain USING (i) LEFT JOIN pattern USING (i)"""


# A row keeps, for each state of a reader (z nothing yet, s, u, a), the least {cost, audit, text}.
_INSERT = "{{'c': {0}.c + 5, 'a': {0}.a || 'I', 'r': {0}.r || chr(10) || '{1}:'}}"
_USER_NEXT = "list_min([u, " + ", ".join(_INSERT.format(x, "user") for x in "zsa") + "])"
_EDIT = "{{'c': {0}.c + {1} + late, 'a': {0}.a || '{2}', 'r': {0}.r || chr(10) || {3} || ':' || t}}"


def _edit_sql(state: str, to: str) -> str:
    kept = f"CASE WHEN kind = '{to[0]}' THEN {_EDIT.format(state, 0, 'K', 'r')} END"
    return f"{kept}, CASE WHEN kind <> 'x' THEN {_EDIT.format(state, 1, 'R', chr(39) + to + chr(39))} END"


_REPAIR = f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
               list_reduce(list_transform(string_split(
                       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                       lambda ch: CAST(ord(ch) AS BIGINT)),
                   lambda crc, byte: list_reduce(range(8), lambda x, i:
                       CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, byte)),
                   4294967295) AS crc
        FROM conversations),
    dealt AS (SELECT *, xor(crc, 4294967295) % 20 AS d FROM keyed),
    said AS (
        SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE r END AS r,
               CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t,
               unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM dealt WHERE d <> 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t, copy) AS i,
               rtrim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS full_text
        FROM said),
    faulty AS (
        SELECT *, left(r, 1) AS initial,
               CASE WHEN full_text = '' THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, r, t ORDER BY i) > 1 THEN 'duplicate'
                    WHEN right(full_text, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(left(r, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM placed),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (WHERE fault = 'blank') AS blank,
               count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
               count(*) FILTER (WHERE fault = 'truncated') AS truncated,
               count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id),
    walk(conv_id, i, z, s, u, a) AS (
        SELECT conv_id, CAST(0 AS BIGINT), {{'c': 0, 'a': '', 'r': ''}},
               CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)), CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)),
               CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR))
        FROM counted
        UNION ALL
        SELECT conv_id, i, {{'c': z.c + 2, 'a': z.a || 'D', 'r': z.r}},
               list_min([CASE WHEN s IS NOT NULL THEN {{'c': s.c + 2, 'a': s.a || 'D', 'r': s.r}} END,
                         CASE WHEN kind = 's' THEN {_EDIT.format("z", 0, "K", "r")} END]),
               list_min([CASE WHEN u IS NOT NULL THEN {{'c': u.c + 2, 'a': u.a || 'D', 'r': u.r}} END,
                         {", ".join(_edit_sql(x, "user") for x in "zsa")}]),
               list_min([CASE WHEN a IS NOT NULL THEN {{'c': a.c + 2, 'a': a.a || 'D', 'r': a.r}} END,
                         {_edit_sql("u", "assistant")}])
        FROM (
            SELECT * REPLACE ({_USER_NEXT} AS u)
            FROM (
                SELECT * REPLACE (list_min([a, {_INSERT.format("u", "assistant")}]) AS a)
                FROM (
                    SELECT w.conv_id, f.i, w.z, w.s, {_USER_NEXT.replace("[u,", "[w.u,")} AS u, w.a, f.r, f.t,
                           CASE WHEN f.fault IN ('blank', 'duplicate') THEN 'x' ELSE f.initial END AS kind,
                           CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS late
                    FROM walk AS w JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)))),
    closed AS (
        SELECT conv_id, list_min([z, a, {_INSERT.format("u", "assistant")}]) AS best
        FROM (SELECT * REPLACE ({_USER_NEXT} AS u)
              FROM (SELECT w.* FROM walk AS w JOIN
                    (SELECT conv_id, max(i) AS i FROM faulty GROUP BY 1) AS e
                    ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i)))
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
           sha256(substr(coalesce(best.r, ''), 2)) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS o
    LEFT JOIN counted AS n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN closed AS b ON b.conv_id IS NOT DISTINCT FROM o.conv_id"""

_HARD_NEGATIVES = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    pairs AS (
        SELECT q.vec_id AS anchor_id, v.vec_id, q.label = v.label AS same,
               CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
        FROM v JOIN v AS q ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN pairs USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3"""

#: What SQL can express; the other queries are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": _CHATS,
    "op4_exact_top_k": _TOP_K,
    "op6_url_filters": _urls(),
    "op11_conversation_repair": _REPAIR,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
