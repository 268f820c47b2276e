"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import bpe, chat, decontaminate, forest, html_text, importance, periodic, permutation_index, pii, quality, simhash, token_output, warc_zip
from assayframe.llm.shared import shared_path, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.resolved(warc_zip.round_trip(table(spark, sf_dir, "pages")))
    page, first = (warc_zip.key_of(c).cast("long") for c in ("record_id", "refers_to"))
    return records.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", first.alias("refers_to"))


CONTROL_CASE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_CASE).alias("text"))
    chats = chat.format_chats(rows.union(own)).withColumn("turns", chat.parse(F.col("formatted")))
    chats = chats.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_path(spark, "tokens")
    token_output.write(table(spark, sf_dir, "documents"), out, TOKENIZER, public_tokenizers.PATTERN)
    docs = token_output.read(spark, out)
    return docs.select("doc_id", "start", "n_tokens", token_output.ids_crc32("token_ids").alias("ids_crc32"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


#: Key of these queries; a real run takes a secret one.
PSEUDONYM_KEY = "assayframe-demonstration-key"


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.with_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = bpe.with_tokens(docs, RANKS, public_tokenizers.PATTERN)
    docs = bpe.with_bytes(docs, RANKS)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return docs.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def held_out(key: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """The quality model of the labelled documents that aren't held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return quality.fit(quality.labelled_sample(docs, labels))


#: Documents of at least this score are predicted to be good.
ACCEPT = 0.7


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality.scored(docs, quality_model(spark, docs, sf_dir))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return permutation_index.search(rows, F.col("vec_id") % 50 == 0)


def op11_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def repeating_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's change to a tenth of the documents: from some word on, a stretch of the words over and over."""
    tenth, g = (zlib.crc32(str(doc_id).encode()) % 10, zlib.crc32(str(doc_id).encode()) // 10) if doc_id is not None else (1, 0)
    n = len(words)
    if tenth or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), changed=repeating_tail)
    runs = F.col("periodic.runs")
    first = F.aggregate(runs, runs[0], lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best))  # runs come by start and period
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    docs = docs.select("doc_id", F.size(runs).cast("long").alias("n_runs"), F.when(F.size(runs) > 0, first).alias("first"), F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")).alias("lines"), "periodic.collapsed")
    return docs.select(
        "doc_id",
        "n_runs",
        "first.*",
        F.floor(1000 * F.col("first.length") / F.col("first.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_zip": op1_warc_zip,
    "op2_chat_format": op2_chat_format,
    "op3_winnowing": op3_winnowing,
    "op4_token_output": op4_token_output,
    "op5_simhash": op5_simhash,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_main_text": op7_main_text,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality": op9_quality,
    "op10_permutation_index": op10_permutation_index,
    "op11_projection_forest": op11_projection_forest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_importance_resampling": op13_importance_resampling,
}

_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INT), 1)" for i in range(8) for shift in (15, 10, 5, 0))

ORACLE_SQL: dict[str, str] = {
    "op1_warc_zip": f"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY 1)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN f USING (h)
    """,
    "op3_winnowing": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, CAST(least(len(w), 10) AS INT) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0) AS q),
        lens AS (SELECT DISTINCT n FROM win), starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
        hit AS (SELECT DISTINCT doc_id, i, win.n, item_id FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM starts) AS q JOIN win ON win.n = q.n AND win.s = q.s),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) AS q GROUP BY 1),
        listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) AS q GROUP BY 1)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN listed ON listed.doc_id = d.doc_id
    """,
    "op2_chat_format": """
        WITH raw AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), marked AS (
            SELECT *,
                length(text) + len(regexp_extract_all(text, '\\\\|<[|]|</?s>|<</?SYS>>|\\[/?INST\\]'))
                + length(role) + len(regexp_extract_all(role, '\\\\|<[|]|</?s>|<</?SYS>>|\\[/?INST\\]')) + 23 AS formatted
            FROM raw
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(formatted) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op11_projection_forest": """
        WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        u AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x <> 0)) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        link AS (SELECT a.r AS a, b.r AS b FROM u AS a JOIN u AS b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
        least AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
        n AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY 1)
        SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(v.vec_id = component_id, false) AS kept
        FROM v JOIN least USING (r) LEFT JOIN n USING (r)
    """,
    "op13_importance_resampling": f"""
        WITH bits AS (SELECT i, list_reduce(list_prepend(i, CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS i) AS q),
        tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits),
        d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT {_WORDS} AS w FROM benchmark),
        words AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b) AS q),
        coded AS MATERIALIZED (
            SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(word)), lambda k: CAST('0x' || substr(hex(encode(word)), CAST(2 * k + 1 AS INT), 2) AS BIGINT))),
                lambda c, x: xor(c // 256, t[CAST(xor(c % 256, x) + 1 AS INT)])), 4294967295) % 10000 AS bucket
            FROM words, tab
        ),
        s AS (SELECT bucket, count(*) AS s FROM (SELECT unnest(w) AS word FROM d) AS q JOIN coded USING (word) GROUP BY 1),
        t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM b) AS q JOIN coded USING (word) GROUP BY 1),
        total AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket), total
        ),
        weighed AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM (SELECT r, unnest(w) AS word FROM d) AS q JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY 1),
        scored AS (
            SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
            FROM d LEFT JOIN weighed USING (r)
        ),
        drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (r)
    """,
}
