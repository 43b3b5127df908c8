"""The operators bound to the given tables, with their SQL counterparts where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflow.llm.bpe import decode_ids, encode_texts
from panelflow.llm.decontaminate import find_contamination
from panelflow.llm.exact_dedup import exact_duplicates, without_spaces
from panelflow.llm.html_text import extract_main_text
from panelflow.llm.line_dedup import drop_boilerplate
from panelflow.llm.lm_score import score_texts
from panelflow.llm.near_dedup import near_duplicates
from panelflow.llm.packing import pack_documents
from panelflow.llm.periodic import find_periodic_runs
from panelflow.llm.quality import score_quality
from panelflow.llm.rans import read_digest, tokenized, write_ids
from panelflow.llm.url_filter import judge_urls
from panelflow.llm.whitening import COMPONENTS, whiten
from panelflow.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    "op7_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
        FROM documents
    ), k AS (
        SELECT doc_id, norm, first(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY norm) AS group_size
        FROM n
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
)
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf, "documents").select("doc_id", "text"))
    digest = F.sha2(without_spaces(F.col("text")), 256)
    return found.select("doc_id", "keep_id", "group_size", "kept", digest.alias("text_sha256"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op8_url_filter",
    f"""
    WITH rules(rule_host, rule_path, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}), u AS (
        SELECT page_id, url,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), fits AS (
        SELECT page_id, url, rule_host || rule_path AS rule, v,
            row_number() OVER (PARTITION BY page_id, url ORDER BY length(rule_host || rule_path) DESC) AS place
        FROM u JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
    )
    SELECT u.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
    FROM u LEFT JOIN fits f ON f.page_id = u.page_id AND f.url = u.url AND place = 1
    """,
)
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    values = ", ".join(str(r) for r in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    judged = judge_urls(table(spark, sf, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_line_dedup",
    r"""
    WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
    ), parts AS (
        SELECT r, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages WHERE text IS NOT NULL
    ), keyed AS (SELECT *, trim(translate(line, chr(9) || chr(13), '  ')) AS key FROM parts
    ), totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source
    ), often AS (
        SELECT k.source, key FROM keyed k JOIN totals t ON t.source IS NOT DISTINCT FROM k.source WHERE key <> ''
        GROUP BY k.source, key, total HAVING count(DISTINCT r) >= 5 AND count(DISTINCT r) > 0.05 * total
    ), marked AS (
        SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k
        LEFT JOIN often o ON o.source IS NOT DISTINCT FROM k.source AND o.key = k.key
    ), clean AS (
        SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS clean
        FROM marked GROUP BY r
    )
    SELECT doc_id, source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, clean AS text
    FROM pages LEFT JOIN clean USING (r)
    """,
)
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs).select("doc_id", "source", "n_lines", "n_dropped", "text")


@query("op2_token_files")
def token_files(spark: SparkSession, sf: str) -> DataFrame:
    tokens = tokenized(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    path = scratch_path(spark, "token-ids")
    write_ids(materialize(tokens), path)
    return read_digest(spark, path)


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op3_decontamination",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
    ), b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)
    ), starts AS (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM b WHERE k > 0
    ), grams AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM starts
    ), sizes AS (SELECT DISTINCT k FROM grams
    ), places AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k
    ), found AS (
        SELECT r, p, f.k, item FROM (SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM places) f
        JOIN grams ON grams.k = f.k AND grams.g = f.g
    ), hits AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM found) GROUP BY r
    ), items AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
    """,
)
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), carry=["doc_id"])
    return found.drop("matches")


@query("op4_html_text")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    found = extract_main_text(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_quality")
def quality(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op1_near_dedup")
def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), words=3, percent=85)


@query("op6_lm_score")
def lm_score(spark: SparkSession, sf: str) -> DataFrame:
    end_of_text = 49407
    return score_texts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_of_text)


@query("op11_bpe")
def bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = encode_texts(table(spark, sf, "documents").select("doc_id", "text"), path)
    return decode_ids(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth document or so is given a period first; that is part of the query, not of the operator."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)")))
    docs = table(spark, sf, "documents").select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> get(words, cast(if(i < a, i, a + (i - a) % p) AS int))), ' ')")
    found = find_periodic_runs(docs.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, components=COMPONENTS)
