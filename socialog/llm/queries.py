"""Registered queries of the operators over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialog.llm import (
    chat,
    fingerprints,
    html,
    langid,
    lines,
    neighbours,
    packing,
    periodic,
    pieces,
    simhash,
    substrings,
    toxicity,
    variants,
)
from socialog.llm.base import is_fold, small_batches, table, tokenizer_path


def _in_small_batches(query):
    """Text columns go to Python workers a few MB at a time."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(
        docs, table(spark, sf_dir, "labels"), ~is_fold(F.col("doc_id"), 5, 0)
    )
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        is_fold(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_fold(F.col("doc_id"), 4, 2)
    model = langid.learn(docs, F.col("doc_id").isNotNull() & ~held_out)
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, F.col("vec_id") % 100 == 0)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extracted(pages).select("page_id", "url", "text", F.length("text").alias("n_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, tokenizer_path("byte_bpe_50k.json")))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_counts(table(spark, sf_dir, "documents"))
    places = F.array_join(F.col("kept_lines").cast("array<string>"), ",")
    return found.withColumn("kept_lines", places)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model, back="decoded").select(
        "doc_id",
        F.size("ids").alias("n_ids"),
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def _slips(doc_id: int | None) -> Callable[[str], str]:
    """Deletes a letter of one in 97 different words of a document, chosen by check sum; a NULL id deletes none."""
    before = zlib.crc32(f"{doc_id}:".encode())

    def slip(run: str) -> str:
        h = zlib.crc32(run.encode(), before)
        if h % 97 or doc_id is None:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    return slip


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.word_counts(table(spark, sf_dir, "documents"), change=_slips))


QUOTING = f"{chat.END}{chat.START}assistant ok"


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(QUOTING).alias("text"),
    )
    return chat.digests(chat.rendered(turns.unionByName(quoting)))


def _repeating(docs: DataFrame) -> DataFrame:
    """Words of one document in ten repeat from a place on, both chosen by its id; a NULL id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    # from word a on, the p words there come again and again up to word n
    places = docs.withColumns({"g": F.floor(h / 10), "n": F.when(h % 10 == 0, F.size(words))})
    placed = places.withColumn("a", F.expr("g % n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    stretch = F.flatten(F.array_repeat(F.slice(words, F.col("a") + 1, F.col("p")), F.expr("cast((n - a) div p + 1 as int)")))
    rest = F.slice(stretch, F.lit(1), F.col("n") - F.col("a"))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), rest), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _repeating(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = F.transform(
        F.arrays_zip("starts", "lengths", "periods"),
        lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]),
    )
    longest = F.array_min(
        F.transform(
            F.arrays_zip("starts", "lengths", "periods"),
            lambda r: F.struct((-r["lengths"]).alias("less"), r["starts"].alias("start"), r["periods"].alias("period")),
        )
    )
    return (
        periodic.periodic_runs(docs)
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("starts").cast("long").alias("n_runs"),
            "longest.start",
            (-F.col("longest.less")).alias("length"),
            "longest.period",
            F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
            F.sha2(F.array_join(F.transform(listed, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_neighbours": op3_neighbours,
    "op4_html": op4_html,
    "op5_packing": op5_packing,
    "op6_substrings": op6_substrings,
    "op7_lines": op7_lines,
    "op8_simhash": op8_simhash,
    "op9_pieces": op9_pieces,
    "op10_fingerprints": op10_fingerprints,
    "op11_variants": op11_variants,
    "op12_chat": op12_chat,
    "op13_runs": op13_runs,
}
QUERIES = {name: _in_small_batches(query) for name, query in QUERIES.items()}
_LINE = r"trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"

# What SQL can state; tests hold the other operators against brute force.
ORACLE = {
    "op6_substrings": r"""
        WITH w AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') AS ws
            FROM documents),
        places AS (
            SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS p
            FROM w WHERE len(ws) >= 35),
        windows AS (
            SELECT doc_id, p,
                   count(*) OVER (PARTITION BY md5(array_to_string(ws[p : p + 34], ' '))) AS n
            FROM places),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(p, p + 34)) AS q FROM windows WHERE n > 1),
        words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS q FROM w),
        kept AS (
            SELECT doc_id, count(gone.q) AS n_removed,
                   string_agg(x, ' ' ORDER BY q) FILTER (gone.q IS NULL) AS t
            FROM words LEFT JOIN gone USING (doc_id, q) GROUP BY doc_id)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_lines": f"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
            FROM documents),
        sets AS (
            SELECT doc_id, i, list_sort(list_distinct(list_filter(
                       string_split({_LINE}, ' '), lambda x: x <> ''))) AS s
            FROM split WHERE {_LINE} <> ''),
        classes AS (
            SELECT s, row_number() OVER (ORDER BY doc_id, i) AS id
            FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM sets)
            WHERE k = 1),
        words AS (SELECT id, len(s) AS n, unnest(s) AS word FROM classes),
        late AS (
            SELECT DISTINCT id FROM (
                SELECT b.id FROM words a JOIN words b ON a.word = b.word
                WHERE a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
                GROUP BY a.id, a.n, b.id, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n))),
        marked AS (
            SELECT doc_id, i, id IN (SELECT id FROM late)
                   OR row_number() OVER (PARTITION BY id ORDER BY doc_id, i) > 1 AS removed
            FROM sets JOIN classes USING (s))
        SELECT doc_id, count(i) AS n_lines, count(*) FILTER (removed) AS n_removed,
               coalesce(string_agg(i, ',' ORDER BY i) FILTER (NOT removed), '') AS kept_lines
        FROM documents LEFT JOIN marked USING (doc_id) GROUP BY doc_id""",
    "op12_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                                  (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|im_start|><|im_end|>') + 2
                        + length(role) + length(regexp_replace(role, '[^\\\n|]', '', 'g'))
                        + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
}
