"""One query per operator, over whole tables, and the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import (
    bpe, decontaminate, exact_dedup, interactions, language, licenses, line_dedup, lm, packing, resampling, simhash, substring_dedup, suffix_dedup,
)
from labelmill.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex(F.col("fingerprint")[0])), 16, "0").alias("fingerprint"), "component_id"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose remainder is not 2, predicts all."""
    docs = table(spark, sf_dir, "documents")
    held_out = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2).alias("held_out")
    model = language.fit(docs.withColumn("held_out", held_out).filter("not held_out"))
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose remainder is not 1, scores all."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    model, counts = lm.fit(docs.filter(~held_out).select(F.coalesce("text", F.lit("")).alias("text")))
    scored = lm.score(docs, model, counts)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the text that is left."""
    cleaned = line_dedup.clean_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, the licences found, the stretches they stand in and the words those hold."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    held = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["template"]))), ",")
    places = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["template"], s["first"], s["words"])), ",")
    return found.select("doc_id", "n_words", F.size("spans").cast("long").alias("n_spans"), names.alias("licenses"), places.alias("places"), held.alias("license_words"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(table(spark, sf_dir, "documents"), keep="max")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark"), percent=10, least_words=20, longest=1, buckets=10_000, seed=2024)
    return drawn.select("doc.doc_id", "n_features", "weight", "score", "rank")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)
    placed = packing.place(cuts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language_id": op2_language_id,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_bpe": op4_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLES: dict[str, str] = {
    "op5_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)
        ), marked AS (
            SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY win) AS again FROM windows
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM marked WHERE again
        ), places AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM w
        ), kept AS (
            SELECT p.doc_id, count(*) AS n_words, count(g.k) AS n_removed,
                   coalesce(string_agg(word, ' ' ORDER BY p.k) FILTER (WHERE g.k IS NULL), '') AS kept
            FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k GROUP BY p.doc_id
        )
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op7_line_dedup": """
        WITH parts AS (
            SELECT doc_id, text, source, string_split(text, chr(10)) AS raw, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS lines
            FROM documents WHERE text IS NOT NULL
        ), signed AS (
            SELECT doc_id, source, lines, text AS signature FROM parts
        ), judged AS (
            SELECT doc_id, source, signature, unnest(list_distinct(lines)) AS line FROM signed
        ), marks AS (
            SELECT line, min(doc_id) AS first FROM judged
            WHERE len(regexp_split_to_array(line, '[ \\t\\x0B\\f\\r]+')) >= 3
            GROUP BY line
            HAVING count(DISTINCT source) >= 10 AND count(DISTINCT signature) >= 10
        ), places AS (
            SELECT doc_id, unnest(raw) AS raw, generate_subscripts(raw, 1) AS i FROM parts
        ), told AS (
            SELECT p.doc_id, p.raw, p.i,
                   m.line IS NOT NULL AND NOT (m.first = p.doc_id AND row_number() OVER (PARTITION BY p.doc_id, trim(p.raw) ORDER BY p.i) = 1) AS gone
            FROM places p LEFT JOIN marks m ON m.line = trim(p.raw)
        ), kept AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
                   coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
            FROM told GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ), b AS (
            SELECT item_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
        ), places AS (
            SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
        ), hits AS (
            SELECT p.doc_id, p.i, p.n, v.item_id FROM places p JOIN windows v ON p.n = v.n AND p.win = v.win
        ), covered AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
            FROM hits GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op11_filter_interactions": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS again
            FROM documents
        ), failing AS (
            SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
                   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d, coalesce(again, false) AS e
            FROM d
        ), told AS (
            SELECT part, [a, b, c, d, e] AS fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
            FROM failing LEFT JOIN labels USING (doc_id)
        ), letters AS (
            SELECT unnest(range(1, 6)) AS k
        ), orders AS (
            SELECT [p.k, q.k, r.k, s.k, t.k] AS o
            FROM letters p JOIN letters q ON q.k <> p.k JOIN letters r ON r.k NOT IN (p.k, q.k) JOIN letters s ON s.k NOT IN (p.k, q.k, r.k)
            JOIN letters t ON t.k NOT IN (p.k, q.k, r.k, s.k)
        ), cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM told GROUP BY part, fails
        ), steps AS (
            SELECT part, o, step, o[step] AS f, n, good, toxic, fails[o[step]] AS fails,
                   list_sum(list_transform(o[1 : step - 1], lambda k: fails[k]::INT)) > 0 AS gone, list_sum(list_transform(fails, lambda x: x::INT)) = 1 AS alone
            FROM cells, orders, (SELECT unnest(range(1, 6)) AS step)
        ), counted AS (
            SELECT part, o, step, f,
                   sum(CASE WHEN NOT fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN fails AND coalesce(gone, false) THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails AND alone THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN toxic ELSE 0 END) AS toxic_lost
            FROM steps GROUP BY part, o, step, f
        )
        SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, step::INT AS step,
               kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
               good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM counted
    """,
    "op12_importance_resampling": r"""
        WITH bits AS (
            SELECT list(crc ORDER BY i) AS tab
            FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
                  FROM (SELECT unnest(range(256)) AS i))
        ), d AS (
            SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ), b AS (
            SELECT unnest(list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS word
            FROM benchmark
        ), words AS (
            SELECT doc_id, unnest(w) AS word FROM d
        ), coded AS (
            SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM (SELECT word FROM words UNION ALL SELECT word FROM b))
        ), hashed AS (
            SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                                         lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM coded, bits
        ), s AS (
            SELECT bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY bucket
        ), t AS (
            SELECT bucket, count(*) AS n FROM b JOIN hashed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
                                           / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)
        ), weights AS (
            SELECT doc_id, sum(gain) AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, len(w) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT)::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ), placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, (10 * count(*) OVER ()) // 100 AS most FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= most THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)
    """,
}
