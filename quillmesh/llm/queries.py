"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    conversations, filter_audit, language, line_dedup, mixing, ngram_join, packing, personal_data, quality, simhash,
    substrings, toxicity, va_search,
)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents")


def op1_source_mix(spark, sf_dir):
    return mixing.taken_words(mixing.mix(_documents(spark, sf_dir)))


def op2_exact_top_k(spark, sf_dir):
    return va_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_line_dedup(spark, sf_dir):
    return line_dedup.line_report(_documents(spark, sf_dir), exact_from=1)


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir))


def op5_quality_trees(spark, sf_dir):
    found = quality.judged(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.STATS, "base_failed", "score", "kept")


def op6_personal_data(spark, sf_dir):
    found = personal_data.find_personal_data(_documents(spark, sf_dir))
    counts = [f"n_{kind}" for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark, sf_dir):
    found = substrings.without_repeats(_documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash_near_dedup(spark, sf_dir):
    classes = simhash.simhash_classes(_documents(spark, sf_dir))
    return classes.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op10_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return language.predict(docs, language.learn(docs))


def op11_conversation_repair(spark, sf_dir):
    return conversations.report(_table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op13_ngram_join(spark, sf_dir):
    return ngram_join.ngram_classes(_documents(spark, sf_dir))


_ALL = (
    op1_source_mix, op2_exact_top_k, op3_line_dedup, op4_best_fit_packing, op5_quality_trees,
    op6_personal_data, op7_toxicity, op8_substring_dedup, op9_simhash_near_dedup, op10_language,
    op11_conversation_repair, op12_filter_audit, op13_ngram_join,
)


def queries() -> dict:
    return {query.__name__: query for query in _ALL}


def oracle_sql() -> dict:
    """Only what SQL answers over whole tables in a fair time; the rest has brute-force tests."""
    return {
        "op2_exact_top_k": """
            WITH vectors AS (
              SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
              FROM embeddings),
            scores AS (
              SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                     CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
              FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
              WHERE q.vec_id % 20 = 0),
            ranked AS (
              SELECT *, CAST(row_number() OVER (
                       PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM scores)
            SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
        "op12_filter_audit": r"""
            WITH RECURSIVE texts AS (
              SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
              FROM documents),
            judged AS (
              SELECT doc_id, part,
                     [len(words) < 200,
                      100 * len(list_distinct(words)) < 50 * len(words),
                      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
                      regexp_matches(t, '[#$%&*|]'),
                      coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)] AS fails
              FROM texts),
            marks AS (
              SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good,
                     coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
              FROM labels GROUP BY doc_id),
            groups AS (
              SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good,
                     coalesce(sum(toxic), 0) AS toxic
              FROM judged LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
            orders(o) AS (
              SELECT '' UNION ALL
              SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f)
              WHERE NOT contains(o, f)),
            steps AS (
              SELECT o AS filter_order, step, instr('ABCDE', substr(o, step, 1)) AS f,
                     [instr('ABCDE', substr(o, k, 1)) FOR k IN range(1, step)] AS earlier,
                     [k FOR k IN range(1, 6) IF k <> instr('ABCDE', substr(o, step, 1))] AS others
              FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) WHERE length(o) = 5),
            seen AS (
              SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS failed,
                     list_bool_or([false] || [fails[k] FOR k IN earlier]) AS gone,
                     list_bool_or([fails[k] FOR k IN others]) AS elsewhere
              FROM groups, steps),
            counted AS (
              SELECT part, filter_order, step, f,
                     sum(CASE WHEN failed OR gone THEN 0 ELSE n END) AS kept,
                     sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
                     sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant,
                     sum(CASE WHEN failed AND NOT elsewhere THEN n ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END) AS good_lost,
                     sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
              FROM seen GROUP BY part, filter_order, step, f)
            SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept,
                   CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
                   CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
                   CAST(toxic_lost AS BIGINT) AS toxic_lost,
                   CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
            FROM counted""",
        # By shingles in common; the query goes by groups of them.
        "op13_ngram_join": r"""
            WITH RECURSIVE words AS (
              SELECT row_number() OVER () AS row, doc_id,
                     regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
              FROM documents),
            sets AS (
              SELECT row, doc_id, list_sort(list_distinct(
                       CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                       ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END)) AS s
              FROM words),
            names AS (SELECT s, len(s) AS n, min(row) AS id FROM sets WHERE len(s) > 0 GROUP BY s),
            tokens AS (SELECT id, n, unnest(s) AS t FROM names),
            pairs AS (
              SELECT a.id AS a, b.id AS b
              FROM tokens a JOIN tokens b
                ON a.t = b.t AND a.id < b.id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
              GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
            sides AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
            reach(a, b) AS (
              SELECT id, id FROM names UNION
              SELECT reach.a, sides.b FROM reach JOIN sides ON sides.a = reach.b),
            roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
            placed AS (SELECT row, doc_id, sets.s, root FROM sets LEFT JOIN names USING (s) LEFT JOIN roots USING (id)),
            least AS (SELECT root, min(doc_id) AS component_id FROM placed WHERE root IS NOT NULL GROUP BY root)
            SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
                   CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id
            FROM placed LEFT JOIN least USING (root)""",
    }
