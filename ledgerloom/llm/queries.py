"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    centroids,
    counting,
    divergence,
    jaccard,
    language,
    mixing,
    packing,
    pages,
    quality,
    shards,
    simhash,
    substrings,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(_table(spark, sf_dir, "documents"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.write_and_read(_table(spark, sf_dir, "documents"), shards.new_folder(spark))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top(_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after edits that follow from its id and text."""
    documents = _table(spark, sf_dir, "documents")
    edits = counting.derived_edits(F.col("doc_id"), F.col("text"))
    return counting.edited_counts(documents.select("doc_id", "text", edits.alias("edits")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_language": op2_language,
        "op3_token_shards": op3_token_shards,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_mixing": op5_mixing,
        "op6_exact_top": op6_exact_top,
        "op7_packing": op7_packing,
        "op8_edited_counts": op8_edited_counts,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_main_text": op10_main_text,
        "op11_source_divergence": op11_source_divergence,
        "op12_centroids": op12_centroids,
        "op13_simhash": op13_simhash,
    }


_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SUBSTRINGS = f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents),
         p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
         x AS (SELECT doc_id, i, w[i] AS word,
                      CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win FROM p),
         c AS (SELECT *, CASE WHEN win IS NOT NULL THEN count(*) OVER (PARTITION BY win) END AS n FROM x),
         r AS (SELECT *, coalesce(max(n) OVER (PARTITION BY doc_id ORDER BY i
                      ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) > 1 AS gone FROM c),
         s AS (SELECT doc_id, count_if(gone) AS n_removed,
                      string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM r GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN s USING (doc_id)
"""

_MIX = f"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
                      md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(coalesce(strlen(source), -1) AS VARCHAR),
                                    coalesce(source, ''), coalesce(text, ''))) AS draw FROM documents),
         c AS (SELECT doc_id, source, draw, len({_WORDS.format(text="text")}) AS size,
                      strlen(regexp_replace(text, '[\\x09-\\x0D\\x20]', '', 'g')) AS seen,
                      strlen(regexp_replace(text, '[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]', '', 'g')) AS letters,
                      string_split(text, chr(10)) AS lines FROM d),
         q AS (SELECT doc_id, source, draw, size,
                      CASE WHEN seen = 0 THEN CAST(0.05 AS DOUBLE) ELSE greatest(CAST(0.05 AS DOUBLE),
                          letters / seen * len(list_distinct(lines)) / len(lines)) END AS quality FROM c),
         k AS (SELECT *, -ln((CAST(CAST('0x' || substr(md5(draw || ':0'), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))
                             / CAST(4503599627370496 AS DOUBLE)) / quality AS key FROM q),
         s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
         w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
                      CAST(3 * source_size AS DOUBLE) AS most FROM s),
         r AS (SELECT *, most / weight AS full_at,
                      (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / sum(weight) OVER onward AS rate
               FROM w WINDOW
                   before AS (ORDER BY most / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   onward AS (ORDER BY most / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
         t AS (SELECT source, source_size, least(most, coalesce(weight *
                      (SELECT rate FROM r WHERE rate <= full_at ORDER BY full_at, rate LIMIT 1), most)) AS target FROM r),
         x AS (SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY key, draw, doc_id
                      ROWS UNBOUNDED PRECEDING) - CAST(size AS DOUBLE) / 2 AS middle FROM k)
    SELECT x.doc_id, CAST(x.size AS BIGINT) AS size, t.source_size, t.target,
           CAST(CASE WHEN x.size = 0 THEN 0 ELSE x.size * (floor(t.target / t.source_size) + CASE WHEN
               x.middle <= t.target - floor(t.target / t.source_size) * t.source_size THEN 1 ELSE 0 END) END AS BIGINT) AS taken
    FROM x JOIN t ON x.source IS NOT DISTINCT FROM t.source
"""

_TOP = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings
               WHERE embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id,
                      CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
               FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 5
"""

_NEAR = f"""
    WITH RECURSIVE d AS (SELECT doc_id, coalesce({_WORDS.format(text=_LOWER)}, []) AS w FROM documents),
         s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
                      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
         p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met
               FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
         l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
               WHERE 100 * met >= 75 * (na.n + nb.n - met)),
         r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
    FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

_DIVERGENCE = r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
         g AS (SELECT DISTINCT lang, source FROM d),
         o AS (SELECT doc_id, lang, source, unnest(w) AS term FROM d),
         k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
         s AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
         c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
         t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
         p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
                      1 + 1000000000 * (coalesce(c.n, 0) + 5) // (t.total + 5 * s.v) AS p,
                      1 + 1000000000 * (k.n + 5) // (s.total + 5 * s.v) AS q
               FROM t JOIN s USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
         x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
         f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
               FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                    LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
               UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
         r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM f)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM r WHERE part = 'pair' OR rank <= 50
"""


def _centroid_sql(rounds: int = 5) -> str:
    """Rounds spelled out one after the other; ``v`` has a row number, so that repeated ids are told apart."""
    parts = [
        """WITH v AS MATERIALIZED (
               SELECT row_number() OVER () AS id, vec_id,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings WHERE len(embedding) = 64
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
           c0 AS MATERIALIZED (
               SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) - 1 AS cluster, e AS c
               FROM v QUALIFY cluster < 40)"""
    ]
    for step in range(rounds + 1):
        parts.append(
            f"""a{step} AS MATERIALIZED (
               SELECT v.id, v.vec_id, v.e, c.cluster,
                      CAST(list_sum(list_transform(list_zip(v.e, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
               FROM v CROSS JOIN c{step} c QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY distance, c.cluster) = 1)"""
        )
        if step < rounds:
            parts.append(
                f"""s{step} AS MATERIALIZED (
               SELECT cluster, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
               FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM a{step}) GROUP BY cluster, place),
           c{step + 1} AS MATERIALIZED (
               SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{step} c
               LEFT JOIN (SELECT cluster, list(x ORDER BY place) AS c FROM s{step} GROUP BY cluster) m USING (cluster))"""
            )
    parts.append(
        f"""t AS (SELECT cluster, sum(distance) AS inertia FROM a{rounds} GROUP BY cluster)"""
    )
    return (
        ", ".join(parts)
        + f"""
    SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance, CAST(t.inertia AS BIGINT) AS cluster_inertia,
           CAST((SELECT sum(inertia) FROM t) AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN t USING (cluster) JOIN c{rounds} c USING (cluster)
"""
    )


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL; the other operators learn a model, encode tokens, make other hashes or parse HTML."""
    return {
        "op4_substring_dedup": _SUBSTRINGS,
        "op5_mixing": _MIX,
        "op6_exact_top": _TOP,
        "op9_near_duplicates": _NEAR,
        "op11_source_divergence": _DIVERGENCE,
        "op12_centroids": _centroid_sql(),
    }
