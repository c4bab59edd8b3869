"""The registered queries of the operators, and those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .codes import ENTRIES, PARTS, ROUNDS, SCALE, code_vectors
from .common import table
from .exact import exact_duplicates
from .extract import extract_main_text
from .gru import identify_language
from .imatch import fingerprint_edits
from .jaccard import near_duplicates
from .lines import dedup_lines
from .mixing import mix_sources
from .phrases import collocations
from .piece import piece_digests
from .shards import shard_by_bytes
from .warc import pages_to_warc


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, n_chars and the digest of the text that is left."""
    left = dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_to_warc(table(spark, sf_dir, "pages"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_vectors(table(spark, sf_dir, "embeddings")).drop("label")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_html, op2_lines, op3_mixing, op4_warc, op5_imatch, op6_ngram_jaccard, op7_sharding, op8_language_id, op9_exact_dedup, op10_bpe,
        op11_sentencepiece, op12_vector_codes, op13_collocations,
    )
    return {f.__name__: f for f in named}


OP3 = r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS w, 2.0::DOUBLE * source_size AS most
    FROM sources),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY most / w, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER (ORDER BY most / w, source IS NULL, encode(source)) AS k
    FROM weighed),
targets AS (
    SELECT source, source_size, coalesce(least(most, w * (SELECT arg_min(level, k) FROM levels WHERE level * w <= most)), most) AS target FROM levels),
laid AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS a FROM sized)
SELECT doc_id, l.source, size, source_size, target,
    CAST(greatest(0, least(a + size, floor(target)) - a) + greatest(0, least(a + size, floor(target) - source_size) - a) AS BIGINT) AS taken
FROM laid l JOIN targets t ON l.source IS NOT DISTINCT FROM t.source
"""

OP9 = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (
    SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY norm) AS group_size
    FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


OP13 = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09.,;:!?\x0A-\x0D]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, n AS size FROM places, range(1, 4) g(n) WHERE i + n - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, phrase, any_value(size) AS size, count(*) AS f FROM grams GROUP BY lang, phrase),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 10),
inside AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE size = 3),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY lang, phrase),
stay AS (SELECT c.* FROM candidates c LEFT JOIN covers v ON v.lang = c.lang AND v.phrase = c.phrase WHERE v.longer IS NULL OR 100 * v.longer < 50 * c.a),
cuts AS (
    SELECT s.lang, s.phrase, s.a, k, x.f AS l, y.f AS r, (1000000 * s.a::HUGEINT * s.a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM stay) s
    JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (SELECT lang, phrase, any_value(a) AS a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, CAST(min(score) AS BIGINT) AS score FROM cuts GROUP BY lang, phrase),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def _op12() -> str:
    """Rounds of Lloyd, one after another: each assigns all parts and replaces the entries that are used."""
    away = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS place,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT vec_id, label, place, p, v[(p * len(v)) // {PARTS} + 1:((p + 1) * len(v)) // {PARTS}] AS x FROM kept, range({PARTS}) r(p)),
book0 AS MATERIALIZED (SELECT p, place - 1 AS e, x AS c FROM parts WHERE place <= {ENTRIES})"""
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
    SELECT place, any_value(vec_id) AS vec_id, any_value(label) AS label, parts.p, any_value(x) AS x, min((away, e)) AS best
    FROM (SELECT parts.*, e, {away} AS away FROM parts JOIN book{k} b ON b.p = parts.p) parts GROUP BY place, parts.p)""")
        if k < ROUNDS:
            steps.append(f"""sums{k} AS (
    SELECT p, e, i, CAST(sum(y) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT p, best[2] AS e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{k}) GROUP BY p, e, i),
book{k + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(u.c, b.c) AS c
    FROM book{k} b LEFT JOIN (SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM sums{k} GROUP BY p, e) u ON u.p = b.p AND u.e = b.e)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (
    SELECT any_value(vec_id) AS vec_id, any_value(label) AS label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY place)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3, "op9_exact_dedup": OP9, "op12_vector_codes": _op12(), "op13_collocations": OP13}
