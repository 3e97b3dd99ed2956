"""The thin queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import bpe, decontaminate, erasure, exact_dedup, html_extract, jaccard_join, line_dedup, packing, quality, substring_dedup, suffix_dedup, toxicity, vector_codes
from skyledger.llm._spark import table
from skyledger.session import ship


def vocabulary() -> str:
    """The rank file of the production tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), ship(spark), pct=90, size=3)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ship(spark))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ship(spark))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(ship(spark), sf_dir, "pages"))


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_tokens(table(ship(spark), sf_dir, "documents"), vocabulary()))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), ship(spark), keep_text=False)


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(ship(spark), sf_dir, "documents"), vocabulary(), keep=())


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ship(spark))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), ship(spark), keep_bytes=False)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"), ship(spark), keep_text=False)


def op12_cascading_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return erasure.cascading_erasure(*(table(spark, sf_dir, t) for t in ("clients", "clicks", "sales", "sale_lines")), ship(spark))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"), ship(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_exact_dedup, op2_ngram_jaccard_join, op3_benchmark_decontamination, op4_toxicity, op5_html_extraction,
        op6_token_id_output, op7_substring_dedup, op8_byte_level_bpe, op9_quality_classifier, op10_suffix_array_dedup,
        op11_line_dedup, op12_cascading_erasure, op13_vector_codes,
    )
    return {f.__name__: f for f in found}


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP2_SQL = r"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[k : k + least(3, len(w)) - 1], ' ') AS s, least(3, len(w)) AS m FROM doc, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS t(k) WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
class AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS rep FROM (SELECT g.doc_id, string_agg(s, chr(0) ORDER BY s) || m AS text FROM grams g GROUP BY g.doc_id, m)),
one AS MATERIALIZED (SELECT g.* FROM grams g JOIN class c ON c.doc_id = g.doc_id AND c.rep = g.doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM one a JOIN one b ON a.s = b.s AND a.m = b.m AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a AS node, a AS low FROM edge UNION SELECT e.b, r.low FROM reach r JOIN edge e ON e.a = r.node WHERE r.low < e.b),
least_ AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(coalesce(l.low, c.rep, d.doc_id) AS BIGINT) AS component_id
FROM doc d LEFT JOIN size USING (doc_id) LEFT JOIN class c USING (doc_id) LEFT JOIN least_ l ON l.node = c.rep
"""

OP3_SQL = r"""
WITH item AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item, item_id, k AS q, least(13, len(w)) AS m, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item, item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
spot AS (
  SELECT d.doc_id, p.m, k, array_to_string(d.w[k : k + p.m - 1], ' ') AS s
  FROM doc d, (SELECT DISTINCT m FROM windows) p, unnest(range(1, len(d.w) - p.m + 2)) AS t(k)),
hit AS (SELECT s.doc_id, s.k, s.m, x.item_id, x.item, s.k - x.q AS diagonal FROM spot s JOIN windows x USING (m, s)),
marks AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (WHERE item_id IS NOT NULL)) AS items FROM hit GROUP BY doc_id),
island AS (SELECT doc_id, m, k, item, diagonal, k - row_number() OVER (PARTITION BY doc_id, item, diagonal ORDER BY k) AS part FROM hit),
matched AS (SELECT doc_id, count(*) + any_value(m) - 1 AS n, min(k) - 1 AS place FROM island GROUP BY doc_id, item, diagonal, part),
best AS (SELECT doc_id, max(n) AS longest, arg_min(place, ROW(-n, place)) AS longest_at FROM matched GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(longest_at AS BIGINT) AS longest_at
FROM doc d LEFT JOIN marks USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""

OP7_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k : k + 12], ' ') AS s FROM doc, unnest(range(1, len(w) - 11)) AS t(k)),
dup AS (SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(k, k + 13)) AS p FROM dup) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM doc d LEFT JOIN gone USING (doc_id)
"""

OP10_SQL = r"""
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, k, substr(h, 2 * k + 1, 200) AS s FROM doc, unnest(range(0, n - 99)) AS t(k)),
dup AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) AS i FROM win) WHERE i > 1),
step AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM dup),
span AS (SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS part FROM step),
run AS (SELECT doc_id, min(k) AS a, max(k) + 100 AS b FROM span GROUP BY doc_id, part),
gap AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM run UNION ALL SELECT doc_id, 0, min(a) FROM run GROUP BY doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * g.a + 1, 2 * (coalesce(g.b, n) - g.a)), '' ORDER BY g.a) AS h FROM gap g JOIN doc USING (doc_id) GROUP BY g.doc_id),
total AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM doc d LEFT JOIN total USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


OP11_SQL = r"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT doc_id, k, l[k] AS line, translate(trim(l[k], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM doc, unnest(range(1, len(l) + 1)) AS t(k)),
repeated AS (SELECT key, max(doc_id) AS top FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, k, line, r.key IS NOT NULL AND doc_id <> top AS gone FROM line LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _op13_sql(rounds: int = 4) -> str:
    """Rounds of assigning and moving, as a chain of tables; doubles hold all numbers exactly."""
    near = """a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, x, arg_min(k, ROW(d, k)) AS k, min(d) AS d FROM (
    SELECT v.*, c.k, list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, c.x) + list_dot_product(c.x, c.x) AS d FROM part v JOIN c{k} c USING (part)
  ) GROUP BY vec_id, label, part, x)"""
    move = """m{k} AS (SELECT part, k, list(floor(s / n) ORDER BY i) AS x FROM (SELECT part, k, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY part, k, i) GROUP BY part, k),
c{j} AS MATERIALIZED (SELECT c.part, c.k, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m USING (part, k))"""
    steps = ",\n".join(x for k in range(rounds) for x in (near.format(k=k), move.format(k=k, j=k + 1)))
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM kept, unnest(range(4)) AS t(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS k, x FROM part QUALIFY k < 256),
{steps},
{near.format(k=rounds)},
coded AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', k), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, k)) FROM c{rounds}) AS codebooks_sha256
FROM coded
"""


OP13_SQL = _op13_sql()


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op2_ngram_jaccard_join": OP2_SQL, "op3_benchmark_decontamination": OP3_SQL, "op7_substring_dedup": OP7_SQL, "op10_suffix_array_dedup": OP10_SQL, "op11_line_dedup": OP11_SQL, "op13_vector_codes": OP13_SQL}
