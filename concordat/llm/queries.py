"""The text operators as named queries over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.byte_bpe import encode_digests, spec_from_file, spec_from_ranks
from concordat.llm.collocations import mine_phrases
from concordat.llm.common import table
from concordat.llm.content_sort import exact_duplicates
from concordat.llm.fingerprints import fingerprint_documents
from concordat.llm.line_runs import drop_repeated_runs
from concordat.llm.ngram_join import join_alike
from concordat.llm.packing import pack
from concordat.llm.scalar_tables import cluster_vectors
from concordat.llm.secret_owners import find_secrets
from concordat.llm.shards import assign_shards
from concordat.llm.site_quality import judge_quality
from concordat.llm.suffix_dedup import remove_repeats
from concordat.llm.url_rules import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_multiset_hash(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op2_content_sort(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op2_content_sort"] = r"""
WITH keyed AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY body) AS group_size,
           first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id
    FROM keyed
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM ranked
"""


@query
def op3_line_runs(spark, sf_dir):
    docs = drop_repeated_runs(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_removed", "n_runs", "text")


ORACLE["op3_line_runs"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents
), windows AS (
    SELECT doc_id, n, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS body
    FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY n)
), ranked AS (
    SELECT doc_id, n, row_number() OVER (PARTITION BY body ORDER BY doc_id, n) AS nth
    FROM windows WHERE body IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, n + k AS n FROM ranked, (VALUES (0), (1), (2)) AS t(k) WHERE nth > 1
), marked AS (
    SELECT l.doc_id, l.n, l.line, g.n IS NOT NULL AS removed,
           g.n IS NOT NULL AND lag(g.n) OVER (PARTITION BY l.doc_id ORDER BY l.n) IS NULL AS opens
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n
)
SELECT doc_id, count(*)::INTEGER AS n_lines, (count(*) FILTER (removed))::INTEGER AS n_removed,
       (count(*) FILTER (opens))::INTEGER AS n_runs,
       coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT removed), '') AS text
FROM marked GROUP BY doc_id
"""


@query
def op4_prefix_sums(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), 24)


@query
def op5_site_bayes(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return judge_quality(docs, labels)


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op6_rule_sweep(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLE["op6_rule_sweep"] = r"""
WITH parts AS (
    SELECT page_id, url,
           translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%'
            THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%'
            THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/'
        END AS rule
    FROM parts
)
SELECT *, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END
    AS verdict
FROM ruled
"""


def rank_spec() -> str:
    """The byte-level tokenizer of the installed public rank file."""
    import public_tokenizers

    return spec_from_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def file_spec() -> str:
    """The byte-level tokenizer of the installed public JSON file."""
    import public_tokenizers

    return spec_from_file(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_byte_bpe(spark, sf_dir):
    return encode_digests(table(spark, sf_dir, "documents"), rank_spec())


@query
def op8_grouping_genetic(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), file_spec())


@query
def op9_induced_sort(spark, sf_dir):
    docs = remove_repeats(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "repeats.*")


@query
def op10_prefix_tree(spark, sf_dir):
    return join_alike(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op11_scalar_tables(spark, sf_dir):
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _rounds_sql(k: int, rounds: int) -> str:
    """k-means in plain SQL: a chain of assignments and floored means."""
    steps = [
        """whole AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        )""",
        f"""centre_0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v
            FROM whole ORDER BY cluster LIMIT {k}
        )""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""placed_{i} AS MATERIALIZED (
            SELECT n, any_value(vec_id) AS vec_id, any_value(v) AS v,
                   arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
            FROM (SELECT w.n, w.vec_id, w.v, c.cluster, CAST(list_sum(list_transform(
                      list_zip(w.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
                  FROM whole w, centre_{i} c) GROUP BY n
        )"""
        )
        if i < rounds:
            steps.append(
                f"""centre_{i + 1} AS MATERIALIZED (
            WITH sums AS (
                SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS m
                FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM placed_{i})
                GROUP BY cluster, d
            ), means AS (
                SELECT cluster, list((s - ((s % m) + m) % m) // m ORDER BY d) AS v
                FROM sums GROUP BY cluster
            )
            SELECT c.cluster, coalesce(m.v, c.v) AS v
            FROM centre_{i} c LEFT JOIN means m ON c.cluster = m.cluster
        )"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(p.cluster AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY p.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM placed_{rounds} p JOIN centre_{rounds} c ON p.cluster = c.cluster"""


ORACLE["op11_scalar_tables"] = _rounds_sql(8, 10)


@query
def op12_de_bruijn(spark, sf_dir):
    return mine_phrases(table(spark, sf_dir, "documents"))


ORACLE["op12_de_bruijn"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), runs AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM worded, (VALUES (1), (2), (3), (4)) AS t(k))
), counted AS (
    SELECT lang, k, gram, count(*) AS a FROM runs GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, gram, a, string_split(gram, ' ') AS w FROM counted WHERE k > 1 AND a >= 30
), held AS (
    SELECT lang, part, max(a) AS held
    FROM (SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS part
          FROM (SELECT *, unnest(range(1, k - j + 2)) AS i
                FROM candidates, (VALUES (2), (3)) AS t(j) WHERE j < k))
    GROUP BY lang, part
), kept AS (
    SELECT c.* FROM candidates c LEFT JOIN held h ON h.lang = c.lang AND h.part = c.gram
    WHERE 100 * CAST(coalesce(h.held, 0) AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)
), cuts AS (
    SELECT lang, gram, a, j, array_to_string(w[1:j], ' ') AS lpart, array_to_string(w[j + 1:], ' ') AS rpart
    FROM kept, (VALUES (1), (2), (3)) AS t(j) WHERE j < k
), scored AS (
    SELECT c.lang, c.gram, c.a, c.j, l.a AS l, r.a AS r,
           CAST(2000000 * CAST(c.a AS HUGEINT) // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
    FROM cuts c JOIN counted l ON l.lang = c.lang AND l.gram = c.lpart
                JOIN counted r ON r.lang = c.lang AND r.gram = c.rpart
), least AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank
    FROM least
)
SELECT s.lang, rank, gram AS phrase, a, l, r, t.n, score
FROM ranked s JOIN totals t ON t.lang = s.lang WHERE rank <= 2000
"""


@query
def op13_ownership_frequency(spark, sf_dir):
    """A document's source is the owner, its languages are the owner's repositories."""
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, F.struct("source", "lang"), F.col("source"))


ORACLE["op13_ownership_frequency"] = r"""
WITH kinds(kind, name, pattern, least) AS (VALUES
    (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 20),
    (2, 'hex', '[0-9a-f]+', 24),
    (3, 'owned', '[A-Za-z0-9+/_.=-]+', 12)
), cut AS (
    SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), matches AS (
    SELECT doc_id, source, 0 AS kind, unnest(regexp_extract_all(text, (SELECT pattern FROM kinds WHERE kind = 0))) AS m,
           unnest(string_split_regex(text, (SELECT pattern FROM kinds WHERE kind = 0))[:-2]) AS gap,
           generate_subscripts(regexp_extract_all(text, (SELECT pattern FROM kinds WHERE kind = 0)), 1) AS i FROM cut
    UNION ALL
    SELECT doc_id, source, 1, unnest(regexp_extract_all(text, 'AKIA[A-Z0-9]+')),
           unnest(string_split_regex(text, 'AKIA[A-Z0-9]+')[:-2]),
           generate_subscripts(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), 1) FROM cut
    UNION ALL
    SELECT doc_id, source, 2, unnest(regexp_extract_all(text, '[0-9a-f]{24,}')),
           unnest(string_split_regex(text, '[0-9a-f]{24,}')[:-2]),
           generate_subscripts(regexp_extract_all(text, '[0-9a-f]{24,}'), 1) FROM cut
    UNION ALL
    SELECT doc_id, source, 3, unnest(regexp_extract_all(text, '[A-Za-z0-9+/_.=-]{12,}')),
           unnest(string_split_regex(text, '[A-Za-z0-9+/_.=-]{12,}')[:-2]),
           generate_subscripts(regexp_extract_all(text, '[A-Za-z0-9+/_.=-]{12,}'), 1) FROM cut
), placed AS (
    SELECT doc_id, source, kind, m,
           sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
    FROM matches
), valued AS (
    SELECT p.doc_id, p.source, p.kind, k.name, CAST(stop - length(m) AS BIGINT) AS start,
           CAST(stop AS BIGINT) AS stop,
           CASE WHEN p.kind = 0 THEN regexp_extract(m, k.pattern, 2) ELSE m END AS value
    FROM placed p JOIN kinds k ON k.kind = p.kind
    WHERE length(CASE WHEN p.kind = 0 THEN regexp_extract(m, k.pattern, 2) ELSE m END) >= k.least
), base AS (
    SELECT * FROM valued WHERE kind < 3
), spans AS (
    SELECT * FROM base
    UNION ALL
    SELECT * FROM valued t WHERE kind = 3 AND regexp_matches(value, '[0-9]')
        AND regexp_matches(value, '[A-Za-z]') AND NOT EXISTS (
            SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.start < t.stop AND t.start < b.stop)
), judged AS (
    SELECT value, CASE
        WHEN count(DISTINCT coalesce(source, chr(0))) >= 2 THEN 'example'
        WHEN bool_or(kind < 3) OR (length(value) >= 20 AND len(list_distinct(string_split(value, ''))) >= 10
            AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')) THEN 'live'
        ELSE 'plain' END AS verdict
    FROM spans GROUP BY value
), kept AS (
    SELECT s.*, verdict, name || ':' || start || ':' || stop AS told
    FROM spans s JOIN judged j ON j.value = s.value WHERE kind < 3 OR verdict = 'live'
), told AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
           count(*) FILTER (kind = 2) AS n_hex,
           string_agg(told, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
           string_agg(told, ',' ORDER BY start, kind) AS spans,
           count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
    FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id
"""
