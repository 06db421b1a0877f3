"""The operators on the test tables, and SQL for what SQL can say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotide.llm import (
    alignment,
    bpe,
    ctw,
    decontaminate,
    jaccard,
    near_dups,
    neighbours,
    phrases,
    repeats,
    rules,
    secrets,
    shards,
    urls,
)
from velotide.llm.common import prepare

QUERIES, ORACLE = {}, {}

#: Vocabulary files; their folder is on every machine.
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20


def query(oracle: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if oracle:
            ORACLE[build.__name__] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


URLS_SQL = """
WITH given(rule, host, path, action) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
patterns(word) AS (VALUES
  ('/ads-'), ('\\.ads-track\\.'), ('-track\\.'), ('/adserver([^a-z0-9_.%-]|$)'),
  ('\\.doubleclick\\.'), ('/banner([^a-z0-9_.%-]|$)'), ('/casino([^a-z0-9_.%-]|$)'),
  ('\\.casino\\.'), ('-casino\\.'), ('/porn([^a-z0-9_.%-]|$)'), ('/login([^a-z0-9_.%-]|$)'),
  ('/wp-login\\.php'), ('/cart([^a-z0-9_.%-]|$)'), ('/checkout([^a-z0-9_.%-]|$)'),
  ('\\.exe([^a-z0-9_.%-]|$)'), ('/tracking/pixel([^a-z0-9_.%-]|$)')),
cut AS (SELECT page_id, coalesce(url, '') AS url,
  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT row_number() OVER () AS n, page_id, url,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM cut),
fitting AS (SELECT n, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
  FROM parts JOIN given g ON (parts.host = g.host OR ends_with(parts.host, '.' || g.host))
    AND starts_with(parts.path, g.path)
  GROUP BY n),
listed AS (SELECT DISTINCT n FROM parts, patterns
  WHERE regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), word))
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN listed.n IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts LEFT JOIN fitting USING (n) LEFT JOIN listed USING (n)
"""

NEAR_DUPS_SQL = """
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (SELECT n, doc_id, CASE WHEN coalesce(len(words), 0) = 0 THEN []::VARCHAR[]
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
    END AS shingles FROM docs),
held AS (SELECT n, len(shingles) AS size, unnest(shingles) AS shingle FROM sets),
links AS (SELECT a.n AS u, b.n AS v FROM held a JOIN held b ON a.shingle = b.shingle AND a.n <> b.n
  GROUP BY a.n, b.n, a.size, b.size HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))),
reached(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
least AS (SELECT u AS n, min(doc_id) AS low FROM reached JOIN sets ON sets.n = v GROUP BY u)
SELECT doc_id, len(shingles) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sets LEFT JOIN least USING (n)
"""

#: Links at 80 hundredths in place of 75, and no choice of rows to keep.
JACCARD_SQL = NEAR_DUPS_SQL.replace("75 * (", "80 * (").replace(
    """ AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept""",
    " AS component_id",
)

PHRASES_SQL = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
total AS (SELECT lang, sum(len(words)) AS n FROM split GROUP BY lang),
placed AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM split, range(1, 6) s(size)),
grams AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM placed GROUP BY ALL HAVING count(*) >= 100),
cut AS (SELECT lang, size, phrase, f AS a, k, string_split(phrase, ' ') AS words
  FROM grams, range(1, 5) c(k) WHERE k < size),
parts AS (SELECT cut.*, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN total USING (lang)
  JOIN grams x ON x.lang = cut.lang AND x.phrase = array_to_string(words[1:k], ' ')
  JOIN grams y ON y.lang = cut.lang AND y.phrase = array_to_string(words[k + 1:], ' ')),
worst AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM worst w WHERE NOT EXISTS (FROM grams g WHERE g.lang = w.lang AND g.size > w.size
    AND contains(' ' || g.phrase || ' ', ' ' || w.phrase || ' ') AND 100 * g.f >= 100 * w.a)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n::BIGINT AS n, score FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""

ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _kind_sql(order: int, name: str, pattern: str, group: int) -> str:
    return f"""
  SELECT n, doc_id, source, {order} AS ord, '{name}' AS kind, i, gaps, wholes, values[i] AS value
  FROM (SELECT *, regexp_split_to_array(text, '{pattern}') AS gaps,
          regexp_extract_all(text, '{pattern}') AS wholes,
          regexp_extract_all(text, '{pattern}', {group}) AS values FROM docs), range(1, len(wholes) + 1) r(i)"""


SECRETS_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents),
matches AS ({
    " UNION ALL ".join(
        _kind_sql(*k)
        for k in [
            (0, "assign", ASSIGN, 2),
            (1, "access", "AKIA[A-Z0-9]+", 0),
            (2, "hex", "[0-9a-f]+", 0),
            (3, "opaque", "[A-Za-z0-9+/_-]+", 0),
        ]
    )
}),
placed AS (SELECT n, doc_id, source, ord, kind, value,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start,
    length(wholes[i]) AS size,
    regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AS mixed
  FROM matches
  WHERE length(value) >= [6, 20, 24, 24][ord + 1]),
owned AS (SELECT value, count(DISTINCT coalesce('=' || source, '-')) AS n_owners
  FROM placed WHERE ord < 3 OR mixed GROUP BY value),
once AS (SELECT value, text, min(doc_id) AS repo FROM placed JOIN docs USING (n, doc_id)
  WHERE ord < 3 OR mixed GROUP BY value, text),
held AS (SELECT value, count(DISTINCT coalesce('=' || repo, '-')) AS n_repos FROM once GROUP BY value),
verdicts AS (SELECT value, (n_owners > 2 AND n_repos > 10) OR n_repos > 1000 AS example
  FROM owned JOIN held USING (value)),
judged AS (SELECT *, mixed AND NOT example AS live FROM placed JOIN verdicts USING (value)
  WHERE ord < 3 OR (mixed AND NOT example)),
listed AS (SELECT n, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access,
    count(*) FILTER (ord = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord)
      FILTER (ord < 3) AS base,
    string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, ord) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example
  FROM judged GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN listed USING (n)
"""

SHARDS_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce('=' || doc_id, '-') || '|' || coalesce('=' || text, '-')), 1, 15))::BIGINT AS bits
  FROM documents),
bucket(depth, prefix) AS (
  SELECT 0, 0::BIGINT
  UNION ALL
  SELECT depth + 1, 2 * prefix + bit
  FROM bucket, (VALUES (0), (1)) b(bit)
  WHERE depth < 60 AND (SELECT sum(bytes) FROM hashed
                        WHERE bits >> (60 - depth) = prefix) > {SHARD_BYTES}),
leaf AS (SELECT * FROM bucket b
  WHERE NOT EXISTS (FROM bucket c WHERE c.depth = b.depth + 1 AND c.prefix >> 1 = b.prefix))
SELECT doc_id, bytes, depth::INTEGER AS depth,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard
FROM hashed JOIN leaf ON bits >> (60 - depth) = prefix
"""


@query(URLS_SQL)
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("n_candidates")


@query()
def op1_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


@query()
def op2_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return neighbours.classify(docs, labels)


@query()
def op4_cgk_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contaminations(docs, benchmark)


@query(NEAR_DUPS_SQL)
def op5_odd_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@query(SECRETS_SQL)
def op6_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query()
def op7_rlbwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"), passages=True)


@query()
def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


@query(SHARDS_SQL)
def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


@query()
def op10_bpe_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))


@query(JACCARD_SQL)
def op12_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"))


@query(PHRASES_SQL)
def op13_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
