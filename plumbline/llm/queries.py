"""The operators as named queries on the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    class_lm, decontaminate, hard_negatives, langid, licenses, near_dup, packing, prefix_trie, sharding, token_count, top_k, url_rules, warc,
)
from plumbline.llm.stored import small_batches

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in pieces of 2048 tokens and of the lower powers of two."""
    return packing.digest(packing.pieces(_table(spark, sf_dir, "documents")))


def op2_class_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram scores of all documents, learned from those whose remainder by 5 is not 1."""
    docs = _table(spark, sf_dir, "documents")
    scored = class_lm.score(docs, docs.filter(langid.remainder("doc_id", 5) != 1))
    return scored.select(
        "doc_id", (langid.remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those whose remainder by 4 is not 2."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(langid.remainder("doc_id", 4) != 2))
    found = langid.predict(docs, model)
    return found.select("doc_id", (langid.remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match tokens of all documents over a public vocabulary."""
    return token_count.count(_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark matches of all documents in windows of 13 words."""
    return decontaminate.digest(decontaminate.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: 3-word runs, similarity 0.85 or more."""
    small_batches(spark)
    return near_dup.link(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; the lists are joined for comparison with SQL."""
    found = licenses.recognise(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), "status")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in random order over 16 shards whose counts differ by one at most."""
    return sharding.digest(sharding.shuffle(_table(spark, sf_dir, "documents"), shards=16))


# The rules of the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    rules = spark.createDataFrame(URL_RULES, url_rules.SCHEMA)
    return url_rules.judge(_table(spark, sf_dir, "pages"), rules)


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt to share turns with the first of its hundred."""
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives near the positives of every vector whose id is divisible by 100, with a seventh of the labels moved."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records, written, read back and assembled to captures."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_class_lm_scores": op2_class_lm_scores,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_sharding": op8_sharding,
    "op9_url_filter": op9_url_filter,
    "op10_top_k_search": op10_top_k_search,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_warc": op13_warc,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEXT = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORDS = f"regexp_extract_all({_TEXT}, " + r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = f"regexp_extract_all({_TEXT}, " + r"'[^\x20\x09-\x0D]+')"


def _license_sql() -> str:
    """Sentences, identifiers and ordered rules of the licence scan in SQL."""
    known, names = list(licenses.SENTENCES.values()), list(licenses.SENTENCES)
    rest, took = "rest", []
    for run, name in licenses.RULES:
        mark = "".join(f"|{names.index(i)}|" for i in run)
        took.append(f"CASE WHEN contains({rest}, '{mark}') THEN '{name}' END")
        rest = f"replace({rest}, '{mark}', ' ')"
    marked = f"regexp_replace(coalesce(text, ''), '{licenses.SENTENCE_END}', chr(10) || '\\1', 'g')"
    normal = (
        f"regexp_replace(regexp_replace(translate(x, '{_UPPER}', '{_LOWER}'), '{licenses.OTHER}', ' ', 'g'), "
        f"'{licenses.EDGE}', '', 'g')"
    )
    return f"""
        WITH s AS (
            SELECT doc_id, list_filter(list_transform(list_transform(string_split_regex({marked}, '{licenses.LINE}'),
                lambda x: {normal}), lambda y: list_position({known}, y)), lambda i: coalesce(i, 0) > 0) AS n
            FROM documents),
        r AS (SELECT doc_id, n, array_to_string(list_transform(n, lambda i: '|' || (i - 1) || '|'), '') AS rest FROM s),
        t AS (SELECT doc_id, n, list_sort(list_distinct(list_filter([{", ".join(took)}], lambda x: x IS NOT NULL))) AS given,
               CASE WHEN len(n) = 0 THEN 'none' WHEN trim({rest}) = '' THEN 'recognised' ELSE 'unclear' END AS status
              FROM r)
        SELECT doc_id, coalesce(array_to_string(list_transform(n, lambda i: {names}[i]), ','), '') AS sentence_ids,
               coalesce(array_to_string(CASE WHEN len(given) > 1 THEN list_filter(given, lambda x: x <> '{licenses.LAST_RESORT}')
                   ELSE given END, ','), '') AS licenses, status
        FROM t"""


#: crc32 of a decimal number's digits, bit by bit: each byte joins the remainder, and eight steps follow.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), "
    "lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda r, v: xor(xor(r, v) >> 1, (xor(r, v) & 1) * 3988292384)), 4294967295)"
)
#: Base32 of a SHA-1 in hexadecimal digits, five of which are four letters.
_BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '')"
)

_REST = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"

ORACLES: dict[str, str] = {
    "op5_benchmark_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM bw),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
        hits AS (
            SELECT doc_id, i, p.n, item_id
            FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM places) p
            JOIN windows v ON v.n = p.n AND v.k = p.k),
        words_hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
        runs AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY 1),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM runs a JOIN runs b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
        reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
        least AS (SELECT doc_id, min(other) AS component FROM reach GROUP BY 1)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
               coalesce(component, d.doc_id) = d.doc_id AS kept
        FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)""",
    "op7_license_scan": _license_sql(),
    "op9_url_filter": f"""
        WITH p AS (
            SELECT page_id, lower(regexp_extract({_REST}, '^[^/?#]*')) AS host, regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        r(h, p, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        m AS (
            SELECT page_id, max_by(h || p, length(h) * 1000 + length(p)) AS rule, max_by(v, length(h) * 1000 + length(p)) AS verdict
            FROM (SELECT page_id, h, r.p AS p, v FROM p, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p))
            GROUP BY 1)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op10_top_k_search": """
        WITH e AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM embeddings),
        v AS (
            SELECT r, vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS c
            FROM (SELECT r, vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM e)),
        s AS (
            SELECT q.r AS own, q.vec_id AS query_id, c.r AS r, c.vec_id AS vec_id, CAST(sum(q.c * c.c) AS BIGINT) AS score
            FROM v q JOIN v c ON q.i = c.i AND q.r <> c.r WHERE q.vec_id % 50 = 0 GROUP BY 1, 2, 3, 4)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op11_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id, length(r) || ':' || r || x AS turn, length(x) AS size,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) - 1 AS i
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
        ids AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
        joined AS (
            SELECT ids.conv_id, 0 AS side, i, turn, size FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 100 AND i < h
            UNION ALL SELECT conv_id, 1, i, turn, size FROM t JOIN ids USING (conv_id) WHERE i >= h),
        seq AS (
            SELECT conv_id, coalesce(turns, []) AS turns, coalesce(sizes, []) AS sizes
            FROM ids LEFT JOIN (
                SELECT conv_id, list(md5(turn) ORDER BY side, i) AS turns, list(size ORDER BY side, i) AS sizes FROM joined GROUP BY 1) USING (conv_id)),
        member AS (
            SELECT conv_id, d, array_to_string(turns[1:d], '') AS k, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(turns) AS ends
            FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM seq)),
        node AS (
            SELECT k, d, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM member GROUP BY k, d),
        child AS (SELECT left(k, 32 * (d - 1)) AS k, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
        full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (k, d)),
        below AS (
            SELECT left(k, 32 * u) AS k, u AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * size) AS saved
            FROM (SELECT *, unnest(range(d + 1)) AS u FROM full_node) GROUP BY 1, 2)
        SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, a.ends_sha256
        FROM full_node a JOIN below USING (k, d) LEFT JOIN node p ON p.k = left(a.k, 32 * (a.d - 1)) AND p.d = a.d - 1""",
    "op12_hard_negatives": """
        WITH r AS (
            SELECT vec_id, row_number() OVER () AS row, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
                   CAST(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
            FROM r a JOIN r b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS n FROM s WHERE same)
            WHERE n <= 5),
        h AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id, s.row) AS rank
            FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM h WHERE rank <= 5""",
    "op13_warc": f"""
        WITH d AS (
            SELECT page_id, octet_length(encode(x)) AS payload_bytes, sha1(x) AS h, min(page_id) OVER (PARTITION BY x) AS first
            FROM (SELECT page_id, coalesce(html, '') AS x FROM pages))
        SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to, CAST(1 AS INTEGER) AS n_requests
        FROM d""",
}
