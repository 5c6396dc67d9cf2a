"""The registered queries of the operators, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logmetrics.llm import (
    alignment, decontamination, html, licences, line_dedup, pieces, quality_rules, similarity, spelling, tokens, toxicity, warc, weak_quality,
)
from logmetrics.llm.text import read


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(key: str = "doc_id"):
    """Is the row kept out of training? A row without key is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return weak_quality.score(docs, weak_quality.fit(docs)).withColumn("kept", F.col("score") >= 0.5)


def captures(pages: DataFrame) -> DataFrame:
    """Capture records from ``pages``: a full response and a later not-modified revisit for each.

    A third of the pages stand for their host's front page, so that URLs repeat. Some
    revisits come too early, name another or a weak entity tag, or no validator.
    """
    base = pages.select(
        "page_id", F.md5("html").alias("digest"), F.expr("page_id * 7919 % 7776000").alias("sec"),
        F.expr("CASE WHEN page_id % 3 = 0 THEN concat('http://', regexp_extract(url, '^https?://([^/?#]+)', 1), '/') ELSE url END").alias("url"),
    ).withColumn("tag", F.expr("concat('\"', substr(digest, 1, 8), '\"')"))
    at = lambda sec: F.timestamp_seconds(F.lit(1704067200) + F.expr(sec))
    text = "map<string,string>"
    response = base.select(
        F.expr("page_id * 2").alias("record_id"), "url", at("sec").alias("ts"), F.lit(200).alias("status"),
        F.expr("map('Content-Type', 'text/html', 'ETag', tag, 'Last-Modified', concat('T', sec), 'Date', concat('D', sec))").cast(text).alias("headers"),
        "digest",
    )
    later = "sec + CASE WHEN page_id % 13 = 0 THEN -3600 ELSE 3600 * (1 + page_id % 50) END"
    revisit = base.withColumn("later", F.expr(later)).select(
        F.expr("page_id * 2 + 1").alias("record_id"), F.expr("replace(url, 'http://', 'HTTPS://')").alias("url"), at("later").alias("ts"),
        F.lit(304).alias("status"),
        F.expr("""map_filter(map(
            'etag', CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 5 = 0 THEN concat('W/', tag) ELSE tag END,
            'Last-Modified', CASE WHEN page_id % 11 = 0 THEN NULL ELSE concat('T', sec) END,
            'Expires', concat('E', later), 'X-Server', 'a'), (k, v) -> v IS NOT NULL)""").cast(text).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.unionByName(revisit)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(captures(read(spark, sf_dir, "pages")))
    none = lambda c: F.coalesce(c, F.lit(""))
    header = lambda name: none(F.col("headers")[name]).alias(name.replace("-", "_"))
    return found.select(
        "record_id", none(F.col("url_key")).alias("url_key"), F.coalesce("response_id", F.lit(-1)).cast("bigint").alias("response_id"),
        none(F.col("digest")).alias("digest"), "outcome", F.coalesce(F.size("headers"), F.lit(-1)).cast("bigint").alias("n_headers"),
        header("etag"), header("last-modified"), header("expires"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), verify=True)
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), F.size("matches").cast("bigint").alias("n_matches"), "n_sentences")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=90)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, read(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "content_share")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score_links(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), digest=True)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_licence_scan": op6_licence_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontamination": op9_decontamination,
    "op10_html_text": op10_html_text,
    "op11_token_alignment": op11_token_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

# Words of a text in lower case, for DuckDB.
_WORDS9 = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES: dict[str, str] = {
    "op7_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM w WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
        ),
        sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT sides.b, reach.c FROM reach JOIN sides ON reach.v = sides.a)
        SELECT v AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
        FROM reach LEFT JOIN n ON n.doc_id = v GROUP BY v""",
    "op4_warc_revisits": r"""
        WITH p AS (
            SELECT page_id, md5(html) AS digest, page_id * 7919 % 7776000 AS sec,
                   CASE WHEN page_id % 3 = 0 THEN 'http://' || regexp_extract(url, '^https?://([^/?#]+)', 1) || '/' ELSE url END AS url
            FROM pages
        ),
        q AS (SELECT *, '"' || substr(digest, 1, 8) || '"' AS tag FROM p),
        cut AS (
            SELECT *, trim(url) AS t,
                   regexp_extract(trim(url), '^(?i:https?)://(?:[^/?#@]*@)?(?:(?i:www)\.)?([^/?#]+)', 1) AS host,
                   regexp_replace(regexp_replace(trim(url), '^(?i:https?)://[^/?#]*', ''), '#.*$', '') AS rest
            FROM q
        ),
        keyed AS (
            SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT
                       regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|phpsessid|jsessionid|sid|ref)='))), '&') AS args
            FROM cut
        ),
        k AS (
            SELECT page_id, digest, sec, tag, CASE WHEN host = '' THEN t ELSE
                regexp_replace(lower(host), '(:80|:443|\.)+$', '') || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '')
                || CASE WHEN args = '' THEN '' ELSE '?' || args END END AS url_key
            FROM keyed
        ),
        r AS (
            SELECT url_key, sec, max(page_id * 2) AS response_id, arg_max(digest, page_id) AS digest, arg_max(tag, page_id) AS tag
            FROM k GROUP BY url_key, sec
        ),
        v AS (
            SELECT page_id * 2 + 1 AS record_id, url_key, sec AS own_sec,
                   sec + CASE WHEN page_id % 13 = 0 THEN -3600 ELSE 3600 * (1 + page_id % 50) END AS later,
                   CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 5 = 0 THEN 'W/' || tag ELSE tag END AS etag,
                   page_id % 11 = 0 AS bare
            FROM k
        ),
        j AS (
            SELECT v.*, r.sec AS sec, r.response_id, r.digest, r.tag
            FROM v ASOF LEFT JOIN r ON v.url_key = r.url_key AND v.later >= r.sec
        ),
        o AS (
            SELECT *, CASE WHEN response_id IS NULL THEN 'orphan' WHEN bare THEN 'unvalidated'
                           WHEN regexp_replace(etag, '^W/', '') = tag THEN 'resolved' ELSE 'changed' END AS outcome
            FROM j
        )
        SELECT record_id, coalesce(url_key, '') AS url_key, CAST(CASE WHEN ok THEN response_id ELSE -1 END AS BIGINT) AS response_id,
               CASE WHEN ok THEN digest ELSE '' END AS digest, outcome,
               CAST(CASE WHEN ok THEN 5 ELSE -1 END AS BIGINT) AS n_headers, CASE WHEN ok THEN coalesce(etag, tag) ELSE '' END AS etag,
               CASE WHEN ok THEN 'T' || CASE WHEN bare THEN sec ELSE own_sec END ELSE '' END AS last_modified,
               CASE WHEN ok THEN 'E' || later ELSE '' END AS expires
        FROM (SELECT *, outcome IN ('resolved', 'unvalidated') AS ok FROM o)""",
    "op9_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS9} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS9} AS w FROM benchmark),
        cut AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM cut)
        ),
        places AS (
            SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
            FROM (
                SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                FROM d, (SELECT DISTINCT k FROM cut) WHERE len(w) >= k
            )
        ),
        hits AS (SELECT doc_id, item_id, k, p FROM places JOIN windows USING (k, g)),
        words AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM (SELECT doc_id, p, unnest(range(0, k)) AS o FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
               coalesce(words.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, p, lines[p] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS p FROM d)),
        k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM l
        ),
        common AS (SELECT k, max(doc_id) AS top FROM k WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT k.*, common.top IS NOT NULL AND common.top <> k.doc_id AS gone FROM k LEFT JOIN common ON k.k = common.k)
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
