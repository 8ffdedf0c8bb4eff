"""One query per operator over the whole of its table, with the SQL that must give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable
from inspect import cleandoc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.llm import align, bpe, exact, html, lines, minhash, mixing, quality, search, substrings, tokens, warc, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = cleandoc(sql)
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@query(
    r"""
    WITH sized AS (
        SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS bigint) AS size
        FROM documents),
    sources AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM sized GROUP BY source),
    listed AS (
        SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
               [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
               2 * source_size AS "limit", sum(source_size) OVER () AS total
        FROM sources),
    levels AS (
        SELECT *, row_number() OVER w AS nth,
               (1.5::double * total - coalesce(sum("limit") OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM listed WINDOW w AS (ORDER BY "limit" * (6 // weight), place)),
    fit AS (SELECT arg_min(level, nth) AS level, min(nth) AS nth FROM levels WHERE level * weight <= "limit"),
    targets AS (
        SELECT l.source, l.source_size,
               CASE WHEN f.nth IS NULL OR l.nth < f.nth THEN cast("limit" AS double) ELSE f.level * weight END AS target
        FROM levels l, fit f),
    ranked AS (
        SELECT s.*, t.source_size, t.target,
               row_number() OVER (PARTITION BY s.source ORDER BY size, md5(cast(doc_id AS varchar)), doc_id) AS rank,
               cast('0x' || substr(md5('mix' || coalesce('/' || s.source, '')), 1, 8) AS bigint)
                   / 4294967296::double AS start,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           size * cast(least(floor(start + rank * rate) - floor(start + (rank - 1) * rate), ceil(rate)) AS bigint) AS taken
    FROM ranked
    """
)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir))


@query(
    r"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    lines AS (
        SELECT doc_id, sum(n - 1)::bigint AS n_again, sum((n - 1) * n_words)::bigint AS n_words_again
        FROM (SELECT doc_id, line, count(*) AS n, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words
              FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
              WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL)
        GROUP BY doc_id),
    windows AS (
        SELECT doc_id, start, array_to_string(words[start:start + 7], ' ') AS part
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS start FROM texts)),
    repeated AS (SELECT doc_id, start FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, part) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT place) AS n
        FROM (SELECT doc_id, unnest(range(start, start + 8)) AS place FROM repeated) GROUP BY doc_id),
    measured AS (
        SELECT t.doc_id, cast(len(words) AS bigint) AS n_words,
               cast(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS bigint) AS word_chars,
               cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
               coalesce(l.n_again, 0) AS n_dup_lines, coalesce(l.n_words_again, 0) AS n_dup_line_words,
               coalesce(c.n, 0) AS n_repeat_words,
               len(list_filter(words, lambda w: regexp_matches(w, '^\pL|\pL$'))) AS n_alpha_words,
               list_filter(words, lambda w: NOT regexp_matches(w, '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}\x{3040}-\x{312F}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}]'))
                   AS spaced
        FROM texts t LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words
                OR 100 * n_dup_line_words > 30 * n_words OR word_chars < 2 * n_words
                OR coalesce(list_sum(list_transform(spaced, lambda w: length(w))), 0) > 15 * len(spaced)
                OR 100 * n_alpha_words < 70 * n_words) AS kept
    FROM measured
    """
)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(documents(spark, sf_dir)))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle_words=4)


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir))


@query()
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(documents(spark, sf_dir))


@query(
    """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    held AS (
        SELECT *, strlen(html) AS n, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html)
                                     ELSE page_id END AS keeper
        FROM payloads)
    SELECT page_id, cast(n AS bigint) AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN keeper <> page_id THEN keeper END AS refers_to
    FROM held
    """
)
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(pages(spark, sf_dir))


@query()
def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(pages(spark, sf_dir))


@query()
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_recurring_lines(documents(spark, sf_dir), least_tokens=1)
    return cleaned.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(documents(spark, sf_dir))


@query(
    r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    windows AS (
        SELECT doc_id, start, array_to_string(words[start:start + 12], ' ') AS part
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM texts)),
    held AS (SELECT doc_id, start FROM windows QUALIFY min(doc_id) OVER (PARTITION BY part) < doc_id),
    gone AS (
        SELECT doc_id, list(DISTINCT place) AS places
        FROM (SELECT doc_id, unnest(range(start, start + 13)) AS place FROM held) GROUP BY doc_id)
    SELECT doc_id, cast(len(words) AS bigint) AS n_words, cast(coalesce(len(places), 0) AS bigint) AS n_removed,
           sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_select(
               words, list_filter(range(1, len(words) + 1), lambda place: NOT list_contains(places, place))) END, ' '))
               AS kept_sha256
    FROM texts LEFT JOIN gone USING (doc_id)
    """
)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.drop_repeated_passages(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    r"""
    WITH texts AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    asked AS (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM texts GROUP BY ALL),
    sizes AS (SELECT doc_id, cast(sum(tf) AS bigint) AS n FROM tf GROUP BY doc_id),
    whole AS (SELECT count(*) AS n_documents, cast(sum(n) AS bigint) AS n_terms FROM sizes),
    weights AS (
        SELECT term, cast(floor(1000 * ln((2 * n_documents + 2)::double / (2 * count(*) + 1)::double)) AS bigint) AS w
        FROM tf, whole GROUP BY term, n_documents),
    parts AS (
        SELECT tf.doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * n_documents) // n_terms)))) AS part
        FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), whole),
    scores AS (
        SELECT item_id, doc_id, cast(sum(part) AS bigint) AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id)
    SELECT item_id, cast(row_number() OVER best AS integer) AS rank, doc_id, score
    FROM scores WHERE score > 0 WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 20
    """
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
