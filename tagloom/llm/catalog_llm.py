"""Queries of the training-data operators and the SQL they are checked against."""

import public_tokenizers

import corpus_pipeline
from tagloom.llm.bpe import round_trip
from tagloom.llm.common import read_table
from tagloom.llm.exact_dedup import mark_duplicates
from tagloom.llm.lexical_search import search
from tagloom.llm.lm_scoring import score as lm_score
from tagloom.llm.minhash import near_duplicates
from tagloom.llm.packing import pack
from tagloom.llm.pii import personal_data
from tagloom.llm.quality_classifier import classify
from tagloom.llm.quality_rules import judge_quality
from tagloom.llm.secret_scan import scan
from tagloom.llm.url_filter import BLOCKED_SITES, judge
from tagloom.llm.wavelet import shard_and_read
from tagloom.llm.whitening import whiten

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES = {}
SQL = {}


def query(sql=None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


@query()
def op1_bpe(spark, sf_dir):
    return round_trip(read_table(spark, sf_dir, "documents"), BYTE_BPE)


@query()
def op2_quality_classifier(spark, sf_dir):
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query()
def op3_packing(spark, sf_dir):
    return pack(read_table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


@query()
def op4_pii(spark, sf_dir):
    return personal_data(read_table(spark, sf_dir, "documents"))


@query()
def op5_minhash(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query(
    sql="""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
)
def op6_exact_dedup(spark, sf_dir):
    return mark_duplicates(read_table(spark, sf_dir, "documents"))


@query()
def op7_token_shards(spark, sf_dir):
    return shard_and_read(read_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, levels=16)


@query(
    sql=f"""
    WITH parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
        FROM pages),
    ruled AS (
        SELECT *,
               CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
        FROM parts)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
                WHEN rule IS NOT NULL THEN 'allow'
                WHEN list_has_any(string_split(host, '.'), {list(BLOCKED_SITES)}) THEN 'block'
                ELSE 'allow' END AS verdict
    FROM ruled"""
)
def op8_url_filter(spark, sf_dir):
    return judge(read_table(spark, sf_dir, "pages"))


@query(
    sql=r"""
    WITH texts AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents),
    windows AS (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
    repeated AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY rid),
    counted AS (
        SELECT rid, doc_id, lang, source, len(w) AS n_words,
               CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
               coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines
        FROM texts LEFT JOIN repeated r USING (rid)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
    cells AS (
        SELECT rid, lang, source, base_failed, 'symbol_share' AS measure, CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS v FROM judged
        UNION ALL SELECT rid, lang, source, base_failed, 'dup_line_share', CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END FROM judged
        UNION ALL SELECT rid, lang, source, base_failed, 'repeat_share', CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END FROM judged
        UNION ALL SELECT rid, lang, source, base_failed, 'mean_length', CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END FROM judged),
    binned AS (SELECT lang, source, measure, CASE WHEN v <= 0 THEN -1 ELSE ceil(ln(v) / ln(1.02)) END AS bin FROM cells WHERE NOT base_failed),
    sketches AS (
        SELECT 1 AS level, lang, source, measure, bin, count(*) AS n FROM binned GROUP BY ALL
        UNION ALL SELECT 2, lang, '', measure, bin, count(*) FROM binned GROUP BY ALL
        UNION ALL SELECT 3, '', '', measure, bin, count(*) FROM binned GROUP BY ALL),
    ranked AS (
        SELECT *, CASE WHEN bin < 0 THEN 0 ELSE pow(1.02, bin) END AS value,
               sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS up_to, sum(n) OVER (PARTITION BY level, lang, source, measure) AS total
        FROM sketches),
    quartiles AS (
        SELECT level, lang, source, measure, max(total) AS total, min(value) FILTER (up_to >= total * 0.25) AS q25,
               min(value) FILTER (up_to >= total * 0.5) AS q50, min(value) FILTER (up_to >= total * 0.75) AS q75,
               CASE measure WHEN 'symbol_share' THEN 20 WHEN 'mean_length' THEN 100 ELSE 60 END AS least
        FROM ranked GROUP BY level, lang, source, measure),
    bounds AS (SELECT *, q75 + 6 * greatest(q75 - q50, least) AS upper, q25 - 6 * greatest(q50 - q25, least) AS lower FROM quartiles WHERE level = 3 OR total >= 50),
    verdicts AS (
        SELECT rid, bool_and(coalesce(v <= coalesce(a.upper, b.upper, c.upper) AND v >= coalesce(a.lower, b.lower, c.lower), TRUE)) AS within
        FROM cells x
        LEFT JOIN bounds a ON a.level = 1 AND a.lang = x.lang AND a.source = x.source AND a.measure = x.measure
        LEFT JOIN bounds b ON b.level = 2 AND b.lang = x.lang AND b.measure = x.measure
        LEFT JOIN bounds c ON c.level = 3 AND c.measure = x.measure
        GROUP BY rid)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND within AS kept
    FROM judged JOIN verdicts USING (rid)"""
)
def op9_quality_rules(spark, sf_dir):
    return judge_quality(read_table(spark, sf_dir, "documents"))


@query()
def op10_secret_scan(spark, sf_dir):
    return scan(read_table(spark, sf_dir, "documents"))


@query()
def op11_whitening(spark, sf_dir):
    return whiten(read_table(spark, sf_dir, "embeddings"))


@query()
def op12_lm_scoring(spark, sf_dir):
    return lm_score(read_table(spark, sf_dir, "documents"), BYTE_BPE)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    sql=f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
    figures AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS big_n, coalesce(sum(len(t)), 0) AS big_l FROM d),
    q AS (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    qc AS (SELECT item_id, term, count(*) AS qc FROM q GROUP BY ALL),
    p AS (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d),
    tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM qc) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
          FROM tf, figures GROUP BY term, big_n),
    c AS (SELECT rid, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)) AS c FROM tf, figures),
    s AS (SELECT item_id, rid, doc_id, sum(qc * w * c) AS score FROM qc JOIN w USING (term) JOIN c USING (term) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST, rid) AS rank FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20"""
)
def op13_lexical_search(spark, sf_dir):
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
