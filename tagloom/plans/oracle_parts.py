"""Common table expressions shared by the DuckDB check queries."""

from tagloom.functions.text import (
    NON_SPACE,
    NON_WORD_CHAR,
    SPACE_CHARS,
    STRUCTURAL,
    URL,
    WORD_CHAR,
    digit_class,
)

RAW = """raw AS (
  SELECT d.doc_id AS tweet_id, d.text AS text,
         CASE WHEN d.doc_id % 20 = 0 THEN 6 WHEN d.doc_id % 33 = 0 THEN 9 ELSE 3 END AS panel,
         CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE 0 END AS minority,
         CASE WHEN l.toxic = 1 THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END AS class_id
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


def _votes(k):
    return (
        f"CASE WHEN class_id = {k} THEN panel - minority "
        f"WHEN (class_id + 1) % 3 = {k} THEN minority ELSE 0 END"
    )


LOADED = RAW + f""", classes AS (
  SELECT * FROM (VALUES (0, 'hate_speech', 'hate', 'Hate Speech'),
    (1, 'offensive_language', 'offensive', 'Offensive Language'),
    (2, 'neither', 'neither', 'Neither')) AS v(class_id, class_name, short_name, display_name)),
tweets AS (SELECT tweet_id, text, panel AS annotator_count, class_id FROM raw),
annotations AS (SELECT tweet_id, {_votes(0)} AS hate_votes, {_votes(1)} AS offensive_votes,
  {_votes(2)} AS neither_votes FROM raw),
loaded AS (
  SELECT tweet_id, text, annotator_count, class_id, class_name, short_name,
         hate_votes, offensive_votes, neither_votes
  FROM tweets JOIN classes USING (class_id) JOIN annotations USING (tweet_id))"""


def clean_sql(text):
    """Cleaned text in DuckDB; RE2 has no look-around, so the marker step runs twice."""
    marker = rf"(^|{NON_WORD_CHAR})rt($|{NON_WORD_CHAR})"
    steps = [
        (URL, " "),
        (f"@{WORD_CHAR}+", " "),
        (f"#({WORD_CHAR}+)", r"\1"),
        (marker, r"\1 \2"),
        (marker, r"\1 \2"),
        ("[^a-z]+", " "),
    ]
    expr = f"lower({text})"
    for pattern, to in steps:
        expr = f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"
    return f"trim({expr})"


CLEAN = LOADED + f""", clean AS (
  SELECT *, CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END AS clean_word_count
  FROM (SELECT *, {clean_sql('text')} AS clean_text FROM loaded)
  WHERE clean_text <> '')"""

SPLIT = CLEAN + """, split AS (
  SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(n * 70 / 100.0) THEN 'train'
    WHEN rn <= floor(n * 85 / 100.0) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, count(*) OVER (PARTITION BY class_id) AS n,
          row_number() OVER (PARTITION BY class_id ORDER BY md5(concat(tweet_id, '|42')), tweet_id) AS rn
        FROM clean)),
train AS (SELECT * FROM split WHERE split = 'train')"""

SCORED = LOADED + """, scored_raw AS (
  SELECT tweet_id, class_id AS true_class_id,
    ((tweet_id * 37) % 101) + 1 AS r0, ((tweet_id * 47 + 13) % 101) + 1 AS r1,
    ((tweet_id * 57 + 26) % 101) + 1 AS r2 FROM tweets),
scored AS (
  SELECT tweet_id, true_class_id,
    CAST(r0 AS DOUBLE) / CAST(r0 + r1 + r2 AS DOUBLE) AS prob_hate,
    CAST(r1 AS DOUBLE) / CAST(r0 + r1 + r2 AS DOUBLE) AS prob_offensive,
    CAST(r2 AS DOUBLE) / CAST(r0 + r1 + r2 AS DOUBLE) AS prob_neither,
    CASE WHEN r0 >= r1 AND r0 >= r2 THEN 0 WHEN r1 >= r2 THEN 1 ELSE 2 END AS pred_class_id
  FROM scored_raw)"""


def words_sql(text):
    return f"list_filter(regexp_split_to_array({text}, '[{SPACE_CHARS}]+'), lambda x: x <> '')"


def _hits(text, pattern):
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _char(text, char):
    return f"length({text}) - length(replace({text}, '{char}', ''))"


def structural_sql(text):
    """name -> DuckDB expression; runs of one character are counted separately."""
    words = words_sql(text)
    letters = rf"length(regexp_replace({text}, '[^\p{{L}}]+', '', 'g'))"
    capitals = rf"length(regexp_replace({text}, '[^\p{{Lu}}]+', '', 'g'))"
    letters_of_words = f"length(regexp_replace({text}, '[{SPACE_CHARS}]+', '', 'g'))"

    def ratio(a, b):
        return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / {b} END"

    capital_words = (
        f"len(list_filter(regexp_split_to_array({text}, '{NON_WORD_CHAR}+'), "
        "lambda x: regexp_full_match(x, '[A-Z]{2,}')))"
    )
    expressions = [
        f"length({text})",
        f"len({words})",
        ratio(letters_of_words, f"len({words})"),
        ratio(f"len(list_distinct({words_sql(f'lower({text})')}))", f"len({words})"),
        _char(text, "!"),
        _char(text, "?"),
        _hits(text, f"#{WORD_CHAR}+"),
        _hits(text, f"@{WORD_CHAR}+"),
        _hits(text, URL),
        _hits(text, digit_class()),
        capital_words,
        ratio(capitals, letters),
    ]
    return dict(zip(STRUCTURAL, expressions))


def runs_cte(source, key, text):
    """CTE ``runs(key, elongated_count)``: runs of at least three equal characters."""
    return f"""chars AS (
  SELECT {key}, unnest(cs) AS ch, generate_subscripts(cs, 1) AS pos
  FROM (SELECT {key}, regexp_extract_all({text}, '(?s).') AS cs FROM {source})),
islands AS (
  SELECT {key}, ch, pos - row_number() OVER (PARTITION BY {key}, ch ORDER BY pos) AS island FROM chars
  WHERE ch <> chr(10)),
runs AS (
  SELECT {key}, count(*) AS elongated_count
  FROM (SELECT {key}, ch, island FROM islands GROUP BY ALL HAVING count(*) >= 3) GROUP BY {key})"""


def structural_cte(source, key, text="text"):
    """CTE ``structural``: key and all thirteen features of ``source``."""
    columns = ", ".join(f"{expr} AS {name}" for name, expr in structural_sql(f"s.{text}").items())
    return f"""{runs_cte(source, key, text)},
structural AS (
  SELECT s.{key} AS {key}, {columns}, coalesce(r.elongated_count, 0) AS elongated_count
  FROM {source} s LEFT JOIN runs r ON r.{key} = s.{key})"""


def terms_cte(source, key, stop_words, clean="clean_text"):
    """CTE ``grams(key, term)``: every word and bigram occurrence."""
    stops = ", ".join(f"'{w}'" for w in stop_words)
    return f"""words AS (
  SELECT {key}, list_filter(string_split({clean}, ' '),
    lambda x: length(x) >= 2 AND NOT list_contains([{stops}], x)) AS ws FROM {source}),
grams AS (
  SELECT {key}, unnest(ws) AS term FROM words
  UNION ALL
  SELECT {key}, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS term FROM words),
stats AS (SELECT term, count(*) AS tf, count(DISTINCT {key}) AS df FROM grams GROUP BY term),
vocab AS (
  SELECT term, tf, df, row_number() OVER (ORDER BY term) - 1 AS term_no
  FROM (SELECT * FROM stats WHERE df >= 5 ORDER BY tf DESC, term LIMIT 5000))"""
