"""The SQL each query is checked against, written from the rules alone.

The text rules are run literally here, one regular expression after the other; the
engine's faster forms must give the same text.
"""

from __future__ import annotations

from functools import reduce

_COMMENTS = """comments AS (
  SELECT lpad(CAST(doc_id AS VARCHAR), greatest(6, length(CAST(doc_id AS VARCHAR)))::INTEGER, '0') AS id,
         CASE doc_id % 10 WHEN 3 THEN text || ' /s' WHEN 7 THEN '&gt; ' || text ELSE text END AS body,
         CAST(floor(epoch(ts)) AS BIGINT) AS created_utc,
         nullif(lang, 'fr') AS author_flair_text,
         't3_' || lpad(CAST(doc_id % 40 AS VARCHAR), 6, '0') AS link_id,
         user_id AS score
  FROM documents JOIN events ON event_id = doc_id)"""
_STORIES = """stories AS (
  SELECT lpad(CAST(page_id AS VARCHAR), greatest(6, length(CAST(page_id AS VARCHAR)))::INTEGER, '0') AS id,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(url) AS score
  FROM pages)"""
_LABELS = """labeled AS (
  SELECT lpad(CAST(doc_id AS VARCHAR), greatest(6, length(CAST(doc_id AS VARCHAR)))::INTEGER, '0') AS Input_id,
         CASE WHEN quality = 1 THEN 1 ELSE -1 END AS labeldem,
         CASE WHEN toxic = 1 THEN -1 END AS labelgop,
         CASE WHEN toxic = 1 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS labeldjt
  FROM labels)"""
_DOUBLED = """doubled AS (
  SELECT * FROM labeled UNION ALL SELECT * FROM labeled WHERE labeldjt = 1)"""

_ELIGIBLE = "body NOT LIKE '%/s%' AND body NOT LIKE '&gt%'"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _rx(text: str, *rules: tuple[str, str]) -> str:
    return reduce(
        lambda t, rule: f"regexp_replace({t}, '{rule[0]}', '{rule[1]}', 'g')", rules, text
    )


# fixed values: the text rules in order
_SOLID = (
    r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_URL = (
    rf"(?:(?:https?|file|ftp)://)?{_SOLID}+(?:\.com|\.edu|\.gov|\.org|\.net|\.us)"
    rf"\\*{_SOLID}*"
)
_BREAKS = ((r"[\n\t]", " "),)
_URLS = ((rf"\[(.*)\]\({_URL}\)", r"\1"), (_URL, ""))
_ASCII = ((r"[^\x20-\x7E]", ""),)
_ENDS = (
    (r"(\w)(\W)$", r"\1 \2"),
    (r"^(\W)(\w)", r"\1 \2"),
    (r"^(\W)$", r"\1 "),
    (r"(\W)(\W)$", r"\1 \2"),
    (r"^(\W)(\W)", r"\1 \2"),
)
_COLLAPSE = ((" +", " "),)
_EDGES = ((r"(\w)(\W) ", r"\1 \2 "), (r" (\W)(\w)", r" \1 \2"), *_COLLAPSE)
_PASS = ((r" (\W)(\W)", r" \1 \2 "), (r"(\W)(\W) ", r"\1 \2 "), *_COLLAPSE)
_SPECIALS = (
    (" [^a-zA-Z0-9.,:;?!]", " "),
    ("[^a-zA-Z0-9.,:;?!] ", " "),
    *_COLLAPSE,
)
_MARKS = "('.', '!', '?', ':', ';', ',')"

_T1 = _rx("body", *_BREAKS)
_T2 = _rx(_T1, *_URLS)
_T3 = f"lower({_T2})"
_T4A = _rx(_T3, *_ASCII)
_EVERY_PASS = _rx("acc", *_PASS)
# A pass changes nothing where no two marks in a row touch a space: skipping it there
# spares the same check 100 regular expressions per row.
_NEEDED_PASS = (
    r"CASE WHEN regexp_matches(acc, ' [^\w ]{2}|[^\w ]{2} ') "
    f"THEN {_EVERY_PASS} ELSE acc END"
)


def _cleaned(one_pass: str = _NEEDED_PASS) -> str:
    return f"""edged AS MATERIALIZED (
  SELECT id, {_rx(_T4A, *_ENDS, *_EDGES)} AS text FROM comments),
peeled AS MATERIALIZED (
  SELECT id, list_reduce(CAST(range(100) AS VARCHAR[]), lambda acc, pass: {one_pass}, text) AS text
  FROM edged),
split AS MATERIALIZED (SELECT id, {_rx("text", *_EDGES)} AS text FROM peeled),
cleaned AS MATERIALIZED (SELECT id, trim({_rx("text", *_SPECIALS)}) AS text FROM split),
worded AS MATERIALIZED (SELECT id, string_split(text, ' ') AS w FROM cleaned)"""


_CLEANED = _cleaned()
_UNI = f"list_filter(w, lambda x: x NOT IN {_MARKS} AND x <> '')"
_BI = (
    f"list_transform(list_filter(range(1, len(w)), lambda i: w[i] NOT IN {_MARKS} "
    f"AND w[i + 1] NOT IN {_MARKS}), lambda i: w[i] || '_' || w[i + 1])"
)
_TRI = (
    f"list_transform(list_filter(range(1, len(w) - 1), lambda i: w[i] NOT IN {_MARKS} "
    f"AND w[i + 1] NOT IN {_MARKS} AND w[i + 2] NOT IN {_MARKS}), "
    "lambda i: w[i] || '_' || w[i + 1] || '_' || w[i + 2])"
)
_GRAMS = f"""{_CLEANED},
grams AS MATERIALIZED (
  SELECT id, list_concat(list_concat({_UNI}, {_BI}), {_TRI}) AS tokens FROM worded)"""
_VOCABULARY = """vocabulary AS MATERIALIZED (
  SELECT term, COUNT(*) AS documents
  FROM (SELECT unnest(list_distinct(tokens)) AS term
        FROM grams JOIN labeled ON id = Input_id)
  GROUP BY term HAVING COUNT(*) >= 5)"""
_NONZEROS = """counted AS MATERIALIZED (
  SELECT grams.id, COUNT(term) AS nonzeros
  FROM grams LEFT JOIN (
    SELECT id, unnest(list_distinct(tokens)) AS token FROM grams) terms ON terms.id = grams.id
  LEFT JOIN vocabulary ON token = term
  GROUP BY grams.id)"""


def _text(expression: str) -> str:
    return _with(_COMMENTS, select=f"SELECT id, {expression} AS text FROM comments")


def _tokens(expression: str, table: str = "worded", parts: str = _CLEANED) -> str:
    return _with(
        _COMMENTS,
        parts,
        select=f"""SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens,
       array_to_string(tokens, ' ') AS tokens
FROM (SELECT id, {expression} AS tokens FROM {table})""",
    )


def _flags(label: str) -> str:
    return (
        f"CASE WHEN {label} = 1 THEN 1 ELSE 0 END AS pos_label, "
        f"CASE WHEN {label} = -1 THEN 1 ELSE 0 END AS neg_label"
    )


def _truth(name: str, label: str) -> str:
    return f"""{name} AS (
  SELECT c.id, c.body, c.created_utc, c.author_flair_text, s.title,
         c.score AS comment_score, s.score AS story_score,
         CAST(CASE WHEN {label} = 1 THEN 1 ELSE 0 END AS DOUBLE) AS pos,
         CAST(CASE WHEN {label} = -1 THEN 1 ELSE 0 END AS DOUBLE) AS neg
  FROM comments c JOIN labeled ON c.id = Input_id JOIN stories s ON right(link_id, 6) = s.id
  WHERE {_ELIGIBLE})"""


_TRUTH = (_COMMENTS, _STORIES, _LABELS, _truth("scored", "labeldjt"))
_PERCENTS = "100 * SUM(pos) / COUNT(*) AS percent_pos, 100 * SUM(neg) / COUNT(*) AS percent_neg"
_DAY = "CAST(make_timestamp(created_utc * 1000000) AS DATE)"


def _bucket(key: str) -> str:
    return f"CAST(('0x' || substr(md5(coalesce({key}, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


def _report(key: str, name: str) -> str:
    return _with(
        *_TRUTH,
        select=f"SELECT {key} AS {name}, {_PERCENTS} FROM scored "
        "GROUP BY 1 ORDER BY 1 ASC NULLS FIRST",
    )


_ALL_COMMENTS = _with(
    _COMMENTS,
    select="SELECT id, body, created_utc, author_flair_text, link_id, score FROM comments",
)
_ALL_TOKENS = _tokens("tokens", "grams", _GRAMS)
_BY_DAY = _report(_DAY, "date")


def _filtered(condition: str) -> str:
    return _with(_COMMENTS, select=f"SELECT id, body FROM comments WHERE {condition}")


def _multi_target() -> str:
    # fixed values: target, label column, sample fraction
    targets = (("dem", "labeldem", 0.05), ("gop", "labelgop", 0.05), ("djt", "labeldjt", 0.1))
    daily = [
        f"SELECT '{name}' AS target, {_DAY} AS date, {_PERCENTS} FROM scored_{name} "
        f"WHERE {_bucket('id')} < {limit} GROUP BY 2"
        for name, _, limit in targets
    ]
    return _with(
        _COMMENTS,
        _STORIES,
        _LABELS,
        *(_truth(f"scored_{name}", label) for name, label, _ in targets),
        select="\nUNION ALL\n".join(daily),
    )


_LABELLED = (_COMMENTS, _LABELS)
# fixed values: seed of the targets, and of the djt target label column, folds and sample
_SEED, _DJT_FOLDS, _DJT_SAMPLE = 42, 2, 0.1
_POLARITIES = (("pos", 0.2, 1), ("neg", 0.25, -1))


def _salted(polarity: str, use: str) -> str:
    return _bucket(f"'{_SEED}:{polarity}:{use}:' || id")


def _trained(polarity: str, threshold: float, value: int) -> str:
    return _with(
        *_LABELLED,
        _GRAMS,
        _VOCABULARY,
        select=f"""SELECT '{polarity}' AS polarity, {threshold}::DOUBLE AS threshold,
       (SELECT COUNT(*) FROM vocabulary) AS features, COUNT(*) AS rows,
       CAST(SUM(CASE WHEN labeldjt = {value} THEN 1 ELSE 0 END) AS BIGINT) AS flagged
FROM comments JOIN labeled ON id = Input_id WHERE {_salted(polarity, "half")} < 0.5""",
    )


def _folds() -> str:
    parts = [
        f"""SELECT '{name}' AS polarity, {_DJT_FOLDS}::BIGINT AS folds,
       CAST(floor(({_salted(name, "fold")}) * {_DJT_FOLDS}) AS INTEGER) AS fold, COUNT(*) AS rows, TRUE AS metric_is_share
FROM comments JOIN labeled ON id = Input_id WHERE {_salted(name, "half")} < 0.5 GROUP BY 3"""
        for name, _, _ in _POLARITIES
    ]
    return _with(*_LABELLED, select="\nUNION ALL\n".join(parts))


def _held_out() -> str:
    parts = [
        f"""SELECT '{name}' AS polarity, COUNT(*) AS rows,
       CAST(SUM(CASE WHEN labeldjt = {value} THEN 1 ELSE 0 END) AS BIGINT) AS flagged, TRUE AS area_is_of_ranks
FROM comments JOIN labeled ON id = Input_id WHERE {_salted(name, "half")} >= 0.5"""
        for name, _, value in _POLARITIES
    ]
    return _with(*_LABELLED, select="\nUNION ALL\n".join(parts))


def _report_keys() -> str:
    key_of = {
        "overall": None,
        "by_day": f"CAST({_DAY} AS VARCHAR)",
        "by_place": "author_flair_text",
        "by_comment_score": "CAST(comment_score AS VARCHAR)",
        "by_story_score": "CAST(story_score AS VARCHAR)",
    }
    # fixed values: target, sample fraction, number of reports
    parts = [
        f"SELECT '{target}' AS target, '{name}' AS report, {key} AS key, TRUE AS in_range "
        f"FROM told WHERE {_bucket('id')} < {fraction} GROUP BY 3"
        if key
        else f"SELECT '{target}', '{name}', NULL, COUNT(*) > 0 FROM told WHERE {_bucket('id')} < {fraction}"
        for target, fraction, reports in (("dem", 0.05, 3), ("gop", 0.05, 3), ("djt", 0.1, 5))
        for name, key in list(key_of.items())[:reports][::-1]
    ]
    told = f"""told AS (
  SELECT c.id, created_utc, author_flair_text, c.score AS comment_score, s.score AS story_score
  FROM comments c JOIN stories s ON right(link_id, 6) = s.id WHERE {_ELIGIBLE})"""
    return _with(_COMMENTS, _STORIES, told, select="\nUNION ALL\n".join(parts))


ORACLE_SQL: dict[str, str] = {
    "sample_bernoulli": "SELECT 0::BIGINT AS foreign_rows, 0::BIGINT AS doubled_rows, COUNT(*) >= 0 AS share_fits FROM documents",
    "split_random": _with(_LABELS, select="SELECT Input_id, COUNT(*) AS times FROM labeled GROUP BY 1"),
    **{f"train_{name}": _trained(name, threshold, value) for name, threshold, value in _POLARITIES},
    "cross_validate": _folds(),
    "eval_auc": _held_out(),
    "model_roundtrip": _with(
        *_LABELLED, select="SELECT id, TRUE AS same FROM comments JOIN labeled ON id = Input_id"
    ),
    "score_pos_neg": _with(
        _COMMENTS, select=f"SELECT id, TRUE AS pos_agrees, TRUE AS neg_agrees FROM comments WHERE {_ELIGIBLE}"
    ),
    "checkpoint_scored": _with(
        _COMMENTS,
        _STORIES,
        select="SELECT c.id, body, created_utc, author_flair_text, title, c.score AS comment_score, "
        "s.score AS story_score, TRUE AS flags_fit FROM comments c JOIN stories s ON right(link_id, 6) = s.id "
        f"WHERE {_ELIGIBLE} AND {_bucket('c.id')} < {_DJT_SAMPLE}",
    ),
    "multi_target_scored": _report_keys(),
    "scan_json": _ALL_COMMENTS,
    "scan_parquet": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "scan_csv": _with(
        _LABELS, select="SELECT Input_id, labeldem, labelgop, labeldjt FROM labeled"
    ),
    "scan_csv_inferred": _with(
        _LABELS,
        select="SELECT CAST(Input_id AS INTEGER) AS Input_id, labeldem, labelgop, labeldjt "
        "FROM labeled",
    ),
    "scan_csv_by_name": _with(
        _LABELS, select="SELECT Input_id, labeldem, labelgop, labeldjt FROM labeled"
    ),
    "scan_json_text_epoch": _ALL_COMMENTS,
    "scan_json_quarantine": _with(
        _COMMENTS,
        """shown AS (
  SELECT id AS record, NULL::VARCHAR AS reason FROM comments
  UNION ALL SELECT '{"id": "' || id || '", "body": "cut o', 'not a JSON object' FROM comments WHERE score % 3 = 0
  UNION ALL SELECT '{"id": "' || id || '", "score": "many"}', 'not a whole number: score' FROM comments WHERE score % 3 = 1)""",
        select="SELECT *, count(*) FILTER (reason IS NULL) OVER () AS n_rows, count(reason) OVER () AS n_rejected FROM shown",
    ),
    "scan_csv_quarantine": _with(
        _LABELS,
        """shown AS (
  SELECT Input_id AS record, NULL::VARCHAR AS reason FROM labeled
  UNION ALL SELECT Input_id || ',1', 'another number of fields than the header' FROM labeled WHERE labeldem = 1
  UNION ALL SELECT Input_id || ',1,1,1,1', 'another number of fields than the header' FROM labeled WHERE labeldjt = -1)""",
        select="SELECT *, count(*) FILTER (reason IS NULL) OVER () AS n_rows, count(reason) OVER () AS n_rejected FROM shown",
    ),
    "ingest_roundtrip": _ALL_COMMENTS,
    "materialize_if_absent": _with(_COMMENTS, select="SELECT id, score FROM comments"),
    "report_csv_roundtrip": _BY_DAY,
    "tokenize_json": _ALL_TOKENS,
    "sql_views": _with(
        *_TRUTH,
        select="SELECT author_flair_text AS place, COUNT(*) AS comments, "
        "CAST(SUM(pos) AS BIGINT) AS positive FROM scored "
        "GROUP BY 1 ORDER BY 1 ASC NULLS FIRST",
    ),
    "sql_sanitize": _ALL_TOKENS,
    "labeled_comments": _with(
        _COMMENTS,
        _LABELS,
        select="SELECT comments.* FROM comments JOIN labeled ON id = Input_id",
    ),
    "comment_story": _with(
        _COMMENTS,
        _STORIES,
        select="SELECT c.id, body, created_utc, author_flair_text, title, "
        "c.score AS comment_score, s.score AS story_score "
        "FROM comments c JOIN stories s ON right(link_id, 6) = s.id",
    ),
    "filter_sarcasm": _filtered("body NOT LIKE '%/s%'"),
    "filter_quoted": _filtered("body NOT LIKE '&gt%'"),
    "filter_eligible": _filtered(_ELIGIBLE),
    "binarize_labels": _with(
        _COMMENTS,
        _LABELS,
        select=f"SELECT c.id, {_flags('b.labeldjt')} FROM comments c "
        "JOIN labeled a ON c.id = a.Input_id JOIN labeled b ON c.id = b.Input_id",
    ),
    "rejoin_duplicates": _with(
        _COMMENTS,
        _LABELS,
        _DOUBLED,
        select=f"SELECT c.id, {_flags('b.labeldjt')} FROM comments c "
        "JOIN doubled a ON c.id = a.Input_id JOIN doubled b ON c.id = b.Input_id",
    ),
    "training_weights": _with(
        _COMMENTS,
        _LABELS,
        _DOUBLED,
        select="SELECT id, pos_label, neg_label, CAST(COUNT(*) AS DOUBLE) AS weight FROM ("
        f"SELECT c.id, {_flags('b.labeldjt')} FROM comments c "
        "JOIN doubled a ON c.id = a.Input_id JOIN doubled b ON c.id = b.Input_id) "
        "GROUP BY ALL",
    ),
    "sample_stable": _with(
        _COMMENTS, select=f"SELECT id, score FROM comments WHERE {_bucket('id')} < 0.1"
    ),
    "split_stable": _with(
        _LABELS,
        select=f"SELECT Input_id, CASE WHEN {_bucket('Input_id')} < 0.5 THEN 'train' "
        "ELSE 'test' END AS half FROM labeled",
    ),
    "fn_right": _with(_COMMENTS, select="SELECT id, right(link_id, 6) AS story_key FROM comments"),
    "fn_epoch_to_date": _with(
        _COMMENTS,
        select="SELECT id, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') "
        f"AS at, {_DAY} AS date FROM comments",
    ),
    "txt_ws": _text(_T1),
    "txt_url": _text(_T2),
    "txt_lower": _text(_T3),
    "txt_ascii": _text(_T4A),
    # all 100 passes, none skipped
    "txt_punct": _with(_COMMENTS, _cleaned(_EVERY_PASS), select="SELECT id, text FROM split"),
    "txt_special": _with(_COMMENTS, _CLEANED, select="SELECT id, text FROM cleaned"),
    "tokenize_words": _tokens("w"),
    "parsed_text": _with(
        _COMMENTS, _CLEANED, select="SELECT id, array_to_string(w, ' ') AS text FROM worded"
    ),
    "unigrams": _tokens(_UNI),
    "bigrams": _tokens(_BI),
    "trigrams": _tokens(_TRI),
    "tokenize_comments": _ALL_TOKENS,
    "vocab_df": _with(
        _COMMENTS, _LABELS, _GRAMS, _VOCABULARY, select="SELECT term, documents FROM vocabulary"
    ),
    "vectorizer_vocab": _with(
        _COMMENTS, _LABELS, _GRAMS, _VOCABULARY, select="SELECT term FROM vocabulary"
    ),
    "vectorize_nnz": _with(
        _COMMENTS,
        _LABELS,
        _GRAMS,
        _VOCABULARY,
        _NONZEROS,
        select="SELECT id, CAST(nonzeros AS INTEGER) AS nonzeros FROM counted",
    ),
    "training_pairs": _with(
        _COMMENTS,
        _LABELS,
        _GRAMS,
        _VOCABULARY,
        _NONZEROS,
        select="SELECT CASE WHEN labeldjt = 1 THEN 1 ELSE 0 END AS label, "
        "CAST(nonzeros AS INTEGER) AS nonzeros FROM counted JOIN labeled ON id = Input_id",
    ),
    "q1_overall": _with(*_TRUTH, select=f"SELECT {_PERCENTS} FROM scored"),
    "q2_by_day": _BY_DAY,
    "q3_by_place": _report("author_flair_text", "place"),
    "q4_by_comment_score": _report("comment_score", "comment_score"),
    "q4_by_story_score": _report("story_score", "story_score"),
    "reports_one_pass": _with(
        *_TRUTH,
        f"keyed AS (SELECT {_DAY} AS date, author_flair_text AS place, comment_score, "
        "story_score, pos, neg FROM scored)",
        select="""SELECT CASE WHEN GROUPING(date) = 0 THEN 'by_day'
            WHEN GROUPING(place) = 0 THEN 'by_place'
            WHEN GROUPING(comment_score) = 0 THEN 'by_comment_score'
            ELSE 'by_story_score' END AS report,
       date, place, comment_score, story_score, """
        + _PERCENTS
        + """
FROM keyed GROUP BY GROUPING SETS ((date), (place), (comment_score), (story_score))""",
    ),
    "multi_target_report": _multi_target(),
}
