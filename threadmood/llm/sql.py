"""The same rows as the queries of this package, as DuckDB SQL."""

_QUALITY_ROUNDS = 20

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), x AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM m
), near AS (
  SELECT r, i, word, lag(word) OVER q AS previous,
         [word, lead(word, 1) OVER q, lead(word, 2) OVER q, lead(word, 3) OVER q, lead(word, 4) OVER q] AS g,
         lead(word, 4) OVER q IS NOT NULL AS whole
  FROM x WINDOW q AS (PARTITION BY r ORDER BY i)
), echoes AS (
  SELECT r, count(*) AS n FROM near WHERE word = previous GROUP BY r
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM near WHERE whole) WHERE c > 1
), repeated AS (
  SELECT r, sum(least(5, coalesce(following - i, 5))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM twice) GROUP BY r
), f AS (
  SELECT m.r, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda y: length(y))), 0)::BIGINT AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_distinct(w)) AS n_distinct, coalesce(echoes.n, 0) AS n_echoes,
         length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_upper
  FROM m LEFT JOIN echoes USING (r) LEFT JOIN repeated USING (r)
), v AS (
  SELECT *, [
    CASE WHEN n_words = 0 THEN 0 WHEN 100 * n_symbols > 10 * n_words THEN -1 WHEN 100 * n_symbols <= 2 * n_words THEN 1 ELSE 0 END,
    CASE WHEN n_words = 0 THEN 0 WHEN 100 * n_repeat_words > 20 * n_words THEN -1 WHEN 100 * n_repeat_words <= 5 * n_words THEN 1 ELSE 0 END,
    CASE WHEN n_lines = 0 THEN 0 WHEN 100 * n_dup_lines > 40 * n_lines THEN -1 WHEN 100 * n_dup_lines <= 10 * n_lines THEN 1 ELSE 0 END,
    CASE WHEN n_words = 0 THEN 0 WHEN 100 * n_echoes > 20 * n_words THEN -1 WHEN 100 * n_echoes <= 5 * n_words THEN 1 ELSE 0 END,
    CASE WHEN word_chars = 0 THEN 0 WHEN 100 * n_upper > 30 * word_chars THEN -1 WHEN 100 * n_upper <= 15 * word_chars THEN 1 ELSE 0 END,
    CASE WHEN n_words = 0 THEN 0 WHEN word_chars > 12 * n_words OR word_chars < 2 * n_words THEN -1
         WHEN word_chars <= 8 * n_words AND word_chars >= 3 * n_words THEN 1 ELSE 0 END,
    CASE WHEN n_words = 0 THEN 0 WHEN 100 * n_distinct <= 20 * n_words THEN -1 WHEN 100 * n_distinct >= 50 * n_words THEN 1 ELSE 0 END,
    CASE WHEN n_words < 10 THEN -1 WHEN n_words >= 20 THEN 1 ELSE 0 END
  ] AS votes FROM f
), ways AS (
  SELECT votes, count(*)::DOUBLE AS n FROM v GROUP BY votes
), cells AS (
  SELECT way.votes, rule, way.votes[rule] AS vote FROM ways AS way, range(1, 9) AS rules(rule)
), slots AS (
  SELECT rule, vote FROM range(1, 9) AS a(rule), (VALUES (-1), (1)) AS b(vote)
), em AS (
  SELECT 0 AS round, votes, n, CASE WHEN list_contains(votes, -1) THEN 0.1::DOUBLE ELSE 0.95::DOUBLE END AS q FROM ways
  UNION ALL
  SELECT * FROM (
    WITH now AS (SELECT * FROM em),
    sums AS (SELECT sum(n * q) AS g, sum(n) AS whole FROM now),
    hits AS (
      SELECT slots.rule, slots.vote,
             coalesce(sum(n * q) FILTER (c.vote = slots.vote), 0) AS hg, coalesce(sum(n * q), 0) AS cg,
             coalesce(sum(n * (1 - q)) FILTER (c.vote = slots.vote), 0) AS hb, coalesce(sum(n * (1 - q)), 0) AS cb
      FROM slots LEFT JOIN (SELECT * FROM cells JOIN now USING (votes)) AS c ON c.rule = slots.rule AND c.vote <> 0
      GROUP BY ALL
    ),
    logs AS (
      SELECT c.votes,
             sum(CASE WHEN c.vote = 0 THEN 0 WHEN c.vote = -1 THEN ln(least((hg + 0.5) / (cg + 1), 0.002)) ELSE ln((hg + 0.5) / (cg + 1)) END) AS lg,
             sum(CASE WHEN c.vote = 0 THEN 0 ELSE ln((hb + 0.5) / (cb + 1)) END) AS lb
      FROM cells AS c LEFT JOIN hits ON c.rule = hits.rule AND c.vote = hits.vote GROUP BY c.votes
    )
    SELECT now.round + 1, now.votes, now.n,
           1 / (1 + exp(lb + ln(1 - (g + 0.5) / (whole + 1)) - lg - ln((g + 0.5) / (whole + 1)))) AS q
    FROM now JOIN logs USING (votes), sums WHERE now.round < {_QUALITY_ROUNDS}
  )
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND q >= 0.5 AS kept,
       round(q, 6) AS quality
FROM v JOIN em USING (votes) WHERE round = {_QUALITY_ROUNDS}
"""

# Windows are not built here: their lengths are summed from the turns that go into each.
OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), counted AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS tokens,
         length('### ' || role || chr(58) || chr(10) || text || chr(10) || '</turn>' || chr(10))
         + length(role || text) - length(translate(role || text, '\<#', ''))
         + length(role) - length(replace(role, chr(58), '')) AS chars
  FROM turns
), summed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM counted
), systems AS (
  SELECT conv_id, min(before) AS system_before, arg_min(tokens, before) AS system_tokens, arg_min(chars, before) AS system_chars
  FROM summed WHERE role = 'system' GROUP BY conv_id
), roomy AS (
  SELECT summed.*, system_before, system_chars, greatest(128, 512 - 128 - coalesce(system_tokens, 0)) AS room
  FROM summed LEFT JOIN systems ON summed.conv_id IS NOT DISTINCT FROM systems.conv_id
), placed AS (
  SELECT *, before // room AS span FROM roomy
), cast_turns AS (
  SELECT *, span AS win FROM placed
  UNION ALL SELECT *, span + 1 FROM placed WHERE before + least(128, room) >= (span + 1) * room
), windows AS (
  SELECT conv_id, win, sum(chars) + max(CASE WHEN system_before < first_before THEN system_chars ELSE 0 END) AS chars
  FROM (SELECT *, min(before) OVER (PARTITION BY conv_id, win) AS first_before FROM cast_turns)
  GROUP BY conv_id, win HAVING bool_or(span = win)
), formatted AS (
  SELECT conv_id, sum(chars) AS formatted_chars FROM windows GROUP BY conv_id
)
SELECT t.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY before)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY before) FILTER (role = 'assistant'), '')) AS loss_sha256,
       any_value(formatted_chars)::BIGINT AS formatted_chars
FROM summed AS t JOIN formatted ON t.conv_id IS NOT DISTINCT FROM formatted.conv_id
GROUP BY t.conv_id
"""



def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit, as a BIGINT; NULL for NULL."""
    characters = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    bits = "lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bits})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {characters}), {byte}), 4294967295::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


_LEAF = " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars"))
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, leaves: str) -> str:
    """CTEs {name} (tree, level, position, total, digest), from leaves of level 0 up to every tree's root, and families of siblings."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, position, count(*) OVER (PARTITION BY tree) AS total, digest FROM {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, position // 16, (any_value(total) + 15) // 16, sha256(string_agg(digest, '' ORDER BY position))
  FROM {name} WHERE total > 1 GROUP BY tree, position // 16
), {name}_lists AS (
  SELECT tree, level, position // 16 AS parent, list(digest ORDER BY position) AS children FROM {name} WHERE total > 1 GROUP BY ALL
)"""


def _climb(name: str, trees: str, start: str) -> str:
    """CTE {name}: rows (r, tree, position, level, folded, siblings) of start, climbing to the roots of trees."""
    here = "CAST(position % 16 + 1 AS INTEGER)"
    return f"""{name} AS (
  SELECT r, tree, position, 0 AS level, folded, siblings FROM {start}
  UNION ALL
  SELECT r, tree, position // 16, level + 1,
         sha256(array_to_string(children[: {here} - 1], '') || folded || array_to_string(children[{here} + 1 :], '')),
         siblings || array_to_string(children[: {here} - 1], '') || array_to_string(children[{here} + 1 :], '')
  FROM {name} JOIN {trees}_lists USING (tree, level) WHERE parent = position // 16
)"""


# Each row climbs its tree with all siblings' digests, and then the tree over the trees.
OP11 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({_LEAF} || {_field("text")}) AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({_LEAF} || {_field(_SMALL)}) END AS tampered
  FROM documents
), leaves AS (
  SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, leaf AS digest,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position FROM d
), {_tree("low", "leaves")}, subroots AS (
  SELECT '' AS tree, tree AS member, row_number() OVER (ORDER BY encode(tree)) - 1 AS position, digest FROM low WHERE total = 1
), {_tree("high", "subroots")}, starts AS (
  SELECT r, tree, position, coalesce(tampered, leaf) AS folded, '' AS siblings FROM leaves
), {_climb("climbed", "low", "starts")}, halfway AS (
  SELECT r, '' AS tree, s.position, folded, siblings
  FROM (SELECT r, tree, arg_max(folded, level) AS folded, arg_max(siblings, level) AS siblings FROM climbed GROUP BY r, tree) AS c
  JOIN subroots AS s ON s.member = c.tree
), {_climb("risen", "high", "halfway")}, ends AS (
  SELECT r, arg_max(folded, level) AS folded_root, arg_max(siblings, level) AS siblings FROM risen GROUP BY r
)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots AS s ON s.member = leaves.tree JOIN ends USING (r), (SELECT digest AS root FROM high WHERE total = 1)
"""

# Pairs of equal words, each with all earlier ones, as diagonals.
OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_crc32("doc_id::VARCHAR")} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sized AS (
  SELECT *, len(w) AS n, coalesce(h % 10 = 0 AND len(w) > 0, false) AS planted,
         (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g FROM d
), spread AS (
  SELECT *, 1 + (n - a) // (3 + g) AS p, unnest(range(n)) AS i FROM sized
), x AS (
  SELECT r, i, n, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM spread
), matches AS (
  SELECT late.r, late.i, late.i - early.i AS q
  FROM x AS late JOIN x AS early ON late.r = early.r AND late.word = early.word AND early.i < late.i AND 3 * (late.i - early.i) <= late.n
), diagonals AS (
  SELECT r, q, min(i) - q AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS diagonal FROM matches)
  GROUP BY r, q, diagonal
), runs AS (
  SELECT r, start, length, min(q) AS period FROM diagonals WHERE length >= greatest(24, 3 * q) GROUP BY r, start, length
), best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM runs
), summed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY r
), dropped AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM x ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN summed USING (r) LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (r) LEFT JOIN left_over USING (r)
"""

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": OP1, "op10_chat_formatting": OP10, "op11_merkle_manifest": OP11, "op12_periodic_runs": OP12}
