"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

# The characters that lines are stripped of.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# A-Z only: lower() would lower other letters too.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP8 = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS dropped
  FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Sizes in words, sources ranked, the level found in one go: sources stop in
# the order of how much of their cap a unit of weight asks for.
OP2 = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS size,
         coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) AS name
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM sources),
stopping AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source IS NULL, source) AS k,
         sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS left_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM ranked
  WINDOW before AS (ORDER BY source_size / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT coalesce(arg_min(left_size::DOUBLE / left_weight, k) FILTER (
           weight * (left_size::DOUBLE / left_weight) <= 3 * source_size), 0) AS level
  FROM stopping),
targets AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * level) AS target FROM ranked, levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
draws AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, floor(r.rate)::BIGINT AS copies, k.k AS seed,
         ('0x' || md5(k.k || ':' || s.name)[1:13])::BIGINT / 4503599627370496.0 < r.rate - floor(r.rate) AS more
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN range(16) k(k)),
best AS (
  SELECT source, arg_min(seed, (missed, seed)) AS seed FROM (
    SELECT source, seed, abs(sum((copies + more::INT) * size) - any_value(target)) AS missed
    FROM draws GROUP BY source, seed) GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, d.target, ((d.copies + d.more::INT) * d.size)::BIGINT AS taken
FROM draws d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed
"""

OP4 = """
WITH codes AS (
  SELECT vec_id, array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '')::BIT AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance
  FROM codes q CROSS JOIN codes c WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INT AS rank FROM near)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

# A block is a header of 7 characters and the role, and a line feed; a turn
# ends with a mark of 7; the signs escaped take one character more each.
OP6 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, row_number() OVER by_turn AS n, lag(role) OVER by_turn IS DISTINCT FROM role AS first_of_block,
         length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 7 AS turn_chars,
         6 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + 1 AS block_chars
  FROM turns WINDOW by_turn AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(turn_chars + CASE WHEN first_of_block THEN block_chars ELSE 0 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

# Hosts are sources here, as no source is a URL.
OP10 = r"""
WITH words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents)),
runs AS (
  SELECT doc_id, i, word, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS run,
         lead(word, 4) OVER o IS NOT NULL AS whole
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
found AS (SELECT *, whole AND count(*) FILTER (whole) OVER (PARTITION BY doc_id, run) > 1 AS again FROM runs),
covered AS (
  SELECT doc_id, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS repeated
  FROM found),
by_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, count(*) FILTER (repeated) AS n_repeat_words
  FROM covered GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
measured AS (
  SELECT d.doc_id, lower(coalesce(d.source, '')) AS host, coalesce(n_words, 0) AS n_words,
         coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM documents d LEFT JOIN by_word USING (doc_id) LEFT JOIN by_line USING (doc_id)),
tested AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 100 * n_symbols > 10 * word_chars AS f3,
         100 * n_dup_lines > 30 * n_lines AS f4 FROM measured),
failed AS (
  SELECT host, rule, count(*) AS n, count(*) FILTER (fails) AS k
  FROM (SELECT host, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS fails FROM tested) GROUP BY host, rule),
stats AS (
  SELECT rule, (sum(k) + 0.5) / (sum(n) + 1.0) AS mean, avg(k / n) AS rate, avg((k / n) * (k / n)) AS squares, avg(1 / n) AS inverse
  FROM failed GROUP BY rule),
priors AS (
  SELECT rule, mean, least(greatest(mean * (1 - mean)
         / greatest(squares - rate * rate - mean * (1 - mean) * inverse, 1e-9) - 1, 2.0), 1000.0) AS strength
  FROM stats),
hosts AS (
  SELECT host, max((k + mean * strength) / (n + strength)) < 0.5 AS host_kept FROM failed JOIN priors USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND host_kept AS kept
FROM tested JOIN hosts USING (host)
"""

# Unsigned crc32 of the decimal doc_id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""


def _op13_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_OP13_HEAD = " || ".join(_op13_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
# Levels of the trees grow in a recursion; a second one walks from a leaf up,
# folding the claimed leaf with the siblings of every level.
OP13 = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, source, sha256({_OP13_HEAD} || {_op13_field("text")}) AS leaf,
         sha256({_OP13_HEAD} || {_op13_field(f"CASE WHEN {_CRC} % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END")}) AS claimed
  FROM documents),
trees AS MATERIALIZED (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM hashed GROUP BY source),
leaves AS MATERIALIZED (
  SELECT doc_id, tree, leaf, claimed, row_number() OVER () AS who,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed JOIN trees ON hashed.source IS NOT DISTINCT FROM trees.source),
nodes AS (
  SELECT 0 AS level, tree, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT level, tree, pos, sha256(digest), count(*) OVER (PARTITION BY tree) FROM (
    SELECT level + 1 AS level, tree, pos // 16 AS pos, string_agg(digest, '' ORDER BY pos) AS digest
    FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 16)),
subroots AS MATERIALIZED (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, tree AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level, pos, sha256(digest), count(*) OVER () FROM (
    SELECT level + 1 AS level, pos // 16 AS pos, string_agg(digest, '' ORDER BY pos) AS digest
    FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 16)),
steps AS MATERIALIZED (
  SELECT tree, level, pos, n, list(digest) OVER run AS members, row_number() OVER run - 1 AS slot
  FROM (SELECT tree, level, pos, digest, n FROM nodes WHERE n > 1
        UNION ALL SELECT -1, level, pos, digest, n FROM upper_nodes WHERE n > 1)
  WINDOW run AS (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS MATERIALIZED (
  SELECT tree, level, pos // 16 AS run, arg_max(members, slot) AS members FROM steps GROUP BY tree, level, pos // 16),
top AS (SELECT digest AS root FROM upper_nodes WHERE n = 1),
walk AS (
  SELECT who, 0 AS hops, tree, 0 AS level, pos, claimed AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT w.who, w.hops + 1,
    CASE WHEN s.members IS NULL THEN -1 ELSE w.tree END,
    CASE WHEN s.members IS NULL THEN 0 ELSE w.level + 1 END,
    CASE WHEN s.members IS NULL THEN w.tree ELSE w.pos // 16 END,
    CASE WHEN s.members IS NULL THEN w.folded
         ELSE sha256(array_to_string(s.members[1:w.pos % 16], '') || w.folded || array_to_string(s.members[w.pos % 16 + 2:], '')) END,
    CASE WHEN s.members IS NULL THEN w.proof
         ELSE w.proof || array_to_string(s.members[1:w.pos % 16], '') || array_to_string(s.members[w.pos % 16 + 2:], '') END
  FROM walk w LEFT JOIN whole s ON s.tree = w.tree AND s.level = w.level AND s.run = w.pos // 16
  WHERE w.tree >= 0 OR s.members IS NOT NULL),
ended AS (
  SELECT who, arg_max(folded, hops) AS folded_root, sha256(arg_max(proof, hops)) AS proof_sha256
  FROM walk GROUP BY who)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN ended USING (who) JOIN subroots USING (tree), top
"""

OP12 = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM near)
WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op2_source_mixing": OP2,
    "op4_hamming_search": OP4,
    "op6_chat_format": OP6,
    "op8_line_dedup": OP8,
    "op10_host_rules": OP10,
    "op12_block_neighbours": OP12,
    "op13_merkle_manifest": OP13,
}
