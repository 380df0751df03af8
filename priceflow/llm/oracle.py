"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from priceflow.llm import divergence as d, mixing

WHITE = r"[\x20\x09-\x0D]"

LINE_DEDUP = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{WHITE}+', ''), '{WHITE}+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, s.first_id IS NOT NULL AND k.doc_id <> s.first_id AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ARCHIVES = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM payloads),
digests AS (
  SELECT *, list_reduce(list_transform(range(8), lambda i: list_reduce(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> s) & 31)::BIGINT + 1, 1)),
    lambda a, b: a || b)), lambda a, b: a || b) AS digest FROM hashed),
last AS (SELECT hex, max(page_id) AS last_id FROM hashed GROUP BY hex)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM digests JOIN last USING (hex)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _divergence() -> str:
    classes = ", ".join(f"length(text) - length(regexp_replace(text, {_quoted(kind + '+')}, '', 'g'))" for kind in d.CLASSES)
    listed = " ".join(f"WHEN {_quoted(lang)} THEN {words!r}" for lang, words in d.COMMON_WORDS.items())
    most = max(map(len, d.COMMON_WORDS.values()))

    def sums(name: str, n: int) -> str:
        return "[" + ", ".join(f"sum(coalesce({name}[{i + 1}], 0))::DOUBLE" for i in range(n)) + "]"

    def distance(p: str, q: str) -> str:
        a, b = f"(coalesce({p}[i], 0) / list_sum({p}))", f"(coalesce({q}[i], 0) / list_sum({q}))"
        part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({1} + {2}) / 2)) ELSE 0 END"
        terms = f"({part.format(a, a, b)} + {part.format(b, a, b)}) / 2"
        return f"sqrt(greatest(0, list_sum(list_transform(range(1, greatest(len({p}), len({q})) + 1), lambda i: {terms}))))"

    return rf"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (SELECT id, unnest(range(1, len(words) - 1)) AS pos, words FROM worded WHERE len(words) >= 3),
keyed AS (SELECT id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS key FROM windows),
often AS (SELECT id, key FROM keyed GROUP BY id, key HAVING count(*) > 1),
repeated AS (SELECT id, count(DISTINCT pos + step) AS n FROM keyed JOIN often USING (id, key), (SELECT unnest([0, 1, 2]) AS step) GROUP BY id),
counted AS (
  SELECT id, doc_id, lang, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM worded LEFT JOIN repeated USING (id)),
failed AS (SELECT *, n_words < {d.BASE_WORDS} OR 100 * n_repeat_words > {d.BASE_REPEATED_PERCENT} * n_words AS base_failed,
  [{classes}] AS c, '  ' || regexp_replace(lower(text), '[^\p{{L}}]+', '  ', 'g') || '  ' AS spaced,
  CASE lang {listed} ELSE []::VARCHAR[] END AS listed FROM counted),
common AS (SELECT *, list_transform(listed, lambda w:
  (length(spaced) - length(replace(spaced, ' ' || w || ' ', ''))) // (length(w) + 2)) AS w FROM failed),
bins AS (SELECT *, list_append(c, greatest(0, length(text) - list_sum(c)))::DOUBLE[] AS classes,
  list_append(w, greatest(0, n_words - coalesce(list_sum(w), 0)))::DOUBLE[] AS common FROM common),
sums AS (SELECT lang, {sums('classes', len(d.CLASSES) + 1)} AS class_reference, {sums('common', most + 1)} AS common_reference
  FROM bins WHERE NOT base_failed GROUP BY lang),
measured AS (SELECT b.*,
  CASE WHEN length(text) >= {d.MIN_CHARS} THEN {distance('classes', 'class_reference')} END AS class_distance,
  CASE WHEN n_words >= {d.MIN_WORDS} AND len(common) > 1 THEN {distance('common', 'common_reference')} END AS word_distance
  FROM bins b LEFT JOIN sums s ON b.lang IS NOT DISTINCT FROM s.lang)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(class_distance, 0) <= {d.CLASS_LIMIT} AND coalesce(word_distance, 0) <= {d.WORD_LIMIT} AS kept
FROM measured
"""


MIXTURE = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, md5(text), '')) AS digest FROM documents),
celled AS (
  SELECT doc_id, source, size, ('0x' || substr(digest, 1, 3))::BIGINT AS cell, ('0x' || substr(digest, 4, 12))::BIGINT AS draw FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
  FROM celled GROUP BY source),
clamped AS (
  SELECT sum(2 * source_size) OVER w AS caps, sum(weight) OVER () - sum(weight) OVER w AS free, sum(source_size) OVER () AS total
  FROM sources WINDOW w AS (ORDER BY 2.0 * source_size / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tried AS (
  SELECT 3 * total - 2 * caps AS up, 2 * free AS down FROM clamped WHERE free > 0
  UNION ALL SELECT 3 * sum(source_size), 2 * sum(weight) FROM sources),
level AS (SELECT up::BIGINT AS up, down::BIGINT AS down FROM tried WHERE down > 0 ORDER BY up::DOUBLE / down DESC, down LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN 2 * source_size::HUGEINT * down <= weight * up THEN 2.0 * source_size ELSE (weight * up)::DOUBLE / down END::DOUBLE AS target,
    CASE WHEN 2 * source_size::HUGEINT * down <= weight * up THEN 2 * source_size ELSE (weight * up) // down END AS words
  FROM sources, level),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS repeats,
    CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END AS rest FROM targets),
cells AS (SELECT source, cell, sum(size) AS cell_size FROM celled GROUP BY source, cell),
along AS (SELECT *, sum(cell_size) OVER (PARTITION BY source ORDER BY cell) AS until FROM cells),
cut AS (
  SELECT p.source, a.cell AS cut, a.cell_size, p.rest - a.until + a.cell_size AS needed
  FROM along a JOIN planned p ON a.source IS NOT DISTINCT FROM p.source
  WHERE p.rest > 0 AND p.rest < a.until AND p.rest >= a.until - a.cell_size)
SELECT d.doc_id, d.size, p.source_size, p.target,
  (p.repeats * d.size + CASE WHEN d.cell < c.cut THEN d.size
    WHEN d.cell = c.cut THEN (d.size * c.needed + d.draw % c.cell_size) // c.cell_size ELSE 0 END)::BIGINT AS taken,
  d.source, p.repeats::BIGINT AS repeats
FROM celled d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
"""

_LEAF = " || ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)
_TEXT = "coalesce(octet_length(encode({0}))::VARCHAR || ':' || {0}, '-')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i)),
    lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE given AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_LEAF} || {_TEXT.format('text')}) AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN sha256({_LEAF} || {_TEXT.format(_LOWER)}) END AS changed FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM given),
nodes AS (
  SELECT tree, 0 AS level, i, n, leaf AS hash FROM leaves
  UNION ALL SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, n, i // 8),
subroots AS (
  SELECT tree, hash AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, subroot AS hash FROM subroots
  UNION ALL SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, n, i // 8),
ways AS (
  SELECT leaves.tree AS tree, leaves.i AS i, 1 + level AS step, level, i // (8 ** level)::BIGINT AS own, NULL::BIGINT AS top FROM leaves
  JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) l ON leaves.tree = l.tree),
beside AS (
  SELECT w.tree, w.i, w.step, coalesce(string_agg(hash, '' ORDER BY s.i) FILTER (s.i < own), '') AS before,
    coalesce(string_agg(hash, '' ORDER BY s.i) FILTER (s.i > own), '') AS behind
  FROM ways w JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.i // 8 = own // 8 GROUP BY w.tree, w.i, w.step
  UNION ALL
  SELECT l.tree, l.i, 1 + r.height + t.level, coalesce(string_agg(hash, '' ORDER BY t.i) FILTER (t.i < r.i // (8 ** t.level)::BIGINT), ''),
    coalesce(string_agg(hash, '' ORDER BY t.i) FILTER (t.i > r.i // (8 ** t.level)::BIGINT), '')
  FROM leaves l JOIN subroots r ON l.tree = r.tree JOIN tops t ON t.n > 1 AND t.i // 8 = r.i // (8 ** t.level)::BIGINT // 8
  GROUP BY l.tree, l.i, r.height, t.level),
proofs AS (SELECT tree, i, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof FROM beside GROUP BY tree, i),
folded AS (
  SELECT tree, i, 0 AS step, coalesce(changed, leaf) AS hash FROM leaves
  UNION ALL SELECT f.tree, f.i, b.step, sha256(b.before || f.hash || b.behind)
  FROM folded f JOIN beside b ON b.tree = f.tree AND b.i = f.i AND b.step = f.step + 1),
ends AS (SELECT tree, i, max_by(hash, step) AS hash FROM folded GROUP BY tree, i)
SELECT l.doc_id, l.leaf, r.subroot, t.hash AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.hash AS folded_root, e.hash = t.hash AS verified
FROM leaves l JOIN subroots r ON l.tree = r.tree JOIN tops t ON t.n = 1 JOIN ends e ON e.tree = l.tree AND e.i = l.i
LEFT JOIN proofs p ON p.tree = l.tree AND p.i = l.i
"""

SQL: dict[str, str] = {
    "op13_merkle_manifest": MERKLE,
    "op11_capped_mixture": MIXTURE,
    "op2_divergence_rules": _divergence(),
    "op4_line_dedup": LINE_DEDUP,
    "op6_warc_normaliser": ARCHIVES,
}
