"""SQL that gives the rows of those queries that SQL can express, each over the whole tables."""

from __future__ import annotations

from covenant.llm.chat import BUDGET, HISTORY, MARKS
from covenant.llm.common import LOWER, UPPER
from covenant.llm.licenses import BASE, OWN, parse

_SPACES = r"'[^\x20\x09-\x0D]+'"
_RUNS = r"'[A-Za-z\x{C0}-\x{FF}]+'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(pattern: str, text: str = "text") -> str:
    return f"regexp_extract_all({text}, {pattern})"


def _lower(text: str = "text") -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


SUBSTRINGS = f"""WITH toks AS (SELECT doc_id, {_words(_SPACES, "coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM toks WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM places),
firsts AS (SELECT g, min(doc_id) AS f FROM windows GROUP BY g),
gone AS (SELECT doc_id, list(DISTINCT i + o) AS p FROM windows JOIN firsts USING (g), range(0, 13) t(o) WHERE f < doc_id GROUP BY doc_id),
kept AS (SELECT t.doc_id, w, coalesce(p, []) AS p FROM toks t LEFT JOIN gone g ON g.doc_id = t.doc_id)
SELECT doc_id, len(w) AS n_words, len(p) AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(p, i)), ' '), '')) AS kept_sha256 FROM kept"""

NEAR_DUPLICATES = f"""WITH RECURSIVE toks AS (SELECT doc_id, {_words(_SPACES, _lower())} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]
  WHEN len(w) > 0 THEN [array_to_string(w, ' ') || chr(10) || len(w)] ELSE [] END) AS g FROM toks),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * c >= 85 * (s.n + t.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.m FROM reach r JOIN edges e ON e.x = r.doc_id),
least AS (SELECT doc_id, min(m) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, c = d.doc_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

CONTAMINATION = f"""WITH dt AS (SELECT doc_id, {_words(_LETTERS, _lower())} AS w FROM documents),
bt AS (SELECT item_id, {_words(_LETTERS, _lower())} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bt WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bi),
lens AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dt, lens WHERE len(w) >= n),
hits AS (SELECT doc_id, i, d.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM di) d
  JOIN bw ON bw.n = d.n AND bw.g = d.g),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, range(0, 10) t(o) WHERE o < n GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id)
SELECT dt.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dt LEFT JOIN cov ON cov.doc_id = dt.doc_id LEFT JOIN ids ON ids.doc_id = dt.doc_id"""

ARCHIVES = """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
t AS (SELECT h, max(page_id) AS m FROM p GROUP BY h)
SELECT page_id, strlen(p.h) AS payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(d, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(0, 32)], '')
    AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM p JOIN t ON t.h = p.h"""

CHAT = rf"""WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(0, 2) r(i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM given),
sized AS (SELECT *, place = 1 AND role = 'system' AS leads,
    len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]')) + {MARKS} AS tokens,
    22 + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '"', '\q'))
      + length(replace(replace(text, '\', '\\'), '<', '\l')) AS size FROM placed),
summed AS (SELECT *, coalesce(sum(CASE WHEN leads THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    coalesce(max(CASE WHEN leads THEN tokens END) OVER (PARTITION BY conv_id), 0) AS lead_tokens FROM sized),
roomy AS (SELECT *, start + CASE WHEN leads THEN 0 ELSE tokens END AS finish, greatest({BUDGET} - {HISTORY} - lead_tokens, 1) AS room FROM summed),
celled AS (SELECT *, finish > (start // room + 1) * room AS crosses,
    CASE WHEN finish > (start // room + 1) * room THEN finish // room ELSE start // room END AS cell FROM roomy),
fitted AS (SELECT *, crosses OR max(finish) OVER (PARTITION BY conv_id, cell) - min(start) OVER (PARTITION BY conv_id, cell) <= room AS early FROM celled),
numbered AS (SELECT *, min(start) OVER own AS begin, max(finish) OVER own AS until FROM fitted WINDOW own AS (PARTITION BY conv_id, cell, early)),
windows AS (SELECT conv_id, begin, least({HISTORY}, {BUDGET} - max(lead_tokens) - coalesce(sum(tokens) FILTER (NOT leads), 0)) AS spare
  FROM numbered GROUP BY conv_id, begin),
tails AS (SELECT w.conv_id, sum(n.size) AS size FROM windows w JOIN numbered n
  ON n.conv_id = w.conv_id AND n.until = w.begin AND NOT n.leads AND w.begin - n.start <= w.spare GROUP BY w.conv_id),
repeats AS (SELECT w.conv_id, (count(*) - 1) * coalesce(max(s.size), 0) AS size FROM windows w
  LEFT JOIN numbered s ON s.conv_id = w.conv_id AND s.leads GROUP BY w.conv_id)
SELECT n.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(n.size) + max(r.size) + coalesce(max(t.size), 0))::BIGINT AS formatted_chars
FROM numbered n JOIN repeats r ON r.conv_id = n.conv_id LEFT JOIN tails t ON t.conv_id = n.conv_id GROUP BY n.conv_id"""


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


def _crc32(data: str) -> str:
    """CRC-32 of a list of bytes, by the table ``tab`` of a row named crc."""
    return f"xor(list_reduce([4294967295::BIGINT] || {data}, lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


def _bytes(text: str) -> str:
    return f"[('0x' || substr(hex({text}), 2 * k + 1, 2))::BIGINT FOR k IN range(strlen({text}))]"


_CRC = """crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, e: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS tab
  FROM range(256) r(i))"""

MANIFEST = f"""WITH RECURSIVE {_CRC},
leaves AS (SELECT row_number() OVER () AS k, doc_id, lang, {_leaf("text")} AS h,
  CASE WHEN {_crc32(_bytes("doc_id::VARCHAR"))} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS c
  FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS p,
  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (SELECT lang, 0 AS l, p, h, n FROM placed
  UNION ALL SELECT lang, l + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY lang, l, n, p // 8),
subs AS (SELECT lang, l AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS l, p, h, n FROM subs
  UNION ALL SELECT l + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY l, n, p // 8),
near AS (SELECT k, u.l, u.p, u.h, u.p < d.p >> (3 * u.l) AS before FROM placed d JOIN up u ON u.lang IS NOT DISTINCT FROM d.lang
    AND u.n > 1 AND u.p // 8 = d.p >> (3 * u.l + 3) AND u.p <> d.p >> (3 * u.l)
  UNION ALL SELECT k, s.height + t.l, t.p, t.h, t.p < s.p >> (3 * t.l) FROM placed d JOIN subs s ON s.lang IS NOT DISTINCT FROM d.lang
    JOIN top t ON t.n > 1 AND t.p // 8 = s.p >> (3 * t.l + 3) AND t.p <> s.p >> (3 * t.l)),
ends AS (SELECT k, s.h AS subroot, s.height + (SELECT max(l) FROM top) AS height FROM placed d JOIN subs s ON s.lang IS NOT DISTINCT FROM d.lang),
sides AS (SELECT k, l, coalesce(string_agg(h, '' ORDER BY p) FILTER (before), '') AS a,
  coalesce(string_agg(h, '' ORDER BY p) FILTER (NOT before), '') AS b FROM near GROUP BY k, l),
folded AS (SELECT d.k, 0 AS l, c AS h FROM placed d UNION ALL
  SELECT f.k, f.l + 1, sha256(coalesce(a, '') || f.h || coalesce(b, '')) FROM folded f JOIN ends e ON e.k = f.k
  LEFT JOIN sides s ON s.k = f.k AND s.l = f.l WHERE f.l < e.height),
proofs AS (SELECT k, sha256(string_agg(h, '' ORDER BY l, p)) AS s FROM near GROUP BY k)
SELECT doc_id, d.h AS leaf, subroot, t.h AS root, coalesce(s, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed d JOIN ends e ON e.k = d.k JOIN top t ON t.n = 1 JOIN folded f ON f.k = d.k AND f.l = e.height LEFT JOIN proofs r ON r.k = d.k"""


def _notices() -> str:
    """Rows (template, label, base, place, word, key) of all notices."""
    rows = [
        f"({t}, '{n.label}', {t < len(BASE)}, {k}, '{word}', {bool(key)})"
        for t, n in enumerate(parse([*BASE, *OWN]))
        for k, (word, key) in enumerate(zip(n.words, n.keys, strict=True))
    ]
    return "(VALUES " + ", ".join(rows) + ") v(t, label, base, k, w, key)"


LICENCES = f"""WITH toks AS (SELECT doc_id, {_words(_LETTERS, _lower())} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM toks),
notices AS (SELECT *, count(*) FILTER (key) OVER (PARTITION BY t) AS keys FROM {_notices()}),
seen AS (SELECT w, count(DISTINCT doc_id) AS n FROM words WHERE w IN (SELECT w FROM notices) GROUP BY w),
weights AS (SELECT v.t, v.k, v.w, ln(((SELECT count(*) FROM documents) + 1) / (coalesce(n, 0) + 1)) + 1 AS x FROM notices v LEFT JOIN seen s ON s.w = v.w),
starts AS (SELECT doc_id, t, label, base, i - k AS s FROM words JOIN notices v ON v.w = words.w AND v.key
  GROUP BY doc_id, t, label, base, i - k, keys HAVING count(*) = keys),
scored AS (SELECT p.doc_id, p.t, p.s, round(sum(x) / any_value(whole), 6) AS score FROM starts p
  JOIN (SELECT *, sum(x) OVER (PARTITION BY t) AS whole FROM weights) v ON v.t = p.t JOIN words w ON w.doc_id = p.doc_id AND w.i = p.s + v.k AND w.w = v.w GROUP BY p.doc_id, p.t, p.s),
found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(score) AS score FROM starts JOIN scored USING (doc_id, t, s) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM toks d LEFT JOIN found f ON f.doc_id = d.doc_id"""

VARIANTS = f"""WITH RECURSIVE {_CRC},
runs AS (SELECT doc_id, translate(r, '{UPPER}', '{LOWER}') AS r FROM
  (SELECT doc_id, unnest({_words(_RUNS, "coalesce(text, '')")}) AS r FROM documents) WHERE length(r) >= 5),
sums AS (SELECT r, n, {_crc32(_bytes("s"))} AS h FROM (SELECT r, doc_id || ':' || r AS s, count(*) AS n FROM runs GROUP BY doc_id, r), crc),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.d = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.d = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS m, arg_min(other, (-n, other)) AS other FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
way AS (SELECT word, word AS root FROM forms UNION ALL SELECT y.word, f.form FROM way y JOIN forms f ON f.word = y.root WHERE f.form IS NOT NULL)
SELECT f.*, root FROM forms f JOIN way y ON y.word = f.word JOIN forms e ON e.word = y.root WHERE e.form IS NULL"""
