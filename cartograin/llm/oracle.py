"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from .licence_texts import LICENCES, NOTICES
from .licences import BULLET, COPYRIGHT_LINE, PHRASES, WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {}

ORACLE["op7_quality_rules"] = rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS body, {_WORDS} AS w FROM documents),
eights AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS window8
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)),
again AS (SELECT doc_id, window8 FROM eights GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT e.doc_id, unnest(range(e.i, e.i + 8)) AS j FROM eights e JOIN again a ON e.doc_id = a.doc_id AND e.window8 = a.window8)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw,
    array_to_string(regexp_extract_all(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'),
      '[!-/:-@\[-`{{-~]', '', 'g'), '[^\x20\x09-\x0D]+'), ' ') AS normal
  FROM (SELECT doc_id, source, unnest(string_split(body, chr(10))) AS line FROM docs)),
held AS (SELECT * FROM lines WHERE nw > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM held GROUP BY doc_id),
texts AS (SELECT source, body, min(doc_id) AS doc_id FROM docs GROUP BY source, body),
above AS (SELECT h.source, h.normal FROM held h JOIN texts t ON h.doc_id = t.doc_id GROUP BY ALL HAVING count(DISTINCT h.doc_id) > 10),
gone AS (
  SELECT h.doc_id, sum(h.nw) AS words, count(DISTINCT h.normal) AS lines
  FROM held h JOIN above a ON h.source IS NOT DISTINCT FROM a.source AND h.normal = a.normal GROUP BY h.doc_id),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(u.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(g.words, 0)::BIGINT AS n_removed_words, coalesce(g.lines, 0)::BIGINT AS n_removed_lines
  FROM docs d LEFT JOIN dups u USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN gone g USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, n_removed_lines,
  NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 20 OR 100 * (n_words - n_removed_words) < 30 * n_words)) AS kept
FROM judged
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _phrased(form: str) -> str:
    out = f"' ' || {form} || ' '"
    for phrase, norm in PHRASES.items():
        out = f"replace({out}, ' {phrase} ', ' {norm} ')"
    return f"trim({out})"


_RESPELLED = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in WORDS.items()) + "}"
_BARE = (
    f"replace(regexp_replace(lower(regexp_replace(regexp_replace(replace(text, chr(13), ''), {_quoted('(?im)' + COPYRIGHT_LINE)}, '', 'g'), "
    f"{_quoted('(?m)' + BULLET)}, ' ', 'g')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10), ' ' || chr(10) || ' ')"
)
_LINED = _phrased(
    f"array_to_string(list_transform(string_split_regex({_BARE}, ' +'), lambda w: coalesce(map_extract({_RESPELLED}, w)[1], w)), ' ')"
)
_WHOLE = _phrased("array_to_string(list_filter(string_split_regex(form, '[ \\n]+'), lambda w: w <> ''), ' ')")


def _known(texts: list[tuple[str, str]]) -> str:
    return "(VALUES " + ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in texts) + ") AS k(licence, text)"


ORACLE["op10_licence_scan"] = f"""
WITH lined AS (SELECT doc_id, {_LINED} AS form FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
whole AS (SELECT doc_id, form, sha256({_WHOLE}) AS digest FROM lined),
licences AS (SELECT DISTINCT licence, sha256({_WHOLE}) AS digest FROM (SELECT licence, {_LINED} AS form FROM {_known(LICENCES)})),
notices AS (SELECT DISTINCT licence, {_LINED} AS form FROM {_known(NOTICES)}),
hits AS (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT licence)), ',') AS notices
  FROM (SELECT doc_id, trim(unnest(string_split(form, ' ' || chr(10) || ' '))) AS form FROM lined) JOIN notices USING (form) GROUP BY doc_id)
SELECT w.doc_id, w.digest, l.licence, coalesce(h.notices, '') AS notices
FROM whole w LEFT JOIN licences l USING (digest) LEFT JOIN hits h USING (doc_id)
"""

ORACLE["op4_chat_formatting"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(role) + len(regexp_extract_all(role, '\\|\n|<\|')) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + 11)::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

ORACLE["op3_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


ORACLE["op5_substring_dedup"] = rf"""
WITH units AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS v FROM (SELECT *, unnest(range(1, n - 33)) AS i FROM units)),
again AS (SELECT v FROM windows GROUP BY v HAVING count(*) > 1),
starts AS (SELECT doc_id, i FROM windows JOIN again USING (v)),
changes AS (SELECT doc_id, p, sum(d) AS d FROM (SELECT doc_id, i AS p, 1 AS d FROM starts UNION ALL SELECT doc_id, i + 35, -1 FROM starts) GROUP BY ALL),
places AS (
  SELECT u.*, p, coalesce(sum(c.d) OVER (PARTITION BY doc_id ORDER BY p), 0) > 0 AS gone
  FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM units) u LEFT JOIN changes c USING (doc_id, p)),
marked AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM places),
rest AS (
  SELECT doc_id, count(*) FILTER (gone) AS removed, count(*) FILTER (opens) AS spans, encode(string_agg(w[p], ' ' ORDER BY p) FILTER (NOT gone)) AS kept FROM marked GROUP BY doc_id)
SELECT u.doc_id, n::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(coalesce(kept, ''::BLOB)) AS kept_sha256
FROM units u LEFT JOIN rest r USING (doc_id)
"""



def _nearest(codebook: str, name: str) -> str:
    """Nearest entry of every part, ties to the lower index, as (vec, part, x, entry, d)."""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""{name} AS MATERIALIZED (
  SELECT vec, part, any_value(x) AS x, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT v.vec, v.part, v.x, c.entry, {distance}::BIGINT AS d FROM cut v JOIN {codebook} c USING (part)) GROUP BY vec, part)"""


def _moved(codebook: str, assigned: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(n.x, o.x) AS x FROM {codebook} o LEFT JOIN (
    SELECT part, entry, list(CAST(floor(total::DOUBLE / n) AS BIGINT) ORDER BY place) AS x
    FROM (SELECT part, best.entry AS entry, place, sum(x[place]) AS total, count(*) AS n FROM {assigned}, (SELECT unnest(range(1, width + 1)) AS place FROM shape) GROUP BY ALL)
    GROUP BY ALL) n USING (part, entry))"""


ORACLE["op11_vector_codes"] = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS vec, vec_id, label, list_transform(embedding, lambda e: CAST(floor(256 * e::DOUBLE) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
shape AS (SELECT (len(x) // 16)::BIGINT AS width FROM kept WHERE vec = 1),
cut AS MATERIALIZED (
  SELECT vec, part, x[part * width + 1:part * width + width] AS x FROM kept, shape, (SELECT unnest(range(16)) AS part) WHERE len(x) = 16 * width),
c0 AS (SELECT part, vec - 1 AS entry, x FROM cut WHERE vec <= 64),
{_nearest("c0", "a0")},
{_moved("c0", "a0", "c1")},
{_nearest("c1", "a1")},
{_moved("c1", "a1", "c2")},
{_nearest("c2", "a2")},
coded AS (SELECT vec, string_agg(lower(format('{{:02x}}', best.entry)), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a2 GROUP BY vec),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256, label
FROM kept JOIN coded USING (vec), digest
"""
