"""DuckDB SQL of those training-data queries that SQL can express, written from their meaning.

XXH64 fingerprints, phrase signatures, trained models, fitted rates and token ids have none; the
tests hold those operators against plain Python.
"""

from __future__ import annotations

# Lower-cases A-Z only, as the words' definition says.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]+"


def _words(table: str, key: str, lower: bool, pattern: str) -> str:
    text = "coalesce(text, '')"
    text = _LOWER.format(text) if lower else text
    return f"SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"


# Five hex digits are twenty bits, which are four letters.
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31), 1)
    for i in range(32)], '')"""

ARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

SUBSTRINGS = f"""
WITH d AS ({_words("documents", "doc_id", False, _NOT_SPACE)}),
wins AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT win, min(doc_id) AS f FROM wins GROUP BY win),
gone AS (SELECT DISTINCT doc_id, p FROM (
  SELECT doc_id, unnest(range(s, s + 50)) AS p FROM wins JOIN firsts USING (win) WHERE f < doc_id)),
each AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id) LEFT JOIN kept USING (doc_id)"""

DECONTAMINATE = f"""
WITH d AS ({_words("documents", "doc_id", True, _ALPHANUMERIC)}),
b AS (SELECT *, least(10, len(w)) AS n FROM ({_words("benchmark", "item_id", True, _ALPHANUMERIC)}) WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM b)),
wins AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM items))),
hits AS (SELECT doc_id, s, n, item_id FROM wins JOIN items USING (n, win)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)"""

# A turn has 9 characters besides its role and text, and one more for each control string inside.
CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + 9 + len(regexp_extract_all(text,
         '[<\[]\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

_TERMS = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
WITH d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
s AS (SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN df USING (t) JOIN tf USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM r WHERE place <= 50"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# CRC-32 of an ASCII string, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
  4294967295)"""
_SIBLINGS = "hs[:(pos % 8)] || {} || hs[(pos % 8 + 2):]"
_CLIMB = f"""SELECT c.doc_id, c.lang, c.leaf, c.level + 1, c.pos // 8,
    c.proof || array_to_string({_SIBLINGS.format('[]')}, ''), sha256(array_to_string({_SIBLINGS.format('[c.cur]')}, ''))"""

MERKLE = f"""
WITH RECURSIVE l AS (SELECT doc_id, lang, {_leaf('text')} AS leaf, {_leaf(_LOWER.format('text'))} AS low, {_CRC} % 3 = 0 AS hit FROM documents),
n0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS c FROM l),
nodes AS (SELECT lang, 0 AS level, pos, c, leaf AS h FROM n0
  UNION ALL SELECT lang, level + 1, pos // 8, (c + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE c > 1 GROUP BY lang, level, pos // 8, c),
runs AS (SELECT lang, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE c > 1 GROUP BY ALL),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS c FROM nodes WHERE c = 1),
tops AS (SELECT 0 AS level, pos, c, subroot AS h FROM subs
  UNION ALL SELECT level + 1, pos // 8, (c + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE c > 1 GROUP BY level, pos // 8, c),
topruns AS (SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE c > 1 GROUP BY ALL),
climb AS (SELECT doc_id, lang, leaf, 0 AS level, pos, '' AS proof, CASE WHEN hit THEN low ELSE leaf END AS cur FROM n0
  UNION ALL {_CLIMB} FROM climb c JOIN runs r ON c.lang IS NOT DISTINCT FROM r.lang AND c.level = r.level AND c.pos // 8 = r.run),
high AS (SELECT c.doc_id, c.leaf, 0 AS level, s.pos, c.proof, c.cur, c.lang, s.subroot FROM (
    SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1) c
  JOIN subs s ON c.lang IS NOT DISTINCT FROM s.lang),
top AS (SELECT doc_id, lang, leaf, level, pos, proof, cur FROM high
  UNION ALL {_CLIMB} FROM top c JOIN topruns r ON c.level = r.level AND c.pos // 8 = r.run),
ends AS (SELECT * FROM top QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
SELECT e.doc_id, e.leaf, h.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.cur AS folded_root, e.cur = t.h AS verified
FROM ends e JOIN high h USING (doc_id), (SELECT h FROM tops WHERE c = 1) t"""


def _letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_NAMES = "|".join([*map(_letters, ("password", "passwd", "secret", "token")), _letters("api") + "_?" + _letters("key")])
_KINDS = {
    "assign": "(" + _NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "host": "gh[opsru]_[A-Za-z0-9]{36,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "key": "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
}
_LONG = {"assign": "length(g[i]) >= 12", "access": "length(m[i]) >= 18", "hex": "length(m[i]) >= 16"}


def _spans(k: int, kind: str, pattern: str) -> str:
    """A match starts after the pieces between matches and the matches before it."""
    pattern = pattern.replace("'", "''")
    group = 2 if kind == "assign" else 0
    return f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, a, a + length(m[i]) AS b FROM (
  SELECT *, CAST(list_sum([length(x) for x in p[:i]]) + coalesce(list_sum([length(x) for x in m[:(i - 1)]]), 0) AS BIGINT) AS a FROM (
    SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m, regexp_extract_all(text, '{pattern}', {group}) AS g,
             string_split_regex(text, '{pattern}') AS p FROM documents WHERE text IS NOT NULL)))
WHERE {_LONG.get(kind, 'true')}"""


_ALL_SPANS = " UNION ALL ".join(_spans(k, kind, pattern) for k, (kind, pattern) in enumerate(_KINDS.items()))
_JOINED = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"

SECRETS = f"""
WITH spans AS ({_ALL_SPANS}),
by_doc AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  {_JOINED} FILTER (k <= 2) AS base, {_JOINED} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN by_doc USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op2_arc": ARC,
    "op6_substrings": SUBSTRINGS,
    "op7_decontaminate": DECONTAMINATE,
    "op10_chat": CHAT,
    "op11_search": SEARCH,
    "op12_merkle": MERKLE,
    "op13_secrets": SECRETS,
}
