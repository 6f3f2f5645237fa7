"""SQL of the registered queries of this package, where SQL can say the same."""

from __future__ import annotations


def crc32(text: str) -> str:
    """crc32 of the UTF-8 of a text of code points below U+0100, bit by bit."""
    points = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
    octets = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    bits = f"flatten(list_transform({octets}, lambda x: [x, 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _cell(state: str, cost: str, edit: str, line: str | None = None) -> str:
    """A cell after one more edit; ``line`` is what it adds to the repaired lines."""
    lines = f"{state}.lines" if line is None else f"{state}.lines || CASE WHEN {state}.n > 0 THEN chr(10) ELSE '' END || {line}"
    n = f"{state}.n" if line is None else f"{state}.n + 1"
    return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{edit}', 'lines': {lines}, 'n': {n}}}"


def _when(condition: str, cell: str) -> str:
    return f"CASE WHEN {condition} THEN {cell} END"


def _row_cells(state: str, before: dict[str, list[str]]) -> str:
    """The least cell of a state after a row: deleted, kept from the states that its initial leads from, or given a role."""
    initial, role = {"s1": ("s", None), "s2": ("u", "user"), "s3": ("a", "assistant")}.get(state, ("", None))
    ways = [_cell(f"c.{state}", "3", "D")]
    for p in before[state]:
        ways.append(_when(f"stays AND initial = '{initial}'", _cell(f"c.{p}", "late", "K", "role || ':' || text")))
        if role:
            ways.append(_when("stays", _cell(f"c.{p}", "(2 + late)", "R", f"'{role}:' || text")))
    return f"list_min([{', '.join(ways)}])"


_BEFORE = {"s0": [], "s1": ["s0"], "s2": ["s0", "s1", "s3"], "s3": ["s2"]}
_NO = "{'cost': 1000000000, 'audit': '', 'lines': '', 'n': 0}"

CONVERSATIONS = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM given WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {BLANKS}) AS bare FROM damaged
), faults AS (
  SELECT *, left(role, 1) AS initial, bare = '' AS blank,
    bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior
  FROM placed
), rows AS (
  SELECT *, NOT blank AND NOT duplicate AS stays, (NOT blank AND NOT duplicate AND cut)::INT AS late FROM faults
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'cost': 0, 'audit': '', 'lines': '', 'n': 0}} AS s0, {_NO} AS s1,
    {{'cost': 2, 'audit': 'I', 'lines': 'user:', 'n': 1}} AS s2, {{'cost': 4, 'audit': 'II', 'lines': 'user:' || chr(10) || 'assistant:', 'n': 2}} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, s0, s1, t2, list_min([e3, {_cell("t2", "2", "I", "'assistant:'")}]) AS s3 FROM (
    SELECT *, list_min([e2, {_cell("s0", "2", "I", "'user:'")}, {_cell("s1", "2", "I", "'user:'")}, {_cell("e3", "2", "I", "'user:'")}]) AS t2 FROM (
      SELECT c.conv_id, r.i, {_row_cells("s0", _BEFORE)} AS s0, {_row_cells("s1", _BEFORE)} AS s1, {_row_cells("s2", _BEFORE)} AS e2, {_row_cells("s3", _BEFORE)} AS e3
      FROM steps c JOIN rows r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = c.i + 1))
), best AS (
  SELECT conv_id, list_min([s0, s3]) AS cell FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM steps) WHERE last = 1
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(late = 1) AS truncated, count_if(i > 1 AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
)
SELECT b.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, b.cell.cost::BIGINT AS cost, b.cell.audit AS audit,
  sha256(b.cell.lines) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_SEARCH_LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words that lack one position each: two words of one length are near if they agree without it, a word is near to one
#: that it becomes without it.
SPELLINGS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_SEARCH_LETTERS}')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2
), hashed AS (
  SELECT run, times, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2
), holes AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), replaced AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
), removed AS (
  SELECT DISTINCT h.word, h.n, w.word AS near, w.n AS near_n FROM holes h JOIN words w ON h.rest = w.word
), pairs AS (
  SELECT word, near, near_n FROM replaced
  UNION ALL SELECT word, near, near_n FROM removed
  UNION ALL SELECT near, word, n FROM removed
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), known AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chains AS (
  SELECT word, word AS at, form AS following FROM known
  UNION ALL
  SELECT c.word, k.word, k.form FROM chains c JOIN known k ON c.following = k.word
)
SELECT k.word, k.form, c.at AS root, k.n, k.n_near, k.form_n FROM known k JOIN chains c ON c.word = k.word AND c.following IS NULL
"""
