"""DuckDB SQL of the queries that SQL can express, written from their contracts.

Not expressed: structural secrets (1), XXH64 fingerprints (2), learned models
(4, 6), summed floating-point scores (7: their last digits depend on the order
of summation), the tokenizer (9).  Those are tested against plain versions.
"""

from __future__ import annotations

from wiretable.llm import conversations as C
from wiretable.llm import decontaminate as D
from wiretable.llm import quality as Q
from wiretable.llm import substring_dedup as S

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def quality() -> str:
    def only(members: str) -> str:
        return f"length(regexp_replace(t, '[^{members}]+', '', 'g'))"

    marks = r""".,;:!?''"()\-"""
    classes = ["solid - upper - digit - symbol - wide - mark", "upper", "digit", "n - solid", "symbol", "wide", "mark"]

    def distance(own: str, ref: str) -> str:
        share = f"list_transform({own}, lambda x: x / list_sum({own}))"
        part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((z[1] + z[2]) / 2)) ELSE 0.0 END"
        return (f"sqrt(greatest(list_sum(list_transform(list_zip({share}, {ref}), lambda z: {part.format('z[1]')} + "
                f"{part.format('z[2]')})) / 2, 0.0))")

    def shares(column: str, name: str) -> str:
        """The summed histogram of each language, as shares."""
        return (f"{name} AS (SELECT lang, list(s / t ORDER BY k) AS {name} FROM (SELECT lang, k, sum({column}[k]) AS s, "
                f"sum(sum({column}[k])) OVER (PARTITION BY lang) AS t FROM (SELECT lang, {column}, unnest(range(1, len({column}) + 1)) AS k "
                f"FROM v JOIN l USING (lang) WHERE NOT base_failed) GROUP BY 1, 2) GROUP BY 1)")

    def limit(base: float, slack: float) -> str:
        return f"sqrt({base} * {base} + {slack} * greatest(1 / n_words - 1 / {Q.STEADY_WORDS}, 0.0) * {base} * {base})"

    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w, length(t) AS n,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS solid, {only('A-Z')} AS upper, {only('0-9')} AS digit,
  {only('#*$%&|<>')} AS symbol, {only(r'^\x00-\x7F')} AS wide, {only(marks)} AS mark,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM f WHERE len(w) >= 3),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY 1),
m AS (SELECT f.*, len(w) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words, [{', '.join(classes)}] AS chars,
  list_transform(list_filter(w, lambda x: length(x) <= {Q.COMMON_LETTERS}), lambda x: lower(x)) AS short,
  len(w) < {Q.BASE_WORDS} OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed FROM f LEFT JOIN r USING (doc_id)),
l AS (SELECT lang FROM m WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1 HAVING count(*) >= {Q.REFERENCE_DOCUMENTS}
  ORDER BY count(*) DESC, lang LIMIT {Q.MOST_LANGUAGES}),
e AS (SELECT lang, unnest(short) AS word FROM m JOIN l USING (lang) WHERE NOT base_failed),
k AS (SELECT word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place FROM e GROUP BY lang, word),
x AS (SELECT coalesce(list(DISTINCT word ORDER BY word), []) AS common FROM k WHERE place <= {Q.COMMON_WORDS}),
u AS (SELECT m.*, common, list_transform(common, lambda y: len(list_filter(short, lambda z: z = y))) AS found FROM m, x),
v AS (SELECT *, found || [n_words - coalesce(list_sum(found), 0)] AS words FROM u),
{shares('chars', 'rc')},
{shares('words', 'rw')},
q AS (SELECT rc, rw, list_transform(range(len(rw)), lambda j: CASE WHEN j = len(rw) - 1 THEN 1.0 ELSE 0.0 END) AS bare
  FROM rc JOIN rw USING (lang) WHERE len(rw) > 1 AND rw[-1] < 1),
j AS (SELECT doc_id, min({distance('chars', 'rc')}) AS dc, min({distance('words', 'rw')} / {distance('bare', 'rw')}) AS dw
  FROM v, q WHERE n_words > 0 GROUP BY 1)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(solid AS BIGINT) AS word_chars, CAST(symbol AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, NOT base_failed AND NOT (coalesce(dc > {limit(Q.CHAR_LIMIT, Q.CHAR_SLACK)}, false)
    OR coalesce((lang IS NULL OR lang IN (SELECT lang FROM l)) AND dw > {limit(Q.WORD_SHARE, Q.WORD_SLACK)}, false)) AS kept FROM v LEFT JOIN j USING (doc_id)"""


def substring_dedup() -> str:
    n = S.WINDOW
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - {n - 2})) AS i, w FROM d WHERE len(w) >= {n}),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + {n - 1}], ' ') ORDER BY doc_id, i) AS k FROM p),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM o, (SELECT unnest(range({n})) AS j) WHERE k > 1),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.pos) AS body, count(*) AS n FROM x ANTI JOIN c USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""


def decontaminate() -> str:
    n = D.WINDOW
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{ALNUM}') AS w FROM benchmark),
s AS (SELECT item, w, least({n}, len(w)) AS k FROM b WHERE len(w) > 0),
u AS (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM s),
v AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM u),
p AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM v) WHERE len(w) >= k),
f AS (SELECT doc_id, i, p.k, item FROM p JOIN v ON v.k = p.k AND v.win = array_to_string(p.w[i:i + p.k - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM f, (SELECT unnest(range({n})) AS j) WHERE j < k GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM f GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


def quotations() -> str:
    marks = r"^(?:[ \t]*>)*"
    head, end = C.FORMAT.split("%s")[0], "<|end|>"
    return rf"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
q AS (SELECT DISTINCT conv_id FROM m WHERE regexp_matches(t, '(?m)^[ \t]*>')),
e AS (SELECT DISTINCT conv_id, turn, t FROM m SEMI JOIN q USING (conv_id) WHERE turn IS NOT NULL),
l AS (SELECT conv_id, turn, t, unnest(range(len(string_split(t, chr(10))))) AS line, unnest(string_split(t, chr(10))) AS body FROM e),
n AS (SELECT conv_id, turn, t, line, length(regexp_replace(regexp_extract(body, '{marks}', 0), '[^>]+', '', 'g')) AS depth,
  lower(trim(regexp_replace(regexp_replace(body, '{marks}', ''), '\s+', ' ', 'g'))) AS words FROM l),
a AS (SELECT *, CAST(words = '' OR lag(words, 1, '') OVER w = '' OR lag(depth, 1, -1) OVER w <> depth AS INT) AS fresh FROM n
  WINDOW w AS (PARTITION BY conv_id, turn, t ORDER BY line)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, t ORDER BY line) AS run FROM a),
p AS (SELECT conv_id, turn, depth, string_agg(words, ' ' ORDER BY line) AS words FROM r WHERE words <> '' GROUP BY conv_id, turn, t, run, depth
  UNION ALL SELECT conv_id, turn, depth, words FROM r WHERE words <> ''),
o AS (SELECT conv_id, words, min(turn) AS origin FROM p WHERE depth = 0 GROUP BY 1, 2),
k AS (SELECT p.conv_id, turn, origin, row_number() OVER (PARTITION BY p.conv_id, turn ORDER BY depth, length(words) DESC, origin DESC) AS best
  FROM p JOIN o USING (conv_id, words) WHERE depth > 0 AND origin < turn),
x AS (SELECT conv_id, turn, origin AS parent FROM k WHERE best = 1),
y(conv_id, turn, thread, depth) AS (SELECT conv_id, turn, parent, 1 FROM x
  UNION ALL SELECT y.conv_id, y.turn, x.parent, y.depth + 1 FROM y JOIN x ON x.conv_id = y.conv_id AND x.turn = y.thread),
z AS (SELECT conv_id, turn, min(thread) AS thread, max(depth) AS depth FROM y GROUP BY 1, 2),
c AS (SELECT *, regexp_replace(array_to_string(list_filter(string_split(t, chr(10)), lambda b: NOT regexp_matches(b, '^[ \t]*>')), chr(10)),
  '^\s+|\s+$', '', 'g') AS body FROM m)
SELECT c.conv_id, coalesce(thread, c.turn) AS thread, c.turn, CAST(coalesce(z.depth, 0) AS BIGINT) AS depth, parent, role,
  sha256('{head}' || coalesce(role, '') || '|>' || chr(10) || body || '{end}' || chr(10)) AS formatted_sha256
FROM c LEFT JOIN z USING (conv_id, turn) LEFT JOIN x USING (conv_id, turn)"""


ORACLES = {"op3_quality": quality(), "op5_substring_dedup": substring_dedup(), "op8_decontaminate": decontaminate(),
           "op10_quotations": quotations()}
