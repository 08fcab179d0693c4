"""DuckDB SQL for the rows of registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from shelfcast.llm import urls


def url_sql(rules: Sequence[urls.Rule]) -> str:
    """Rules as a table, masses by a recursive query over the links of hosts."""
    table = ", ".join(f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in rules)
    link = urls.LINK.replace("'", "''")
    lower = f"'{urls.UPPER}', '{urls.LOWER}'"
    return rf"""
WITH RECURSIVE rules(rhost, rpath, rname, said) AS (VALUES {table}),
cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path,
         row_number() OVER () AS line
  FROM cut
),
fits AS (
  SELECT line, max_by(rname, length(rname)) AS rule, max_by(said, length(rname)) AS said
  FROM named JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY line
),
judged AS (SELECT named.*, rule, said FROM named LEFT JOIN fits USING (line)),
seeds AS (
  SELECT CASE said WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS weight
  FROM judged WHERE said IS NOT NULL AND host <> '' GROUP BY ALL
),
base AS (
  SELECT kind, host, ({urls.UNITS} // sum(weight) OVER (PARTITION BY kind))::BIGINT * weight * {100 - urls.DAMPING} // 100 AS m FROM seeds
),
links AS (
  SELECT src, dst, count(*) AS w FROM (
    SELECT DISTINCT line, host AS src, unnest(list_transform(regexp_extract_all(html, '{link}', 1), lambda x: translate(x, {lower}))) AS dst
    FROM judged WHERE host <> ''
  ) WHERE src <> dst GROUP BY src, dst
),
arcs AS (
  SELECT 'trust' AS kind, src AS a, dst AS b, w, sum(w) OVER (PARTITION BY src) AS total FROM links
  UNION ALL SELECT 'distrust', dst, src, w, sum(w) OVER (PARTITION BY dst) FROM links
),
steps AS (
  SELECT 0 AS step, kind, host, m::BIGINT AS m FROM base
  UNION ALL
  SELECT step, kind, host, sum(m)::BIGINT FROM (
    SELECT step + 1 AS step, kind, b AS host, (m // total)::BIGINT * w * {urls.DAMPING} // 100 AS m
    FROM steps JOIN arcs USING (kind) WHERE a = host AND step < {urls.ROUNDS}
    UNION ALL
    SELECT step + 1, base.kind, base.host, base.m FROM base, (SELECT max(step) AS step FROM steps) WHERE step < {urls.ROUNDS}
  ) GROUP BY ALL
),
masses AS (
  SELECT host, sum(CASE kind WHEN 'trust' THEN m ELSE 0 END)::BIGINT AS trust, sum(CASE kind WHEN 'distrust' THEN m ELSE 0 END)::BIGINT AS distrust
  FROM steps WHERE step = {urls.ROUNDS} GROUP BY host
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN coalesce(distrust, 0) * {100 - urls.LIMIT} > coalesce(trust, 0) * {urls.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM judged LEFT JOIN masses USING (host)
"""


# CRC-32 byte by byte over a table made by its rule; near words meet where deleting one letter at one
# place gives equal rests (replaced), or the other word (inserted).
SPELLING_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)
  )
),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
uses AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(1, 2 * strlen(id || ':' || run), 2), lambda k: ('0x' || substr(hex(encode(id || ':' || run)), k, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM uses, crc
),
changed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word
),
near AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN near USING (word)
),
way AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT way.word, forms.form FROM way JOIN forms ON way.root = forms.word WHERE forms.form IS NOT NULL
),
ends AS (SELECT way.word, way.root FROM way JOIN forms ON way.root = forms.word WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
