"""DuckDB SQL of the HTML queries.  Written apart from ``functions.html``: the
stack of open elements is a recursive query over the tokens of all pages, and
strings climb from texts to the elements that hold nothing else."""

from __future__ import annotations

TOKENS = """tk AS (
  SELECT id, i, x, CASE WHEN x[1] <> '<' OR length(x) = 1 THEN 't'
      WHEN x[1:2] = '<!' OR regexp_matches(x, '^<(script|style)') THEN 'r'
      WHEN x[1:2] = '</' THEN 'c'
      WHEN regexp_matches(x, '^<(br|meta)[ />]') THEN 'v' ELSE 'o' END AS kind,
    lower(regexp_extract(x, '^</?([a-zA-Z][^ />]*)', 1)) AS name
  FROM (SELECT id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT id, regexp_extract_all(html,
    '(?s:<!--.*?-->|<script.*?</script>|<style.*?</style>)|<!?/?[a-zA-Z][^>]*>|[^<]+|<') AS l FROM pg)))"""


#: The references that occur in the pages; & comes last.
REFERENCES = "s"
for _name, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#x27;", "''"), ("&lt;", "<"), ("&gt;", ">"),
                     ("&amp;", "&")):
    REFERENCES = f"replace({REFERENCES}, '{_name}', '{_char}')"


def block_sql(pages: str, heading: str, text: str | None, container: str) -> str:
    is_text = "true" if text is None else f"h.s = '{text}'"
    return f"""WITH RECURSIVE pg AS ({pages}),
{TOKENS},
st AS (
  SELECT id, 0::BIGINT AS i, [''] AS names, [0::BIGINT] AS ids FROM pg
  UNION ALL
  SELECT st.id, tk.i, CASE WHEN kind = 'o' THEN list_append(names, name) WHEN kind = 'c' AND list_contains(names, name)
      THEN names[1:len(names) - list_position(list_reverse(names), name)] ELSE names END,
    CASE WHEN kind = 'o' THEN list_append(ids, tk.i) WHEN kind = 'c' AND list_contains(names, name)
      THEN ids[1:len(names) - list_position(list_reverse(names), name)] ELSE ids END
  FROM st JOIN tk ON tk.id = st.id AND tk.i = st.i + 1),
tx AS (
  SELECT id, min(i) AS i, string_agg(x, '' ORDER BY i) AS s
  FROM (SELECT id, i, x, i - row_number() OVER (PARTITION BY id ORDER BY i) AS run FROM tk WHERE kind = 't') GROUP BY id, run),
nd AS (
  SELECT n.id, n.i, n.name, st.ids[len(st.ids)] AS parent, st.names AS above, st.ids AS above_ids, n.s FROM (
    SELECT id, i, name, NULL AS s FROM tk WHERE kind IN ('o', 'v')
    UNION ALL SELECT id, i, NULL, regexp_replace(regexp_replace(x, '^<!(--)?|^<[^>]*>', ''), '(--)?>$|<[^>]*>$', '')
      FROM tk WHERE kind = 'r'
    UNION ALL SELECT id, i, NULL, {REFERENCES} FROM tx) n
  JOIN st ON st.id = n.id AND st.i = n.i - 1),
one AS (SELECT id, parent FROM nd GROUP BY id, parent HAVING count(*) = 1),
up AS (
  SELECT id, i, parent, s FROM nd WHERE s IS NOT NULL
  UNION ALL
  SELECT nd.id, nd.i, nd.parent, up.s FROM up JOIN one ON one.id = up.id AND one.parent = up.parent
  JOIN nd ON nd.id = up.id AND nd.i = up.parent),
hd AS (SELECT id, min(i) AS i FROM nd WHERE name = '{heading}' GROUP BY id),
bx AS (
  SELECT id, list_max(list_transform(list_filter(list_zip(above, above_ids), lambda z: z[1] = '{container}'), lambda z: z[2])) AS box
  FROM nd JOIN hd USING (id, i) LEFT JOIN up h USING (id, i) WHERE {is_text})
SELECT nd.id, up.s AS lyric_line FROM nd JOIN bx ON bx.id = nd.id AND list_contains(nd.above_ids, box)
JOIN up ON up.id = nd.id AND up.i = nd.i
WHERE nd.name = 'p' AND length(up.s) - length(replace(up.s, ' ', '')) > 2"""


LYRIC_PAGES = """SELECT page_id AS id, replace(replace(html, '<article>',
  '<div class="page"><p>a line before the heading</p>' || ['<h2>Lyrics</h2>', '<h2><b>Lyrics</b></h2>', '<h2>About this</h2>',
    '<div><h2>Lyrics</h2></div>', '<h2>Ly<i>rics</i></h2>'][page_id % 5 + 1]),
  '</article>', '</div><p>a line after the block</p>') AS html FROM pages"""

SQL = {
    "html_lines": block_sql("SELECT page_id AS id, html FROM pages", "h1", None, "article"),
    "lyric_lines": block_sql(LYRIC_PAGES, "h2", "Lyrics", "div"),
}
