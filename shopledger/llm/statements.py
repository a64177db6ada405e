"""SQL for DuckDB that says what the queries mean, written the plain way."""

from __future__ import annotations

_KEY = """translate(trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, text, row, i AS place, ls[i] AS line, {_KEY.format("ls[i]")} AS k
  FROM (SELECT doc_id, text, row, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, text, row_number() OVER () AS row,
                     string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), often AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, o.k IS NOT NULL AND l.doc_id < o.last AS gone FROM lines l LEFT JOIN often o ON o.k = l.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row
"""


def _host(url: str) -> str:
    found = f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1)"
    return f"translate({found}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _path(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _address(url: str) -> str:
    query = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1)"
    return f"CASE WHEN contains({url}, '://') THEN {_host(url)} || {_path(url)} || {query} END"


def _attribute(tag: str, name: str) -> str:
    quote = "[\"'']"
    found = f"""regexp_extract({tag}, '(?is)[\\s"'']{name}\\s*=\\s*("([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1)"""
    bare = f"regexp_replace(regexp_replace({found}, '^{quote}', ''), '{quote}$', '')"
    return f"replace({bare}, '&amp;', '&')"


def url_aliases(rules: list) -> str:
    """Rules in the order of their length; an address is reached if a blocked one is connected with it."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    fits = [
        (f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in ordered
    ]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r.text}'" for c, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{r.verdict}'" for c, r in fits) + " END"
    return f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
), targets AS (
  SELECT url, trim({_attribute("tag", "href")}) AS target FROM tags
  WHERE lower(tag[2:5]) = 'link' AND lower(trim({_attribute("tag", "rel")})) = 'canonical'
  UNION ALL
  SELECT url, regexp_extract({_attribute("tag", "content")}, '(?is)^[^;,]*[;,]\\s*url\\s*=\\s*["'']?([^"'']*)', 1) FROM tags
  WHERE lower(tag[2:5]) = 'meta' AND lower(trim({_attribute("tag", "http-equiv")})) = 'refresh'
), resolved AS (
  SELECT url, CASE
      WHEN target = '' OR starts_with(target, '#') THEN NULL
      WHEN starts_with(target, '//') THEN 'http:' || target
      WHEN regexp_matches(target, '(?i)^[a-z][a-z0-9+.-]*://') THEN target
      WHEN regexp_matches(target, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
      WHEN starts_with(target, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target
      WHEN starts_with(target, '?') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || {_path("url")} || target
      ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
           || coalesce(nullif(regexp_replace({_path("url")}, '[^/]*$', ''), ''), '/') || target END AS target
  FROM targets
), pairs AS (
  SELECT {_address("url")} AS a, {_address("target")} AS b FROM resolved
), edges AS (
  SELECT a, b FROM pairs WHERE a <> b UNION SELECT b, a FROM pairs WHERE a <> b
), reached AS (
  SELECT a AS node FROM (SELECT a, {_host("'x://' || a")} AS host, {_path("'x://' || a")} AS path FROM edges)
  WHERE {verdict} = 'block'
  UNION SELECT edges.b FROM reached JOIN edges ON edges.a = reached.node
), judged AS (
  SELECT page_id, coalesce({_host("url")}, '') AS host, coalesce({_path("url")}, '') AS path, {_address("url")} AS node FROM pages
), decided AS (
  SELECT *, CASE WHEN node IS NOT NULL THEN {rule} END AS own_rule, CASE WHEN node IS NOT NULL THEN {verdict} END AS own
  FROM judged
)
SELECT page_id, host, path, own_rule AS rule,
       coalesce(own, CASE WHEN node IN (SELECT node FROM reached) THEN 'block' END, 'allow') AS verdict
FROM decided
"""


PIVOT_SEARCH = """
WITH whole AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM (SELECT *, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents
), spans AS (
  SELECT row, size, s, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM docs JOIN (SELECT DISTINCT size FROM item_windows) ON len(w) >= size)
), hits AS (
  SELECT row, s, size, item_id FROM spans JOIN item_windows USING (size, words)
), covered AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(s, s + size)) AS place FROM hits) GROUP BY row
), found AS (
  SELECT row, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""


def product_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Each round compares every part with every entry of its codebook."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row, * FROM (
    SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
), size AS (
  SELECT CAST(ceil(max(len(v)) / {parts}.0) AS BIGINT) AS w FROM kept
), cells AS MATERIALIZED (
  SELECT row, (i - 1) // w AS part, (i - 1) % w AS j, coalesce(v[i], 0) AS c
  FROM (SELECT row, v, w, unnest(range(1, {parts} * w + 1)) AS i FROM kept, size)
), book0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, j, c FROM cells WHERE row <= {entries}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT row, part, min(struct_pack(d := d, entry := entry)) AS hit FROM (
    SELECT x.row, part, b.entry, CAST(sum((x.c - b.c) * (x.c - b.c)) AS BIGINT) AS d
    FROM cells x JOIN book{r} b USING (part, j) GROUP BY ALL)
  GROUP BY row, part
)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, j, coalesce((s - ((s % n) + n) % n) // n, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT part, hit.entry AS entry, j, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
    FROM near{r} JOIN cells USING (row, part) GROUP BY ALL) USING (part, entry, j)
)""")
    return f"""WITH {",".join(steps)}, coded AS (
  SELECT row, string_agg(printf('%02x', hit.entry), '' ORDER BY part) AS code, CAST(sum(hit.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY row
), digest AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""


FILL_IN_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), split AS (
  SELECT *, array_to_string(units[1:least(a, b)], '') AS prefix,
         array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM split
"""
