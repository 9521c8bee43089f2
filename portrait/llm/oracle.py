"""DuckDB SQL of the queries that SQL can express.

No SQL: the SentencePiece search, the MinHash license scan's windows, the tree
model, and the language model (its floating-point sums follow no fixed order);
they are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _words(text: str, gap: str) -> str:
    return f"list_filter(string_split_regex({text}, '{gap}'), lambda x: x <> '')"


_SPACED = r"[\x20\x09-\x0D]+"
_PUNCT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_words(_LOWER.format('text'), _PUNCT)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(_LOWER.format('text'), _PUNCT)} AS w FROM benchmark),
bw AS (SELECT item, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
dw AS (SELECT doc_id, l.n, unnest(list_transform(range(1, len(w) - l.n + 2),
              lambda i: {{'i': i, 's': array_to_string(w[i:i + l.n - 1], ' ')}})) AS g
       FROM d, (SELECT DISTINCT n FROM win) l WHERE len(w) >= l.n),
hit AS (SELECT dw.doc_id, dw.n, dw.g.i AS i, win.item FROM dw JOIN win ON dw.n = win.n AND dw.g.s = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op3_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host,
                  {_words("coalesce(text, '')", _SPACED)} AS w FROM documents),
tri AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2),
trig AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM tri),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM trig WHERE c > 1)
        GROUP BY doc_id),
raw AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT doc_id, host, text, line, {_words('line', _SPACED)} AS lw FROM raw),
lns AS (SELECT *, translate(lower(array_to_string(lw, ' ')), '123456789', '000000000') AS norm FROM ln WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lns GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM lns GROUP BY host),
often AS (SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM lns GROUP BY host, norm)
          JOIN hosts USING (host) WHERE n > 20 AND (n > 0.01 * texts OR n > 1000)),
gone AS (SELECT doc_id, sum(len(lw)) AS n FROM lns JOIN often USING (host, norm) GROUP BY doc_id),
s AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone.n, 0) AS BIGINT) AS n_line_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_line_words >= 0.5 * n_words AS kept
FROM s""",
    "op4_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_LOWER.format('text'), _SPACED)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS t FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM n JOIN r ON r.x = n.doc_id GROUP BY n.doc_id, n.n""",
    "op6_chat_format": r"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
                  coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, CASE WHEN regexp_matches(text, '[<\[]\\*(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])')
                THEN regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g')
                ELSE text END AS body FROM t),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(len('<|im_start|>') + len(role) + 1 + len(body) + len('<|im_end|>') + 1) AS chars
      FROM f GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(every) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g""",
    "op7_url_filter": r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(v, h, q) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                          ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (SELECT page_id, arg_max(h || q, len(h || q)) AS rule, arg_max(v, len(h || q)) AS verdict
        FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id),
o AS (SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
             list_reverse(string_split(host, '.')) AS parts FROM p LEFT JOIN o USING (page_id) GROUP BY host),
k AS (SELECT host, n, bad, parts[1] AS suffix, CASE WHEN len(parts) > 1 THEN parts[2] || '.' || parts[1] ELSE host END AS domain
      FROM h),
dg AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM k GROUP BY domain, suffix),
sg AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM k GROUP BY suffix),
lv AS (SELECT 0 AS l, '' AS parent, n, bad FROM sg WHERE n > 0 UNION ALL SELECT 1, suffix, n, bad FROM dg WHERE n > 0
       UNION ALL SELECT 2, domain, n, bad FROM k WHERE n > 0),
per AS (SELECT l, count(*) AS k, sum(n) AS w, sum(n * n) AS q, sum(bad) AS b, sum(bad * bad / n) AS s FROM lv GROUP BY l, parent),
mom AS (SELECT l, sum(s - b * b / w - b / w * (1 - b / w) * (k - 1)) AS spare,
               sum(b / w * (1 - b / w) * (w - q / w - (k - 1))) AS room FROM per GROUP BY l),
st AS (SELECT l, CASE WHEN room > 0 THEN 1 / greatest(least(spare / room, 1 / 1.5::DOUBLE), 1 / 10001.0::DOUBLE) - 1
                      ELSE 10.0::DOUBLE END AS m FROM mom),
e AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) ELSE 0.5::DOUBLE END AS rate,
             coalesce((SELECT m FROM st WHERE l = 0), 10.0::DOUBLE) AS m0, coalesce((SELECT m FROM st WHERE l = 1), 10.0::DOUBLE) AS m1,
             coalesce((SELECT m FROM st WHERE l = 2), 10.0::DOUBLE) AS m2 FROM k),
sx AS (SELECT suffix, (bad + m0 * rate) / (n + m0) AS m FROM sg, e),
dm AS (SELECT domain, (dg.bad + m1 * sx.m) / (dg.n + m1) AS m FROM dg JOIN sx USING (suffix), e),
ab AS (SELECT host, bad + m2 * dm.m AS a, n - bad + m2 * (1 - dm.m) AS b FROM k JOIN dm USING (domain), e),
rg AS (SELECT host, a, b, ln(a / b) AS y0, ln(a / b) - 8 * sqrt(1 / a + 1 / b) - 30 / a AS lo,
              ln(a / b) + 8 * sqrt(1 / a + 1 / b) + 30 / b AS hi FROM ab),
tp AS (SELECT *, a * y0 - (a + b) * (greatest(y0, 0) + ln(1 + exp(-abs(y0)))) AS top FROM rg),
gr AS (SELECT host, side, any_value(lo) AS lo, any_value(hi) AS hi, any_value(abs(from_ - to_)) / 128
              * sum(CASE WHEN i IN (0, 128) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                    * exp(a * y - (a + b) * (greatest(y, 0) + ln(1 + exp(-abs(y)))) - top)) AS area
       FROM (SELECT *, from_ + i * (to_ - from_) / 128 AS y FROM (
               SELECT *, 0 AS side, lo AS from_, 0.0::DOUBLE AS to_ FROM tp
               UNION ALL SELECT *, 1, 0.0::DOUBLE, hi FROM tp) z, range(0, 129) g(i) WHERE lo < 0 AND hi > 0)
       GROUP BY host, side),
ar AS (SELECT host, sum(area) FILTER (side = 1) / sum(area) AS above FROM gr GROUP BY host),
j AS (SELECT host, CASE WHEN lo >= 0 THEN true WHEN hi <= 0 THEN false ELSE above >= 0.95 END AS blocked
      FROM tp LEFT JOIN ar USING (host))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (page_id) JOIN j USING (host)""",
    "op8_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, unnest(list_transform(range(0, len(x) // 2 - 399),
             lambda i: {'i': i, 'h': md5(substring(x, CAST(2 * i + 1 AS BIGINT), 800))})) AS p FROM d WHERE len(x) >= 800),
c AS (SELECT p.h AS h FROM s GROUP BY 1 HAVING count(*) > 1),
a AS (SELECT doc_id, p.i AS i, max(p.i + 400) OVER (PARTITION BY doc_id ORDER BY p.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e
      FROM s JOIN c ON p.h = c.h),
g AS (SELECT doc_id, i, sum(CASE WHEN e IS NULL OR i > e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM a),
r AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, span),
t AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(b ORDER BY a) AS bs, list(a ORDER BY a) AS az FROM r GROUP BY doc_id),
k AS (SELECT d.doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
             CASE WHEN bs IS NULL THEN x ELSE array_to_string(list_transform(range(1, len(bs) + 2), lambda j: substring(x,
               CAST(2 * (CASE WHEN j = 1 THEN 0 ELSE bs[j - 1] END) + 1 AS BIGINT),
               CAST(2 * ((CASE WHEN j > len(bs) THEN len(x) // 2 ELSE az[j] END) - (CASE WHEN j = 1 THEN 0 ELSE bs[j - 1] END)) AS BIGINT))), '') END AS kept
      FROM d LEFT JOIN t USING (doc_id))
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(kept)) AS kept_sha256 FROM k""",
}
