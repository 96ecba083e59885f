"""SQL twins of the text queries, for checking against another engine.

Constants are written out here, not taken from the operators. Queries whose
method SQL cannot say (models trained by gradients or sampled, decoding layers,
page structure) have none; tests check them by brute force, round trip or accuracy.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PHRASES = (
    "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright",
    "licensed under", "released under", "subscribe", "newsletter", "sign in", "sign up", "log in", "login",
    "javascript", "click here", "read more", "share this", "lorem ipsum",
    "datenschutz", "impressum", "nutzungsbedingungen", "alle rechte vorbehalten", "jetzt anmelden", "jetzt registrieren",
    "abonnieren", "weiterlesen", "hier klicken", "seite teilen",
    "politique de confidentialité", "mentions légales", "conditions générales", "tous droits réservés", "abonnez-vous",
    "inscrivez-vous", "connectez-vous", "lire la suite", "cliquez ici", "partager cet article",
    "política de privacidad", "aviso legal", "términos de uso", "condiciones de uso", "todos los derechos reservados",
    "suscríbete", "regístrate", "iniciar sesión", "leer más", "haz clic aquí", "compartir este artículo",
)
_NOTICE = f"length(x) <= 120 * len(list_filter([{', '.join(f"'{p}'" for p in _PHRASES)}], lambda p: contains(lower(x), p)))"
_CLOSED = "right(rtrim(x, '''\")]»”’ ' || chr(9) || chr(13)), 1)"

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
p AS (SELECT doc_id, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM p WHERE len(w) >= 3)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
m AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id),
q AS (SELECT p.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(m.n, 0) AS BIGINT) AS n_repeat_words,
        coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) AS line_chars,
        coalesce(list_sum(list_transform(list_filter(lines, lambda x: NOT (
            {_CLOSED} = '' OR NOT contains('.!?:;…。！？', {_CLOSED}) OR {_NOTICE}
            OR length(x) - length(regexp_replace(x, '[|»›·•]', '', 'g')) > 2
            OR length(x) - length(replace(x, '!!', '')) > 4
            OR length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) > 0.05 * length(x))), lambda x: length(x))), 0) AS good_chars
        FROM p LEFT JOIN m ON p.doc_id = m.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND line_chars > 0 AND 2 * good_chars >= line_chars AS kept FROM b
"""

_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, $$$$)')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
DECONTAMINATION = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item, least(13, len(w)) AS size, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS pos FROM i WHERE len(w) > 0),
t AS (SELECT DISTINCT item, size, array_to_string(w[pos:pos + size - 1], ' ') AS gram FROM iw),
s AS (SELECT DISTINCT size FROM t),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM d, s WHERE len(w) >= size),
h AS (SELECT dw.doc_id, dw.pos, dw.size, t.item
        FROM (SELECT doc_id, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS gram FROM dw) AS dw JOIN t ON dw.gram = t.gram AND dw.size = t.size),
n AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM h) GROUP BY doc_id),
e AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(e.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(e.items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN e ON d.doc_id = e.doc_id
"""


def _level(order: int, below: str) -> str:
    """Interpolated estimates after ``order`` characters for both classes."""
    one = "CASE WHEN s.n{0} = 0 THEN {1} ELSE (c.{0} + s.k{0} * {1}) / (s.n{0} + s.k{0}) END AS p{0}"
    low = ("l.pa", "l.pb") if below else ("1.0 / z.size", "1.0 / z.size")
    source = f"JOIN p{order - 1} AS l ON substr(c.gram, 2) = l.gram" if below else "CROSS JOIN (SELECT count(*) AS size FROM c0) AS z"
    return f"""
s{order} AS (SELECT substr(gram, 1, {order}) AS context, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ka, count(*) FILTER (b > 0) AS kb
        FROM c{order} GROUP BY 1),
p{order} AS (SELECT c.gram, {one.format("a", low[0])}, {one.format("b", low[1])}
        FROM c{order} AS c JOIN s{order} AS s ON substr(c.gram, 1, {order}) = s.context {source})"""


_REST = "substr(url, instr(url, '://') + 3)"
URLS = f"""
WITH h AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN {_LOWER.format(f"regexp_extract({_REST}, '^[^/?#]*')")} ELSE '' END AS host,
        CASE WHEN instr(url, '://') > 0 THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
f AS (SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM h),
v AS (SELECT *, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled FROM f),
u AS (SELECT DISTINCT url, ruled, chr(2) || chr(2) || chr(2) || {_LOWER.format("url")} || chr(3) AS padded FROM v WHERE url IS NOT NULL),
w AS (SELECT url, ruled, substr(padded, pos, 4) AS gram FROM (SELECT *, unnest(range(1, length(padded) - 2)) AS pos FROM u)),
c3 AS (SELECT gram, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM w GROUP BY 1),
c2 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(b) AS b FROM c3 GROUP BY 1),
c1 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(b) AS b FROM c2 GROUP BY 1),
c0 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(b) AS b FROM c1 GROUP BY 1),
{_level(0, "")}, {_level(1, "p0")}, {_level(2, "p1")}, {_level(3, "p2")},
e AS (SELECT w.url, any_value(w.ruled) AS ruled, avg(ln(pa) - ln(pb)) AS score FROM w JOIN p3 ON w.gram = p3.gram GROUP BY 1),
t AS (SELECT (avg(score) FILTER (ruled = 'allow') + avg(score) FILTER (ruled = 'block')) / 2 AS cut FROM e)
SELECT v.page_id, v.host, v.path, v.rule, coalesce(v.ruled, CASE WHEN e.score < t.cut THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN e ON v.url = e.url CROSS JOIN t
"""

INFILL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""

TWINS: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op3_decontamination": DECONTAMINATION,
    "op7_url_filter": URLS,
    "op11_infill": INFILL,
}
