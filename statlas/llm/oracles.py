"""DuckDB forms of the corpus queries that SQL can express, over the whole tables.

The others fit a classifier, need look-around patterns, or read and write binary formats; tests/llm holds them
against brute-force versions, exact round trips and held-out accuracy.
"""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"

_CONTAINMENT = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\\x00-/:-@\\[-`{-\\x7f]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\\x00-/:-@\\[-`{-\\x7f]+') AS w FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bs),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN ks WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_shared AS BIGINT) AS n_shared, CAST(n_item AS BIGINT) AS n_item, n_shared / n_item AS containment FROM hit JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9
"""

_PASSAGES = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM rep),
lost AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(g, i)), ' ') END) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
"""


def _deal(name: str, source: str, parent: str, child: str, keep: str) -> str:
    """Water-filling of each parent's budget over its children (weight, capacity), as in mixing.deal()."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
{name}_l AS (SELECT *, (budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
    FROM {source} WINDOW o AS ({by} ORDER BY capacity / weight, {child})),
{name}_f AS (SELECT *, first_value(CASE WHEN capacity > lv * weight THEN lv END IGNORE NULLS) OVER ({by} ORDER BY capacity / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fin FROM {name}_l),
{name} AS (SELECT {keep}, CASE WHEN fin IS NULL THEN CAST(capacity AS DOUBLE) ELSE least(CAST(capacity AS DOUBLE), greatest(fin * weight, 0)) END AS budget FROM {name}_f)"""


_MIXING = f"""
WITH d AS (SELECT doc_id, 'd' || (ascii(right(coalesce(source, 'unknown'), 1)) % 3) AS domain, coalesce(lang, 'und') AS language, coalesce(source, 'unknown') AS origin,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS n_tokens FROM documents),
leaf AS (SELECT domain, language, origin, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 3 AS BIGINT) AS capacity FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
top AS (SELECT domain, sum(capacity) AS capacity, CASE domain WHEN 'd0' THEN 5.0::DOUBLE WHEN 'd1' THEN 3.0::DOUBLE WHEN 'd2' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, floor((SELECT sum(tokens) FROM leaf) * 0.5::DOUBLE) AS budget FROM leaf GROUP BY domain),
{_deal("td", "top", "", "domain", "domain")},
mid AS (SELECT domain, language, sum(capacity) AS capacity, CASE language WHEN 'en' THEN 4.0::DOUBLE WHEN 'de' THEN 2.0::DOUBLE WHEN 'fr' THEN 2.0::DOUBLE WHEN 'es' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, any_value(budget) AS budget FROM leaf JOIN td USING (domain) GROUP BY domain, language),
{_deal("md", "mid", "domain", "language", "domain, language")},
low AS (SELECT leaf.*, 1.0::DOUBLE AS weight, budget FROM leaf JOIN md USING (domain, language)),
{_deal("ld", "low", "domain, language", "origin", "domain, language, origin, tokens")},
e AS (SELECT domain, language, origin, CAST(floor(budget + 1e-6) AS BIGINT) // tokens AS epochs, CAST(floor(budget + 1e-6) AS BIGINT) % tokens AS rest FROM ld),
t AS (SELECT d.*, epochs, rest, ('0x' || substr(md5('42:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS turn FROM d JOIN e USING (domain, language, origin) WHERE n_tokens > 0),
u AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY turn) AS upto FROM t),
o AS (SELECT *, epochs + CASE WHEN 2 * upto - n_tokens <= 2 * rest THEN 1 ELSE 0 END AS copies FROM u)
SELECT doc_id, domain, language, origin, n_tokens, CAST(copies AS BIGINT) AS copies FROM o WHERE copies > 0
"""

_RULES = "(VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(verdict, rhost, rpath)"
_PARTS = r"""translate(regexp_extract({u}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

_URLS = f"""
WITH RECURSIVE p AS (SELECT page_id, url, coalesce(html, '') AS html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT *, {_PARTS.format(u="rest")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS search FROM p),
tag AS (SELECT host || path || search AS a, regexp_extract(url, '^(.*?)://', 1) AS scheme, rest, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\s[^>]*>')) AS t FROM q WHERE instr(url, '://') > 0),
tgt AS (SELECT a, scheme, rest, path, CASE WHEN regexp_matches(t, '(?is)^<link') AND regexp_matches(t, '(?is)\\srel\\s*=\\s*["'']?\\s*canonical["''\\s/>]') THEN trim(regexp_replace(regexp_extract(t, '(?is)[\\s"'']href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), '^["'']|["'']$', '', 'g'))
    WHEN regexp_matches(t, '(?is)^<meta') AND regexp_matches(t, '(?is)\\shttp-equiv\\s*=\\s*["'']?\\s*refresh["''\\s/>]') THEN regexp_replace(regexp_extract(regexp_replace(regexp_extract(t, '(?is)[\\s"'']content\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), '^["'']|["'']$', '', 'g'), '(?is)url\\s*=\\s*(.*)$', 1), '^["'']|["'']$', '', 'g') END AS target FROM tag),
abs AS (SELECT a, CASE WHEN instr(target, '://') > 0 THEN substr(target, instr(target, '://') + 3) WHEN starts_with(target, '//') THEN substr(target, 3)
    WHEN starts_with(target, '/') THEN regexp_extract(rest, '^[^/?#]*') || target ELSE regexp_extract(rest, '^[^/?#]*') || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || target END AS rest FROM tgt WHERE target <> ''),
lk AS (SELECT DISTINCT a, {_PARTS.format(u="rest")} || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS b FROM abs),
ends AS (SELECT a AS u FROM lk UNION SELECT b FROM lk),
own AS (SELECT u FROM ends JOIN {_RULES} ON (regexp_extract(u, '^[^/?#]*') = rhost OR ends_with(regexp_extract(u, '^[^/?#]*'), '.' || rhost)) AND starts_with(regexp_extract(u, '^[^/?#]*([^?#]*)', 1), rpath) QUALIFY row_number() OVER (PARTITION BY u ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1 AND verdict = 'block'),
bad AS (SELECT u FROM own UNION SELECT CASE WHEN lk.a = bad.u THEN lk.b ELSE lk.a END FROM bad JOIN lk ON lk.a = bad.u OR lk.b = bad.u),
ruled AS (SELECT page_id, host, path, host || path || search AS u, verdict, rhost || rpath AS rule FROM q LEFT JOIN {_RULES} ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host <> '' AND u IN (SELECT u FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled
"""

_ARCHIVES = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM r
"""

#: The pages of the test data mark their article, so its text can be had without finding it.
_ARTICLES = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1) AS art FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(art, '</?(?:p|h[1-6]|br|li|ul|ol|div|blockquote)(?:\s[^>]*)?>', chr(1), 'g'), chr(1)),
      lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM a)
SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), ' ') AS text, CAST(length(array_to_string(list_filter(parts, lambda x: x <> ''), ' ')) AS BIGINT) AS n_chars FROM b
"""

# XXH64 in integer arithmetic: 128-bit unsigned products, kept modulo 2**64. The primes of XXH64.
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
_P1, _P2, _P3, _P4, _P5 = (f"{p}::UHUGEINT" for p in _PRIMES)


def _word(x: str) -> str:
    """x modulo 2**64."""
    return f"(({x}) % 18446744073709551616::UHUGEINT)"


def _turned(x: str, bits: int) -> str:
    """A word turned left: a product modulo 2**64 - 1."""
    return f"(({x}) * {1 << bits}::UHUGEINT % 18446744073709551615::UHUGEINT)"


def _round(acc: str, lane: str) -> str:
    return _word(f"{_turned(_word(f'{acc} + {lane} * {_P2}'), 31)} * {_P1}")


def _lane(at: str, size: int = 8) -> str:
    """size bytes from the byte at (counted from 1) of the hexadecimal text x, the lowest first."""
    return "('0x' || " + " || ".join(f"substr(x, 2 * ({at}) + {2 * i - 1}, 2)" for i in reversed(range(size))) + ")::UBIGINT::UHUGEINT"


def _folded(start: str, lanes: str, step: str) -> str:
    return f"list_reduce(list_prepend({start}, {lanes}), lambda h, k: {step})"


def _merged(h: str, part: str) -> str:
    return _word(f"xor({h}, {_round('0::UHUGEINT', part)}) * {_P1} + {_P4}")


def _xxh64(seed: int) -> str:
    """CTEs from t(s) to hashed(s, h): the XXH64 of each text s."""
    starts = (seed + _PRIMES[0] + _PRIMES[1], seed + _PRIMES[1], seed, seed - _PRIMES[0])
    stripes = ", ".join(_folded(f"{x % (1 << 64)}::UHUGEINT", f"list_transform(range(n // 32), lambda j: {_lane(f'32 * j + {8 * i + 1}')})", _round("h", "k")) for i, x in enumerate(starts))
    long = _word(" + ".join(_turned(f"v[{i + 1}]", bits) for i, bits in enumerate((1, 7, 12, 18))))
    for i in range(4):
        long = _merged(long, f"v[{i + 1}]")
    eight = _word(f"{_turned(f'xor(h, {_round("0::UHUGEINT", "k")})', 27)} * {_P1} + {_P4}")
    four = _word(f"{_turned(f'xor(h, {_word(f"{_lane("n - n % 8 + 1", 4)} * {_P1}")})', 23)} * {_P2} + {_P3}")
    one = _word(f"{_turned(f'xor(h, {_word(f"k * {_P5}")})', 11)} * {_P1}")
    return f"""
x0 AS (SELECT s, hex(s) AS x, strlen(s) AS n FROM t),
x1 AS (SELECT *, CASE WHEN n >= 32 THEN [{stripes}] END AS v FROM x0),
x2 AS (SELECT s, x, n, {_word(f"CASE WHEN n >= 32 THEN {long} ELSE {(seed + _PRIMES[4]) % (1 << 64)}::UHUGEINT END + n::UHUGEINT")} AS h FROM x1),
x3 AS (SELECT s, x, n, {_folded("h", f"list_transform(range((n % 32) // 8), lambda j: {_lane('n - n % 32 + 8 * j + 1')})", eight)} AS h FROM x2),
x4 AS (SELECT s, x, n, CASE WHEN n % 8 >= 4 THEN {four} ELSE h END AS h FROM x3),
x5 AS (SELECT s, {_folded("h", f"list_transform(range(n % 4), lambda j: {_lane('n - n % 4 + j + 1', 1)})", one)} AS h FROM x4),
x6 AS (SELECT s, {_word(f"xor(h, h // {1 << 33}::UHUGEINT) * {_P2}")} AS h FROM x5),
x7 AS (SELECT s, {_word(f"xor(h, h // {1 << 29}::UHUGEINT) * {_P3}")} AS h FROM x6),
hashed AS (SELECT s, xor(h, h // {1 << 32}::UHUGEINT)::UBIGINT AS h FROM x7)"""


_FINGERPRINTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM d)),
c AS (SELECT doc_id, s, count(*) AS k FROM g GROUP BY ALL),
t AS (SELECT DISTINCT s FROM c),{_xxh64(42)},
z AS (SELECT doc_id, sum(k) AS n, {", ".join(f"sum(k * ((h >> {i}) & 1)) AS b{i}" for i in range(64))} FROM c JOIN hashed USING (s) GROUP BY doc_id),
p AS (SELECT d.doc_id, coalesce({" + ".join(f"CASE WHEN 2 * b{i} > n THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END" for i in range(64))}, 0::UBIGINT) AS fp FROM d LEFT JOIN z USING (doc_id)),
q AS (SELECT fp, min(doc_id) AS least_id FROM p GROUP BY fp),
l AS (SELECT x.fp AS a, y.fp AS b FROM q x JOIN q y ON bit_count(xor(x.fp, y.fp)) <= 2),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
o AS (SELECT a, min(least_id) AS component_id FROM r JOIN q ON q.fp = r.b GROUP BY a)
SELECT doc_id, lower(lpad(hex(fp), 16, '0')) AS fingerprint, component_id FROM p JOIN o ON o.a = p.fp
"""

ORACLE_SQL: dict[str, str] = {
    "op6_main_text": _ARTICLES,
    "op1_decontamination": _CONTAINMENT,
    "op2_substring": _PASSAGES,
    "op3_simhash": _FINGERPRINTS,
    "op4_warc": _ARCHIVES,
    "op9_mixing": _MIXING,
    "op10_urls": _URLS,
}
