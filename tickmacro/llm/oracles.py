"""The SQL form of the text queries, where SQL can express them.

Left out: sentence dedup (runs of a length that the words decide), SimHash (XXH64,
components), the maximum-entropy model (gradient updates), whitening (eigenvectors) and
the main text of pages (nested markup); tests hold these against brute force.
"""

from __future__ import annotations

import math

from tickmacro.llm import pii, quality, secret_scan, sharding, url_filter
from tickmacro.llm.queries import SHARDS, URL_RULES

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(kind: str, pattern: str) -> str:
    """Rows rid, kind, s, v of all matches in the texts of d; positions from the lengths
    of what lies between them."""
    return f"""
  SELECT rid, '{kind}' AS kind, s::BIGINT AS s, v FROM (
    SELECT rid, v, sum(gap + coalesce(length(before), 0)) OVER (PARTITION BY rid ORDER BY i) AS s FROM (
      SELECT *, lag(v) OVER (PARTITION BY rid ORDER BY i) AS before FROM (
        SELECT rid, unnest(range(1, len(p) + 1)) AS i, unnest(f) AS v, unnest(list_transform(p, lambda x: length(x))) AS gap
        FROM (SELECT rid, regexp_extract_all(t, {_quoted(pattern)}) AS f, string_split_regex(t, {_quoted(pattern)}) AS p FROM d))))
  WHERE v IS NOT NULL"""


def _digest(rows: str, key: str, ranks: dict[str, int]) -> str:
    """kind:start:end of rows (key, kind, s, e) by start and rank, joined for each key."""
    rank = "CASE kind " + " ".join(f"WHEN '{k}' THEN {r}" for k, r in ranks.items()) + " END"
    return (
        f"SELECT {key}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, {rank}, e) AS text"
        f" FROM {rows} GROUP BY {key}"
    )


_NUMBERED = "SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents"

# Letters in either case are spelled out: a case-insensitive match would also take
# letters beyond ASCII that fold to them.
_KEY = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else "_?" for c in word)
    for word in ("password", "passwd", "secret", "token", "api_key")
)
_ASSIGN = rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ASSIGN_VALUE = f"regexp_extract(v, {_quoted(_ASSIGN)}, 2)"

OP1 = f"""
WITH d AS ({_NUMBERED}),
found AS (
  {_spans("assign", _ASSIGN)} UNION ALL {_spans("access", "AKIA[A-Z0-9]+")} UNION ALL {_spans("hex", "[0-9a-f]+")}
),
base AS (
  SELECT rid, kind, s, s + length(v) AS e, v,
         CASE kind WHEN 'assign' THEN {_ASSIGN_VALUE} ELSE v END AS value
  FROM found
  WHERE CASE kind WHEN 'assign' THEN length({_ASSIGN_VALUE}) >= 8
                  WHEN 'access' THEN length(v) >= 16 ELSE length(v) >= 32 END
),
tokens AS (
  SELECT rid, kind, s, s + length(v) AS e, v AS value
  FROM ({_spans("random", secret_scan.TOKEN)})
),
free AS (
  SELECT * FROM tokens t
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = t.rid AND b.s < t.e AND t.s < b.e)
),
samples AS (
  SELECT value, true AS random FROM base
  UNION ALL
  SELECT value, false FROM free
  WHERE regexp_matches(value, '^([0-9]+|[A-Z]+|[A-Z]?[a-z]+)([_-]([0-9]+|[A-Z]+|[A-Z]?[a-z]+))*$')
),
values_of AS (
  SELECT value, max(is_free) AS is_free, sum(pos) AS pos, sum(neg) AS neg FROM (
    SELECT value, 0 AS is_free, random::INT AS pos, (NOT random)::INT AS neg FROM samples
    UNION ALL SELECT value, 1, 0, 0 FROM free)
  GROUP BY value
),
steps AS (
  SELECT value, pos, neg,
         CASE WHEN i = 0 THEN 0 ELSE ord(value[i]) END AS a,
         CASE WHEN i = length(value) THEN 0 ELSE ord(value[i + 1]) END AS b
  FROM values_of, unnest(range(0, length(value) + 1)) r(i)
),
pairs AS (SELECT a, b, sum(pos) AS n1, sum(neg) AS n0 FROM steps GROUP BY a, b),
lasts AS (SELECT a, sum(n1) AS t1, sum(n0) AS t0 FROM pairs GROUP BY a),
scored AS (
  SELECT value, any_value(pos) AS pos, any_value(neg) AS neg,
         sum(ln((n1 + 0.5) / (t1 + 64.0)) - ln((n0 + 0.5) / (t0 + 64.0))) / (length(value) + 1) AS score
  FROM (SELECT value, pos, neg, a, b FROM steps) JOIN pairs USING (a, b) JOIN lasts USING (a)
  GROUP BY value
),
means AS (
  SELECT sum(score * pos) / sum(pos) AS m1, sum(score * neg) / sum(neg) AS m0 FROM scored
),
spans AS (
  SELECT rid, kind, s, e FROM base
  UNION ALL
  SELECT rid, kind, s, e FROM free JOIN scored USING (value), means
  WHERE m1 > m0 AND score > (m1 + m0) / 2
),
base_text AS ({_digest("base", "rid", secret_scan.RANKS)}),
span_text AS ({_digest("spans", "rid", secret_scan.RANKS)}),
counts AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex
  FROM base GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.text, '')) AS base_sha256, coalesce(x.text, '') AS spans
FROM d LEFT JOIN counts USING (rid) LEFT JOIN base_text b USING (rid) LEFT JOIN span_text x USING (rid)
"""

_RULE = "CASE " + " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.name))
) + " END"
_ALLOWED = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {str(r.allow).lower()}" for r in URL_RULES) + " END"
_N = url_filter.CODES
_CODE = f"CASE WHEN strpos('{url_filter.ALPHABET}', x) > 0 THEN strpos('{url_filter.ALPHABET}', x) ELSE {_N - 1} END"

OP3 = f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split AS (
  SELECT rid, page_id, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         substr(rest, length(regexp_extract(rest, '^[^?#]*')) + 1) AS tail FROM u
),
ruled AS (SELECT *, {_RULE} AS rule FROM split),
judged AS (
  SELECT *, {_ALLOWED} AS allowed,
         list_transform(list_filter(string_split(translate({_lower("host || path || tail")}, '123456789', '000000000'), ''),
                                    lambda x: x <> ''), lambda x: {_CODE}) AS c
  FROM ruled
),
hashed AS (
  SELECT *, [0, 0] || c || [0] AS padded FROM judged
),
grams AS (
  SELECT rid, allowed, host || path AS name, padded[i] AS a, padded[i + 1] AS b, padded[i + 2] AS c
  FROM hashed, unnest(range(1, len(padded) - 1)) r(i)
),
folds AS (
  SELECT rid, allowed, ('0x' || substr(md5(host || path), 1, 4))::INT % 5 AS fold FROM judged WHERE allowed IS NOT NULL
),
tri AS (
  SELECT a, b, c, count(*) FILTER (f.allowed) AS y, count(*) FILTER (NOT f.allowed) AS n
  FROM grams g JOIN folds f USING (rid) WHERE fold <> 0 GROUP BY a, b, c
),
ab AS (SELECT a, b, sum(y) AS y_ab, sum(n) AS n_ab FROM tri GROUP BY a, b),
bc AS (SELECT b, c, sum(y) AS y_bc, sum(n) AS n_bc FROM tri GROUP BY b, c),
b1 AS (SELECT b, sum(y) AS y_b, sum(n) AS n_b FROM tri GROUP BY b),
c1 AS (SELECT c, sum(y) AS y_c, sum(n) AS n_c FROM tri GROUP BY c),
total AS (SELECT sum(y) AS ty, sum(n) AS tn FROM tri),
own AS (
  SELECT rid, coalesce(y, 0) AS y, coalesce(n, 0) AS n, coalesce(y_ab, 0) AS y_ab, coalesce(n_ab, 0) AS n_ab,
         coalesce(y_bc, 0) AS y_bc, coalesce(n_bc, 0) AS n_bc, coalesce(y_b, 0) AS y_b, coalesce(n_b, 0) AS n_b,
         (coalesce(y_c, 0) + 1) / (ty + {_N})::DOUBLE AS py, (coalesce(n_c, 0) + 1) / (tn + {_N})::DOUBLE AS pn
  FROM grams LEFT JOIN tri USING (a, b, c) LEFT JOIN ab USING (a, b) LEFT JOIN bc USING (b, c)
  LEFT JOIN b1 USING (b) LEFT JOIN c1 USING (c), total WHERE ty > 0 AND tn > 0
),
rated AS (
  SELECT rid, floor(greatest(least(avg(ln((y + 2 * ((y_bc + 2 * py) / (y_b + 2))) / (y_ab + 2))
                                       - ln((n + 2 * ((n_bc + 2 * pn) / (n_b + 2))) / (n_ab + 2))),
                                   {url_filter.FURTHEST}), -{url_filter.FURTHEST}) * {url_filter.STEPS}) AS step
  FROM own GROUP BY rid
),
per AS (
  SELECT step, count(*) FILTER (allowed) AS y, count(*) FILTER (NOT allowed) AS n
  FROM folds JOIN rated USING (rid) WHERE fold = 0 GROUP BY step
),
cuts AS (
  SELECT step, floor((step + coalesce(lead(step) OVER (ORDER BY step), step)) / 2) AS halfway,
         sum(y) OVER (ORDER BY step) / nullif(sum(y) OVER (), 0) AS wrong,
         sum(n) OVER (ORDER BY step) / nullif(sum(n) OVER (), 0) AS reject FROM per
),
cut AS (
  SELECT halfway AS cut FROM cuts WHERE wrong <= 0.01 AND reject IS NOT NULL ORDER BY reject - wrong DESC, step LIMIT 1
)
SELECT page_id, host, path, rule,
       CASE WHEN coalesce(allowed, NOT coalesce(step <= (SELECT cut FROM cut), false)) THEN 'allow' ELSE 'block' END AS verdict
FROM judged LEFT JOIN rated USING (rid)
"""

_LIMITS = pii.Disclosure()
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE"
    f" WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INT"
    f" ELSE (substr(reverse({_DIGITS}), i, 1)::INT * 2) // 10 + (substr(reverse({_DIGITS}), i, 1)::INT * 2) % 10 END)) % 10 = 0"
)
_PII_FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LETTER = r"[\p{L}\p{M}]"

OP4 = f"""
WITH d AS ({_NUMBERED}),
found AS ({" UNION ALL ".join(_spans(k, p) for k, p in _PII_FORMS.items())}),
base AS (
  SELECT rid, t, kind, s, s + length(v) AS e, v FROM found JOIN d USING (rid)
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'), lambda p: p::HUGEINT <= 255))
    WHEN 'card' THEN length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}
    ELSE length({_DIGITS}) BETWEEN 10 AND 15 END
),
sides AS (
  SELECT rid, kind || ':' || CASE kind WHEN 'email' THEN lower(v) ELSE {_DIGITS} END AS entity,
         substr(t, greatest(s - {pii.NEAR_CHARS}, 0) + 1, least(s, {pii.NEAR_CHARS})) AS l,
         substr(t, e + 1, {pii.NEAR_CHARS}) AS r, s
  FROM base
),
cut AS (
  SELECT rid, entity,
         regexp_extract_all(lower(CASE WHEN s > {pii.NEAR_CHARS} THEN regexp_replace(l, '^{_LETTER}+', '') ELSE l END), '{pii.TERM}') AS l,
         regexp_extract_all(lower(CASE WHEN length(r) = {pii.NEAR_CHARS} THEN regexp_replace(r, '{_LETTER}+$', '') ELSE r END), '{pii.TERM}') AS r
  FROM sides
),
contexts AS (SELECT rid, entity, l[-{pii.NEAR_TERMS}:] AS l, r[1:{pii.NEAR_TERMS}] AS r FROM cut),
near AS (SELECT rid, entity, l, r, unnest(list_distinct(l || r)) AS term FROM contexts),
pairs AS (
  SELECT entity, term FROM (SELECT DISTINCT entity, term, l, r FROM near)
  GROUP BY entity, term HAVING count(*) >= {_LIMITS.support}
),
both_of AS (SELECT entity, term, count(DISTINCT rid) AS n_both FROM near JOIN pairs USING (entity, term) GROUP BY entity, term),
entities AS (SELECT entity, count(DISTINCT rid) AS n_entity FROM near GROUP BY entity),
placed AS ({_spans("term", pii.TERM)}),
holders AS (
  SELECT lower(v) AS term, count(DISTINCT rid) AS n_term FROM placed
  WHERE lower(v) IN (SELECT term FROM pairs) GROUP BY lower(v)
),
rated AS (
  SELECT term, max(n_both / n_term) AS chance FROM both_of JOIN holders USING (term) JOIN entities USING (entity)
  WHERE log2((n_both / n_term) / (n_entity / (SELECT count(*) FROM d))) >= {_LIMITS.bits} GROUP BY term
),
flagged AS (
  SELECT term, CASE WHEN chance >= {_LIMITS.remove} THEN 'remove' ELSE 'generalise' END AS kind
  FROM rated WHERE chance >= {_LIMITS.generalise}
),
terms AS (
  SELECT rid, f.kind, s, s + length(v) AS e FROM placed p JOIN flagged f ON lower(p.v) = f.term
),
spans AS (
  SELECT rid, kind, s, e FROM base
  UNION ALL
  SELECT rid, kind, s, e FROM terms t
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = t.rid AND b.s < t.e AND t.s < b.e)
),
base_text AS ({_digest("base", "rid", pii.RANKS)}),
span_text AS ({_digest("spans", "rid", pii.RANKS)}),
counts AS (
  SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _PII_FORMS)} FROM base GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in _PII_FORMS)},
       sha256(coalesce(b.text, '')) AS base_sha256, coalesce(x.text, '') AS spans
FROM d LEFT JOIN counts USING (rid) LEFT JOIN base_text b USING (rid) LEFT JOIN span_text x USING (rid)
"""

_TOKENS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP5 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_TOKENS}') AS w
  FROM documents
),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_lower("coalesce(text, '')")}, '{_TOKENS}') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) r(k) WHERE len(w) > 0
),
runs AS (
  SELECT rid, k, m, array_to_string(w[k:k + m - 1], ' ') AS s
  FROM d, (SELECT DISTINCT m FROM windows), unnest(range(1, len(w) - m + 2)) r(k)
),
found AS (SELECT DISTINCT rid, k, m, item FROM runs JOIN windows USING (m, s)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + m)) AS p FROM found) GROUP BY rid
),
listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN listed USING (rid)
"""

_PLACE = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS}"

OP6 = f"""
SELECT doc_id, slot, 'shard-' || lpad(shards[slot + 1]::VARCHAR, 4, '0') AS shard
FROM (SELECT doc_id, ({_PLACE})::INTEGER AS slot FROM documents),
     (SELECT {sharding.fill_table(SHARDS)} AS shards)
"""

_RISK = quality.Risk()
_RATE = _RISK.false_rejects


def _any(steps: int) -> str:
    """What the rules reject after so many steps."""
    return " OR ".join(f"{rule} > {cut}" for rule, cut in quality.STEPS[:steps])


OP7 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
runs AS (SELECT rid, k, array_to_string(w[k:k + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) r(k)),
again AS (SELECT rid, s FROM runs GROUP BY rid, s HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(k, k + 5)) AS p FROM runs JOIN again USING (rid, s))
  GROUP BY rid
),
counted AS (
  SELECT rid, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '{quality.SYMBOLS}', '', 'g')) AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN covered USING (rid)
),
measured AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeats,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_lines, coalesce(word_chars / nullif(n_words, 0), 0) AS word_length,
         coalesce(n_upper / nullif(word_chars, 0), 0) AS capitals
  FROM counted
),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
tried AS ({" UNION ALL ".join(f"SELECT lang, {k} AS k, count(*) AS n, count(*) FILTER ({_any(k)}) AS x FROM held GROUP BY lang" for k in range(1, len(quality.STEPS) + 1))}),
judged AS (
  SELECT lang, k, x < n * {_RATE!r} AND list_sum(list_transform(range(0, x + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {math.log(_RATE)!r} + (n - i) * {math.log(1 - _RATE)!r})))
    <= {_RISK.failure!r} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM held)) AS sure
  FROM tried
),
reached AS (SELECT lang, coalesce(min(k) FILTER (NOT sure), {len(quality.STEPS) + 1}) AS k FROM judged GROUP BY lang),
rejected AS (
  SELECT DISTINCT rid FROM measured m JOIN reached r ON m.lang IS NOT DISTINCT FROM r.lang
  WHERE {" OR ".join(f"(r.k > {k} AND {rule} > {cut})" for k, (rule, cut) in enumerate(quality.STEPS, 1))}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM rejected) AS kept
FROM measured
"""

OP8 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS key
  FROM documents
),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w, 3 * source_size AS cap,
         sum(source_size) OVER () AS total FROM per
),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(w) OVER before, 0) AS w_before, sum(w) OVER () AS w_all
  FROM weighted WINDOW before AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
capped AS (SELECT *, (total - cap_before) * w >= cap * (w_all - w_before) AS at_cap FROM ordered),
targets AS (
  SELECT source, source_size,
         CASE WHEN at_cap THEN cap::DOUBLE
              ELSE (total - coalesce(sum(cap) FILTER (WHERE at_cap) OVER (), 0))::DOUBLE * w
                   / greatest(coalesce(sum(w) FILTER (WHERE NOT at_cap) OVER (), 0), 1) END AS target
  FROM capped
),
running AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM running
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]', 0, 's') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g"""

LLM_ORACLES: dict[str, str] = {
    "op1_secrets": OP1,
    "op3_urls": OP3,
    "op4_pii": OP4,
    "op5_decontaminate": OP5,
    "op6_shard": OP6,
    "op7_quality": OP7,
    "op8_mix": OP8,
    "op12_fill_middle": OP12,
}
