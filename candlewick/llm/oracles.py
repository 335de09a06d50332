"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

from .urls import LISTED, LOWER, RULES, UPPER

_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _spans(kind: str, rank: int, pattern: str, keep: str, score: str = "1.0") -> str:
    """(doc_id, start, rank, kind, end) of the confirmed matches of a kind."""
    return f"""
SELECT doc_id, s AS start, {rank} AS rank, '{kind}' AS kind, s + length(v) AS stop FROM (
  SELECT doc_id, t, unnest(m) AS v, unnest(list_transform(range(1, len(m) + 1), lambda i:
    list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))) AS s
  FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM texts)
) WHERE {keep} AND {score} >= 0.6"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN reverse({_DIGITS})[i]::INT WHEN reverse({_DIGITS})[i]::INT > 4 THEN reverse({_DIGITS})[i]::INT * 2 - 9
  ELSE reverse({_DIGITS})[i]::INT * 2 END)) % 10 = 0"""

PII = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_spans("email", 0, _MAIL, "true")} UNION ALL
{_spans("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_matches(v, '^{_PART}(\.{_PART}){{3}}$')")} UNION ALL
{_spans("card", 2, "[0-9]([ -]?[0-9])+", _LUHN)} UNION ALL
{_spans("phone", 3, r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}),
rows AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN rows USING (doc_id)"""

DECONTAMINATION = r"""
WITH worded AS (SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 5) AS k FROM worded WHERE side = 'i' AND len(w) > 0),
shingles AS (SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM worded, sizes WHERE len(w) >= k AND (side = 'd' OR k = least(len(w), 5))),
items AS (SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE side = 'i')
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, n::INT AS n_item, count(*) / n AS containment
FROM shingles d JOIN items i USING (s) WHERE d.side = 'd' GROUP BY d.id, i.id, n HAVING count(*) >= ceil(0.8 * n - 1e-9)"""

def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


def _url_verdicts(rules: tuple, listed: tuple) -> str:
    longest = sorted(rules, key=lambda rule: -len(rule[0] + rule[1]))
    text = " ".join(f"WHEN {_fits(host, path)} THEN '{host}{path}'" for host, path, _ in longest)
    verdict = " ".join(f"WHEN {_fits(host, path)} THEN '{what}'" for host, path, what in longest + list(listed))
    return rf"""
WITH parts AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {text} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM parts"""


FILTER_AUDIT = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
worded AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
marked AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM worded LEFT JOIN labelled USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
orders AS (SELECT '' AS o UNION ALL SELECT o || f FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS u(f) WHERE NOT contains(o, f)),
steps AS (SELECT o, s, o[s] AS f, o[:s - 1] AS before, o[:s] AS upto FROM orders, unnest(range(1, 6)) AS u(s) WHERE length(o) = 5),
found AS (SELECT part, o, s, f,
  coalesce(sum(n) FILTER (len(list_intersect(string_split(fails, ''), string_split(upto, ''))) = 0 OR fails = ''), 0) AS kept,
  coalesce(sum(n) FILTER (contains(fails, f) AND (before = '' OR len(list_intersect(string_split(fails, ''), string_split(before, ''))) = 0)), 0) AS removed,
  coalesce(sum(n) FILTER (contains(fails, f)), 0) AS failing, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
  coalesce(sum(good) FILTER (contains(fails, f) AND (before = '' OR len(list_intersect(string_split(fails, ''), string_split(before, ''))) = 0)), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (contains(fails, f) AND (before = '' OR len(list_intersect(string_split(fails, ''), string_split(before, ''))) = 0)), 0) AS toxic_lost
  FROM counted, steps GROUP BY ALL)
SELECT part, o AS filter_order, s::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, (failing - removed)::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM found"""

DIVERGENCE = rf"""
WITH texts AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
terms AS (SELECT id, lang, source, unnest(w) AS term FROM texts),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM texts),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM sources JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
own AS (SELECT lang, source, term, n, (1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang, source)::BIGINT + v)) AS p FROM grid JOIN sizes USING (lang)),
totals AS (SELECT lang, term, sum(n)::BIGINT AS n FROM grid GROUP BY lang, term),
base AS (SELECT lang, term, (1 + 1000000000 * (n + 1) // (sum(n) OVER (PARTITION BY lang)::BIGINT + v)) AS q FROM totals JOIN sizes USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
above AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM own JOIN base USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM above)
SELECT * FROM (SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 200"""

ORACLES = {
    "op2_pii": PII, "op7_decontamination": DECONTAMINATION, "op11_url_filter": _url_verdicts(RULES, LISTED),
    "op12_filter_audit": FILTER_AUDIT, "op13_source_divergence": DIVERGENCE,
}
