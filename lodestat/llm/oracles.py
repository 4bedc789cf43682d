"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

import math

from lodestat.llm import hostrank, licenses, quality

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_sql() -> str:
    rules = {
        "short": f"n_words < {quality.MIN_WORDS}",
        "repeated": f"n_repeat_words * 100 > n_words * {quality.MAX_REPEATED_PERCENT}",
        "symbols": f"n_symbols * 100 > n_words * {quality.MAX_SYMBOLS_PERCENT}",
        "dup_lines": f"n_dup_lines * 100 > n_words * {quality.MAX_DUP_LINES_PERCENT}",
    }
    mean = {r: f"(all_{r} / docs)" for r in rules}
    chance = {r: f"({mean[r]} * (1 - {mean[r]}))" for r in rules}
    excess = {r: f"(sq_{r} / docs - {mean[r]} * {mean[r]} - {chance[r]} * hosts / docs)" for r in rules}
    weight = {
        r: f"CASE WHEN {excess[r]} * {quality.CHANCE_WEIGHT} > {chance[r]} THEN greatest({chance[r]} / {excess[r]} - 1, 0) ELSE {quality.CHANCE_WEIGHT} END"
        for r in rules}
    kept = " AND ".join(f"(k_{r} + {mean[r]} * ({weight[r]})) / (n + ({weight[r]})) <= {quality.MAX_HOST_RATE}" for r in rules)
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
           FROM documents),
p AS (SELECT rid, unnest(range(len(ws) - 2)) AS i, ws FROM w WHERE len(ws) > 2),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i + 1], ws[i + 2], ws[i + 3]) AS many FROM p),
c AS (SELECT rid, count(DISTINCT i + o) AS n FROM g, (VALUES (0), (1), (2)) v(o) WHERE many > 1 GROUP BY rid),
s AS (SELECT doc_id, source, len(ws) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, {', '.join(f'{e} AS {r}' for r, e in rules.items())} FROM s),
h AS (SELECT source, count(*) AS n, {', '.join(f'count(*) FILTER ({r}) AS k_{r}' for r in rules)} FROM f GROUP BY source),
a AS (SELECT CAST(sum(n) AS BIGINT) AS docs, count(*) AS hosts,
             {', '.join(f'CAST(sum(k_{r}) AS BIGINT) AS all_{r}, sum(k_{r} * k_{r} / n) AS sq_{r}' for r in rules)} FROM h),
v AS (SELECT source, {kept} AS host_kept FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeated AS base_failed,
       NOT (short OR repeated) AND host_kept AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""


def license_sql() -> str:
    k = licenses.GRAM
    words = f"list_filter(regexp_split_to_array(translate({{}}, '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    templates = ", ".join(f"({i}, {_quoted(label)}, {_quoted(text)})" for i, (label, text) in enumerate(licenses.TEMPLATES))
    phrases = ", ".join(f"({_quoted(label)}, [{', '.join(map(_quoted, phrase.split()))}])" for phrase, label in licenses.PHRASES)
    gram = " || ' ' || ".join(f"ws[i + {j + 1}]" for j in range(k))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words.format("coalesce(text, '')")} AS ws FROM documents),
q AS (SELECT i AS template, label, {words.format('text')} AS ws FROM (VALUES {templates}) t(i, label, text)),
tg AS (SELECT template, label, size, i AS spot, {gram} AS gram
       FROM (SELECT *, len(ws) - {k - 1} AS size, unnest(range(len(ws) - {k - 1})) AS i FROM q)),
dg AS (SELECT rid, i AS pos, {gram} AS gram FROM (SELECT rid, ws, unnest(range(len(ws) - {k - 1})) AS i FROM d WHERE len(ws) >= {k})),
votes AS (SELECT rid, template, label, size, pos - spot AS diagonal, list(DISTINCT spot) AS ats, min(pos) AS first, max(pos) AS last
          FROM dg JOIN tg USING (gram) GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o > {licenses.DIAGONAL_GAP} OR first - lag(last) OVER o > {licenses.SPAN_GAP}
                       OR lag(first) OVER o - last > {licenses.SPAN_GAP} OR lag(diagonal) OVER o IS NULL THEN 1 ELSE 0 END AS new
           FROM votes WINDOW o AS (PARTITION BY rid, template ORDER BY diagonal)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM marked),
spans AS (SELECT rid, label, size, len(list_distinct(flatten(list(ats)))) / size AS coverage, max(last) + {k} - min(first) AS length
          FROM runs GROUP BY rid, template, label, size, run),
found AS (SELECT rid, list(DISTINCT label) AS found, max(coverage) AS best FROM spans
          WHERE coverage >= {licenses.COVERAGE} AND length <= (size + {k - 1}) * {licenses.STRETCH} GROUP BY rid),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
         FROM (SELECT rid, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1 : i + len(p)] = p)) AS i
               FROM d, (VALUES {phrases}) t(label, p)) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN found USING (rid)"""


def _ranks(name: str, seeds: str, source: str, target: str) -> str:
    """Table ``name`` of ranks along ``source`` to ``target``, after so many steps that less than the residual is on its way."""
    steps = math.ceil(math.log(hostrank.RESIDUAL) / math.log(hostrank.DAMPING))
    return (
        f"{name}_moved AS (SELECT host, seed AS moved, 0 AS step FROM {seeds} UNION ALL SELECT e.{target}, "
        f"sum(moved * (e.links / sum_links) * {hostrank.DAMPING}), step + 1 FROM {name}_moved JOIN (SELECT *, sum(links) OVER (PARTITION BY {source}) AS sum_links "
        f"FROM e) e ON host = e.{source} WHERE step < {steps} GROUP BY e.{target}, step),\n{name} AS (SELECT host, sum(moved) AS rank FROM {name}_moved GROUP BY host)")


def url_sql() -> str:
    best = []
    for verdict, rule in sorted(hostrank.RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        best.append((f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '/{path}')", rule, verdict))
    case = lambda i: "CASE " + " ".join(f"WHEN {b[0]} THEN '{b[i]}'" for b in best) + " END"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT page_id, html, host, path, {case(1)} AS rule, {case(2)} AS rule_verdict FROM u),
l AS (SELECT host AS a, translate(unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1)), '{_UPPER}', '{_LOWER}') AS b
      FROM r WHERE host <> ''),
e AS (SELECT a, b, count(*) AS links FROM l WHERE a <> b GROUP BY a, b),
s AS (SELECT host, count(*) FILTER (rule_verdict = 'allow') / count(*) AS good, count(*) FILTER (rule_verdict = 'block') / count(*) AS bad
      FROM r WHERE host <> '' GROUP BY host),
sg AS (SELECT host, good AS seed FROM s WHERE good > 0), sb AS (SELECT host, bad AS seed FROM s WHERE bad > 0),
{_ranks('t', 'sg', 'a', 'b')},
{_ranks('d', 'sb', 'b', 'a')},
v AS (SELECT host, coalesce(t.rank, 0) AS trust, coalesce(d.rank, 0) AS distrust FROM t FULL JOIN d USING (host))
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN distrust >= {hostrank.MIN_DISTRUST} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN v USING (host)"""


NEGATIVES_SQL = """
WITH points AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, p.vec_id AS vec_id, a.label = p.label AS same,
         CAST(list_dot_product(a.v, p.v) AS BIGINT) AS score
  FROM points a JOIN points p ON a.vec_id <> p.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id
WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""


PASSAGES_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM docs),
windows AS (
  SELECT doc_id, i, words[i] AS word,
         CASE WHEN i + 49 <= len(words) THEN array_to_string(words[i:i + 49], ' ') END AS content
  FROM places),
least AS (SELECT content, min(doc_id) AS first_doc FROM windows WHERE content IS NOT NULL GROUP BY content),
marked AS (
  SELECT doc_id, i, word, max(CASE WHEN first_doc < doc_id THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM windows LEFT JOIN least USING (content)),
kept AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
