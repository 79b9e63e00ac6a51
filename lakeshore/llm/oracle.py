"""DuckDB SQL of the queries that SQL can express, written from their definitions.

Operators 1, 5, 7, 9 and 10 and the pipeline are checked against brute force in the tests.
"""

from __future__ import annotations

from lakeshore.llm import chat_format, quality, url_filter

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_A_TO_Z = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_A_TO_Z.format("coalesce(text, '')"))} AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w
),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
l AS (
  SELECT a, b FROM e JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
),
r AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.r = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, MIN(r) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
    AND list_contains(list_transform(embedding, lambda x: x <> 0), true)
),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
r AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.r = l.a),
m AS (SELECT vec_id, MIN(r) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, (SELECT COUNT(*) FROM l WHERE l.a = m.vec_id) AS n_links, component_id, m.vec_id = component_id AS kept FROM m"""


def _url_filter() -> str:
    levels = []
    for k in range(1, url_filter.LEVELS + 1):
        part = f"t.parts[{k + 1}]"
        levels.append(f"""
v{k} AS (
  SELECT host, before FROM (SELECT host, before, {part} AS part, SUM(urls) AS urls FROM t{k - 1} t WHERE {part} IS NOT NULL GROUP BY ALL)
  GROUP BY ALL HAVING COUNT(*) >= {url_filter.MANY_VALUES} AND SUM(urls) < {url_filter.FEW_URLS} * COUNT(*)
),
t{k} AS (
  SELECT t.* REPLACE (CASE WHEN {part} IS NULL THEN t.before ELSE t.before || '/' ||
      CASE WHEN v.host IS NULL THEN {part} ELSE '{{*}}' END END AS before){", t.before AS before_2" if k == 2 else ""}
  FROM t{k - 1} t LEFT JOIN v{k} v ON t.host = v.host AND t.before = v.before
)""")
    alike = ("coalesce(abs({b} / nullif(CAST({n} AS DOUBLE), 0) - {pb} / nullif(CAST({pn} AS DOUBLE), 0)) <= "
             f"{url_filter.SIGNIFICANT}" " * sqrt(({pb} / nullif(CAST({pn} AS DOUBLE), 0)) * (1 - {pb} / nullif(CAST({pn} AS DOUBLE), 0)) "
             "/ nullif(CAST({n} AS DOUBLE), 0)) + 0.5 / nullif(CAST({n} AS DOUBLE), 0), false)")
    return rf"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
),
p AS (
  SELECT page_id, coalesce({_A_TO_Z.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
),
q AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}', '{{u}}', 'g'),
      '/[0-9a-fA-F]{{16,}}([/.]|$)', '/{{h}}\1', 'g'), '[0-9]+', '{{n}}', 'g') AS shape
  FROM p
),
z AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled FROM q),
t0 AS (
  SELECT host, shape, COUNT(*) AS urls, COUNT(ruled) AS labelled, COUNT(*) FILTER (WHERE ruled = 'block') AS blocked,
    string_split(shape, '/') AS parts, '' AS before
  FROM z GROUP BY host, shape
),{",".join(levels)},
tree AS (
  SELECT host, shape, labelled, blocked, before_2 AS branch,
    CASE WHEN len(parts) > {url_filter.LEVELS + 1} THEN before || '/' || array_to_string(parts[{url_filter.LEVELS + 2}:], '/') ELSE before END AS template
  FROM t{url_filter.LEVELS}
),
leaf AS (SELECT host, branch, template, SUM(labelled) AS n, SUM(blocked) AS b FROM tree GROUP BY ALL),
nodes AS (
  SELECT *, SUM(n) OVER (PARTITION BY host, branch) AS n_1, SUM(b) OVER (PARTITION BY host, branch) AS b_1,
    SUM(n) OVER (PARTITION BY host) AS n_2, SUM(b) OVER (PARTITION BY host) AS b_2, SUM(n) OVER () AS n_3, SUM(b) OVER () AS b_3
  FROM leaf
),
up AS (
  SELECT *, n = 0 OR {alike.format(n="n", b="b", pn="n_1", pb="b_1")} AS up_1, {alike.format(n="n_1", b="b_1", pn="n_2", pb="b_2")} AS alike_2 FROM nodes
),
pure AS (
  SELECT host, template, CASE WHEN up_1 AND alike_2 THEN n_2 WHEN up_1 THEN n_1 ELSE n END AS m,
    CASE WHEN up_1 AND alike_2 THEN b_2 WHEN up_1 THEN b_1 ELSE b END AS c, b_3 / nullif(CAST(n_3 AS DOUBLE), 0) AS prior
  FROM up
)
SELECT page_id, z.host, path, rule,
  coalesce(ruled, CASE WHEN m > 0 AND (c + {url_filter.PRIOR_URLS} * prior) / (m + {url_filter.PRIOR_URLS}) >= {url_filter.REJECT_PURITY}
    THEN 'block' ELSE 'allow' END) AS verdict, tree.template
FROM z JOIN tree ON z.host = tree.host AND z.shape = tree.shape JOIN pure ON pure.host = tree.host AND pure.template = tree.template"""


def _quality() -> str:
    classes = [c.replace("'", "''") for c in quality.CLASSES]
    usual = r"[\x20\x09-\x0Da-zß-öø-ÿ]+"
    counts = ", ".join(f"length(marked) - length(regexp_replace(marked, '{c}', '', 'g'))" for c in classes)
    common = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(f'len(list_filter(w, lambda x: x = {chr(39)}{word}{chr(39)}))' for word in words)}]"
        for lang, words in quality.COMMON_WORDS.items())
    n = len(classes) + 3

    def sums(name: str, bins: int) -> str:
        share = "coalesce(CAST(SUM(CAST(trunc(1000000 * {n}[{i}] / nullif(list_sum({n}), 0)) AS BIGINT)) AS DOUBLE), 0)"
        return f"[{', '.join(share.format(n=name, i=i + 1) for i in range(bins))}]"

    def distance(mine: str, theirs: str, bins: int) -> str:
        part = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0.0 END"
        terms = []
        for i in range(1, bins + 1):
            p, q = f"({mine}[{i}] / list_sum({mine}))", f"({theirs}[{i}] / list_sum({theirs}))"
            terms += [part.format(x=p, p=p, q=q), part.format(x=q, p=p, q=q)]
        return f"CASE WHEN list_sum({mine}) > 0 AND list_sum({theirs}) > 0 THEN sqrt(greatest(({' + '.join(terms)}) / 2, 0.0)) END"

    return rf"""
WITH a AS (SELECT row_number() OVER () AS i, doc_id, lang, coalesce(text, '') AS t FROM documents),
b AS (
  SELECT *, {_WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    regexp_replace(t, '{usual}', '', 'g') AS marked
  FROM a
),
c AS (
  SELECT i, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, [{counts}] AS classes,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, length(t) AS chars, length(marked) AS n_marked,
    CASE lang {common} END AS word_bins
  FROM b
),
windows AS (SELECT i, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS g FROM (SELECT i, w, unnest(range(1, len(w) - 1)) AS k FROM b)),
twice AS (SELECT i, k FROM windows QUALIFY COUNT(*) OVER (PARTITION BY i, g) > 1),
covered AS (SELECT i, COUNT(DISTINCT k + o) AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY i),
d AS (
  SELECT c.*, coalesce(covered.n, 0) AS n_repeat_words,
    list_transform(list_concat([chars - word_chars, word_chars - n_marked], classes, [n_marked - list_sum(classes)]), lambda x: CAST(x AS DOUBLE)) AS char_bins
  FROM c LEFT JOIN covered USING (i)
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM d),
ref AS (SELECT lang AS l, {sums("char_bins", n)} AS rc, {sums("word_bins", quality.WORD_BINS)} AS rw FROM f WHERE NOT base_failed GROUP BY lang),
g AS (
  SELECT f.*, CASE WHEN n_words >= {quality.GUARD_WORDS} THEN {distance("char_bins", "rc", n)} END AS dc,
    CASE WHEN list_sum(word_bins) >= {quality.GUARD_COMMON} THEN {distance("word_bins", "rw", quality.WORD_BINS)} END AS dw
  FROM f LEFT JOIN ref ON f.lang IS NOT DISTINCT FROM ref.l
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(classes[1] AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(dc, 0) <= {quality.MAX_CHAR_DISTANCE} AND coalesce(dw, 0) <= {quality.MAX_WORD_DISTANCE} AS kept
FROM g"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT h, MAX(page_id) AS first FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.b AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
WINDOW best AS (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)
QUALIFY row_number() OVER best <= 5"""


def _chat() -> str:
    template = chat_format.PLAIN
    before, after = "lag(role) OVER turns", "lead(role) OVER turns"
    heads = " ".join(f"WHEN '{r}' THEN {len(p.head)}" for r, p in template.parts.items())
    steps = " OR ".join(f"({before} {'IS NULL' if a is None else f'= {a!r}'} AND role = {b!r})"
                        for a, bs in template.follows.items() for b in bs if b is not None)
    ends = ", ".join(f"{a!r}" for a, bs in template.follows.items() if None in bs)
    marks = "|".join(("\\\\", *template.controls))
    text = chat_format.ADDED_TEXT
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({chat_format.ADDED_ID}, 0, 'user', '{text}'), ({chat_format.ADDED_ID}, 1, 'assistant', '{text}')
),
f AS (
  SELECT *, CASE role {heads} ELSE {len(template.other.head + template.name_end)} + length(regexp_replace(role, '({marks})', '\\\\\\1', 'g')) END
    + length(regexp_replace(text, '({marks})', '\\\\\\1', 'g')) + {len(template.other.tail)} AS chars,
    CAST(NOT coalesce({steps}, false) AS BIGINT) + CAST({after} IS NULL AND role NOT IN ({ends}) AS BIGINT) AS illegal
  FROM t WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(SUM(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE role WHEN 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(SUM(chars) AS BIGINT) AS formatted_chars, CAST(SUM(illegal) AS BIGINT) AS illegal_turns
FROM f GROUP BY conv_id"""


def _repair() -> str:
    """Damage by CRC-32, then dynamic programming over suffixes: a state's best is its cost, in
    eight digits, and its audit, so that the least text is the cheapest and first one."""
    far, white = "50000000", r"\x20\x09-\x0D"

    def after(cost: str, letter: str, best: str) -> str:
        return f"(printf('%08d', CAST(substr({best}, 1, 8) AS INTEGER) + {cost}) || '{letter}' || substr({best}, 9))"

    def inserted(bests: list[str]) -> str:
        follows = (2, 2, 3, 2)
        return ", ".join(f"least({b}, {after('5', 'I', bests[follows[q]])}) AS s{q}" for q, b in enumerate(bests))

    stays = "fault IN ('truncated', 'sound')"
    more = "CASE fault WHEN 'truncated' THEN 5 ELSE 0 END"

    def kept(q: int) -> str:
        options = {0: "CASE initial WHEN 's' THEN s1 WHEN 'u' THEN s2 END", 1: "CASE initial WHEN 'u' THEN s2 END",
                   2: "CASE initial WHEN 'a' THEN s3 END", 3: "CASE initial WHEN 'u' THEN s2 END"}[q]
        rerole = after(f"1 + {more}", "R", f"s{(2, 2, 3, 2)[q]}")
        return (f"least({after('2', 'D', f's{q}')}, CASE WHEN {stays} THEN {after(more, 'K', f'({options})')} END, "
                f"CASE WHEN {stays} THEN {rerole} END)")

    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
),
coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split({key}, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, COUNT(*) OVER (PARTITION BY conv_id) AS n
  FROM damaged
),
f AS (
  SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^{white}]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^{white}])[{white}]*$', 1) IN ('.', '!', '?') THEN 'sound' ELSE 'truncated' END AS fault
  FROM placed
),
counted AS (
  SELECT conv_id, CAST(coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS BIGINT) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
    COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated
  FROM f GROUP BY conv_id
),
pairs AS (
  SELECT conv_id, COUNT(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM f) GROUP BY conv_id
),
ends AS (SELECT DISTINCT conv_id, n AS i, '00000000' AS s0, '{far}' AS s1, '{far}' AS s2, '00000000' AS s3 FROM placed),
ends1 AS (SELECT conv_id, i, {inserted(["s0", "s1", "s2", "s3"])} FROM ends),
best AS (
  SELECT conv_id, i, {inserted(["s0", "s1", "s2", "s3"])} FROM ends1
  UNION ALL
  SELECT conv_id, i, {inserted(["s0", "s1", "s2", "s3"])} FROM (
    SELECT conv_id, i, {inserted(["s0", "s1", "s2", "s3"])} FROM (
      SELECT f.conv_id, f.i - 1 AS i, {", ".join(f"{kept(q)} AS s{q}" for q in range(4))}
      FROM best JOIN f ON f.conv_id IS NOT DISTINCT FROM best.conv_id AND f.i = best.i))
),
found AS (SELECT conv_id, CAST(substr(s0, 1, 8) AS BIGINT) AS cost, substr(s0, 9) AS audit FROM best WHERE i = 0),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS nr FROM found WHERE audit <> ''),
numbered AS (
  SELECT *, COUNT(*) FILTER (edit <> 'I') OVER up AS i, COUNT(*) FILTER (edit <> 'D') OVER up AS place
  FROM letters WINDOW up AS (PARTITION BY conv_id ORDER BY nr ROWS UNBOUNDED PRECEDING)
),
lined AS (
  SELECT l.conv_id, l.nr, l.edit, f.role, f.text, place - MAX(CAST(edit = 'K' AND place = 1 AND f.initial = 's' AS INTEGER)) OVER (PARTITION BY l.conv_id) AS place
  FROM numbered l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE edit <> 'D'
),
texts AS (
  SELECT conv_id, sha256(string_agg(CASE edit WHEN 'K' THEN role ELSE CASE WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' ||
    CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY nr)) AS repaired
  FROM lined GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN pairs ON pairs.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN found ON found.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE = {
    "op2_ngram_jaccard_join": NGRAM_JOIN.strip(),
    "op3_embedding_near_dedup": EMBEDDINGS.strip(),
    "op4_url_filters": _url_filter().strip(),
    "op6_quality_rules": _quality().strip(),
    "op8_warc": WARC.strip(),
    "op11_hard_negatives": HARD_NEGATIVES.strip(),
    "op12_conversation_repair": _repair().strip(),
    "op13_chat_formatting": _chat().strip(),
}
