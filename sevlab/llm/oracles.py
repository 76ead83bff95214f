"""DuckDB SQL of the queries that SQL can express."""

from sevlab.llm.blob_ledger import RULES
from sevlab.llm.license_templates import PERCENT, TEMPLATES

#: The recursion is the jump hash; the checksum runs over the text's UTF-8 half bytes, low half first, with CRC-32's table of 16.
OP4 = """
WITH RECURSIVE keys AS (
  SELECT DISTINCT doc_id, n FROM documents, (VALUES (16), (17)) AS counts(n)
), jumps AS (
  SELECT doc_id, n, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM keys
  UNION ALL
  SELECT doc_id, n, next, j, CAST(floor(least((j + 1) * (2147483648.0::DOUBLE / (((next // 8589934592)::DOUBLE) + 1)), n)) AS BIGINT)
  FROM (SELECT *, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616 AS next FROM jumps WHERE j < n)
), shards AS (
  SELECT doc_id, max(b) FILTER (WHERE n = 16) AS shard, max(b) FILTER (WHERE n = 17) AS grown_shard FROM jumps WHERE j >= n GROUP BY doc_id
), bits AS (
  SELECT range AS i, list_reduce(list_prepend(range::BIGINT, [0,1,2,3]::BIGINT[]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(16)
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits
), sums AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(2 * strlen(coalesce(text, ''))),
      lambda i: instr('123456789ABCDEF', h[i + 2 - 2 * (i % 2)])::BIGINT)),
      lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents), crc
)
SELECT s.doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY s.doc_id, text_crc32, size) - 1 AS BIGINT) AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM sums s JOIN shards k ON s.doc_id IS NOT DISTINCT FROM k.doc_id
"""

#: Thirty halvings of the exponent, quotas, epochs with a running sum over the hash, and blocks.
OP5 = """
WITH RECURSIVE tokens AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), sums AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / (SELECT sum(n_tokens) FROM tokens)::DOUBLE AS share FROM tokens GROUP BY source
), facts AS (
  SELECT -sum(share * ln(share)) AS own_entropy, ln(count(*)) AS uniform, ln(max(share) / min(share)) AS spread, count(*) AS n FROM sums WHERE tokens > 0
), halving AS (
  SELECT 0 AS k, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT k + 1, CASE WHEN meets THEN low ELSE mid END, CASE WHEN meets THEN mid ELSE high END FROM (
    SELECT k, low, high, (low + high) / 2 AS mid,
      (SELECT ln(sum(exp((low + high) / 2 * ln(share)))) - (low + high) / 2 * sum(ln(share) * exp((low + high) / 2 * ln(share))) / sum(exp((low + high) / 2 * ln(share))) FROM sums WHERE tokens > 0)
        <= (SELECT own_entropy + 0.5 * (uniform - own_entropy) FROM facts) AND (1 - (low + high) / 2) * (SELECT spread FROM facts) <= ln(4.0) AS meets
    FROM halving WHERE k < 30)
), powers AS (
  SELECT source, tokens, share, pow(share, CASE WHEN (SELECT n FROM facts) < 2 THEN 1.0 ELSE (SELECT round(high, 6) FROM halving WHERE k = 30) END) AS power FROM sums WHERE tokens > 0
), budget AS (
  SELECT sum(power) AS norm, CAST(ceil(round(max(share / power) * sum(power) * (SELECT sum(n_tokens) FROM tokens), 3)) AS BIGINT) AS budget FROM powers
), quotas AS (
  SELECT source, tokens, CAST(floor(round(power / norm * budget::DOUBLE, 3)) AS BIGINT) AS quota, greatest(1, (budget + 999999) // 1000000) AS blocks FROM powers, budget
  UNION ALL SELECT source, tokens, 0, 1 FROM sums WHERE tokens = 0
), copies AS (
  SELECT doc_id, t.source, n_tokens, tokens, quota, blocks, unnest(range(CASE WHEN tokens = 0 THEN 1 ELSE quota // tokens + 1 END)) AS epoch FROM tokens t JOIN quotas q ON t.source IS NOT DISTINCT FROM q.source
), hashed AS (
  SELECT *, CAST('0x' || md5('17:' || epoch || ':' || coalesce(doc_id::VARCHAR, ''))[1:15] AS BIGINT) AS h FROM copies
), placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot FROM hashed
), blocked AS (
  SELECT *, CASE WHEN quota > 0 THEN least(CAST(floor(spot::DOUBLE / quota::DOUBLE * blocks::DOUBLE) AS BIGINT), blocks - 1) ELSE 0 END AS block FROM placed WHERE spot < quota OR tokens = 0 OR epoch < quota // tokens
)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block AS BIGINT) AS block,
  CAST('0x' || md5('17:' || epoch || '/' || block || ':' || coalesce(doc_id::VARCHAR, ''))[1:15] AS BIGINT) AS draw FROM blocked
"""

#: Shingles, pairs that share one, their similarity, and reachability.
OP9 = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes k ON k.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, k.n HAVING 100 * count(*) >= 85 * (m.n + k.n - count(*))
), reach AS (
  SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op8() -> str:
    """Matches from the texts between them, kept if long enough, listed in order."""
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    columns = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)
    per_rule = " UNION ALL ".join(
        f"SELECT doc_id, text, {i} AS rank, {_quoted(r.kind)} AS kind, {r.least} AS least, {r.base} AS base, string_split_regex(text, {_quoted(r.pattern)}) AS gaps, "
        f"regexp_extract_all(text, {_quoted(r.pattern)}, 0) AS hits, regexp_extract_all(text, {_quoted(r.pattern)}, {r.group}) AS groups FROM documents WHERE regexp_matches(text, {_quoted(r.pattern)})"
        for i, r in enumerate(RULES))
    return f"""
WITH found AS ({per_rule}), hits AS (
  SELECT doc_id, rank, kind, least, base, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(groups) AS part FROM found
), placed AS (
  SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS stop FROM hits
), spans AS (
  SELECT doc_id, rank, kind, base, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span FROM placed WHERE length(part) >= least
), listed AS (
  SELECT doc_id, {counts}, string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE base) AS base_spans, string_agg(span, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id
)
SELECT doc_id, {columns}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN listed USING (doc_id)
"""


def op10() -> str:
    """Distinct bigrams of lines and whole texts against those of the templates."""
    templates = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))
    words = "list_filter(string_split_regex(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f"""
WITH units AS (
  SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS unit FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
  UNION ALL SELECT doc_id, -1, text FROM documents WHERE contains(text, chr(10))
), words AS (
  SELECT doc_id, line, {words.format("unit")} AS w FROM units
), bigrams AS (
  SELECT DISTINCT doc_id, line, w[i] || ' ' || w[i + 1] AS b FROM (SELECT *, unnest(range(1, len(w))) AS i FROM words)
), sizes AS (
  SELECT doc_id, line, count(*) AS n FROM bigrams GROUP BY ALL
), templates AS (
  SELECT DISTINCT id, license, w[i] || ' ' || w[i + 1] AS b FROM (SELECT id, license, w, unnest(range(1, len(w))) AS i FROM (SELECT id, license, {words.format("notice")} AS w FROM (VALUES {templates}) AS t(id, license, notice)))
), template_sizes AS (
  SELECT id, license, count(*) AS m FROM templates GROUP BY ALL
), scored AS (
  SELECT doc_id, line, t.id, license, count(*) AS shared FROM bigrams JOIN templates t USING (b) GROUP BY ALL
)
SELECT doc_id, CAST(line AS INTEGER) AS line, s.license, CAST(max(2000 * shared // (n + m)) AS INTEGER) AS dice_permille
FROM scored s JOIN sizes USING (doc_id, line) JOIN template_sizes k ON k.id = s.id WHERE 200 * shared >= {PERCENT} * (n + m) GROUP BY doc_id, line, s.license
"""

#: All products of anchors and rows; the first five of each label side by window functions.
OP11 = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), p AS (
  SELECT rid, anchor_id, vec_id, score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same QUALIFY k <= 5
), n AS (
  SELECT p.rid, p.k, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.rid, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score QUALIFY rank <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""

#: The checksum as in OP4; the repair row by row, the least (cost, audit) of each phase of the grammar kept.
OP13 = """
WITH RECURSIVE bits AS (
  SELECT range AS i, list_reduce(list_prepend(range::BIGINT, [0,1,2,3]::BIGINT[]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(16)
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h)), lambda i: instr('123456789ABCDEF', h[i + 2 - 2 * (i % 2)])::BIGINT)),
    lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) % 20 AS kind FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    i > 1 AND lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM numbered
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE illegal) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), moves(phase, inserted, target) AS (
  VALUES ('', '', 's'), ('', '', 'u'), ('', 'u', 'a'), ('s', '', 'u'), ('s', 'u', 'a'), ('u', '', 'a'), ('u', 'a', 'u'), ('a', '', 'u'), ('a', 'u', 'a'),
    ('', '', NULL), ('s', '', NULL), ('u', '', NULL), ('a', '', NULL)
), walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS phase, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS turns FROM conversations
  UNION ALL
  SELECT conv_id, i, phase, cost, audit, turns FROM (
    SELECT w.conv_id, r.i, coalesce(m.target, w.phase) AS phase,
      w.cost + CASE WHEN m.target IS NULL THEN 2 ELSE 5 * len(m.inserted) + CASE WHEN r.initial = m.target THEN 0 ELSE 1 END + CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END END AS cost,
      w.audit || CASE WHEN m.target IS NULL THEN 'D' ELSE repeat('I', len(m.inserted)) || CASE WHEN r.initial = m.target THEN 'K' ELSE 'R' END END AS audit,
      CASE WHEN m.target IS NULL THEN w.turns ELSE list_concat(list_concat(w.turns, CASE m.inserted WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE []::VARCHAR[] END),
        [CASE WHEN r.initial = m.target THEN r.role WHEN m.target = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text]) END AS turns
    FROM walk w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN moves m ON m.phase = w.phase
    WHERE m.target IS NULL OR (r.fault NOT IN ('blank', 'duplicate') AND (m.target <> 's' OR r.initial = 's')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, phase ORDER BY cost, audit) = 1
), ended AS (
  SELECT w.conv_id, w.i, cost + 5 * len(rest) AS cost, audit || repeat('I', len(rest)) AS audit,
    list_concat(turns, CASE rest WHEN 'a' THEN ['assistant:'] WHEN 'ua' THEN ['user:', 'assistant:'] ELSE []::VARCHAR[] END) AS turns
  FROM walk w JOIN (VALUES ('', ''), ('s', 'ua'), ('u', 'a'), ('a', '')) e(phase, rest) ON e.phase = w.phase
)
SELECT e.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(f.blank, 0) AS BIGINT) AS blank, CAST(coalesce(f.duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(f.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(f.illegal, 0) AS BIGINT) AS illegal, CAST(e.cost AS BIGINT) AS cost, e.audit, sha256(array_to_string(e.turns, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
WHERE e.i = coalesce(f.n, 0)
QUALIFY row_number() OVER (PARTITION BY e.conv_id ORDER BY e.cost, e.audit) = 1
"""
