"""SQL for the corpus queries that SQL can express; the tests compare the others with brute force.

Line hashes, learned scores, subword tokens, code point spans of patterns and sketches are beyond it.
"""

_SPACE = r"[^\x20\x09-\x0D]+"
_FACTS = rf"""
texts AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '{_SPACE}')] AS lines FROM documents),
places AS (SELECT r, unnest(range(1, len(w) - 6)) AS i FROM texts WHERE len(w) >= 8),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) AS n
    FROM places JOIN texts USING (r)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM windows WHERE n > 1) GROUP BY 1),
facts AS (SELECT r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM texts LEFT JOIN covered c USING (r)),
failed AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repetitive,
    10 * n_symbols > word_chars AS symbolic, 3 * n_dup_lines > n_lines AS echoing FROM facts)"""
_RULES = ("short", "repetitive", "symbolic", "echoing")


def _quality_rules() -> str:
    sums = ", ".join(f"CAST(count(*) FILTER ({rule}) AS DOUBLE) AS {rule}" for rule in _RULES)
    moments = ", ".join(f"(sum({rule}) + 0.5) / (sum(n) + 1.0) AS m_{rule}, sum({rule} * {rule} / n) / sum(n)"
                        f" - (sum({rule}) / sum(n)) ^ 2 AS s_{rule}" for rule in _RULES)
    chance = "m_{0} * (1 - m_{0}) * hosts / total"
    weights = ", ".join(
        f"CASE WHEN s_{rule} - {chance.format(rule)} <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0,"
        f" m_{rule} * (1 - m_{rule}) / (s_{rule} - {chance.format(rule)}) - 1)) END AS w_{rule}" for rule in _RULES)
    rates = ", ".join(f"({rule} + m_{rule} * w_{rule}) / (n + w_{rule})" for rule in _RULES)
    return f"""WITH {_FACTS},
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {sums} FROM failed GROUP BY 1),
moments AS (SELECT sum(n) AS total, count(*) AS hosts, {moments} FROM hosts),
priors AS (SELECT *, {weights} FROM moments),
verdicts AS (SELECT source, greatest({rates}) > 0.5 AS rejected FROM hosts, priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
  NOT (short OR repetitive) AND NOT rejected AS kept
FROM failed f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source"""


_CHAT = """
WITH numbered AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
places AS (SELECT *, CASE WHEN conv_id IS NULL THEN r END AS alone FROM numbered),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM places),
speakers AS (SELECT DISTINCT conv_id, alone, role AS perspective FROM turns WHERE role <> 'system'),
pieces AS (SELECT t.*, pos // 256 AS part, perspective, role = perspective AS own,
    '<|' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
      ELSE 'user name=' || role END || '|>' || chr(10) AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.alone IS NOT DISTINCT FROM s.alone),
placed AS (SELECT *, CAST(sum(length(head) + length(text) + 9) OVER (PARTITION BY conv_id, alone, perspective, part
    ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) - length(text) - 9 AS start FROM pieces)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
  string_agg(head || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(start AS VARCHAR) || ':' || CAST(start + length(text) AS VARCHAR), ',' ORDER BY pos) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, alone, perspective, part"""



def _tree(levels: int = 4) -> str:
    """Each level: half of a node's blocks, first in the order of a digest, goes left."""
    return "\n".join(f"""tree{n + 1} AS (SELECT source, block, 2 * node + CASE WHEN 2 * row_number() OVER (PARTITION BY node ORDER BY digest, source, block)
    > count(*) OVER (PARTITION BY node) + node % 2 THEN 1 ELSE 0 END AS node
  FROM (SELECT *, md5('{n}|' || (source IS NULL) || '|' || coalesce(source, '') || '|' || block) AS digest FROM tree{n})),"""
                     for n in range(levels))


_MIXTURE = rf"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACE}')) AS BIGINT) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS hash FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY 1),
weighed AS (SELECT *, 2 * source_size AS bound, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sources),
levels AS (SELECT *, bound / weight AS ratio,
    (1.5 * sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (SELECT source, source_size, least(CAST(bound AS DOUBLE), weight *
    (SELECT min_by(level, ratio) FROM levels WHERE level <= ratio)) AS target FROM levels),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY hash, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized),
passed AS (SELECT p.doc_id, p.source, p.size, p.start, t.source_size, t.target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, CAST(passes + CASE WHEN target - passes * source_size > 0
    AND 2 * start + size <= 2 * (target - passes * source_size) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM passed),
blocks AS (SELECT greatest(1, CAST(ceil(1.5 * sum(source_size) / 1024) AS BIGINT)) AS words FROM sources),
tree0 AS (SELECT source, unnest(range(0, CAST(floor(target / words) AS BIGINT) + 1)) AS block, 0 AS node FROM targets, blocks),
{{levels}}
draws AS (SELECT r, string_agg(CAST(t.node AS VARCHAR), ',' ORDER BY copy) AS shards
  FROM (SELECT row_number() OVER () AS r, * FROM taken) d, blocks, unnest(range(0, copies)) AS c(copy)
  JOIN tree4 t ON t.source IS NOT DISTINCT FROM d.source AND t.block = (copy * source_size + start) // words GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, coalesce(shards, '') AS shards
FROM (SELECT row_number() OVER () AS r, * FROM taken) LEFT JOIN draws USING (r)""".replace("{levels}", _tree())

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM benchmark),
sizes AS (SELECT *, least(13, len(w)) AS size FROM items WHERE len(w) > 0),
item_places AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sizes),
grams AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM item_places),
doc_places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM docs CROSS JOIN (SELECT DISTINCT size FROM sizes) WHERE len(w) >= size),
found AS (SELECT r, i, size, item_id FROM (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM doc_places)
  JOIN grams USING (size, gram)),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1),
named AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)"""

def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_LEAF = " || ".join(_encoded(value) for value in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))
# CRC-32 bit by bit: eight steps for each digit of the id.
_CRC = ("xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b:"
        " list_reduce([CAST(i AS BIGINT) FOR i IN range(8)], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)))")
_STEPS = "coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos {} o.pos // CAST(pow(3, s.level) AS BIGINT)), '')"
_SIBLINGS = "s.n > 1 AND s.pos // 3 = o.pos // CAST(pow(3, s.level + 1) AS BIGINT)"
_MERKLE = f"""
WITH RECURSIVE hashed AS (SELECT row_number() OVER () AS r, doc_id, source, sha256({_LEAF} || {_encoded("text")}) AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN sha256({_LEAF} || {_encoded("replace(text, chr(10), '')")}) END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM hashed),
nodes AS (SELECT 0 AS level, source, pos, n, leaf AS d FROM leaves
  UNION ALL SELECT level + 1, source, pos // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY level, source, pos // 3),
subroots AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
above AS (SELECT 0 AS level, pos, n, d FROM subroots
  UNION ALL SELECT level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' ORDER BY pos))
    FROM above WHERE n > 1 GROUP BY level, pos // 3),
steps AS (SELECT o.r, s.level, {_STEPS.format("<")} AS l, {_STEPS.format(">")} AS g
    FROM leaves o JOIN nodes s ON o.source IS NOT DISTINCT FROM s.source AND {_SIBLINGS} GROUP BY o.r, s.level
  UNION ALL SELECT f.r, 1000 + s.level, {_STEPS.format("<")}, {_STEPS.format(">")}
    FROM leaves f JOIN subroots o ON f.source IS NOT DISTINCT FROM o.source JOIN above s ON {_SIBLINGS} GROUP BY f.r, s.level),
ways AS (SELECT r, list(l || '|' || g ORDER BY level) AS way, string_agg(l || g, '' ORDER BY level) AS proof FROM steps GROUP BY r),
judged AS (SELECT f.doc_id, f.leaf, s.d AS subroot, a.d AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(coalesce(way, []), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2)), coalesce(changed, leaf)) AS folded_root
  FROM leaves f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source JOIN (SELECT d FROM above WHERE n = 1) a ON true
  LEFT JOIN ways w ON w.r = f.r)
SELECT *, folded_root = root AS verified FROM judged"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_MIDDLE = rf"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
    [CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[8 * i + 1:8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM documents),
cut AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50
      THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM drawn),
parts AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cut)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality_rules(),
    "op3_chat_formatting": _CHAT.strip(),
    "op6_source_mixture": _MIXTURE.strip(),
    "op8_benchmark_decontamination": _BENCHMARK.strip(),
    "op11_merkle_manifest": _MERKLE.strip(),
    "op12_fill_in_middle": _MIDDLE.strip(),
}
