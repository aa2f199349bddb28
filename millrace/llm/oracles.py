"""DuckDB SQL for the queries that SQL can express. The others are tested against brute force."""

from __future__ import annotations

from millrace.llm.quality import RULES, STOP_WORDS

BLANK = r"[\x20\x09-\x0D]+"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    failed = []
    for rule in RULES:
        bounds = []
        if rule.least is not None:
            bounds.append(f"{rule.metric} < {rule.least}")
        if rule.most is not None:
            bounds.append(f"{rule.metric} > {rule.most}")
        failed.append(f"CASE WHEN {' OR '.join(bounds)} THEN '{rule.name}' END")
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{BLANK}'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i + 7] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base)
), twice AS (
  SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, w HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) r(k) GROUP BY doc_id
), counted AS (
  SELECT b.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(list_filter(words, lambda x: x IN ({stop}))) AS n_stop
  FROM base b LEFT JOIN repeated r USING (doc_id)
), rated AS (
  SELECT *, n_repeat_words / nullif(n_words, 0) AS repeat_word_ratio, word_chars / nullif(n_words, 0) AS mean_word_chars,
    n_symbols / nullif(n_words, 0) AS symbol_ratio, n_upper / nullif(word_chars, 0) AS upper_ratio,
    n_stop / nullif(n_words, 0) AS stop_word_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio
  FROM counted
), judged AS (
  SELECT *, concat_ws(';', {", ".join(failed)}) AS failed_rules,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM rated
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged"""


CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
), sized AS (
  SELECT *, 4 + length(role) + 2 + length(text) + len(regexp_extract_all(text, '[\\#<]')) + 8 AS chars FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learned,
    sum(chars) AS formatted_chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM whole"""


DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, words[i:i + 9] AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM item_words WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT len(w) AS n FROM windows
), places AS (
  SELECT doc_id, i, words[i:i + n - 1] AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc_words, sizes)
), hits AS (
  SELECT doc_id, i, len(p.w) AS n, item_id FROM places p JOIN windows b ON p.w = b.w
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


TRIE = r"""
WITH turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations
), paths AS (
  SELECT conv_id, list({'id': id, 'chars': chars} ORDER BY turn NULLS FIRST, id) AS own,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1),
        lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda v, k: xor(v >> 1, (v & 1) * 3988292384))), 4294967295::BIGINT) % 6 AS h
  FROM turns GROUP BY conv_id
), whole AS (
  SELECT p.conv_id, list_concat(coalesce(f.own[1:p.h], []), p.own[p.h + 1:]) AS path
  FROM paths p LEFT JOIN paths f ON f.conv_id = p.conv_id - p.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(path) AS length, d, list_transform(path[1:d], lambda x: x.id) AS node, coalesce(path[d].chars, 0) AS chars
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), kids AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), known AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)
), below AS (
  SELECT node[1:a] AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM known) GROUP BY ALL
)
SELECT k.conv_id, k.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (node) LEFT JOIN known p ON k.depth > 0 AND p.node = k.node[1:k.depth - 1]"""


SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS place, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), whole AS (
  SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs WHERE len(words) > 0
), items AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark
), item_terms AS (
  SELECT item, item_id, term, count(*) AS repeats FROM items GROUP BY ALL
), found AS (
  SELECT place, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT place, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY place, doc_id, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM found, whole GROUP BY term
), parts AS (
  SELECT place, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS part
  FROM found JOIN weighed USING (term), whole
), scores AS (
  SELECT item, item_id, place, doc_id, sum(repeats * part)::BIGINT AS score
  FROM item_terms JOIN parts USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
    md5(coalesce(doc_id::VARCHAR, '') || '|13|' || md5(coalesce(text, ''))) AS digest
  FROM documents
), keyed AS (
  SELECT doc_id, source, size::BIGINT AS size, ('0x' || substr(digest, 14, 15))::BIGINT AS tie,
    CASE WHEN size > 0 THEN -ln((('0x' || substr(digest, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / (size::DOUBLE / (size + 50.0) * (size::DOUBLE / (size + 5.0 * symbols))) END AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS weight
  FROM keyed GROUP BY source
), whole AS (
  SELECT sum(source_size) AS words, sum(weight) AS weights FROM sources
), full_ones AS (
  SELECT sum(2 * source_size) OVER w AS filled, sum(weight) OVER w AS used FROM sources
  WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source IS NULL, source ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT 1.5::DOUBLE * words::DOUBLE / weights::DOUBLE AS level FROM whole
  UNION ALL SELECT (1.5::DOUBLE * words::DOUBLE - filled::DOUBLE) / (weights - used)::DOUBLE FROM full_ones, whole WHERE used < weights
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight::DOUBLE) AS target FROM sources
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS rest
  FROM targets
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key NULLS LAST, tie
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM keyed
)
SELECT p.doc_id, p.size, b.source_size, b.target::DOUBLE AS target,
  (b.epochs * p.size + greatest(0, least(p.size, b.rest - p.ahead)))::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op4_chat_format": CHAT,
    "op10_decontaminate": DECONTAMINATION,
    "op11_turn_trie": TRIE,
    "op12_ranked_search": SEARCH,
    "op13_source_mix": MIX,
}
