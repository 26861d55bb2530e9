"""SQL of the text queries for a second engine, written from their definitions.

Models, minimum hashes and tokenizers are beyond SQL, and strings of all positions
(op8) or similar lines (op7) are too many for it on whole tables; tests hold these
against plain Python.
"""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, {_WORDS.format('text')} AS words, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
u AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS i FROM s),
grams AS (SELECT rid, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram,
    lead(word, 4) OVER o AS last FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams WHERE last IS NOT NULL),
repeated AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS place FROM windows WHERE n > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words FROM s LEFT JOIN repeated r USING (rid)),
f AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT
    + 64 * (2 * n_capitals > word_chars)::INT AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
"""

_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, 15 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;'))
        + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n FROM t),
x AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""

_NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
u AS (SELECT doc_id, len(words) AS size, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
grams AS (SELECT doc_id, size, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS shingle
    FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
y AS (SELECT DISTINCT doc_id, shingle FROM grams WHERE i <= greatest(size - 4, 0)),
x AS (SELECT doc_id, shingle, count(*) OVER (PARTITION BY doc_id) AS n FROM y),
s AS (SELECT w.doc_id, coalesce(any_value(x.n), 0) AS n FROM w LEFT JOIN x USING (doc_id) GROUP BY w.doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, min(b) AS component_id, s.doc_id = min(b) AS kept
FROM s JOIN reach ON a = s.doc_id GROUP BY s.doc_id, n
"""

_AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT d.*, {_WORDS.format('text')} AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(words) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' END,
    CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > least THEN 'E' END) AS fails
    FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c, c d, c e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS letter FROM o, (SELECT unnest(range(1, 6)) AS step)),
g AS (SELECT part, filter_order, step, letter, n, good, toxic, fails,
    length(regexp_replace(filter_order[1:step], '[^' || fails || '~]', '', 'g')) > 0 AS gone,
    length(regexp_replace(filter_order[1:step - 1], '[^' || fails || '~]', '', 'g')) > 0 AS earlier FROM m, s),
a AS (SELECT part, filter_order, step, letter, sum(n) FILTER (NOT gone) AS kept, sum(n) FILTER (gone AND NOT earlier) AS removed,
    sum(n) FILTER (contains(fails, letter) AND earlier) AS redundant, sum(n) FILTER (fails = letter) AS unique_fails,
    sum(good) FILTER (gone AND NOT earlier) AS good_lost, sum(toxic) FILTER (gone AND NOT earlier) AS toxic_lost FROM g GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley FROM a
"""


def _edits(state: str, user: str | None, reply: str | None, system: str | None = None) -> str:
    """The least of deleting, keeping and re-roling a row from ``state``; values are eight digits of cost and the edits."""
    def arc(cost: str, label: str, after: str) -> str:
        return f"printf('%08d', CAST(left({after}, 8) AS INT) + {cost}) || '{label}' || substr({after}, 9)"
    found = [arc("3", "D", state)]
    for initial, after in (("u", user), ("a", reply), ("s", system)):
        if after:
            kept = arc("truncated::INT", "K", after)
            found.append(f"CASE WHEN whole AND initial = '{initial}' THEN {kept} ELSE '~' END")
            if initial != "s":
                found.append(f"CASE WHEN whole THEN {arc('2 + truncated::INT', 'R', after)} ELSE '~' END")
    return f"least({', '.join(found)})"


def _insert(after: str) -> str:
    return f"printf('%08d', CAST(left({after}, 8) AS INT) + 2) || 'I' || substr({after}, 9)"


# Conversations are read from their ends: best values of the states nothing, system, user, assistant.
_REPAIR = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, 4294967295 - list_reduce(
    list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role, CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE crc % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
r AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, left(role, 1) AS initial,
    regexp_matches(text, '[^ 	-
]') AND NOT again AS whole,
    regexp_matches(text, '[^ 	-
]') AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-
]*$') AS truncated,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM n),
t AS (SELECT conv_id, greatest(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum((again AND NOT blank)::INT) AS duplicate,
    sum(truncated::INT) AS truncated, sum((prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal, max(i) AS size FROM r GROUP BY conv_id),
v AS (SELECT conv_id, size AS i, '00000000' AS b0, '00000004II' AS b1, '00000002I' AS b2, '00000000' AS b3 FROM t
    UNION ALL
    SELECT conv_id, i - 1, least(p0, {_insert('q2')}), least(p1, {_insert('q2')}), q2, least(p3, {_insert('p2')})
    FROM (SELECT *, least(p2, {_insert('p3')}) AS q2 FROM (SELECT v.conv_id, v.i,
        {_edits('b0', 'b2', None, 'b1')} AS p0, {_edits('b1', 'b2', None)} AS p1, {_edits('b2', None, 'b3')} AS p2, {_edits('b3', 'b2', None)} AS p3
        FROM v JOIN r ON r.conv_id = v.conv_id AND r.i = v.i))),
best AS (SELECT conv_id, CAST(left(b0, 8) AS BIGINT) AS cost, substr(b0, 9) AS audit FROM v WHERE i = 0),
e AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS spot FROM best WHERE audit <> ''),
p AS (SELECT *, sum((edit <> 'I')::INT) OVER w AS i, sum((edit <> 'D')::INT) OVER w AS place FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
x AS (SELECT p.conv_id, p.edit, p.spot, p.place, r.role, r.text, bool_or(p.edit = 'K' AND p.place = 1 AND r.initial = 's') OVER (PARTITION BY p.conv_id) AS headed
    FROM p LEFT JOIN r ON r.conv_id = p.conv_id AND r.i = p.i AND p.edit <> 'I'),
y AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - headed::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS repaired FROM x WHERE edit <> 'D' GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN t USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN y USING (conv_id)
"""

SQL: dict[str, str] = {"op3_chat_formatting": _CHAT, "op6_quality_rules": _RULES, "op9_minhash_dedup": _NEAR, "op12_filter_audit": _AUDIT, "op13_conversation_repair": _REPAIR}
