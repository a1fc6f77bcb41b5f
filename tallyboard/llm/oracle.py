"""DuckDB equivalents of those corpus queries that SQL can express.

Packing, pseudonyms, the trained classifier, id matrices and fuzzy lines have
none; the tests hold them against brute force, round trips and held-out rows.
"""

from __future__ import annotations

from .queries import ENTROPY_SHARE, MAX_COVERED, MAX_LONGEST, MIX_SEED, MOST_REPEATS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTS = 1_000_000_000


def _components(nodes: str, edges: str) -> str:
    """A recursive part: (node, label) by the smallest node that edges (a, b), both ways, lead to."""
    return f"""reach(node, label) AS (
    SELECT node, node FROM {nodes}
    UNION
    SELECT e.b, r.label FROM reach r JOIN {edges} e ON r.node = e.a WHERE r.label < e.b
), labels AS (SELECT node, min(label) AS label FROM reach GROUP BY node)"""


OP2 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(source, '') AS s, len({WORDS}) + 1 AS n_tokens FROM documents
), src AS (
    SELECT s, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / (SELECT sum(n_tokens)::DOUBLE FROM d) AS share FROM d GROUP BY s
), total AS (SELECT sum(tokens)::HUGEINT AS t, count(*) AS n, min(tokens) AS least FROM src
), entropy(step, lo, hi) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT step + 1,
        CASE WHEN ln(sum(pow(share, (lo + hi) / 2))) - (lo + hi) / 2 * sum(pow(share, (lo + hi) / 2) * ln(share)) / sum(pow(share, (lo + hi) / 2))
            >= {ENTROPY_SHARE} * ln((SELECT n FROM total)) THEN (lo + hi) / 2 ELSE lo END,
        CASE WHEN ln(sum(pow(share, (lo + hi) / 2))) - (lo + hi) / 2 * sum(pow(share, (lo + hi) / 2) * ln(share)) / sum(pow(share, (lo + hi) / 2))
            >= {ENTROPY_SHARE} * ln((SELECT n FROM total)) THEN hi ELSE (lo + hi) / 2 END
    FROM entropy, src WHERE step < 50 GROUP BY step, lo, hi
), repeats(step, lo, hi) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT step + 1,
        CASE WHEN max(pow(share, (lo + hi) / 2) / tokens) / sum(pow(share, (lo + hi) / 2)) * (SELECT t FROM total) > {MOST_REPEATS} THEN (lo + hi) / 2 ELSE lo END,
        CASE WHEN max(pow(share, (lo + hi) / 2) / tokens) / sum(pow(share, (lo + hi) / 2)) * (SELECT t FROM total) > {MOST_REPEATS} THEN hi ELSE (lo + hi) / 2 END
    FROM repeats, src WHERE step < 50 GROUP BY step, lo, hi
), alpha AS (
    SELECT greatest((SELECT lo FROM entropy WHERE step = 50), (SELECT hi FROM repeats WHERE step = 50)) AS a
), plan AS (
    SELECT s, tokens, greatest(round({PARTS} * pow(share, a) / sum(pow(share, a)) OVER ())::BIGINT, 1)::HUGEINT * (SELECT t FROM total) // {PARTS} AS quota
    FROM src, alpha
), passes AS (SELECT s, tokens, (quota // tokens)::BIGINT AS full_passes, (quota % tokens)::BIGINT AS rest FROM plan
), last AS (
    SELECT d.*, full_passes, rest, md5(concat_ws('|', '{MIX_SEED}', full_passes::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS k
    FROM d JOIN passes USING (s)
), placed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY s ORDER BY k) - sum(n_tokens) OVER (PARTITION BY s, k) AS before FROM last
), copies AS (SELECT *, full_passes + CASE WHEN before < rest THEN 1 ELSE 0 END AS n FROM placed)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, e::BIGINT AS epoch,
    md5(concat_ws('|', '{MIX_SEED}', e::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS mix_order
FROM copies, unnest(range(0, n)) AS t(e)
"""

OP3 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
win AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(list_slice(words, i, i + 19), ' ') ORDER BY doc_id, i) AS n
    FROM w, unnest(range(1, len(words) - 18)) AS t(i) WHERE len(words) >= 20
),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win, unnest(range(0, 20)) AS t(k) WHERE n > 1),
word AS (SELECT doc_id, p, words[p] AS word FROM w, unnest(range(1, len(words) + 1)) AS t(p)),
kept AS (
    SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS text FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
    WHERE gone.p IS NULL GROUP BY word.doc_id
),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id LEFT JOIN lost ON w.doc_id = lost.doc_id
"""

OP4 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{A_Z.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
),
gram AS (
    SELECT DISTINCT doc_id, list_slice(words, i, i + 4) AS g FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0
),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
edges AS (
    SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * common.n >= 75 * (p.n + q.n - common.n)
),
nodes AS (SELECT doc_id AS node FROM documents),
{_components("nodes", "edges")}
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, label AS component_id, doc_id = label AS kept
FROM documents JOIN labels ON node = doc_id LEFT JOIN size USING (doc_id)
"""


def _repeated(name: str, size: int) -> str:
    return f"""{name} AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(words, i, i + {size - 1}), ' ')) AS n
        FROM w, unnest(range(1, len(words) - {size - 2})) AS t(i) WHERE len(words) >= {size}
    ) WHERE n > 1
), {name}_words AS (
    SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM {name}, unnest(range(0, {size})) AS t(k) GROUP BY doc_id
)"""


OP7 = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
{_repeated("eight", 8)},
{_repeated("five", 5)},
long_repeat AS (
    SELECT DISTINCT doc_id FROM (
        SELECT doc_id, count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(words, i, i + {MAX_LONGEST}), ' ')) AS n
        FROM w, unnest(range(1, len(words) - {MAX_LONGEST - 1})) AS t(i) WHERE len(words) > {MAX_LONGEST}
    ) WHERE n > 1
),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (
    SELECT doc_id, line, count(*) AS n FROM line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL) GROUP BY doc_id),
counted AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
        (len(text) - len(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
        coalesce(eight_words.n, 0)::BIGINT AS n_repeat_words, coalesce(five_words.n, 0)::BIGINT AS covered_words,
        w.doc_id IN (SELECT doc_id FROM long_repeat) AS too_long
    FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN eight_words USING (doc_id) LEFT JOIN five_words USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * covered_words <= {round(100 * MAX_COVERED)} * n_words AND NOT too_long AS kept
FROM counted
"""

OP8 = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
edges AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_components("nodes", "edges")},
degree AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(degree.n, 0)::BIGINT AS n_links, labels.label AS component_id, vec_id = labels.label AS kept
FROM embeddings JOIN labels ON node = vec_id LEFT JOIN degree ON a = vec_id
"""

#: The table of CRC-32: every byte, shifted and folded eight times.
CRC_TABLE = """crc_step(step, entries) AS (
    SELECT 0, list_transform(range(256), lambda x: x::BIGINT)
    UNION ALL
    SELECT step + 1, list_transform(entries, lambda x: xor(x >> 1, (x & 1) * 3988292384)) FROM crc_step WHERE step < 8
), crc AS (SELECT entries FROM crc_step WHERE step = 8)"""


def _crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes; needs crc among the tables read."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295)"


OP11 = f"""
WITH RECURSIVE {CRC_TABLE},
run AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''), '{A_Z}', '{A_Z.lower()}'), '[A-Za-z\u00C0-\u00FF]+')) AS run
    FROM documents
),
hashed AS (SELECT run, {_crc32("doc || ':' || run")} AS h FROM run, crc WHERE length(run) >= 6),
spelt AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
),
v AS (SELECT word, count(*) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS t(i)),
lacking AS (SELECT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS t(i)),
pair AS (
    SELECT x.word, y.word AS near, y.n FROM masked x JOIN masked y ON x.rest = y.rest AND x.word <> y.word
    UNION SELECT lacking.word, v.word, v.n FROM lacking JOIN v ON lacking.rest = v.word
    UNION SELECT v.word, lacking.word, lacking.n FROM lacking JOIN v ON lacking.rest = v.word
),
best AS (SELECT word, count(*) AS n_near, list(near ORDER BY n DESC, near)[1] AS near, max(n) AS near_n FROM pair GROUP BY word),
judged AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
    FROM v LEFT JOIN best ON v.word = best.word
),
follow(word, reached) AS (
    SELECT word, form FROM judged WHERE form IS NOT NULL
    UNION ALL SELECT follow.word, judged.form FROM follow JOIN judged ON judged.word = follow.reached WHERE judged.form IS NOT NULL
),
topmost AS (SELECT follow.word, follow.reached AS root FROM follow JOIN judged ON judged.word = follow.reached WHERE judged.form IS NULL)
SELECT judged.word, form, coalesce(root, judged.word) AS root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM judged LEFT JOIN topmost ON judged.word = topmost.word
"""

_FIVE_BITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0))

OP12 = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
    array_to_string(list_transform(list_transform(regexp_extract_all(sha1(payload), '.....'), lambda x: ('0x' || x)::BIGINT), lambda x: {_FIVE_BITS}), '') AS payload_digest,
    CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id > first THEN first END AS refers_to
FROM p
"""

OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
turn AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS turns FROM turn GROUP BY conv_id
),
hashed AS (SELECT conv_id, turns, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM own, crc),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
    FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
),
member AS (SELECT conv_id, d, list_slice(turns, 1, d) AS path, d = len(turns) AS ends FROM rebuilt, unnest(range(0, len(turns) + 1)) AS t(d)),
node AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ended FROM member GROUP BY path, d
),
child AS (SELECT list_slice(path, 1, d - 1) AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
figure AS (
    SELECT node.*, coalesce(child.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(node.path[d].text) END AS saved FROM node LEFT JOIN child ON child.path = node.path
),
subtree AS (
    SELECT list_slice(path, 1, k) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved FROM figure, unnest(range(0, d + 1)) AS t(k) GROUP BY 1
)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(f.ended, '')) AS ends_sha256
FROM figure f JOIN subtree s ON s.path = f.path LEFT JOIN node p ON f.d > 0 AND p.path = list_slice(f.path, 1, f.d - 1)
"""

ORACLE_SQL = {
    "op2_mixing": OP2,
    "op3_substring_dedup": OP3,
    "op4_minhash": OP4,
    "op7_repetition": OP7,
    "op8_embeddings": OP8,
    "op11_spelling_variants": OP11,
    "op12_warc": OP12,
    "op13_conversation_trie": OP13,
}
