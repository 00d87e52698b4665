"""SQL of the operators that SQL can express, for DuckDB."""

# CRC-32 has no function: a table of the 256 bytes' sums, and a step for each byte of a text.
_CRC_TABLE = """crc_step(x, c, k) AS (
    SELECT x, x::UBIGINT, 0 FROM range(256) AS r(x)
    UNION ALL
    SELECT x, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END), k + 1
    FROM crc_step WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY x) AS crcs FROM crc_step WHERE k = 8)"""


def _crc32(text: str) -> str:
    """The unsigned sum of a text; ``crcs`` of crc_table must be in scope."""
    digits = f"hex(encode({text}))"
    values = (
        f"list_transform(range(1, length({digits}), 2), lambda i: (16 * (instr('0123456789ABCDEF', "
        f"substr({digits}, i, 1)) - 1) + instr('0123456789ABCDEF', substr({digits}, i + 1, 1)) - 1)::UBIGINT)"
    )
    start = f"list_prepend(4294967295::UBIGINT, {values})"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c & 255, b) + 1)::BIGINT])"
    return f"xor(list_reduce({start}, {step}), 4294967295::UBIGINT)::BIGINT"


# A pair of words of one length differs in one place if both are equal without it; of two
# lengths, the shorter one is the longer one without a letter.
POSITION_INDEX = f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
    SELECT run, times, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
    FROM counted, crc_table
),
spelt AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT)
        || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed
),
words AS (
    SELECT word, sum(times)::BIGINT AS n FROM spelt
    WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
cut AS (
    SELECT word, n, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i
    WHERE a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
near AS (
    SELECT word, count(*) AS n_near, min_by(other, (-other_n, other)) AS best, max(other_n) AS best_n
    FROM pairs GROUP BY word
),
told AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN best_n >= 2 * w.n THEN best END AS form,
        CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
    FROM words w LEFT JOIN near USING (word)
),
followed AS (
    SELECT word, word AS root FROM told
    UNION ALL
    SELECT f.word, t.form FROM followed f JOIN told t ON t.word = f.root WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, f.root, t.n, t.n_near, t.form_n
FROM told t JOIN followed f USING (word)
WHERE f.root IN (SELECT word FROM told WHERE form IS NULL)"""


# A node is a list of first turns; those beneath it are found by the lists that its members have.
PREFIX_TRIE = f"""WITH RECURSIVE {_CRC_TABLE},
numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM numbered), crc_table
),
turns AS (
    SELECT c.conv_id, 0 AS own, n.place, n.role, n.text
    FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.place < c.h
    UNION ALL
    SELECT c.conv_id, 1, n.place, n.role, n.text
    FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.place >= c.h
),
prefixes AS (
    SELECT conv_id, text, row_number() OVER w AS depth, list({{'role': role, 'text': text}}) OVER w AS prefix,
        count(*) OVER (PARTITION BY conv_id) AS n
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
    UNION ALL
    SELECT c.conv_id, '', 0, [], coalesce(t.n, 0)
    FROM convs c LEFT JOIN (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1) t USING (conv_id)
),
nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(length(text)) AS letters,
        string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
    FROM prefixes GROUP BY depth, prefix
),
ways AS (
    SELECT p.conv_id AS member, p.depth, n.conv_id
    FROM prefixes p JOIN nodes n ON n.depth = p.depth AND n.prefix = p.prefix
),
parents AS (
    SELECT n.conv_id, n.depth, w.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN ways w ON w.member = n.conv_id AND w.depth = n.depth - 1
),
children AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY ALL),
told AS (
    SELECT n.*, p.parent_conv_id, coalesce(c.n_children, 0) AS n_children
    FROM nodes n JOIN parents p ON p.conv_id = n.conv_id AND p.depth = n.depth
    LEFT JOIN children c ON c.parent_conv_id = n.conv_id AND c.depth = n.depth
),
sums AS (
    SELECT w.conv_id, w.depth, count_if(t.n_children = 0) AS n_leaves,
        sum((t.n_convs - 1) * t.letters) AS saved_tokens
    FROM told t JOIN ways w ON w.member = t.conv_id AND w.depth <= t.depth GROUP BY ALL
)
SELECT t.conv_id, t.depth::BIGINT AS depth, t.parent_conv_id, t.n_convs, t.n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
    sha256(coalesce(t.ends, '')) AS ends_sha256
FROM told t JOIN sums s ON s.conv_id = t.conv_id AND s.depth = t.depth"""
