"""The registered queries in SQL, written independently of the Spark expressions."""

from folia.checks import views
from folia.config import Settings
from folia.functions.cleaning import PUNCTUATION

SETTINGS = Settings()

# Character classes of the RE2 engine.
WS_BODY = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_BODY}]"
NOT_WS = f"[^{WS_BODY}]"
W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
D = r"\p{Nd}"
LB = r"(?:\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}])"


def text(value: str) -> str:
    """A string as an SQL expression; all but printable ASCII goes through chr()."""
    parts, plain = [], ""
    for char in value:
        if " " <= char <= "~" and char != "'":
            plain += char
            continue
        if plain:
            parts.append(f"'{plain}'")
        parts.append(f"chr({ord(char)})")
        plain = ""
    if plain or not parts:
        parts.append(f"'{plain}'")
    return "(" + " || ".join(parts) + ")"


def sub(value: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({value}, '{pattern}', '{to}', 'g')"


def swap(value: str, old: str, new: str) -> str:
    return f"replace({value}, {text(old)}, {text(new)})"


# Cleaning steps.
def crlf(x):
    return swap(x, "\r\n", "\n")


def spaces(x):
    return sub(x, r"[ \t]+", " ")


def newlines(x):
    return f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def page_lines(x):
    return sub(x, rf"(?m)^{D}+{WS}*$")


def page_x_of_y(x):
    return sub(x, rf"(?i)page{WS}+{D}+{WS}+of{WS}+{D}+")


def hyphen(x):
    return sub(x, rf"({W})-\n({W})", r"\1\2")


def typography(x):
    for old, new in PUNCTUATION.items():
        x = swap(x, old, new)
    return x


def control(x):
    # The control characters to drop.
    return sub(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def strip(x):
    return sub(x, rf"\A{WS}+|{WS}+\z")


def clean(x):
    for step in (
        crlf, spaces, newlines, page_lines, page_x_of_y, hyphen, typography, control, strip,
    ):
        x = step(x)
    return x


# Metadata.
def words(x):
    return f"list_filter(regexp_split_to_array(lower({x}), '{WS}+'), lambda w: w <> '')"


def line_count(x):
    return (
        f"(len(regexp_extract_all({x}, '{LB}'))"
        f" + ({x} <> '' AND NOT regexp_matches({x}, '{LB}\\z'))::INT)"
    )


def has_tables(x):
    return f"(len(list_filter(regexp_split_to_array({x}, '{LB}'), lambda l: contains(l, '|'))) > 3)"


def has_lists(x):
    # What marks an item of a list.
    return (
        f"(regexp_matches({x}, '(?m)^{WS}*[-*•]{WS}')"
        f" OR regexp_matches({x}, '(?m)^{WS}*{D}+[.)]{WS}'))"
    )


def has_numbers(x):
    # An amount, a percentage, a number of four digits.
    return (
        rf"(regexp_matches({x}, '\${D}+[{D},]*\.?{D}*') OR regexp_matches({x}, '[{D},]+{WS}?%')"
        rf" OR regexp_matches({x}, '(^|{NOT_W}){D}{{4}}({NOT_W}|$)'))"
    )


def language(x):
    # The words that hint at English.
    hints = "'the', 'and', 'is', 'in', 'it', 'of', 'to', 'a'"
    hits = f"len(list_filter({words(x)}, lambda w: w IN ({hints})))"
    return (
        f"CASE WHEN len({words(x)}) >= 10 AND {hits} > len({words(x)}) * 0.05::DOUBLE"
        f" THEN 'en' ELSE 'unknown' END"
    )


def metadata(x):
    return (
        f"length({x}) AS char_count, len({words(x)}) AS word_count, {line_count(x)} AS line_count, "
        f"{has_tables(x)} AS has_tables, {has_lists(x)} AS has_lists, "
        f"{has_numbers(x)} AS has_numbers, {language(x)} AS language"
    )


# Views, the counterpart of folia.checks.views.
DIRTY = f"""CASE doc_id % 5
    WHEN 0 THEN {swap("text", ". ", views.PAGE_BREAK)}
    WHEN 1 THEN {swap(swap("text", " ", "  " + chr(9)), "er", "e-" + chr(10) + "r")}
    WHEN 2 THEN {swap("text", " the ", views.QUOTED)}
    WHEN 3 THEN {swap("text", ", ", views.LISTED)}
    ELSE {text(views.BEFORE)} || text || {text(views.AFTER)} END"""
NAME = """(CASE WHEN doc_id % 50 = 7 THEN '_pipeline/' ELSE '' END || source || '/'
    || (doc_id // 150) || '/doc_' || (doc_id % 150)
    || CASE doc_id % 6 WHEN 0 THEN '.PDF' WHEN 1 THEN '.txt' WHEN 2 THEN '.v2.pdf' ELSE '.pdf' END)"""
FILES = f"""files AS (
    SELECT *, 'gs://{views.BUCKET}/' || name AS uri FROM (
        SELECT doc_id, {NAME} AS name,
            CASE WHEN doc_id % 10 <> 9 THEN n_chars END AS size,
            CASE WHEN doc_id % 9 <> 0
                THEN make_timestamp((1704067200 + doc_id * 61) * 1000000) END AS updated
        FROM documents))"""
DIRTY_DOCUMENTS = f"dirty_documents AS (SELECT doc_id, {DIRTY} AS text FROM documents)"
LAYOUT = """list_transform(string_split(dirty, chr(10)), lambda line, i: {
    'chunk_id': 'c' || (i - 1), 'content': line, 'page_start': ((i - 1) // 4)::INT,
    'page_end': (i // 4)::INT, 'source_block_ids': ['b' || (i - 1)]})"""
EXTRACTED = f"""extracted AS MATERIALIZED (
    SELECT doc_id, name, 'gs://{views.BUCKET}/' || name AS uri,
        CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 <> 3 THEN dirty END AS text,
        CASE WHEN doc_id % 7 % 3 = 0 THEN {LAYOUT} ELSE [] END AS layout_chunks,
        CASE WHEN doc_id % 97 = 5 THEN '{views.FAILED}' END AS error
    FROM (SELECT doc_id, {DIRTY} AS dirty, {NAME} AS name FROM documents))"""
RAW = """coalesce(nullif(text, ''),
    array_to_string(list_transform(layout_chunks, lambda c: c.content), chr(10) || chr(10)), '')"""
PROCESSED_INDEX = """processed_index AS (
    SELECT uri FROM files WHERE doc_id IN (SELECT doc_id FROM labels))"""
BASENAME = "regexp_extract({}, '[^/]*$')"


def result_path(filename: str) -> str:
    return f"'results/' || regexp_replace({filename}, '\\.[^.]*$', '') || '.json'"


def is_pdf(name: str = "name") -> str:
    return f"lower({name}) LIKE '%.pdf'"


def with_ctes(*parts: str) -> str:
    ctes, select = parts[:-1], parts[-1]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def leaf_ctes(source: str, size: int) -> list[str]:
    """Pieces ``leaves(doc_id, s, t, lv, ps)`` of ``source(doc_id, text)``."""
    ctes = [
        f"l0 AS MATERIALIZED (SELECT doc_id, 0::BIGINT AS s, text AS t, 0 AS lv, 0::BIGINT AS ps"
        f" FROM {source} WHERE text <> '')"
    ]
    # The separators, coarsest first.
    separators = ("\n\n", "\n", ". ", "! ", "? ", ";", ",", " ")
    for level, separator in enumerate(separators, 1):
        marked = f"replace(t, {text(separator)}, chr(1) || {text(separator)})"
        ctes.append(
            f"""l{level} AS MATERIALIZED (
    SELECT doc_id, s, t, lv, ps FROM l{level - 1} WHERE length(t) < {size}
    UNION ALL
    SELECT doc_id, (s + sum(length(piece)) OVER (PARTITION BY doc_id, s ORDER BY ord)
        - length(piece))::BIGINT, piece, {level}, s
    FROM (SELECT doc_id, s, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS ord
        FROM (SELECT doc_id, s, string_split({marked}, chr(1)) AS pieces
            FROM l{level - 1} WHERE length(t) >= {size}))
    WHERE piece <> '')"""
        )
    ctes.append(f"leaves AS (SELECT * FROM l{len(separators)})")
    return ctes


def chunk_ctes(source: str, size: int = SETTINGS.chunk_size, overlap: int = SETTINGS.chunk_overlap):
    """Chunks ``chunks(doc_id, chunk_index, content)`` of ``source(doc_id, text)``.

    From every piece the end of a chunk starting there and the start of the next chunk
    are looked up; a recursion then follows these links from the start of each run.
    """
    return [
        *leaf_ctes(source, size),
        f"""marked AS (
    SELECT doc_id, s, s + length(t) AS e, length(t) >= {size} AS big,
        (coalesce(lag(lv) OVER w <> lv OR lag(ps) OVER w <> ps, true)
        OR length(t) >= {size} OR lag(length(t) >= {size}) OVER w)::INT AS brk
    FROM leaves WINDOW w AS (PARTITION BY doc_id ORDER BY s))""",
        """pieces AS MATERIALIZED (
    SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked)""",
        """runs AS MATERIALIZED (
    SELECT doc_id, run, min(s) AS first, max(e) AS last, bool_or(big) AS big
    FROM pieces GROUP BY ALL)""",
        f"""floors AS (
    SELECT doc_id, run, s, e, greatest(s - {overlap}, e - {size}) AS floor FROM pieces)""",
        """backs AS MATERIALIZED (
    SELECT f.doc_id, f.run, f.s, f.e, p.s AS back FROM floors f ASOF JOIN pieces p
    ON f.doc_id = p.doc_id AND f.run = p.run AND f.floor <= p.s)""",
        f"""links AS MATERIALIZED (
    SELECT p.doc_id, p.run, p.s, b.s AS e, greatest(p.s, b.back) AS following
    FROM pieces p ASOF JOIN backs b
    ON p.doc_id = b.doc_id AND p.run = b.run AND p.s + {size} < b.e AND p.big = false)""",
        """spans AS (
    SELECT doc_id, run, first AS s FROM runs
    UNION ALL
    SELECT l.doc_id, l.run, l.following FROM spans x JOIN links l
    ON l.doc_id = x.doc_id AND l.run = x.run AND l.s = x.s)""",
        f"""found AS (
    SELECT x.doc_id, x.s, substring(d.text, x.s + 1, coalesce(l.e, r.last) - x.s) AS t, r.big
    FROM spans x JOIN runs r ON r.doc_id = x.doc_id AND r.run = x.run
    LEFT JOIN links l ON l.doc_id = x.doc_id AND l.run = x.run AND l.s = x.s
    JOIN {source} d ON d.doc_id = x.doc_id)""",
        f"""chunks AS MATERIALIZED (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_index, content
    FROM (SELECT doc_id, s, CASE WHEN big THEN t ELSE {strip("t")} END AS content FROM found)
    WHERE content <> '')""",
    ]


def weight_ctes(source: str, keys: str, content: str, dims: int, name: str) -> list[str]:
    """Sparse embeddings ``name(keys, bucket, n, weight)`` of a text column."""
    return [
        f"""{name}_counts AS MATERIALIZED (
    SELECT {keys}, bucket, count(*) AS n FROM (
        SELECT {keys}, ('0x' || substr(md5(token), 1, 8))::BIGINT % {dims} AS bucket FROM (
            SELECT {keys}, unnest(regexp_extract_all(lower({content}), '{W}+')) AS token
            FROM {source}))
    GROUP BY ALL)""",
        f"""{name} AS MATERIALIZED (
    SELECT *, (n / sqrt(sum(n * n) OVER (PARTITION BY {keys})::DOUBLE))::FLOAT::DOUBLE AS weight
    FROM {name}_counts)""",
    ]


CLEANED_DIRTY = [
    DIRTY_DOCUMENTS,
    f"cleaned AS MATERIALIZED (SELECT doc_id, {clean('text')} AS text FROM dirty_documents)",
]
# Processed documents: cleaned text, counts and metadata of every extracted document.
PROCESSED = [
    EXTRACTED,
    f"raws AS MATERIALIZED (SELECT *, {RAW} AS raw FROM extracted)",
    f"cleaned AS MATERIALIZED (SELECT *, {clean('raw')} AS cleaned FROM raws)",
    f"""described AS MATERIALIZED (
    SELECT doc_id, uri AS source, name, {BASENAME.format("uri")} AS filename, error,
        length(raw) AS raw_char_count, length(cleaned) AS cleaned_char_count,
        len(layout_chunks) AS layout_chunk_count, layout_chunks, cleaned, {metadata("cleaned")}
    FROM cleaned)""",
]
PROCESSED_CHUNKS = [
    *PROCESSED,
    "chunk_source AS (SELECT doc_id, cleaned AS text FROM described)",
    *chunk_ctes("chunk_source"),
    """chunk_sums AS MATERIALIZED (
    SELECT doc_id, count(*) AS n, md5(string_agg(content, '|' ORDER BY chunk_index)) AS digest
    FROM chunks GROUP BY doc_id)""",
    f"""processed AS MATERIALIZED (
    SELECT d.*, coalesce(c.n, 0) AS text_chunk_count, coalesce(c.digest, md5('')) AS chunk_digest,
        {result_path("filename")} AS output_path
    FROM described d LEFT JOIN chunk_sums c ON c.doc_id = d.doc_id)""",
]
RECORD_COLUMNS = """source, filename, raw_char_count, cleaned_char_count, layout_chunk_count,
    text_chunk_count, char_count, word_count, line_count, has_tables, has_lists, has_numbers,
    language, chunk_digest, md5(array_to_string(list_transform(layout_chunks,
        lambda c: c.chunk_id || ':' || c.page_start || ':' || c.page_end || ':'
            || c.source_block_ids[1] || ':' || c.content), '|')) AS layout_digest"""
# Chunks of all good PDFs with their ids in an empty vector table.
STORED = [
    *PROCESSED_CHUNKS,
    f"""stored AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY source, chunk_index) AS id, source, filename,
        chunk_index, content
    FROM chunks JOIN processed USING (doc_id) WHERE error IS NULL AND {is_pdf()})""",
]
# The field of a body that is an object, of repeated keys the last; values hold no quotes here.
def _field(key: str) -> str:
    return (
        f"CASE WHEN json_type(body) = 'OBJECT' THEN "
        f"list_last(regexp_extract_all(body, '\"{key}\":\"([^\"]*)\"', 1)) END AS body_{key}"
    )


NOTIFICATIONS = [
    FILES,
    f"""plain AS (
    SELECT event_id, event_type, name, '{{"kind":"storage#object","name":"' || name
        || '","bucket":"{views.BUCKET}","contentType":"application/pdf"}}' AS body
    FROM events JOIN files ON doc_id = user_id)""",
    f"""bodies AS (
    SELECT * EXCLUDE (body), CASE WHEN event_id % 100 IN (1, 24) THEN '[1]'
        WHEN event_id % 100 = 21 THEN body || ' x'
        WHEN event_id % 100 = 14 THEN '{views.REPEATED}' || substr(body, 2) ELSE body END AS body
    FROM plain)""",
    """encoded AS (
    SELECT *, to_base64(CASE WHEN event_id % 100 = 31 THEN encode(body) || '\\xFF'::BLOB
        ELSE encode(body) END) AS sent FROM bodies)""",
    f"""unwrapped AS (
    SELECT event_id, CASE WHEN event_id % 10 = 5 THEN 'A' || sent
            WHEN event_id % 20 = 7 THEN '' WHEN event_id % 10 = 7 THEN NULL ELSE sent END AS data,
        CASE WHEN event_id % 10 NOT IN (3, 4) THEN '{views.BUCKET}'
            WHEN event_id % 10 = 4 THEN '' END AS bucket_id,
        CASE WHEN event_id % 10 <> 3 THEN name END AS object_id,
        CASE WHEN event_id % 10 <> 3 THEN CASE WHEN event_type = 'error'
            THEN 'OBJECT_DELETE' ELSE 'OBJECT_FINALIZE' END END AS kind
    FROM encoded)""",
    f"""decoded AS (
    SELECT *, {_field("bucket")}, {_field("name")}
    FROM (SELECT * EXCLUDE (data), try(decode(try(from_base64(nullif(data, ''))))) AS body FROM unwrapped)
    WHERE body IS NOT NULL AND json_valid(body))""",
    """routed AS (
    SELECT event_id, coalesce(nullif(bucket_id, ''), nullif(body_bucket, '')) AS bucket,
        coalesce(nullif(object_id, ''), nullif(body_name, '')) AS name, coalesce(kind, '') AS event_type
    FROM decoded
    WHERE coalesce(nullif(bucket_id, ''), nullif(body_bucket, '')) IS NOT NULL
        AND coalesce(nullif(object_id, ''), nullif(body_name, '')) IS NOT NULL)""",
    f"""accepted AS (
    SELECT *, 'gs://' || bucket || '/' || name AS uri FROM routed
    WHERE event_type = 'OBJECT_FINALIZE' AND {is_pdf()})""",
]
