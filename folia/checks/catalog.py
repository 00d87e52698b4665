"""Every operator as a registered query: a DataFrame, and its SQL where there is one."""

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folia.checks import oracles as sql, views
from folia.config import Settings
from folia.functions import cleaning, metadata as meta, naming
from folia.functions.splitting import split_pieces
from folia.functions.vectors import cosine_similarity
from folia.operators import ann, documents as docs, embedding, pivots, quantised, runs, search
from folia.operators.ids import with_dense_ids
from folia.plans import batch, scheduled
from folia.session import materialise, scratch_path
from folia.sources import index, objects, results, vectors
from folia.sources.spread import spread
from folia.sources.vectorlog import VectorLog
from folia.streaming import notifications as notes, retries

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = Settings()
PREFIX = "src1"
# Digits of a vector's elements that are compared.
SCALE = 1_000_000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def widened(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _widened(query(spark, sf_dir))

        QUERIES[name] = widened
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return add


def _widened(frame: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, the type they have in SQL."""
    return frame.select(
        *(
            F.col(f.name).cast("bigint").alias(f.name)
            if isinstance(f.dataType, T.IntegerType)
            else F.col(f.name)
            for f in frame.schema.fields
        )
    )


# Listing and paths.


@register(
    "scan_prefix",
    sql.with_ctes(sql.FILES, f"SELECT uri, name FROM files WHERE name LIKE '{PREFIX}%'"),
)
def scan_prefix(spark, sf_dir):
    return objects.under_prefix(views.files(spark, sf_dir), PREFIX).select("uri", "name")


@register(
    "filter_pdf", sql.with_ctes(sql.FILES, f"SELECT uri, name FROM files WHERE {sql.is_pdf()}")
)
def filter_pdf(spark, sf_dir):
    return objects.pdfs(views.files(spark, sf_dir)).select("uri", "name")


@register(
    "filter_control_prefix",
    sql.with_ctes(
        sql.FILES, "SELECT uri, name FROM files WHERE NOT starts_with(name, '_pipeline/')"
    ),
)
def filter_control_prefix(spark, sf_dir):
    return objects.without_control_files(views.files(spark, sf_dir)).select("uri", "name")


@register(
    "uri_basename",
    f"""SELECT page_id, 'gs://{views.BUCKET}/' || url AS uri,
    {sql.BASENAME.format("url")} AS filename FROM pages""",
)
def uri_basename(spark, sf_dir):
    uri = naming.object_uri(views.BUCKET, F.col("url"))
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", uri.alias("uri"), naming.basename(uri).alias("filename"))


@register(
    "file_info",
    sql.with_ctes(
        sql.FILES,
        """SELECT uri AS gcs_uri, name AS filename, coalesce(size, 0) AS size,
        coalesce(strftime(updated, '%Y-%m-%dT%H:%M:%S+00:00'), '') AS updated FROM files""",
    ),
)
def file_info(spark, sf_dir):
    return objects.file_info(views.files(spark, sf_dir))


def _named_files(spark, sf_dir):
    filename = naming.basename(F.col("uri"))
    return results.with_output_path(
        views.files(spark, sf_dir).select("name", filename.alias("filename"))
    )


_NAMED_FILES = [
    sql.FILES,
    f"named AS (SELECT name, {sql.BASENAME.format('uri')} AS filename FROM files)",
]


@register(
    "result_path",
    sql.with_ctes(
        *_NAMED_FILES,
        f"SELECT name, filename, {sql.result_path('filename')} AS output_path FROM named",
    ),
)
def result_path(spark, sf_dir):
    return _named_files(spark, sf_dir)


@register(
    "result_path_collisions",
    sql.with_ctes(
        *_NAMED_FILES,
        f"""SELECT {sql.result_path("filename")} AS output_path, count(*) AS files,
        max(name) AS kept FROM named GROUP BY 1 HAVING count(*) > 1""",
    ),
)
def result_path_collisions(spark, sf_dir):
    return results.path_collisions(_named_files(spark, sf_dir))


# Extracted documents.


@register("extract_text", sql.with_ctes(sql.EXTRACTED, f"SELECT uri, {sql.RAW} AS raw FROM extracted"))
def extract_text(spark, sf_dir):
    raw = docs.extracted_text(F.col("text"), F.col("layout_chunks"))
    return views.extracted(spark, sf_dir).select("uri", raw.alias("raw"))


@register(
    "extract_layout_chunks",
    sql.with_ctes(
        sql.EXTRACTED,
        """SELECT uri, position - 1 AS position, c.chunk_id, c.content,
        c.page_start::BIGINT AS page_start, c.page_end::BIGINT AS page_end,
        array_to_string(c.source_block_ids, ',') AS source_block_ids
        FROM (SELECT uri, unnest(layout_chunks) AS c,
            generate_subscripts(layout_chunks, 1) AS position FROM extracted)""",
    ),
)
def extract_layout_chunks(spark, sf_dir):
    rows = docs.layout_chunk_rows(views.extracted(spark, sf_dir))
    return rows.withColumn("source_block_ids", F.array_join("source_block_ids", ","))


def _processed(spark, sf_dir):
    return results.with_output_path(docs.process(views.extracted(spark, sf_dir)))


def _digest(texts: Column) -> Column:
    return F.md5(F.array_join(texts, "|"))


def _flat_records(processed: DataFrame) -> DataFrame:
    """Processed documents without nesting: metadata fields and digests of the chunks."""
    layout = F.transform(
        "layout_chunks",
        lambda c: F.concat_ws(
            ":", c["chunk_id"], c["page_start"], c["page_end"], c["source_block_ids"][0], c["content"]
        ),
    )
    texts = F.transform("text_chunks", lambda c: c["content"])
    counts = ("raw_char_count", "cleaned_char_count", "layout_chunk_count", "text_chunk_count")
    fields = (
        "char_count", "word_count", "line_count", "has_tables", "has_lists", "has_numbers", "language",
    )
    return processed.select(
        "source",
        "filename",
        *counts,
        *(f"metadata.{name}" for name in fields),
        _digest(texts).alias("chunk_digest"),
        _digest(layout).alias("layout_digest"),
    )


@register(
    "doc_counts",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        """SELECT source, raw_char_count, cleaned_char_count, layout_chunk_count, text_chunk_count
        FROM processed""",
    ),
)
def doc_counts(spark, sf_dir):
    return _processed(spark, sf_dir).select(
        "source", "raw_char_count", "cleaned_char_count", "layout_chunk_count", "text_chunk_count"
    )


@register(
    "process_documents",
    sql.with_ctes(*sql.PROCESSED_CHUNKS, f"SELECT {sql.RECORD_COLUMNS} FROM processed"),
)
def process_documents(spark, sf_dir):
    return _flat_records(_processed(spark, sf_dir))


@register(
    "doc_summary",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        """SELECT source, raw_char_count, cleaned_char_count, layout_chunk_count, text_chunk_count
        FROM processed WHERE error IS NULL""",
    ),
)
def doc_summary(spark, sf_dir):
    return docs.summary(docs.succeeded(_processed(spark, sf_dir)))


@register(
    "result_json",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        """joined AS (SELECT doc_id, string_agg(content, '|' ORDER BY chunk_index) AS contents
            FROM chunks GROUP BY doc_id)""",
        """SELECT source, filename, raw_char_count, word_count, language,
        layout_chunk_count AS layout_count, text_chunk_count AS text_count,
        coalesce(contents, '') AS contents
        FROM processed LEFT JOIN joined USING (doc_id)""",
    ),
)
def result_json(spark, sf_dir):
    record = _processed(spark, sf_dir).select(F.to_json(results.record()).alias("json"))
    schema = """source STRING, filename STRING, raw_char_count INT,
        metadata STRUCT<word_count INT, language STRING>, docai_chunks_count INT,
        langchain_chunks_count INT, langchain_chunks ARRAY<STRUCT<content STRING>>"""
    parsed = record.select(F.from_json("json", schema).alias("r"))
    return parsed.select(
        "r.source",
        "r.filename",
        "r.raw_char_count",
        "r.metadata.word_count",
        "r.metadata.language",
        F.col("r.docai_chunks_count").alias("layout_count"),
        F.col("r.langchain_chunks_count").alias("text_count"),
        F.coalesce(F.array_join("r.langchain_chunks.content", "|"), F.lit("")).alias("contents"),
    )


_WINNERS = f"""winners AS (
    SELECT output_path, max(name) AS name FROM processed
    WHERE error IS NULL AND {sql.is_pdf()} GROUP BY output_path)"""


@register(
    "read_results",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        _WINNERS,
        f"""SELECT {sql.RECORD_COLUMNS} FROM processed
        WHERE error IS NULL AND name IN (SELECT name FROM winners)""",
    ),
)
def read_results(spark, sf_dir):
    """Results written as JSON, colliding paths resolved, and read back."""
    path = scratch_path(spark, "results")
    batch.run_batch(views.extracted(spark, sf_dir), path)
    return _flat_records(results.current_results(spark, path))


# Cleaning.


def _register_cleaning(name: str, step: Callable[[Column], Column], oracle: Callable) -> None:
    statement = f"SELECT doc_id, {oracle('text')} AS cleaned FROM dirty_documents"

    @register(name, sql.with_ctes(sql.DIRTY_DOCUMENTS, statement))
    def query(spark, sf_dir):
        dirty = views.dirty_documents(spark, sf_dir)
        return dirty.select("doc_id", step(F.col("text")).alias("cleaned"))


for _name, _step, _oracle in (
    ("clean_text", cleaning.clean, sql.clean),
    ("clean_crlf", cleaning.unify_line_ends, sql.crlf),
    ("clean_spaces", cleaning.squeeze_blanks, sql.spaces),
    ("clean_newlines", cleaning.normalise_whitespace, lambda x: sql.newlines(sql.spaces(sql.crlf(x)))),
    ("clean_page_lines", cleaning.drop_page_number_lines, sql.page_lines),
    ("clean_page_x_of_y", cleaning.drop_page_x_of_y, sql.page_x_of_y),
    ("clean_hyphen", cleaning.rejoin_hyphens, sql.hyphen),
    ("clean_unicode", cleaning.ascii_punctuation, sql.typography),
    ("clean_control", cleaning.drop_controls, sql.control),
    ("clean_strip", cleaning.strip, sql.strip),
):
    _register_cleaning(_name, _step, _oracle)


# Metadata, on the texts before and after cleaning.


def _register_hint(name: str, function: Callable[[Column], Column], oracle: Callable) -> None:
    statement = f"SELECT doc_id, {oracle('text')} AS value FROM dirty_documents"

    @register(name, sql.with_ctes(sql.DIRTY_DOCUMENTS, statement))
    def query(spark, sf_dir):
        dirty = views.dirty_documents(spark, sf_dir)
        return dirty.select("doc_id", function(F.col("text")).alias("value"))


for _name, _function, _oracle in (
    ("word_count", meta.word_count, lambda x: f"len({sql.words(x)})"),
    ("line_count", meta.line_count, sql.line_count),
    ("detect_tables", meta.has_tables, sql.has_tables),
    ("detect_lists", meta.has_lists, sql.has_lists),
    ("detect_numbers", meta.has_numbers, sql.has_numbers),
    ("detect_language", meta.language, sql.language),
):
    _register_hint(_name, _function, _oracle)


def _cleaned(spark, sf_dir):
    dirty = views.dirty_documents(spark, sf_dir)
    return dirty.select("doc_id", cleaning.clean(F.col("text")).alias("text"))


@register(
    "doc_metadata",
    sql.with_ctes(
        *sql.CLEANED_DIRTY,
        f"SELECT doc_id, 'unknown' AS filename, {sql.metadata('text')} FROM cleaned",
    ),
)
def doc_metadata(spark, sf_dir):
    described = _cleaned(spark, sf_dir).select(
        "doc_id", meta.metadata(F.col("text"), F.lit("")).alias("m")
    )
    return described.select("doc_id", "m.*").drop("extracted_at")


# Chunking.


@register(
    "split_leaves",
    sql.with_ctes(
        *sql.CLEANED_DIRTY,
        *sql.leaf_ctes("cleaned", SETTINGS.chunk_size),
        """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS position,
        t AS piece FROM leaves""",
    ),
)
def split_leaves(spark, sf_dir):
    pieces = F.array_remove(split_pieces(F.col("text"), SETTINGS.chunk_size), "")
    return _cleaned(spark, sf_dir).select("doc_id", F.posexplode(pieces).alias("position", "piece"))


def _register_chunks(name: str, settings: Settings) -> None:
    statement = """SELECT doc_id, chunk_index, content, length(content) AS char_count,
        'unknown' AS source FROM chunks"""

    @register(
        name,
        sql.with_ctes(
            *sql.CLEANED_DIRTY,
            *sql.chunk_ctes("cleaned", settings.chunk_size, settings.chunk_overlap),
            statement,
        ),
    )
    def query(spark, sf_dir):
        cleaned = _cleaned(spark, sf_dir).withColumn("source", F.lit(""))
        return docs.chunk_rows(cleaned, "text", "source", settings)


_register_chunks("chunk_documents", SETTINGS)
_register_chunks("merge_chunks", Settings(chunk_size=512, chunk_overlap=64))


@register(
    "chunk_source",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        """SELECT source AS uri, chunk_index, filename AS source, length(content) AS char_count
        FROM chunks JOIN processed USING (doc_id)""",
    ),
)
def chunk_source(spark, sf_dir):
    exploded = _processed(spark, sf_dir).select(
        F.col("source").alias("uri"), F.explode("text_chunks").alias("c")
    )
    return exploded.select("uri", "c.chunk_index", "c.source", "c.char_count")


# Embedding.


def _vector_text(vector: Column) -> Column:
    """Non-zero elements of a vector as text, exact to one in SCALE."""
    elements = F.transform(
        vector,
        lambda x, i: F.when(
            x != 0, F.concat_ws(":", i, F.floor(x.cast("double") * SCALE).cast("bigint"))
        ),
    )
    return F.array_join(elements, " ")


_VECTOR_TEXT = (
    f"string_agg(bucket || ':' || floor(weight * {SCALE})::BIGINT, ' ' ORDER BY bucket)"
)


@register(
    "embed_chunks",
    sql.with_ctes(
        *sql.CLEANED_DIRTY,
        *sql.chunk_ctes("cleaned"),
        *sql.weight_ctes("chunks", "doc_id, chunk_index", "content", SETTINGS.embedding_dimensions, "weights"),
        f"texts AS (SELECT doc_id, chunk_index, {_VECTOR_TEXT} AS vector FROM weights GROUP BY ALL)",
        f"""SELECT doc_id, chunk_index, {SETTINGS.embedding_dimensions}::BIGINT AS dims,
        coalesce(vector, '') AS vector FROM chunks LEFT JOIN texts USING (doc_id, chunk_index)""",
    ),
)
def embed_chunks(spark, sf_dir):
    chunks = docs.chunk_rows(_cleaned(spark, sf_dir).withColumn("source", F.lit("")), "text", "source")
    embedded = embedding.embed_texts(chunks, "content", SETTINGS.embedding_dimensions)
    return embedded.select(
        "doc_id", "chunk_index", F.size("embedding").alias("dims"), _vector_text(F.col("embedding")).alias("vector")
    )


_QUERY_TEXTS = sql.weight_ctes("benchmark", "item_id", "text", SETTINGS.embedding_dimensions, "asked")


@register(
    "embed_query",
    sql.with_ctes(
        *_QUERY_TEXTS,
        f"texts AS (SELECT item_id, {_VECTOR_TEXT} AS vector FROM asked GROUP BY item_id)",
        "SELECT item_id, coalesce(vector, '') AS vector FROM benchmark LEFT JOIN texts USING (item_id)",
    ),
)
def embed_query(spark, sf_dir):
    texts = views.table(spark, sf_dir, "benchmark")
    embedded = embedding.embed_texts(texts, "text", SETTINGS.embedding_dimensions)
    return embedded.select("item_id", _vector_text(F.col("embedding")).alias("vector"))


_ZIP_SOURCE = f"""zipped AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)"""


@register(
    "zip_embeddings",
    sql.with_ctes(
        _ZIP_SOURCE,
        """SELECT doc_id, CASE WHEN position % 2 = 0 THEN position * 10 ELSE position END AS chunk_index,
        content, length(content)::DOUBLE AS x FROM (
            SELECT doc_id, unnest(lines) AS content,
            generate_subscripts(lines, 1) - 1 AS position FROM zipped)""",
    ),
)
def zip_embeddings(spark, sf_dir):
    """Lines as chunks, every second one without an index of its own."""
    lines = F.split("text", "\n")
    chunks = F.transform(
        lines,
        lambda line, i: F.struct(
            F.when(i % 2 == 0, i * 10).alias("chunk_index"), line.alias("content")
        ),
    )
    made = F.transform(lines, lambda line: F.array(F.length(line).cast("float")))
    source = views.documents(spark, sf_dir).select(
        "doc_id", chunks.alias("chunks"), made.alias("embeddings")
    )
    zipped = embedding.zip_embeddings(source, "chunks", "embeddings")
    return zipped.select("doc_id", "chunk_index", "content", F.col("embedding")[0].cast("double").alias("x"))


# The vector table.


def _stored(spark, sf_dir):
    processed = batch.process_prefix(views.extracted(spark, sf_dir))
    return batch.stored_view(materialise(processed, "processed"))


@register(
    "store_chunks",
    sql.with_ctes(
        *sql.STORED,
        "SELECT id, source, filename, chunk_index, content FROM stored",
    ),
)
def store_chunks(spark, sf_dir):
    return _stored(spark, sf_dir).select("id", "source", "filename", "chunk_index", "content")


# Ids that a writer reserves before it dies.
_LOST = 100


@register(
    "append_log",
    sql.with_ctes(
        *sql.STORED,
        f"""SELECT row_number() OVER (ORDER BY chunk_index % 2, source, chunk_index)
            + CASE WHEN chunk_index % 2 = 1 THEN {_LOST} ELSE 0 END AS id,
        source, filename, chunk_index, content FROM stored""",
    ),
)
def append_log(spark, sf_dir):
    """Chunks of even and of odd index by two writers; a third one dies between the two."""
    processed = batch.process_prefix(views.extracted(spark, sf_dir))
    chunks = materialise(results.result_chunks(processed), "chunks")
    root = scratch_path(spark, "vectors")
    for odd in (0, 1):
        log = VectorLog(spark, root)
        log.append(chunks.where(F.col("chunk_index") % 2 == odd), SETTINGS)
        log.log.commit(lambda state: {"kind": "reserve", "first_id": state.next_id, "rows": _LOST})
    return log.table().select("id", "source", "filename", "chunk_index", "content")


@register(
    "store_index_fallback",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        f"""SELECT source, chunk_index, content FROM chunks JOIN processed USING (doc_id)
        WHERE error IS NULL AND {sql.is_pdf()}""",
    ),
)
def store_index_fallback(spark, sf_dir):
    """Results whose chunks carry no index: each takes its position."""
    processed = batch.process_prefix(views.extracted(spark, sf_dir))
    bare = F.transform(
        "text_chunks", lambda c: c.withField("chunk_index", F.lit(None).cast("int"))
    )
    rows = results.result_chunks(processed.withColumn("text_chunks", bare))
    return rows.select("source", "chunk_index", "content")


def _filled_table(spark, sf_dir, times: int = 1) -> Settings:
    """A new vector table holding the chunks of all PDFs, stored ``times`` times."""
    location = scratch_path(spark, "vectors")
    settings = Settings(vector_table="chunks_" + location.rsplit("-", 1)[-1])
    vectors.ensure_table(spark, settings, location)
    processed = materialise(batch.process_prefix(views.extracted(spark, sf_dir)), "processed")
    for _ in range(times):
        batch.embed_and_store(processed, settings)
    return settings


@register(
    "ensure_table",
    sql.with_ctes(
        *sql.STORED,
        """SELECT count(*) * 2 AS stored, max(id) * 2 AS last_id, count(DISTINCT source) AS documents
        FROM stored""",
    ),
)
def ensure_table(spark, sf_dir):
    """Created twice, filled twice: the second creation changes nothing, appends add up."""
    settings = _filled_table(spark, sf_dir, times=2)
    vectors.ensure_table(spark, settings)
    return spark.table(settings.vector_table).agg(
        F.count("*").alias("stored"),
        F.max("id").alias("last_id"),
        F.countDistinct("source").alias("documents"),
    )


@register(
    "store_one",
    sql.with_ctes(*sql.STORED, "SELECT count(*) + 1 AS stored, max(id) + 1 AS new_id FROM stored"),
)
def store_one(spark, sf_dir):
    """One chunk appended to a filled table."""
    settings = _filled_table(spark, sf_dir)
    vector = embedding.embed_query(spark, "one more", settings.embedding_dimensions)
    new_id = vectors.store_chunk(
        spark, "gs://one/more.pdf", "more.pdf", 0, "one more", vector, settings=settings
    )
    return spark.table(settings.vector_table).agg(
        F.count("*").alias("stored"), F.lit(new_id).cast("bigint").alias("new_id")
    )


@register(
    "process_embed_store",
    sql.with_ctes(
        *sql.STORED,
        *sql.weight_ctes("stored", "id", "content", SETTINGS.embedding_dimensions, "weights"),
        """nonzero AS (SELECT id, count(*) AS words, max(n) AS top_count FROM weights_counts GROUP BY id)""",
        f"""SELECT s.id, s.source, s.chunk_index, md5(s.content) AS content_md5,
        {SETTINGS.embedding_dimensions}::BIGINT AS dims, coalesce(n.words, 0) AS nonzero, d.language
        FROM stored s LEFT JOIN nonzero n USING (id) JOIN described d ON d.source = s.source""",
    ),
)
def process_embed_store(spark, sf_dir):
    """From extracted documents to the stored table, end to end."""
    settings = _filled_table(spark, sf_dir)
    nonzero = F.size(F.filter("embedding", lambda x: x != 0))
    return spark.table(settings.vector_table).select(
        "id",
        "source",
        "chunk_index",
        F.md5(F.encode("content", "UTF-8")).alias("content_md5"),
        F.size("embedding").alias("dims"),
        nonzero.alias("nonzero"),
        F.get_json_object("metadata", "$.language").alias("language"),
    )


# Search.


def _first_vector(spark, sf_dir) -> list[float]:
    return list(views.vectors(spark, sf_dir).orderBy("id").limit(1).first().embedding)


_ASKED_VECTOR = "asked AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)"
_VECTORS = """vectors AS (
    SELECT vec_id AS id, 'gs://vectors/label_' || label AS source, 'label_' || label AS filename,
        vec_id AS chunk_index, repeat('vector ' || vec_id || chr(10), (1 + vec_id % 40)::INT) AS content,
        '{}' AS metadata, embedding, label FROM embeddings)"""
_COSINE = "list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[])"
_HITS = f"""hits AS (
    SELECT *, {_COSINE} AS similarity FROM vectors, asked
    ORDER BY round(similarity, 9) DESC, id LIMIT {{k}})"""


@register(
    "cosine_similarity",
    sql.with_ctes(
        _ASKED_VECTOR,
        f"SELECT vec_id AS id, round({_COSINE}, 6) AS similarity FROM embeddings, asked",
    ),
)
def similarity(spark, sf_dir):
    query = F.lit(_first_vector(spark, sf_dir))
    value = F.round(cosine_similarity(F.col("embedding"), query), 6)
    return views.vectors(spark, sf_dir).select("id", value.alias("similarity"))


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("similarity", F.round("similarity", 6))


@register(
    "similarity_search",
    sql.with_ctes(
        _ASKED_VECTOR,
        _VECTORS,
        _HITS.format(k=10),
        """SELECT id, source, filename, chunk_index, content, metadata,
        round(similarity, 6) AS similarity FROM hits""",
    ),
)
def similarity_search(spark, sf_dir):
    table = views.vectors(spark, sf_dir)
    return _rounded(search.similarity_search(table, _first_vector(spark, sf_dir)))


@register(
    "search_by_vector",
    sql.with_ctes(
        _ASKED_VECTOR, _VECTORS, _HITS.format(k=25), "SELECT id, round(similarity, 6) AS similarity FROM hits"
    ),
)
def search_by_vector(spark, sf_dir):
    """The query vector given as a JSON list."""
    json = views.vectors(spark, sf_dir).orderBy("id").limit(1).select(F.to_json("embedding")).first()[0]
    query = search.vector_from_json(json)
    return _rounded(search.similarity_search(views.vectors(spark, sf_dir), query, 25, ["id"]))


_FIRST_TEXT = "first_text AS (SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 1)"


def _text_search(queries: str) -> list[str]:
    """Scores of all stored chunks for the texts of ``queries(item_id, text)``."""
    dims = SETTINGS.embedding_dimensions
    return [
        *sql.STORED,
        *sql.weight_ctes("stored", "id", "content", dims, "weights"),
        *sql.weight_ctes(queries, "item_id", "text", dims, "asked"),
        """norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY id)""",
        """asked_norms AS (SELECT item_id, sqrt(sum(weight * weight)) AS norm FROM asked GROUP BY item_id)""",
        """dots AS (SELECT a.item_id, w.id, sum(a.weight * w.weight) AS dot
            FROM asked a JOIN weights w USING (bucket) GROUP BY ALL)""",
        """scores AS (SELECT an.item_id, n.id, coalesce(dot, 0) / (n.norm * an.norm) AS similarity
            FROM norms n CROSS JOIN asked_norms an LEFT JOIN dots d ON d.id = n.id AND d.item_id = an.item_id)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id
            ORDER BY round(similarity, 9) DESC, id) AS rank FROM scores)""",
    ]


@register(
    "search_by_text",
    sql.with_ctes(
        _FIRST_TEXT,
        *_text_search("first_text"),
        """SELECT id, source, filename, chunk_index, content, round(similarity, 6) AS similarity
        FROM ranked JOIN stored USING (id) WHERE rank <= 10""",
    ),
)
def search_by_text(spark, sf_dir):
    text = views.table(spark, sf_dir, "benchmark").orderBy("item_id").limit(1).first().text
    query = embedding.embed_query(spark, text, SETTINGS.embedding_dimensions)
    hits = search.similarity_search(_stored(spark, sf_dir), query)
    return _rounded(hits).drop("metadata")


@register(
    "search_by_text_batch",
    sql.with_ctes(
        *_text_search("benchmark"),
        """SELECT item_id AS query_id, rank, id, round(similarity, 6) AS similarity
        FROM ranked WHERE rank <= 5""",
    ),
)
def search_by_text_batch(spark, sf_dir):
    """All given query texts at once over the stored chunks."""
    texts = views.table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_id")
    queries = embedding.embed_texts(texts, "text", SETTINGS.embedding_dimensions)
    hits = search.search_many(_stored(spark, sf_dir), queries.select("query_id", "embedding"), 5)
    return _rounded(hits)


# All ids divisible by 50 as queries, against all vectors.
_EVERY_FIFTIETH = sql.with_ctes(
    _VECTORS,
    "queries AS (SELECT id AS query_id, embedding AS q FROM vectors WHERE id % 50 = 0)",
    f"""ranked AS (SELECT query_id, id, similarity, row_number() OVER (
        PARTITION BY query_id ORDER BY round(similarity, 9) DESC, id) AS rank
    FROM (SELECT query_id, id, {_COSINE} AS similarity FROM queries, vectors))""",
    "SELECT query_id, rank, id, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 10",
)


def _every_fiftieth(table):
    return table.where(F.col("id") % 50 == 0).select(F.col("id").alias("query_id"), "embedding")


@register("similarity_search_batch", _EVERY_FIFTIETH)
def similarity_search_batch(spark, sf_dir):
    table = views.vectors(spark, sf_dir)
    return _rounded(search.search_many(table, _every_fiftieth(table)))


@register("similarity_search_pivots", _EVERY_FIFTIETH)
def similarity_search_pivots(spark, sf_dir):
    """The same hits; cells and blocks that cannot hold one are left out."""
    table = views.vectors(spark, sf_dir)
    settings = pivots.Pivots(per_cell=100, block=32)
    return _rounded(pivots.search_by_pivots(table, _every_fiftieth(table), settings=settings))


ANN_LISTS, ANN_PROBES = 32, 12


@register(
    "ann_search",
    sql.with_ctes(
        _ASKED_VECTOR,
        _VECTORS,
        f"""centres AS (SELECT embedding AS centre, md5(vec_id::VARCHAR) AS hash FROM embeddings
            ORDER BY hash, vec_id LIMIT {ANN_LISTS})""",
        """placed AS (SELECT id, arg_max(hash, list_cosine_similarity(embedding::DOUBLE[], centre::DOUBLE[])) AS list
            FROM vectors, centres GROUP BY id)""",
        f"""probed AS (SELECT hash FROM centres, asked
            ORDER BY list_cosine_similarity(centre::DOUBLE[], q::DOUBLE[]) DESC LIMIT {ANN_PROBES})""",
        f"""hits AS (SELECT v.*, {_COSINE} AS similarity FROM vectors v JOIN placed USING (id), asked
            WHERE list IN (SELECT hash FROM probed) ORDER BY round(similarity, 9) DESC, id LIMIT 10)""",
        """SELECT id, source, filename, chunk_index, content, metadata,
        round(similarity, 6) AS similarity FROM hits""",
    ),
)
def ann_search(spark, sf_dir):
    """Approximate, but by a rule: which lists are read follows from ids and vectors."""
    table = views.vectors(spark, sf_dir)
    path = scratch_path(spark, "ann")
    ann.build_index(table, path, ANN_LISTS)
    query = _first_vector(spark, sf_dir)
    return _rounded(ann.ann_search(table, path, query, probes=ANN_PROBES))


# What the search over codes must reach: its hits depend on trained codebooks, so SQL only
# says what has to hold for them.
ANN_RECALL, ANN_SHARE = 0.9, 0.4


@register(
    "ann_recall",
    sql.with_ctes(
        _VECTORS,
        "queries AS (SELECT id AS query_id, embedding AS q FROM vectors WHERE id % 50 = 0)",
        f"""centres AS (SELECT embedding AS centre, md5(vec_id::VARCHAR) AS hash FROM embeddings
            ORDER BY hash, vec_id LIMIT {ANN_LISTS})""",
        """placed AS (SELECT id, arg_max(hash, list_cosine_similarity(embedding::DOUBLE[], centre::DOUBLE[])) AS list
            FROM vectors, centres GROUP BY id)""",
        f"""probed AS (SELECT query_id, hash FROM queries, centres QUALIFY row_number() OVER (PARTITION BY query_id
            ORDER BY list_cosine_similarity(centre::DOUBLE[], q::DOUBLE[]) DESC) <= {ANN_PROBES})""",
        f"scored AS (SELECT query_id, id, {_COSINE} AS similarity FROM queries, vectors)",
        """exact AS (SELECT query_id, id FROM scored QUALIFY row_number() OVER (
            PARTITION BY query_id ORDER BY round(similarity, 9) DESC, id) <= 10)""",
        """found AS (SELECT s.query_id, s.id, 1 AS hit FROM scored s JOIN placed p USING (id)
            JOIN probed b ON b.query_id = s.query_id AND b.hash = p.list QUALIFY row_number() OVER (
            PARTITION BY s.query_id ORDER BY round(similarity, 9) DESC, s.id) <= 10)""",
        """SELECT count(DISTINCT query_id) AS queries, round(count(hit) / count(*), 6) AS recall,
        true AS found_enough, true AS read_few FROM exact LEFT JOIN found USING (query_id, id)""",
    ),
)
def ann_recall(spark, sf_dir):
    """All ids divisible by 50 against all vectors: the recall of the lists at 10.

    Beside it, whether the codes find enough, and how many vectors they compare for that.
    """
    table = views.vectors(spark, sf_dir)
    lists, codes = scratch_path(spark, "ann"), scratch_path(spark, "codes")
    ann.build_index(table, lists, ANN_LISTS)
    quantised.build_quantised_index(table, codes)
    queries = _every_fiftieth(table)
    exact = materialise(search.search_many(table, queries), "exact")
    by_lists = ann.recall(ann.ann_search_many(spark, lists, queries, probes=ANN_PROBES), exact)
    by_codes = ann.recall(quantised.quantised_search_many(spark, codes, queries), exact)
    share = F.lit(quantised.load_depth(spark, codes).compared) / F.lit(table.count())
    told = by_codes.select((F.col("recall") >= ANN_RECALL).alias("found_enough"))
    # One row each.
    return by_lists.crossJoin(told).select(
        "queries", F.round("recall", 6).alias("recall"), "found_enough", (share <= ANN_SHARE).alias("read_few")
    )


@register(
    "search_report",
    sql.with_ctes(
        _ASKED_VECTOR,
        _VECTORS,
        _HITS.format(k=10),
        """SELECT row_number() OVER (ORDER BY round(similarity, 9) DESC, id) AS rank,
        format('{:.3f}', similarity) AS score, filename || '#chunk-' || chunk_index AS chunk, source,
        replace(substring(content, 1, 200), chr(10), ' ')
            || CASE WHEN length(content) > 200 THEN '...' ELSE '' END AS preview FROM hits""",
    ),
)
def search_report(spark, sf_dir):
    table = views.vectors(spark, sf_dir)
    return search.report(search.similarity_search(table, _first_vector(spark, sf_dir)))


# Bookkeeping.

_PENDING = [
    sql.FILES,
    sql.PROCESSED_INDEX,
    f"""pending AS (SELECT * FROM files WHERE {sql.is_pdf()}
    AND NOT starts_with(name, '_pipeline/') AND uri NOT IN (SELECT uri FROM processed_index))""",
]
MAX_FILES = SETTINGS.max_files_per_run


def _pending(spark, sf_dir):
    return runs.pending_files(views.files(spark, sf_dir), views.processed_index(spark, sf_dir))


@register("pending_files", sql.with_ctes(*_PENDING, "SELECT uri, name FROM pending"))
def pending_files(spark, sf_dir):
    return _pending(spark, sf_dir).select("uri", "name")


@register(
    "pending_capped",
    sql.with_ctes(*_PENDING, f"SELECT uri, name FROM pending ORDER BY name LIMIT {MAX_FILES}"),
)
def pending_capped(spark, sf_dir):
    return runs.capped(_pending(spark, sf_dir), MAX_FILES).select("uri", "name")


@register(
    "discovery_counts",
    sql.with_ctes(
        *_PENDING, f"SELECT count(*) AS pending, least(count(*), {MAX_FILES}) AS taken FROM pending"
    ),
)
def discovery_counts(spark, sf_dir):
    return runs.discovery_counts(_pending(spark, sf_dir), MAX_FILES)


@register(
    "process_batch_isolated",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        f"SELECT {sql.RECORD_COLUMNS} FROM processed WHERE error IS NULL AND {sql.is_pdf()}",
    ),
)
def process_batch_isolated(spark, sf_dir):
    return _flat_records(batch.process_prefix(views.extracted(spark, sf_dir)))


@register(
    "batch_paths",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        f"""SELECT source, 'gs://{SETTINGS.output_bucket}/' || output_path AS output_uri
        FROM processed WHERE error IS NULL AND {sql.is_pdf()} AND starts_with(name, '{PREFIX}')""",
    ),
)
def batch_paths(spark, sf_dir):
    selected = batch.select_pdfs(views.extracted(spark, sf_dir), PREFIX)
    return batch.output_uris(batch.result_files(selected))


# Every pending file, and one listed file per web page, which has no document and so fails.
_OUTCOMES = [
    *sql.PROCESSED_CHUNKS,
    *_PENDING,
    f"""outcomes AS (
    SELECT CASE WHEN problem IS NULL THEN 'success' ELSE 'failed' END AS status, gcs_uri,
        CASE WHEN problem IS NULL THEN output_path END AS output_path,
        CASE WHEN problem IS NULL THEN text_chunk_count END AS chunk_count,
        CASE WHEN problem IS NULL THEN filename ELSE name END AS filename, problem AS error
    FROM (SELECT f.uri AS gcs_uri, f.name, p.filename, p.output_path, p.text_chunk_count,
        CASE WHEN p.source IS NULL THEN '{docs.NOT_EXTRACTED}' ELSE p.error END AS problem
        FROM (SELECT uri, name FROM pending UNION ALL
            SELECT 'gs://{views.BUCKET}/pages/' || page_id || '.pdf', 'pages/' || page_id || '.pdf' FROM pages) f
        LEFT JOIN processed p ON p.source = f.uri))""",
]


def _outcomes(spark, sf_dir):
    extracted = views.extracted(spark, sf_dir).drop("doc_id")
    name = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".pdf"))
    pages = views.table(spark, sf_dir, "pages").select(
        naming.object_uri(views.BUCKET, name).alias("uri"), name.alias("name")
    )
    files = _pending(spark, sf_dir).select("uri", "name").unionByName(pages)
    documents = runs.attach_extracted(files, extracted)
    return runs.outcomes(results.with_output_path(docs.process(documents)))


# Chunks of such a length are too much for the model of the scheduled run.
_BAD_LENGTH = "% 97 = 5"


def _fussy_model():
    def embed(texts):
        for text in texts:
            if len(text) % 97 == 5:
                raise ValueError(f"cannot embed {len(text)} characters")
        return [[float(len(text)), 1.0] for text in texts]

    return embed


@register(
    "scheduled_run",
    sql.with_ctes(
        *sql.PROCESSED_CHUNKS,
        *_PENDING,
        f"""refused AS (SELECT doc_id, 'cannot embed ' || arg_min(length(content), chunk_index) || ' characters' AS error
            FROM chunks WHERE length(content) {_BAD_LENGTH} GROUP BY doc_id)""",
        """told AS (SELECT p.*, coalesce(p.error, r.error) AS problem
            FROM processed p LEFT JOIN refused r USING (doc_id) WHERE source IN (SELECT uri FROM pending))""",
        """SELECT CASE WHEN problem IS NULL THEN 'success' ELSE 'failed' END AS status, source AS gcs_uri,
            CASE WHEN problem IS NULL THEN output_path END AS output_path,
            CASE WHEN problem IS NULL THEN filename ELSE name END AS filename, problem AS error,
            problem IS NULL AS in_index, problem IS NOT NULL AS dead,
            CASE WHEN problem IS NULL THEN text_chunk_count ELSE 0 END AS stored,
            error IS NULL AND name IN (SELECT max(name) FROM told WHERE error IS NULL GROUP BY output_path) AS written
        FROM told""",
    ),
)
def scheduled_run(spark, sf_dir):
    """A whole run with a model that refuses some chunks, and what it left in every place."""
    root = scratch_path(spark, "run")
    places = [f"{root}/{name}" for name in ("index", "results", "dead")]
    index.add_to_index(views.processed_index(spark, sf_dir), places[0])
    settings = dataclasses.replace(
        SETTINGS, max_files_per_run=None, embedding_dimensions=2, vector_log=f"{root}/vectors"
    )
    embed = functools.partial(embedding.embed_or_fail, text="content", load_model=_fussy_model)
    listing, extracted = views.files(spark, sf_dir), views.extracted(spark, sf_dir).drop("doc_id")
    told = scheduled.run_scheduled(listing, extracted, *places, settings, "run", embed=embed, fail=False)
    done = index.read_index(spark, places[0])
    dead = runs.current_dead_letters(spark, places[2], done).select(
        F.get_json_object("record", "$.gcs_uri").alias("gcs_uri"), F.lit(True).alias("dead")
    )
    stored = vectors.stored_table(spark, settings).groupBy(F.col("source").alias("gcs_uri"))
    written = results.current_results(spark, places[1]).select(
        F.col("source").alias("gcs_uri"), F.lit(True).alias("written")
    )
    joined = told.join(done.select(F.col("uri").alias("gcs_uri"), F.lit(True).alias("in_index")), "gcs_uri", "left")
    joined = joined.join(dead, "gcs_uri", "left").join(written, "gcs_uri", "left")
    joined = joined.join(stored.agg(F.count("*").alias("stored")), "gcs_uri", "left")
    marks = [F.coalesce(c, F.lit(False)).alias(c) for c in ("in_index", "dead", "written")]
    number = F.coalesce("stored", F.lit(0)).alias("stored")
    return joined.select("status", "gcs_uri", "output_path", "filename", "error", *marks, number)


@register(
    "process_outcomes",
    sql.with_ctes(
        *_OUTCOMES, "SELECT * REPLACE (coalesce(chunk_count, -1) AS chunk_count) FROM outcomes"
    ),
)
def process_outcomes(spark, sf_dir):
    """A failure has no chunk count; here it shows as -1."""
    count = F.coalesce("chunk_count", F.lit(-1))
    return _outcomes(spark, sf_dir).withColumn("chunk_count", count)


@register(
    "split_outcomes",
    sql.with_ctes(
        *_OUTCOMES,
        """SELECT 'success' AS side, gcs_uri FROM outcomes WHERE status = 'success'
        UNION ALL SELECT 'failure', gcs_uri FROM outcomes WHERE status = 'failed'""",
    ),
)
def split_outcomes(spark, sf_dir):
    outcomes = materialise(_outcomes(spark, sf_dir), "outcomes")
    good = runs.successes(outcomes).select(F.lit("success").alias("side"), "gcs_uri")
    return good.union(runs.failures(outcomes).select(F.lit("failure").alias("side"), "gcs_uri"))


@register(
    "dead_letter",
    sql.with_ctes(
        *_OUTCOMES,
        """SELECT 'failed/' || filename || '.error.json' AS path, '{"status":"failed","gcs_uri":"'
        || gcs_uri || '","filename":"' || filename || '","error":"' || error || '"}' AS record
        FROM outcomes WHERE status = 'failed'""",
    ),
)
def dead_letter(spark, sf_dir):
    return runs.dead_letters(_outcomes(spark, sf_dir))


@register(
    "run_summary",
    sql.with_ctes(
        *_OUTCOMES,
        """SELECT count(*) AS total, count(*) FILTER (status = 'success') AS passed,
        count(*) FILTER (status = 'failed') AS failed FROM outcomes""",
    ),
)
def run_summary(spark, sf_dir):
    return runs.run_summary(_outcomes(spark, sf_dir))


_UNION = """SELECT uri FROM processed_index
    UNION SELECT gcs_uri FROM outcomes WHERE status = 'success'"""


@register("index_union", sql.with_ctes(*_OUTCOMES, _UNION))
def index_union(spark, sf_dir):
    done = runs.successes(_outcomes(spark, sf_dir)).selectExpr("gcs_uri AS uri")
    return index.union_index(views.processed_index(spark, sf_dir), done)


@register(
    "write_index",
    sql.with_ctes(
        sql.FILES,
        sql.PROCESSED_INDEX,
        "SELECT row_number() OVER (ORDER BY uri) AS position, uri FROM processed_index",
    ),
)
def write_index(spark, sf_dir):
    """A compacted index, read back in file order: sorted and without repetitions."""
    path = scratch_path(spark, "index")
    entries = views.processed_index(spark, sf_dir)
    index.write_snapshot(entries.union(entries), path)
    file = F.col("_metadata.file_path")
    row = F.col("_metadata.row_index")
    rows = spark.read.parquet(path).select("uri", file.alias("file"), row.alias("row"))
    return with_dense_ids(rows, ["file", "row"]).select(F.col("id").alias("position"), "uri")


@register(
    "read_index",
    sql.with_ctes(sql.FILES, sql.PROCESSED_INDEX, "SELECT uri FROM processed_index"),
)
def read_index(spark, sf_dir):
    """Appended to twice, read as a set; a missing index reads as empty."""
    path = scratch_path(spark, "index")
    for _ in range(2):
        index.add_to_index(views.processed_index(spark, sf_dir), path)
    missing = index.read_index(spark, scratch_path(spark, "no-index"))
    return index.read_index(spark, path).union(missing)


# Notifications.


def _messages(spark, sf_dir):
    listing = spread(views.files(spark, sf_dir), "doc_id")
    return views.notifications(views.events(spark, sf_dir), listing)


@register(
    "notify_unwrap",
    sql.with_ctes(
        *sql.NOTIFICATIONS,
        "SELECT event_id, data, bucket_id, object_id, kind AS event_type FROM unwrapped",
    ),
)
def notify_unwrap(spark, sf_dir):
    return notes.unwrap(_messages(spark, sf_dir)).select(
        "event_id",
        "data",
        F.col("attributes")["bucketId"].alias("bucket_id"),
        F.col("attributes")["objectId"].alias("object_id"),
        F.col("attributes")["eventType"].alias("event_type"),
    )


@register(
    "notify_decode",
    sql.with_ctes(
        *sql.NOTIFICATIONS,
        "SELECT event_id, body_bucket AS bucket, body_name AS name FROM decoded",
    ),
)
def notify_decode(spark, sf_dir):
    decoded = notes.decode(notes.unwrap(_messages(spark, sf_dir)))
    return decoded.select("event_id", "body.bucket", "body.name")


@register(
    "notify_route",
    sql.with_ctes(*sql.NOTIFICATIONS, "SELECT event_id, bucket, name, event_type FROM routed"),
)
def notify_route(spark, sf_dir):
    return notes.route(notes.decode(notes.unwrap(_messages(spark, sf_dir))))


@register("notify_filter", sql.with_ctes(*sql.NOTIFICATIONS, "SELECT event_id, uri FROM accepted"))
def notify_filter(spark, sf_dir):
    return notes.accepted(_messages(spark, sf_dir)).select("event_id", "uri")


@register(
    "notify_stream",
    sql.with_ctes(
        *sql.NOTIFICATIONS,
        *sql.PROCESSED_CHUNKS,
        """announced AS (SELECT * FROM processed WHERE error IS NULL
            AND source IN (SELECT uri FROM accepted))""",
        """kept AS (SELECT max(name) AS name FROM announced GROUP BY output_path)""",
        f"SELECT {sql.RECORD_COLUMNS} FROM announced WHERE name IN (SELECT name FROM kept)",
    ),
)
def notify_stream(spark, sf_dir):
    """The notifications as a stream, run until all of them are handled."""
    static = views.events(spark, sf_dir)
    arriving = (
        spark.readStream.schema(static.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    path = scratch_path(spark, "stream")
    query = notes.start_processing(
        views.notifications(arriving, views.files(spark, sf_dir)),
        views.extracted(spark, sf_dir).drop("doc_id"),
        f"{path}/results",
        f"{path}/checkpoint",
        availableNow=True,
    )
    query.awaitTermination()
    return _flat_records(results.current_results(spark, f"{path}/results"))


@register(
    "notify_retries",
    sql.with_ctes(
        *sql.NOTIFICATIONS,
        *sql.PROCESSED_CHUNKS,
        """SELECT 'failed/' || name || '.error.json' AS path, source AS uri, name, 2 AS attempts, error
        FROM processed WHERE error IS NOT NULL AND source IN (SELECT uri FROM accepted)""",
    ),
)
def notify_retries(spark, sf_dir):
    """The notifications as a stream that tries failed objects twice; its dead letters."""
    static = views.events(spark, sf_dir)
    arriving = (
        spark.readStream.schema(static.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    path = scratch_path(spark, "stream")
    query = retries.start_with_retries(
        views.notifications(arriving, views.files(spark, sf_dir)),
        lambda session: views.extracted(session, sf_dir).drop("doc_id"),
        f"{path}/results",
        f"{path}/checkpoint",
        retries=retries.Retries(attempts=2, first=0.1),
        processingTime="1 second",
    )
    try:
        # Every failure is followed by one more attempt, and that by a success or a dead letter.
        while not query.recentProgress or retries.open_objects(spark, f"{path}/results"):
            query.awaitTermination(1)
    finally:
        query.stop()
    return retries.dead_letters(spark, f"{path}/results")
