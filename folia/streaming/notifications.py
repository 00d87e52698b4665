"""Storage notifications: decode, route, filter, and process what they announce.

All steps work on batch and streaming DataFrames alike.
"""

from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from folia.config import Settings
from folia.functions.binding import let
from folia.functions.naming import is_pdf, object_uri
from folia.operators.documents import process, succeeded
from folia.operators.runs import attach_extracted
from folia.schemas import NOTIFICATION
from folia.session import materialise
from folia.sources.results import keep_path_winners, with_output_path, write_results

# Fixed value: the only event type that leads to processing.
CREATED = "OBJECT_FINALIZE"
# The fields of the body that are used.
_BODY = ("bucket", "name")


def notification_stream(spark: SparkSession, path: str) -> DataFrame:
    """Messages arriving as JSON files; any source with the same columns will do."""
    return spark.readStream.schema(NOTIFICATION).json(path)


def unwrap(messages: DataFrame) -> DataFrame:
    """``data`` and ``attributes`` of bare and of wrapped messages."""
    wrapped = F.col("message").isNotNull()
    return messages.select(
        *(name for name in messages.columns if name not in ("data", "attributes", "message")),
        F.when(wrapped, F.col("message.data")).otherwise(F.col("data")).alias("data"),
        F.when(wrapped, F.col("message.attributes"))
        .otherwise(F.col("attributes"))
        .alias("attributes"),
    )


def decode(messages: DataFrame) -> DataFrame:
    """Add ``body``; messages that are empty or cannot be decoded are dropped.

    The body is exploded from an array of one or none: that decodes each message once,
    whereas a filter on the decoded text would be pushed down and decode it again.
    """

    def bodies(text: Column) -> Column:
        # The parser stops at the end of a value. As the element of a list, text after the
        # value shows up as bad JSON or as a second element. Values may be of any kind, but
        # only objects have fields; of repeated keys the last one counts.
        fields = F.from_json(text, ", ".join(f"{key} STRING" for key in _BODY))
        is_object = text.rlike(r"\A\s*\{")
        return let(
            F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"),
            lambda values: F.when(
                F.size(values) == 1,
                F.array(F.when(is_object, fields)),
            ),
        )

    kept = [name for name in messages.columns if name != "data"]
    return messages.select(*kept, F.explode(let(_decoded(F.col("data")), bodies)).alias("body"))


def _decoded(data: Column) -> Column:
    """Base64 to text, or NULL. Characters outside of the alphabet are skipped."""
    padded = r"\A[A-Za-z0-9+/]*={0,2}\z"
    return let(
        F.regexp_replace(data, r"[^A-Za-z0-9+/=]", ""),
        lambda encoded: F.when(
            encoded.rlike(padded) & (F.length(encoded) % 4 == 0) & (encoded != ""),
            F.try_validate_utf8(F.unbase64(encoded).cast("string")),
        ),
    )


def route(messages: DataFrame) -> DataFrame:
    """Add ``bucket``, ``name`` and ``event_type``; drop messages without bucket or name.

    Bucket and name come from the attributes or else from the body, the event type
    from the attributes only.
    """

    def attribute(key: str) -> Column:
        return F.nullif(F.col("attributes")[key], F.lit(""))

    def field(name: str) -> Column:
        return F.nullif(F.col("body")[name], F.lit(""))

    routed = messages.select(
        *(name for name in messages.columns if name not in ("attributes", "body")),
        F.coalesce(attribute("bucketId"), field("bucket")).alias("bucket"),
        F.coalesce(attribute("objectId"), field("name")).alias("name"),
        F.coalesce(attribute("eventType"), F.lit("")).alias("event_type"),
    )
    return routed.where(F.col("bucket").isNotNull() & F.col("name").isNotNull())


def created_pdfs(routed: DataFrame) -> DataFrame:
    """Newly created PDFs, with their ``uri``."""
    wanted = routed.where((F.col("event_type") == CREATED) & is_pdf(F.col("name")))
    return wanted.withColumn("uri", object_uri(F.col("bucket"), F.col("name")))


def accepted(messages: DataFrame) -> DataFrame:
    """All steps from a raw message to the objects to process."""
    return created_pdfs(route(decode(unwrap(messages))))


class ObjectsFailed(RuntimeError):
    """Objects of a micro-batch failed; ``failures`` has them, with their errors."""

    def __init__(self, message: str, failures: DataFrame):
        super().__init__(message)
        self.failures = failures


def _failed_path(results_path: str, query: str, batch_id: int) -> str:
    return f"{results_path.rstrip('/')}_failed/query={query}/batch={batch_id}"


def failed_objects(spark: SparkSession, results_path: str, query: str, batch_id: int) -> DataFrame:
    """``uri, name, error`` of the objects that had failed after a micro-batch."""
    schema = "uri STRING, name STRING, error STRING"
    try:
        return spark.read.schema(schema).parquet(_failed_path(results_path, query, batch_id))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def process_batch(
    objects: DataFrame,
    batch_id: int,
    extracted: DataFrame,
    results_path: str,
    settings: Settings = Settings(),
    raise_failures: bool = False,
    query: str = "batch",
) -> None:
    """Process the objects of a micro-batch and write their results.

    However often an object is announced, it is processed once per batch. Results are
    keyed by the streaming query and the batch, so a repeated batch replaces its own
    results and no other query's. Objects that fail are written beside the results and
    tried again with the next batch; with ``raise_failures`` the batch fails instead.
    """
    spark = objects.sparkSession
    announced = objects.select("uri", "name")
    if batch_id > 0:
        again = failed_objects(spark, results_path, query, batch_id - 1).select("uri", "name")
        announced = announced.unionByName(again)
    documents = attach_extracted(announced.dropDuplicates(["uri"]), extracted)
    processed = materialise(with_output_path(process(documents, settings)), "processed")
    good = succeeded(processed)
    write_results(keep_path_winners(good, good), results_path, f"{query}-{batch_id:012d}")
    failed = processed.where(F.col("error").isNotNull())
    failed = failed.select(F.col("source").alias("uri"), "name", "error")
    if raise_failures:
        number = failed.count()
        if number:
            raise ObjectsFailed(f"{number} object(s) failed in batch {batch_id}", failed)
    failed.write.mode("overwrite").parquet(_failed_path(results_path, query, batch_id))


def start_processing(
    messages: DataFrame,
    extracted: DataFrame,
    results_path: str,
    checkpoint_path: str,
    settings: Settings = Settings(),
    raise_failures: bool = False,
    **trigger,
) -> StreamingQuery:
    """Start the query; give a trigger such as ``availableNow=True``."""
    started = Event()
    ids: list[str] = []

    def handle(objects: DataFrame, batch_id: int) -> None:
        # The query's id stays the same from restart to restart, and differs between queries.
        started.wait()
        process_batch(objects, batch_id, extracted, results_path, settings, raise_failures, ids[0])

    writer = accepted(messages).writeStream.foreachBatch(handle)
    if trigger:
        writer = writer.trigger(**trigger)
    query = writer.option("checkpointLocation", checkpoint_path).start()
    ids.append(query.id)
    started.set()
    return query
