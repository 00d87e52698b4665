"""Processing announced objects, with further attempts for those that fail.

Every object has a state: how often it was tried, and whether it waits. An announcement makes an
attempt at once. What fails in a micro-batch is written beside the results, and the same
query reads it back as a second source: the object then waits, longer each time, and a timer
makes the next attempt without any new message. After the last one it is a dead letter. Objects that
have not failed are forgotten after a while, so the state holds what is under way.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from threading import Event

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folia.config import Settings
from folia.functions.naming import dead_letter_path
from folia.operators.documents import process, succeeded
from folia.operators.runs import attach_extracted
from folia.session import materialise
from folia.sources.results import keep_path_winners, read_results, with_output_path, write_results
from folia.streaming.notifications import accepted

_EVENT = "uri string, name string, error string"
_STATE = "attempts int, name string, waiting boolean"
_STEP = "uri string, name string, attempts int, dead boolean, error string"


@dataclass(frozen=True)
class Retries:
    """``attempts`` in all; waits of ``first`` seconds, ``factor`` times as long each, at most ``longest``.

    ``settled``: seconds after which an object that has not failed is forgotten. It must be longer
    than a micro-batch takes.
    """

    # Three more attempts, after five minutes up to an hour.
    attempts: int = 4
    first: float = 300.0
    factor: float = 2.0
    longest: float = 3600.0
    settled: float = 7200.0

    def wait(self, attempts: int) -> float:
        """Seconds to wait after so many attempts."""
        return min(self.first * self.factor ** (attempts - 1), self.longest)


def step(
    key: tuple, events: Iterator[pd.DataFrame], state: GroupState, retries: Retries
) -> Iterator[pd.DataFrame]:
    """What is to be done with one object: an attempt, a dead letter, or nothing."""
    (uri,) = key

    def row(name: str, attempts: int, error: str | None = None) -> pd.DataFrame:
        return pd.DataFrame([(uri, name, attempts, error is not None, error)], columns=["uri", "name", "attempts", "dead", "error"])

    def attempt(name: str, number: int) -> pd.DataFrame:
        state.update((number, name, False))
        state.setTimeoutDuration(int(retries.settled * 1000))
        return row(name, number)

    if state.hasTimedOut:
        attempts, name, waiting = state.get
        if waiting:
            yield attempt(name, attempts + 1)
        else:
            state.remove()
        return
    announced, error = None, None
    for frame in events:
        for name, failure in zip(frame["name"], frame["error"]):
            if failure is None:
                announced = name
            else:
                error = failure
    if announced is not None:
        # A new version of the object: its attempts start anew.
        yield attempt(announced, 1)
    elif error is not None and state.exists:
        attempts, name, _ = state.get
        if attempts >= retries.attempts:
            state.remove()
            yield row(name, attempts, error)
        else:
            state.update((attempts, name, True))
            state.setTimeoutDuration(max(1, int(retries.wait(attempts) * 1000)))


def _folder(results_path: str, kind: str) -> str:
    return f"{results_path.rstrip('/')}_{kind}"


def dead_letters(spark: SparkSession, results_path: str) -> DataFrame:
    """``path, uri, name, attempts, error`` of the objects that failed for the last time."""
    schema = "path string, uri string, name string, attempts int, error string"
    try:
        found = spark.read.schema(schema).json(_folder(results_path, "dead"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found.select("path", "uri", "name", "attempts", "error")


def open_objects(spark: SparkSession, results_path: str) -> int:
    """How many objects have failed and neither succeeded nor become dead letters since."""
    failures = spark.read.schema(_EVENT).option("recursiveFileLookup", "true").json(_folder(results_path, "retries"))
    failed = failures.select("uri").distinct()
    done = dead_letters(spark, results_path).select("uri")
    written = read_results(spark, results_path).select(F.col("source").alias("uri"))
    return failed.join(done.union(written), "uri", "left_anti").count()


def process_steps(
    steps: DataFrame,
    batch_id: int,
    extracted: DataFrame,
    results_path: str,
    settings: Settings,
    query: str,
) -> None:
    """Make the attempts of a micro-batch; all that it writes is keyed by query and batch.

    A repeated batch replaces its own results, failures and dead letters.
    """
    steps = materialise(steps, "steps")
    documents = attach_extracted(steps.where(~F.col("dead")).select("uri", "name"), extracted)
    processed = materialise(with_output_path(process(documents, settings)), "processed")
    good = succeeded(processed)
    place = f"query={query}/batch={batch_id:012d}"
    write_results(keep_path_winners(good, good), results_path, f"{query}-{batch_id:012d}")
    dead = steps.where("dead").withColumn("path", dead_letter_path(F.col("name"))).drop("dead")
    dead.write.mode("overwrite").json(f"{_folder(results_path, 'dead')}/{place}")
    # Last: once they are there, the next batch may read them.
    failed = processed.where(F.col("error").isNotNull())
    failed = failed.select(F.col("source").alias("uri"), "name", "error")
    failed.write.mode("overwrite").json(f"{_folder(results_path, 'retries')}/{place}")


def start_with_retries(
    messages: DataFrame,
    extracted: Callable[[SparkSession], DataFrame],
    results_path: str,
    checkpoint_path: str,
    settings: Settings = Settings(),
    retries: Retries = Retries(),
    **trigger,
) -> StreamingQuery:
    """Start the query; ``extracted`` gives the documents there are when a batch is processed.

    Timers run with the micro-batches, so the trigger is to be a processing time. One
    query writes to a results folder.
    """
    spark = messages.sparkSession
    failures = _folder(results_path, "retries")
    # The source needs its folder.
    spark.createDataFrame([], _EVENT).write.mode("append").json(failures)
    again = spark.readStream.schema(_EVENT).option("recursiveFileLookup", "true").json(failures)
    new = accepted(messages).select("uri", "name", F.lit(None).cast("string").alias("error"))

    def stepped(key, events, state):
        yield from step(key, events, state, retries)

    steps = (
        new.unionByName(again.select("uri", "name", "error"))
        .groupBy("uri")
        .applyInPandasWithState(stepped, _STEP, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    )
    started, ids = Event(), []

    def handle(rows: DataFrame, batch_id: int) -> None:
        started.wait()
        process_steps(rows, batch_id, extracted(spark), results_path, settings, ids[0])

    writer = steps.writeStream.outputMode("append").foreachBatch(handle)
    if trigger:
        writer = writer.trigger(**trigger)
    query = writer.option("checkpointLocation", checkpoint_path).start()
    ids.append(query.id)
    started.set()
    return query
