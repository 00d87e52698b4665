"""The scheduled run: new files only, failures set aside, everything booked."""

from pyspark.sql import DataFrame

from folia.config import Settings
from folia.operators.documents import process, succeeded
from folia.operators.runs import (
    attach_extracted,
    capped,
    failures,
    outcomes,
    pending_files,
    successes,
    with_errors,
    write_dead_letters,
)
from folia.plans.batch import embed_and_store, run_name
from folia.session import materialise
from folia.sources.index import add_to_index, read_index
from folia.sources.results import keep_path_winners, with_output_path, write_results
from folia.sources.vectorrows import Embed

# Failed files that an error names; the others are in its DataFrame.
NAMED = 100


class FilesFailed(RuntimeError):
    """Some files of a run failed; all bookkeeping was done before this was raised.

    The message and ``names`` have the first names in order, ``failures`` the outcomes of all.
    """

    def __init__(self, message: str, failures: DataFrame, names: list[str]):
        super().__init__(message)
        self.failures, self.names = failures, names


def run_scheduled(
    listing: DataFrame,
    extracted: DataFrame,
    index_path: str,
    results_path: str,
    dead_letter_path: str,
    settings: Settings = Settings(),
    run: str | None = None,
    dedupe: bool = False,
    embed: Embed | None = None,
    fail: bool = True,
) -> DataFrame:
    """Process the pending files and return their outcomes.

    Failures stay out of the index, so the next run tries them again. With ``dedupe`` a run
    that broke off after storing its vectors can be repeated without storing them twice. A file
    whose chunks ``embed`` marks as failed has failed, though its result is written. Without
    ``fail`` no error is raised for files that failed.
    """
    spark = listing.sparkSession
    run = run or run_name()
    pending = pending_files(listing, read_index(spark, index_path))
    taken = capped(pending, settings.max_files_per_run)
    documents = attach_extracted(taken, extracted)
    processed = materialise(with_output_path(process(documents, settings)), "processed")
    good = succeeded(processed)
    write_results(keep_path_winners(good, good), results_path, run)
    not_embedded = embed_and_store(good, settings, dedupe, embed)
    results = outcomes(with_errors(processed, not_embedded) if embed is not None else processed)
    add_to_index(successes(results).selectExpr("gcs_uri AS uri"), index_path)
    write_dead_letters(results, dead_letter_path, run)

    failed = failures(results)
    number = failed.count()
    if number and fail:
        where = f"{dead_letter_path}/run={run}"
        names = [r[0] for r in failed.select("filename").orderBy("filename").limit(NAMED).collect()]
        listed = ", ".join(names) + (f" and {number - len(names)} more" if number > len(names) else "")
        message = f"{number} file(s) failed processing in run {run}: {listed}; see {where}"
        raise FilesFailed(message, failed, names)
    return results
