"""Batch and scheduled runs, bookkeeping, results."""

import dataclasses
import functools
import json

import pytest
from pyspark.sql import functions as F

from folia.config import Settings
from folia.functions import naming
from folia.operators import runs
from folia.operators.embedding import embed_or_fail, embed_with_model
from folia.operators.documents import NOT_EXTRACTED, process
from folia.plans import batch
from folia.plans.scheduled import FilesFailed, run_scheduled
from folia.schemas import EXTRACTED, LISTING
from folia.session import scratch_path
from folia.sources import index, listing as listing_source, objects, results

BUCKET = "gs://in/"
LAYOUT = [("chunk_0", "First", 0, 1, ["block_1"]), ("chunk_1", "Second", 1, 2, ["block_2"])]
TEXT = "This is the text.\n\nIt has paragraphs.\nPage 1 of 5\n"


def extracted(spark, *documents):
    rows = [(BUCKET + name, name, text, layout, error) for name, text, layout, error in documents]
    return spark.createDataFrame(rows, EXTRACTED)


def listing(spark, *names):
    rows = [(BUCKET + name, name, None, None) for name in names]
    return spark.createDataFrame(rows, LISTING)


@pytest.fixture
def settings(spark, tmp_path):
    name = "t" + tmp_path.name.replace("-", "_")
    yield Settings(
        chunk_size=64, chunk_overlap=8, embedding_dimensions=16, vector_table=name,
        max_files_per_run=3,
    )
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_process_record(spark):
    row = process(extracted(spark, ("docs/test.pdf", TEXT, LAYOUT, None))).first()
    assert (row.source, row.filename) == (BUCKET + "docs/test.pdf", "test.pdf")
    assert row.raw_char_count == len(TEXT) and row.cleaned_char_count == len(TEXT) - 13
    assert (row.layout_chunk_count, row.text_chunk_count) == (2, 1)
    assert row.layout_chunks[0].chunk_id == "chunk_0"
    assert row.text_chunks[0].source == "test.pdf"
    assert "Page 1 of 5" not in row.text_chunks[0].content
    assert row.metadata.filename == "test.pdf"


def test_text_falls_back_to_layout_chunks(spark):
    documents = extracted(
        spark, ("a.pdf", "", LAYOUT, None), ("b.pdf", None, LAYOUT, None), ("c.pdf", "", [], None),
        ("d.pdf", None, None, None),
    )
    rows = {r.name: r for r in process(documents).collect()}
    assert rows["a.pdf"].text_chunks[0].content == "First\n\nSecond"
    assert rows["b.pdf"].raw_char_count == len("First\n\nSecond")
    assert rows["c.pdf"].text_chunks == [] == rows["d.pdf"].layout_chunks


def test_processing_is_narrow_and_without_python(spark):
    plan = process(extracted(spark, ("a.pdf", TEXT, LAYOUT, None)).repartition(3))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Python" not in text.split("Exchange")[0]


def test_prefix_and_errors(spark):
    documents = extracted(
        spark, ("docs/report.PDF", TEXT, [], None), ("docs/broken.pdf", None, None, "bad"),
        ("docs/note.txt", TEXT, [], None), ("other/x.pdf", TEXT, [], None),
    )
    found = batch.process_prefix(documents, "docs/")
    assert [r.filename for r in found.collect()] == ["report.PDF"]
    assert batch.output_uris(found.drop("name")).first().output_uri == (
        "gs://corporate-processed-docs/results/report.json"
    )
    assert batch.process_prefix(documents, "none/").collect() == []


@pytest.mark.parametrize(
    "filename, path",
    [("a.pdf", "a"), ("a.v2.pdf", "a.v2"), ("a", "a"), (".pdf", ""), ("a.", "a"), ("a\n.b", "a\n")],
)
def test_result_path(apply, filename, path):
    assert apply(naming.result_path, [filename]) == [f"results/{path}.json"]


def test_iso_utc_in_any_zone(spark):
    moment = F.timestamp_micros(F.lit(1_704_067_200_000_000 + 120_000))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            text = spark.range(1).select(naming.iso_utc(moment)).first()[0]
            assert text == "2024-01-01T00:00:00.120000+00:00"
            # The second time the clock shows half past one.
            twice = F.timestamp_micros(F.lit(1_730_615_400_000_000))
            text = spark.range(1).select(naming.iso_utc(twice, "Z")).first()[0]
            assert text == "2024-11-03T06:30:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_list_objects(spark, tmp_path):
    for name in ("a.pdf", "docs/B.PDF", "docs/c.txt", "_pipeline/d.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    found = objects.list_objects(spark, str(tmp_path))
    assert {r.name: r.size for r in found.collect()} == dict.fromkeys(
        ["a.pdf", "docs/B.PDF", "docs/c.txt"], 5
    )
    pushed = objects.list_objects(spark, str(tmp_path), "docs/B")
    assert [r.name for r in pushed.collect()] == ["docs/B.PDF"]
    assert pushed.inputFiles() and all("/docs/" in f for f in pushed.inputFiles())
    assert objects.list_objects(spark, str(tmp_path), "none/x").count() == 0
    # Spark's own file listing hides names that start with an underscore.
    eligible = objects.without_control_files(objects.pdfs(found))
    assert {r.name for r in eligible.collect()} == {"a.pdf", "docs/B.PDF"}
    info = objects.file_info(objects.under_prefix(found, "docs/")).first()
    assert info.updated.endswith("+00:00")
    unknown = objects.file_info(listing(spark, "x.pdf")).first()
    assert (unknown.size, unknown.updated) == (0, "")


def test_list_bucket(spark, tmp_path):
    """Hidden names too; the start of names decides which folders are listed."""
    names = ["_x.pdf", ".y.pdf", "a.pdf", "_pipeline/d.pdf", "docs/B.PDF", "docs/deep/_c/e.pdf", "docs2/f.txt", "d"]
    for name in names:
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"123")
    root = str(tmp_path / "in")
    for uri in (root, f"file://{root}"):
        for prefix in ("", "d", "docs", "docs/", "docs/d", "docs/deep/_c/e.pdf", "_", ".", "none/x", "docs/deep/x"):
            found = listing_source.list_bucket(spark, uri, prefix).collect()
            assert sorted(r.name for r in found) == sorted(n for n in names if n.startswith(prefix)), prefix
            assert all(r.uri == f"{uri}/{r.name}" and r.size == 3 and r.updated for r in found)
    with pytest.raises(Exception, match="not exist|No such|not found|FileNotFound"):
        listing_source.list_bucket(spark, root + "x").collect()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        asked = objects.under_prefix(listing_source.list_bucket(spark, root), "docs/")
        assert sorted(r.name for r in asked.collect()) == ["docs/B.PDF", "docs/deep/_c/e.pdf"]
        assert asked.rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    eligible = objects.without_control_files(objects.pdfs(listing_source.list_bucket(spark, root)))
    assert {r.name for r in eligible.collect()} == {"_x.pdf", ".y.pdf", "a.pdf", "docs/B.PDF", "docs/deep/_c/e.pdf"}


def test_results_round_trip_and_overwriting(spark, tmp_path):
    path = str(tmp_path / "results")
    documents = extracted(spark, ("a/x.pdf", "first", LAYOUT, None), ("b/x.pdf", "second", [], None))
    outputs = batch.run_batch(documents, path, run="9").outputs
    assert {r.stored_at for r in outputs.collect()} == {f"{path}/run=9"}
    current = results.current_results(spark, path).collect()
    assert [r.source for r in current] == [BUCKET + "b/x.pdf"]
    batch.run_batch(extracted(spark, ("c/x.pdf", "third", [], None)), path, run="10")
    row = results.current_results(spark, path).first()
    assert (row.source, row.run, row.output_path) == (BUCKET + "c/x.pdf", "10", "results/x.json")
    assert row.metadata.extracted_at.endswith("Z")
    # The earlier run is still there, and repeating a run replaces it.
    batch.run_batch(documents, path, run="9")
    assert results.read_results(spark, path).count() == 2


def test_only_files_with_current_results_are_read(spark, tmp_path):
    """Ten runs over the same documents, one over others: two runs' files are opened."""
    path = str(tmp_path / "results")
    same = extracted(spark, *((f"a/{i}.pdf", f"text {i}", [], None) for i in range(6)))
    for run in range(10):
        batch.run_batch(same, path, run=f"same{run}")
    batch.run_batch(extracted(spark, ("b/x.pdf", "x", [], None)), path, run="other")
    current = results.current_results(spark, path)
    runs_read = {f.split("run=")[1].split("/")[0] for f in current.inputFiles() if "run=" in f}
    assert current.count() == 7 and runs_read - {"same9", "other"} == set()
    records = [f for f in current.inputFiles() if f.startswith(f"file://{path}/")]
    held = spark.read.json(path).where("output_path IS NOT NULL").select(F.col("_metadata.file_path").alias("f"), "run")
    wanted = {r.f for r in held.where("run IN ('same9', 'other')").collect()}
    assert {f.replace("file:///", "file:/") for f in records} == {f.replace("file:///", "file:/") for f in wanted}
    assert results.current_results(spark, path).where("run = 'same9'").count() == 6


def test_index_is_not_shuffled(spark, tmp_path):
    """A listing is joined with the index where the index lies."""
    path = str(tmp_path / "index")
    names = [f"d/{i}.pdf" for i in range(300)]
    for part in (names[:100], names[50:200]):
        index.add_to_index(spark.createDataFrame([(BUCKET + n,) for n in part], "uri STRING"), path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = runs.pending_files(listing(spark, *names), index.read_index(spark, path))
        assert {r.name for r in pending.collect()} == set(names[200:])
        plan = pending._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        final = plan.split("== Initial Plan ==")[0]
        assert "Bucketed: true" in final and "SortMergeJoin" in final
        assert final.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    index.compact_index(spark, path, str(tmp_path / "new"))
    assert index.read_index(spark, str(tmp_path / "new")).count() == 200
    assert len(list((tmp_path / "new_by_uri").glob("*.parquet"))) <= index.BUCKETS
    with pytest.raises(FileExistsError):
        index.compact_index(spark, path, str(tmp_path / "new"))


def test_a_third_of_all_files_on_one_path(spark, tmp_path):
    hot = [(f"d{i:03}/same.pdf", f"text {i}", [], None) for i in range(100)]
    others = [(f"d/{i}.pdf", f"text {i}", [], None) for i in range(200)]
    batch.run_batch(extracted(spark, *hot, *others), str(tmp_path / "r"))
    current = results.current_results(spark, str(tmp_path / "r"))
    assert current.count() == 201
    kept = current.where("filename = 'same.pdf'").collect()
    assert [r.source for r in kept] == [BUCKET + "d099/same.pdf"]


def test_single_record_files_can_be_stored(spark, tmp_path, settings):
    record = {
        "source": "gs://in/a.pdf",
        "filename": "a.pdf",
        "raw_char_count": 5,
        "cleaned_char_count": 5,
        "metadata": {"filename": "a.pdf", "word_count": 1, "extracted_at": "2024-01-01T00:00:00Z"},
        "docai_chunks_count": 0,
        "langchain_chunks_count": 2,
        "docai_chunks": [],
        "langchain_chunks": [{"content": "one"}, {"chunk_index": 7, "content": "two"}],
    }
    (tmp_path / "a.json").write_text(json.dumps(record, indent=2))
    batch.store_results(spark, str(tmp_path / "a.json"), settings, multi_line=True)
    rows = spark.table(settings.vector_table).orderBy("id").collect()
    assert [(r.id, r.chunk_index, r.content) for r in rows] == [(1, 0, "one"), (2, 7, "two")]
    assert json.loads(rows[0].metadata)["extracted_at"] == "2024-01-01T00:00:00Z"


def test_index(spark, tmp_path):
    path = str(tmp_path / "index")
    assert index.read_index(spark, path).count() == 0
    for uris in (["b", "a"], ["a", "c"]):
        index.add_to_index(spark.createDataFrame([(u,) for u in uris], "uri STRING"), path)
    stored = index.read_index(spark, path)
    assert sorted(r.uri for r in stored.collect()) == ["a", "b", "c"]
    index.write_snapshot(stored, str(tmp_path / "compact"))
    assert index.read_index(spark, str(tmp_path / "compact")).count() == 3
    for file in (tmp_path / "compact").glob("*.parquet"):
        file.write_bytes(b"not a table")
        (tmp_path / "compact" / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="not a Parquet file|CANNOT_READ_FILE"):
        index.read_index(spark, str(tmp_path / "compact")).count()


def test_pending(spark):
    files = listing(spark, "b.pdf", "a.pdf", "c.txt", "_pipeline/d.pdf", "e.PDF", "f.pdf")
    done = spark.createDataFrame([(BUCKET + "a.pdf",)], "uri STRING")
    pending = runs.pending_files(files, done)
    assert [r.name for r in runs.capped(pending, 2).collect()] == ["b.pdf", "e.PDF"]
    assert runs.discovery_counts(pending, 2).first()[:] == (3, 2)
    assert runs.capped(pending, None).count() == 3
    assert runs.discovery_counts(pending, None).first()[:] == (3, 3)


def test_scheduled_runs(spark, tmp_path, settings):
    documents = extracted(
        spark, ("a.pdf", TEXT, [], None), ("b.pdf", None, None, "parser failed"),
        ("d.pdf", TEXT, [], None), ("e.pdf", TEXT, [], None),
    )
    files = listing(spark, "a.pdf", "b.pdf", "c.pdf", "d.pdf", "e.pdf")
    paths = [str(tmp_path / name) for name in ("index", "results", "dead")]

    with pytest.raises(FilesFailed, match="2 file.*run one.*dead/run=one") as failed:
        run_scheduled(files, documents, *paths, settings, run="one")
    assert {r.filename for r in failed.value.failures.collect()} == {"b.pdf", "c.pdf"}
    assert failed.value.names == ["b.pdf", "c.pdf"] and "b.pdf, c.pdf;" in str(failed.value)
    with pytest.raises(FilesFailed):
        run_scheduled(files.where("name > 'a' AND name < 'd'"), documents, *paths, settings, run="two")
    done = index.read_index(spark, paths[0])
    letters = runs.current_dead_letters(spark, paths[2], done).collect()
    assert {r.path: r.run for r in letters} == dict.fromkeys(
        ["failed/b.pdf.error.json", "failed/c.pdf.error.json"], "two"
    )
    done = {r.uri for r in index.read_index(spark, paths[0]).collect()}
    assert done == {BUCKET + "a.pdf"}
    dead = {r.path: json.loads(r.record) for r in spark.read.json(paths[2]).collect()}
    assert dead["failed/b.pdf.error.json"] == {
        "status": "failed",
        "gcs_uri": BUCKET + "b.pdf",
        "filename": "b.pdf",
        "error": "parser failed",
    }
    assert dead["failed/c.pdf.error.json"]["error"] == NOT_EXTRACTED

    # The next run has the failures and the files left over before it.
    pending = runs.pending_files(files, index.read_index(spark, paths[0]))
    assert {r.name for r in pending.collect()} == {"b.pdf", "c.pdf", "d.pdf", "e.pdf"}

    mended = documents.where("error IS NULL").unionByName(
        extracted(spark, ("b.pdf", TEXT, [], None), ("c.pdf", TEXT, [], None))
    )
    outcome = run_scheduled(files, mended, *paths, settings).collect()
    assert {r.filename for r in outcome} == {"b.pdf", "c.pdf", "d.pdf"}
    assert {r.output_path for r in outcome} == {f"results/{n}.json" for n in "bcd"}
    run_scheduled(files, mended, *paths, settings)
    assert run_scheduled(files, mended, *paths, settings).count() == 0
    assert results.current_results(spark, paths[1]).count() == 5
    stored = spark.table(settings.vector_table)
    assert stored.select("source").distinct().count() == 5
    assert stored.count() == stored.agg(F.max("id")).first()[0]


def test_many_failures_are_all_told(spark, tmp_path, settings):
    files = listing(spark, *(f"{i:02}.pdf" for i in range(25)))
    with pytest.raises(FilesFailed) as failed:
        run_scheduled(
            files, extracted(spark), *(str(tmp_path / n) for n in "ird"),
            dataclasses.replace(settings, max_files_per_run=None),
        )
    assert failed.value.failures.count() == 25


def test_a_model_in_the_plans(spark, tmp_path, settings):
    def lengths():
        return lambda texts: [[float(len(t))] * 16 for t in texts]

    embed = functools.partial(embed_with_model, text="content", load_model=lengths)
    documents = extracted(spark, ("a.pdf", TEXT, [], None), ("bad.pdf", None, None, "bad"))
    batch.run_batch(documents, str(tmp_path / "r"), store=True, settings=settings, embed=embed)
    batch.run_batch(documents, None, store=True, settings=settings, embed=embed, dedupe=True)
    rows = spark.table(settings.vector_table).collect()
    assert rows and all(list(r.embedding) == [float(len(r.content))] * 16 for r in rows)
    assert len({(r.source, r.chunk_index) for r in rows}) == len(rows)
    records = {json.dumps(r.metadata.asDict(), sort_keys=True) for r in results.current_results(spark, str(tmp_path / "r")).collect()}
    assert all(json.loads(r.metadata)["extracted_at"].endswith("Z") for r in rows) and records


def picky(calls, bad):
    def load():
        def model(texts):
            with open(calls, "a") as file:
                file.write(f"{len(texts)}\n")
            if any(b in t for t in texts for b in bad):
                raise RuntimeError(next(b for t in texts for b in bad if b in t))
            return [[float(len(t))] * 16 for t in texts][: None if "short" not in "".join(texts) else -1]

        return model

    return load


def test_a_failing_call_is_halved(spark, tmp_path):
    """Only the guilty texts fail, at the cost of a few calls for each of them."""
    texts = [f"text {i}" for i in range(500)]
    texts[37], texts[38], texts[444], texts[3] = "very bad", None, "worse", "short"
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, content string").coalesce(1)

    def load():
        model = picky(tmp_path / "calls", ["bad", "worse"])()
        return lambda texts: model(["".join(t) for t in texts])

    found = embed_or_fail(rows, "content", load).collect()
    failed = {r["i"]: r["error"] for r in found if r["error"] is not None}
    assert set(failed) == {37, 38, 444, 3} and failed[37] == "bad" and failed[444] == "worse"
    assert "another number" in failed[3] and "iterable" in failed[38]
    assert all((r["embedding"] is None) == (r["i"] in failed) for r in found) and len(found) == 500
    assert len((tmp_path / "calls").read_text().split()) <= 2 + 4 * 2 * 9
    with pytest.raises(ValueError, match="already"):
        embed_or_fail(found and rows.withColumnRenamed("i", "error"), "content", load)
    assert embed_or_fail(rows.where("i < 0"), "content", load).count() == 0


def test_a_model_that_refuses_a_document(spark, tmp_path, settings):
    """One refused chunk fails its document alone, in scheduled and in batch runs."""
    embed = functools.partial(embed_or_fail, text="content", load_model=picky(tmp_path / "calls", ["refuse"]))
    documents = extracted(
        spark, ("a.pdf", TEXT, [], None), ("b.pdf", TEXT + " refuse this", [], None), ("bad.pdf", None, None, "bad")
    )
    places = [str(tmp_path / name) for name in "ird"]
    with pytest.raises(FilesFailed, match="2 file") as failed:
        run_scheduled(listing(spark, "a.pdf", "b.pdf", "bad.pdf"), documents, *places, settings, embed=embed)
    assert {r.filename: r.error for r in failed.value.failures.collect()} == {"b.pdf": "refuse", "bad.pdf": "bad"}
    assert {r.filename for r in spark.table(settings.vector_table).collect()} == {"a.pdf"}
    assert {r.uri for r in index.read_index(spark, places[0]).collect()} == {BUCKET + "a.pdf"}
    done = batch.run_batch(documents, None, store=True, settings=settings, embed=embed)
    assert [tuple(r) for r in done.failed.collect()] == [(BUCKET + "b.pdf", "refuse")]
    assert {r.filename for r in spark.table(settings.vector_table).collect()} == {"a.pdf"}


def test_attach_extracted(spark):
    documents = extracted(spark, ("a.pdf", "x", [], None), ("b.pdf", None, None, "bad"))
    found = runs.attach_extracted(listing(spark, "a.pdf", "b.pdf", "c.pdf"), documents)
    processed = results.with_output_path(process(found))
    outcome = {r.gcs_uri[-5:]: r for r in runs.outcomes(processed).collect()}
    assert outcome["a.pdf"].status == "success" and outcome["a.pdf"].chunk_count == 1
    assert (outcome["b.pdf"].error, outcome["c.pdf"].error) == ("bad", NOT_EXTRACTED)
    summary = runs.run_summary(runs.outcomes(processed)).first()
    assert summary[:] == (3, 1, 2)


def test_chunks_are_cut_once(spark):
    """The chunks of documents are exploded without a filter that processes the texts as well."""
    documents = spark.createDataFrame([("gs://b/a.pdf", "a.pdf", "One. Two.", [], None), ("gs://b/e.pdf", "e.pdf", "", [], None)], EXTRACTED)
    chunks = results.result_chunks(batch.process_prefix(documents))
    plan = chunks._jdf.queryExecution().optimizedPlan()
    assert "size(" not in "".join(line for line in plan.toString().splitlines() if "Filter" in line)
    assert [(r.source, r.chunk_index, r.content) for r in chunks.collect()] == [("gs://b/a.pdf", 0, "One. Two.")]
