import base64
import json
import time

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException

from folia.plans import batch
from folia.schemas import EXTRACTED, NOTIFICATION
from folia.sources import results
from folia.streaming import notifications as notes, retries
from folia.streaming.retries import Retries

BODY = {"kind": "storage#object", "name": "doc.pdf", "bucket": "raw", "contentType": "application/pdf"}


def encoded(body):
    text = body if isinstance(body, str) else json.dumps(body)
    return base64.b64encode(text.encode()).decode()


def message(event="OBJECT_FINALIZE", name="doc.pdf", body=BODY, **attributes):
    given = {"bucketId": "raw", "objectId": name, "eventType": event, **attributes}
    return {"data": encoded(body), "attributes": given}


CASES = [
    (message(), "gs://raw/doc.pdf"),
    (message(name="a/B.PDF"), "gs://raw/a/B.PDF"),
    ({"message": message()}, "gs://raw/doc.pdf"),
    (message(bucketId="", objectId=""), "gs://raw/doc.pdf"),
    (message(body={"x": 1}), "gs://raw/doc.pdf"),
    (message("OBJECT_DELETE"), None),
    (message(name="doc.txt"), None),
    # Without attributes there is no event type.
    ({"data": encoded(BODY)}, None),
    (message(body={"x": 1}, bucketId="", objectId=""), None),
    ({**message(), "data": ""}, None),
    ({**message(), "data": None}, None),
    (message(body="no json"), None),
    # Any JSON value will do where the attributes are complete.
    *((message(body=body), "gs://raw/doc.pdf") for body in ("[1]", '"x"', "5", "null", '{"a":NaN}', '{"a":1,"a":2}')),
    (message(body='{"name":"no.txt","name":"yes.pdf","bucket":"raw"}', bucketId="", objectId=""), "gs://raw/yes.pdf"),
    (message(body="[1]", bucketId=""), None),
    (message(body='{"name":'), None),
    (message(body='{"name": "x"} y'), None),
    (message(body='{"name": "x"}, {"name": "y"}'), None),
    # Characters outside of the alphabet are skipped, wrong padding is not accepted.
    ({**message(), "data": "!" + encoded(BODY)[:8] + "\n" + encoded(BODY)[8:]}, "gs://raw/doc.pdf"),
    ({**message(), "data": "A" + encoded(BODY)}, None),
    ({**message(), "data": base64.b64encode(b'{"a":"\xff"}').decode()}, None),
]


def write(path, messages, name="part"):
    path.mkdir(exist_ok=True)
    (path / f"{name}.json").write_text("\n".join(json.dumps(m) for m in messages))


def test_accepted(spark, tmp_path):
    for number, (given, uri) in enumerate(CASES):
        write(tmp_path / str(number), [given])
        frame = spark.read.schema(NOTIFICATION).json(str(tmp_path / str(number)))
        assert [r.uri for r in notes.accepted(frame).collect()] == ([uri] if uri else []), given


def extracted(spark, *names):
    rows = [(f"gs://raw/{n}", n, f"Text of {n}.", [], None) for n in names]
    return spark.createDataFrame(rows, EXTRACTED)


def run(spark, tmp_path, documents, checkpoint="checkpoint", source="in", **options):
    query = notes.start_processing(
        notes.notification_stream(spark, str(tmp_path / source)),
        documents,
        str(tmp_path / "results"),
        str(tmp_path / checkpoint),
        availableNow=True,
        **options,
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    documents = extracted(spark, "doc.pdf", "a/B.PDF", "c/doc.pdf", "unasked.pdf")
    write(tmp_path / "in", [given for given, _ in CASES] * 3, "one")
    run(spark, tmp_path, documents)
    run(spark, tmp_path, documents)
    out = str(tmp_path / "results")
    assert results.read_results(spark, out).count() == 2
    assert {r.source for r in results.current_results(spark, out).collect()} == {
        "gs://raw/doc.pdf",
        "gs://raw/a/B.PDF",
    }
    # A later message about another file of the same base name takes over its path.
    write(tmp_path / "in", [message(name="c/doc.pdf")], "two")
    run(spark, tmp_path, documents)
    current = {r.output_path: r.source for r in results.current_results(spark, out).collect()}
    assert current["results/doc.json"] == "gs://raw/c/doc.pdf"


def current(spark, tmp_path):
    rows = results.current_results(spark, str(tmp_path / "results")).collect()
    return {r.output_path: r.source for r in rows}


def test_failures_can_stop_the_stream_and_are_tried_again(spark, tmp_path):
    write(tmp_path / "in", [message(), message(name="late.pdf")])
    with pytest.raises(StreamingQueryException, match="1 object"):
        run(spark, tmp_path, extracted(spark, "doc.pdf"), raise_failures=True)
    run(spark, tmp_path, extracted(spark, "doc.pdf", "late.pdf"), raise_failures=True)
    rows = results.read_results(spark, str(tmp_path / "results"))
    assert rows.count() == 2


def test_a_failed_object_is_tried_again_with_the_next_batch(spark, tmp_path):
    write(tmp_path / "in", [message(), message(name="late.pdf")], "one")
    query = run(spark, tmp_path, extracted(spark, "doc.pdf"))
    failed = notes.failed_objects(spark, str(tmp_path / "results"), query.id, 0)
    assert [r.uri for r in failed.collect()] == ["gs://raw/late.pdf"]
    write(tmp_path / "in", [message(name="new.pdf")], "two")
    query = run(spark, tmp_path, extracted(spark, "doc.pdf", "late.pdf", "new.pdf"))
    assert notes.failed_objects(spark, str(tmp_path / "results"), query.id, 1).count() == 0
    assert set(current(spark, tmp_path)) == {"results/doc.json", "results/late.json", "results/new.json"}


def test_streams_and_batches_on_one_folder(spark, tmp_path):
    documents = extracted(spark, "a.pdf", "b.pdf", "x/b.pdf")
    write(tmp_path / "one", [message(name="a.pdf")])
    write(tmp_path / "two", [message(name="b.pdf")])
    run(spark, tmp_path, documents, "first", "one")
    run(spark, tmp_path, documents, "second", "two")
    assert set(current(spark, tmp_path)) == {"results/a.json", "results/b.json"}
    # Whatever the runs are called, the result written last counts.
    batch.run_batch(documents.where("name = 'x/b.pdf'"), str(tmp_path / "results"), run="2026")
    assert current(spark, tmp_path)["results/b.json"] == "gs://raw/x/b.pdf"
    write(tmp_path / "two", [message(name="b.pdf")], "again")
    run(spark, tmp_path, documents, "second", "two")
    assert current(spark, tmp_path)["results/b.json"] == "gs://raw/b.pdf"


def until(query, done, seconds=180):
    end = time.time() + seconds
    while time.time() < end and not done():
        assert query.exception() is None
        time.sleep(1)
    assert done()


def test_retries(spark, tmp_path):
    """One object comes at the third attempt, one never; no further message is needed."""
    write(tmp_path / "in", [message(), message(name="late.pdf"), message(name="never.pdf"), message(name="no.txt")] * 2)
    out, calls = str(tmp_path / "results"), []

    def documents(spark):
        tried = retries_of(spark, out, "late.pdf")
        calls.append(tried)
        return extracted(spark, "doc.pdf", *(["late.pdf"] if tried >= 2 else []))

    def start():
        return retries.start_with_retries(
            notes.notification_stream(spark, str(tmp_path / "in")), documents, out, str(tmp_path / "checkpoint"),
            retries=Retries(attempts=3, first=1.0, factor=1.5, settled=600.0), processingTime="1 second",
        )

    query = start()
    until(query, lambda: retries_of(spark, out, "late.pdf") >= 1)
    query.stop()
    # The state and its timers outlive the query.
    query = start()
    until(query, lambda: retries.dead_letters(spark, out).count() == 1 and len(current(spark, tmp_path)) == 2)
    query.stop()
    assert set(current(spark, tmp_path)) == {"results/doc.json", "results/late.json"}
    assert [tuple(r) for r in retries.dead_letters(spark, out).collect()] == [
        ("failed/never.pdf.error.json", "gs://raw/never.pdf", "never.pdf", 3, "no extracted document")
    ]
    assert retries_of(spark, out, "late.pdf") == 2 and retries_of(spark, out, "never.pdf") == 3
    assert retries.dead_letters(spark, out + "x").count() == 0


def retries_of(spark, out, name):
    failed = spark.read.schema("uri string, name string, error string").option("recursiveFileLookup", "true")
    return failed.json(f"{out}_retries").where(f"name = '{name}'").count()


class State:
    """A state by hand."""

    def __init__(self, value=None, timed_out=False):
        self.value, self.hasTimedOut, self.timeout = value, timed_out, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, milliseconds):
        self.timeout = milliseconds


def steps(state, *events):
    frame = pd.DataFrame([("a.pdf", e) for e in events], columns=["name", "error"]).astype(object)
    frame = frame.where(frame.notna(), None)
    found = retries.step(("gs://a.pdf",), iter([frame] if events else []), state, Retries(attempts=3, first=10, longest=15))
    return [(r.attempts, r.dead, r.error) for f in found for r in f.itertuples()]


def test_steps_of_an_object():
    state = State()
    assert steps(state, None, None) == [(1, False, None)] and state.timeout == 7_200_000
    assert steps(state, "bad") == [] and state.value == (1, "a.pdf", True) and state.timeout == 10_000
    state.hasTimedOut = True
    assert steps(state) == [(2, False, None)]
    state.hasTimedOut = False
    assert steps(state, "bad") == [] and state.timeout == 15_000
    # Announced again: from the beginning.
    assert steps(state, None, "old") == [(1, False, None)] and state.value == (1, "a.pdf", False)
    state.value = (3, "a.pdf", False)
    assert steps(state, "worse") == [(3, True, "worse")] and not state.exists
    # A failure of an object that is not known any more, and an object that has not failed.
    assert steps(state, "late") == []
    settled = State((1, "a.pdf", False), timed_out=True)
    assert steps(settled) == [] and not settled.exists
