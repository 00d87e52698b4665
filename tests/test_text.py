"""Cleaning and metadata by example."""

import pytest
from pyspark.sql import functions as F

from folia.functions import cleaning, metadata as meta
from folia.functions.patterns import WHITESPACE_CHARS

CLEANED = [
    ("Rain    fell.\n\n\n\n\nThen it stopped.", "Rain fell.\n\nThen it stopped."),
    ("above\n117\nbelow", "above\n\nbelow"),
    ("above\nPage 12 of 340\nbelow", "above\n\nbelow"),
    ("homepage 3 OF 10", "home"),
    ("A tele-\nscope stood there.", "A telescope stood there."),
    ("a-\nb-\nc-\nd", "ab-\ncd"),
    ("x\U0001d7d8-\ny", "x\U0001d7d8y"),
    ("“Oh”—said the owl…", '"Oh"--said the owl...'),
    ("“”‘’–", "\"\"''-"),
    ("ri\x00ver\x1f bank", "river bank"),
    ("one\ntwo\tthree", "one\ntwo three"),
    ("", ""),
    ("   \n\n  ", ""),
    ("　\x85 Low tide.  ", "Low tide."),
    # A bare CR ends no line, so the number stays.
    ("42\rfoo", "42\rfoo"),
    # Blank lines collapse before page numbers go, spaces before no-break spaces do.
    ("a\n\n7\n\nb", "a\n\n\nb"),
    ("a  b", "a  b"),
    # Control characters go after words are rejoined.
    ("a-\x01\nb", "a-\nb"),
]


def test_clean(apply):
    assert apply(cleaning.clean, [raw for raw, _ in CLEANED]) == [clean for _, clean in CLEANED]


def test_single_steps(apply):
    assert apply(cleaning.normalise_whitespace, ["p\t\tq", "up\r\ndown", "p\rq"]) == [
        "p q",
        "up\ndown",
        "p\rq",
    ]
    assert apply(cleaning.remove_page_numbers, ["top\n8\n90\nend"]) == ["top\n\n\nend"]
    assert apply(cleaning.rejoin_hyphens, ["left - right"]) == ["left - right"]
    assert apply(cleaning.drop_controls, ["a\nb\tc\r"]) == ["a\nb\tc\r"]


def test_whitespace_is_unicode_whitespace():
    assert set(WHITESPACE_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(
    "function, expected",
    [
        (meta.word_count, {"Two words": 2, "": 0, " \n ": 0, "a　b\x85c": 3}),
        (
            meta.line_count,
            {"": 0, "a": 1, "a\n": 1, "a\n\nb": 3, "a\r\nb\rc d": 4, "\n": 1, "a\x0bb": 2},
        ),
        (
            meta.has_tables,
            {"neither nor": False, "a | b\nnone": False, "|\n|\n|": False, "|\n||\r|x\n|": True},
        ),
        (
            meta.has_lists,
            {"x\n- pears": True, "7. go\n8. stop": True, "no items": False,
             "3) c": True, "-x": False, " • x": True, "1.x": False},
        ),
        (
            meta.has_numbers,
            {"fee of $98,765.40": True, "down by 3%": True, "since 1999 or so": True,
             "none at all": False, ",%": True, "12345": False, "a2024": False,
             "2024_": False, "\U0001d7d82024": False, "5 %": True},
        ),
        (
            meta.language,
            {"There is a boat on the lake and it is far from the shore of the bay": "en",
             "Yes": "unknown", "Bruma verde sobre campos largos ontem cedo tarde noite": "unknown",
             "the b c d e f g h i j": "en", "b c d e f g h i j k": "unknown",
             " ".join(["the"] + ["x"] * 19): "unknown", " ".join(["IT"] + ["x"] * 18): "en"},
        ),
    ],
)
def test_hints(apply, function, expected):
    assert dict(zip(expected, apply(function, expected))) == expected


def test_metadata_record(spark, apply):
    records = apply(lambda text: meta.metadata(text, F.lit("log.txt")), ["Low tide now"])
    record = records[0].asDict()
    assert record.pop("extracted_at") is not None
    assert record == {
        "filename": "log.txt",
        "char_count": 12,
        "word_count": 3,
        "line_count": 1,
        "has_tables": False,
        "has_lists": False,
        "has_numbers": False,
        "language": "unknown",
    }
    for missing in (F.lit(None).cast("string"), F.lit("")):
        assert apply(lambda text: meta.metadata(text, missing), ["x"])[0].filename == "unknown"


def test_words_and_lines_are_counted_by_batches(spark):
    text = meta.metadata(F.col("text"), F.lit("a.pdf"))
    frame = spark.createDataFrame([("The x |\r\n|\n|\x1c|\n",), ("",)], "text string")
    counted = frame.select(text.alias("m")).select("m.*")
    assert "ArrowEvalPython" in counted._jdf.queryExecution().executedPlan().toString()
    first, second = (tuple(r)[2:5] for r in counted.select("filename", "char_count", "word_count", "line_count", "has_tables").collect())
    assert first == (6, 5, True) and second == (0, 0, False)


def test_steps_without_a_sign_leave_the_text(apply):
    assert apply(cleaning.squeeze_blanks, ["a b", "a\tb", "a  b", None]) == ["a b", "a b", "a b", None]
    assert "contains" in str(cleaning.squeeze_newlines(F.col("text")))


def test_bytes_that_are_no_text_are_replaced(spark):
    broken = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS text")
    for step in (cleaning.squeeze_blanks, cleaning.squeeze_newlines, cleaning.rejoin_hyphens):
        assert broken.select(F.hex(step(F.col("text")))).first()[0] == "61EFBFBD62"
