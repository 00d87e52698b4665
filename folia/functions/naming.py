"""Object names, URIs and time stamps."""

from pyspark.sql import Column, functions as F

# Names that take part in results.
CONTROL_PREFIX = "_pipeline/"
RESULTS_PREFIX = "results/"
DEAD_LETTER_PREFIX = "failed/"


def is_pdf(name: Column) -> Column:
    return F.lower(name).endswith(".pdf")


def is_control(name: Column) -> Column:
    return name.startswith(CONTROL_PREFIX)


def object_uri(bucket: Column | str, name: Column) -> Column:
    bucket = F.lit(bucket) if isinstance(bucket, str) else bucket
    return F.concat(F.lit("gs://"), bucket, F.lit("/"), name)


def basename(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def result_path(filename: Column) -> Column:
    """Where the result of a file goes: its last suffix replaced by ``.json``."""
    stem = F.regexp_replace(filename, r"(?s)\.[^.]*\z", "")
    return F.concat(F.lit(RESULTS_PREFIX), stem, F.lit(".json"))


def dead_letter_path(name: Column) -> Column:
    return F.concat(F.lit(DEAD_LETTER_PREFIX), name, F.lit(".error.json"))


def iso_utc(moment: Column, zone: str = "+00:00") -> Column:
    """ISO 8601 text in UTC whatever the session zone; fractions only where there are any."""
    # Counted from the epoch: local time is ambiguous in the hour when clocks are set back.
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)
    text = F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(
        F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text),
        F.lit(zone),
    )
