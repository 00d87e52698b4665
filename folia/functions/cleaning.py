"""Text cleaning as Column expressions: regex, ``replace`` and ``btrim`` only.

A step with a cheap sign of having something to do looks for that first.

The step order of :func:`clean` is part of the result: blank lines collapse
before page numbers go, no-break spaces become spaces after runs of spaces are
squeezed, and control characters go after hyphenated words are rejoined.
"""

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from folia.functions.binding import let
from folia.functions.patterns import DIGIT, WHITESPACE_CHARS, WORD, WORD_BEHIND, WS

# Typographic characters and their ASCII spelling.
PUNCTUATION = {
    "\u201c": '"',
    "\u201d": '"',
    "\u2018": "'",
    "\u2019": "'",
    "\u2013": "-",
    "\u2014": "--",
    "\u2026": "...",
    "\u00a0": " ",
}

# The control characters to drop.
_CONTROLS = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f"


def _where(text: Column, sign: Callable[[Column], Column], step: Callable[[Column], Column]) -> Column:
    """``step`` for the texts with the sign; the others stay as they are.

    Bytes that are no UTF-8 are a sign as well: a regex replaces them.
    """
    return let(text, lambda t: F.when(sign(t) | ~F.is_valid_utf8(t), step(t)).otherwise(t))


def unify_line_ends(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def squeeze_blanks(text: Column) -> Column:
    return _where(
        text,
        lambda t: F.contains(t, F.lit("  ")) | F.contains(t, F.lit("\t")),
        lambda t: F.regexp_replace(t, r"[ \t]+", " "),
    )


def squeeze_newlines(text: Column) -> Column:
    return _where(
        text, lambda t: F.contains(t, F.lit("\n\n\n")), lambda t: F.regexp_replace(t, r"\n{3,}", "\n\n")
    )


def drop_page_number_lines(text: Column) -> Column:
    # (?d): only LF ends a line, so a bare CR does not.
    return F.regexp_replace(text, rf"(?md)^{DIGIT}+{WS}*$", "")


def drop_page_x_of_y(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?i)page{WS}+{DIGIT}+{WS}+of{WS}+{DIGIT}+", "")


def rejoin_hyphens(text: Column) -> Column:
    # A letter joins to one side only: of the breaks in "a-\nb-\nc" every second one
    # stays. The pattern leads with the literal so that the search is cheap.
    broken = rf"-\n(?<={WORD_BEHIND}-\n)({WORD})(-\n(?={WORD}))?"
    return _where(
        text, lambda t: F.contains(t, F.lit("-\n")), lambda t: F.regexp_replace(t, broken, "$1$2")
    )


def ascii_punctuation(text: Column) -> Column:
    def spell(text: Column) -> Column:
        for typographic, ascii_text in PUNCTUATION.items():
            text = F.replace(text, F.lit(typographic), F.lit(ascii_text))
        return text

    return _where(text, lambda t: F.octet_length(t) != F.length(t), spell)


def drop_controls(text: Column) -> Column:
    """Drop control characters, all but TAB, LF and CR."""
    return F.regexp_replace(text, f"[{_CONTROLS}]+", "")


def strip(text: Column) -> Column:
    """Strip Unicode white space at both ends (``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def normalise_whitespace(text: Column) -> Column:
    return squeeze_newlines(squeeze_blanks(unify_line_ends(text)))


def remove_page_numbers(text: Column) -> Column:
    return drop_page_x_of_y(drop_page_number_lines(text))


def clean(text: Column) -> Column:
    """All cleaning steps in order, as one expression without a UDF."""
    text = remove_page_numbers(normalise_whitespace(text))
    return strip(drop_controls(ascii_punctuation(rejoin_hyphens(text))))
