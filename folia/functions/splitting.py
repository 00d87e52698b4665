"""Hierarchical text splitting with overlap, as one Column expression.

A text is cut at the coarsest separator it holds; pieces still too long are cut
at the next finer one, and so on. Neighbouring short pieces are then packed into
chunks of at most ``size`` characters, each chunk repeating up to ``overlap``
characters of its predecessor.

Everything happens inside the row: chunking a table is a narrow transformation
without a shuffle, and its memory need is that of one document.
"""

from pyspark.sql import Column, functions as F

from folia.functions.binding import let
from folia.functions.cleaning import strip

# Separators from the coarsest to the finest.
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", ";", ",", " ")

# Marks cut positions while a piece is split; texts holding it take a slower, exact path.
_MARK = "\x01"


def split_pieces(text: Column, size: int) -> Column:
    """``array<string>`` of the pieces of ``text``, in order.

    The pieces concatenate to the text. An empty string is not a piece: it
    separates runs of pieces, and only pieces of one run may share a chunk.
    Pieces of ``size`` or more characters hold no separator but at their start;
    packing never joins them with a neighbour, as nothing fits beside them.
    """

    def cut(piece: Column, separator: str) -> Column:
        marked = F.replace(piece, F.lit(separator), F.lit(_MARK + separator))
        # Marks at both ends yield the run separators around the pieces.
        fast = F.split(F.concat(F.lit(_MARK), marked, F.lit(_MARK)), _MARK, -1)
        quoted = rf"\Q{separator}\E"
        exact = F.regexp_extract_all(
            piece, F.lit(rf"(?s)(?:{quoted})?.*?(?={quoted}|\z)"), F.lit(0)
        )
        exact = F.concat(F.array(F.lit("")), F.array_remove(exact, ""), F.array(F.lit("")))
        return F.when(F.contains(piece, F.lit(_MARK)), exact).otherwise(fast)

    def level(pieces: Column, separator: str) -> Column:
        return F.flatten(
            F.transform(
                pieces,
                lambda p: F.when(F.length(p) < size, F.array(p)).otherwise(cut(p, separator)),
            )
        )

    def all_levels(whole: Column) -> Column:
        pieces = F.array(whole)
        for separator in SEPARATORS:
            pieces = level(pieces, separator)
        return F.when(F.length(whole) < size, F.array(whole)).otherwise(pieces)

    return let(text, all_levels)


def merge_pieces(pieces: Column, size: int, overlap: int) -> Column:
    """Pack the runs of :func:`split_pieces` into chunk texts (``array<string>``).

    One linear fold finds the chunks as (index of first piece, number of pieces);
    the texts are joined afterwards. A fold copies its state at every step, so the
    state stays flat and small: the pieces are read from outside of it and the
    chunks found so far are one short string, not an array.
    """

    def pack(pieces: Column) -> Column:
        def shrink(state: Column, length: Column) -> Column:
            """Drop pieces from the front until the rest fits the overlap and leaves room."""
            at_least = F.greatest(
                state["offset"] - F.lit(overlap), state["offset"] + length - F.lit(size)
            )
            return F.aggregate(
                F.slice(pieces, state["first"] + 1, state["index"] - state["first"]),
                _window(state["start"], state["first"]),
                lambda w, p: F.when(
                    w["start"] < at_least, _window(w["start"] + F.length(p), w["first"] + 1)
                ).otherwise(w),
            )

        def step(state: Column, piece: Column) -> Column:
            length = F.length(piece)
            run_ends = length == 0
            overflow = state["offset"] + length - state["start"] > size
            done = (state["offset"] > state["start"]) & (run_ends | overflow)
            # Only a piece that could not be cut small enough fills a chunk by itself.
            uncut = (state["index"] - state["first"] == 1) & (
                state["offset"] - state["start"] >= size
            )
            window = (
                F.when(run_ends, _window(state["offset"], state["index"] + 1))
                .when(done, shrink(state, length))
                .otherwise(_window(state["start"], state["first"]))
            )
            return F.struct(
                (state["index"] + 1).alias("index"),
                (state["offset"] + length).alias("offset"),
                window["start"].alias("start"),
                window["first"].alias("first"),
                F.when(
                    done,
                    F.concat(
                        state["found"],
                        F.when(uncut, F.lit("u")).otherwise(F.lit("")),
                        F.concat_ws(",", state["first"], state["index"] - state["first"]),
                        F.lit(";"),
                    ),
                )
                .otherwise(state["found"])
                .alias("found"),
            )

        nothing = F.struct(
            *(F.lit(0).alias(name) for name in ("index", "offset", "start", "first")),
            F.lit("").alias("found"),
        )
        found = F.aggregate(pieces, nothing, step, lambda state: state["found"])

        def content(chunk: Column) -> Column:
            uncut = chunk.startswith("u")
            first = F.ltrim(F.substring_index(chunk, ",", 1), F.lit("u")).cast("int")
            count = F.substring_index(chunk, ",", -1).cast("int")
            text = F.array_join(F.slice(pieces, first + 1, count), "")
            return F.when(uncut, text).otherwise(strip(text))

        return F.transform(F.array_remove(F.split(found, ";"), ""), content)

    closed = F.concat(pieces, F.array(F.lit("")))
    return F.array_remove(let(closed, pack), "")


def split_text(text: Column, size: int, overlap: int) -> Column:
    """Chunk texts of ``text`` in order; none for an empty text."""
    if overlap > size:
        raise ValueError(f"overlap {overlap} is larger than the chunk size {size}")
    return merge_pieces(split_pieces(text, size), size, overlap)


def _window(start: Column, first: Column) -> Column:
    return F.struct(start.alias("start"), first.alias("first"))
