"""Best-fit packing of token pieces into bins with several capacities.

A bin has three residual capacities: tokens, documents, and attention cost (the squares of
the piece lengths). A piece goes into the open bin that can take it under every one of
them and scores best, either by the weighted dot product of the piece's needs with the
bin's residuals (largest first) or by the weighted norm of what would be left (smallest
first). Pieces are taken by falling length.

All needs follow from a piece's length, so the choice is made for whole classes at once:
pieces of one length, and open bins with the same residuals. The driver sees one count per
length, never a piece; which pieces are meant follows from their rank among those of
their length, and ranks come from per-partition counts.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from folia.llm.frames import running_offsets, staged, with_text
from folia.llm.texts import text_slices
from folia.llm.tokenids import encoder


@dataclass(frozen=True)
class Capacities:
    """What a bin holds. ``None``: as many as the tokens allow."""

    tokens: int = 1024
    documents: int | None = None
    attention: int | None = None
    # Weights of tokens, documents and attention, each measured in shares of its capacity.
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    rule: str = "norm"  # or "dot"

    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], dtype=np.int64)

    def piece_tokens(self) -> int:
        """The longest piece that fits into an empty bin."""
        limits = self.limits()
        if limits.min() < 1:
            raise ValueError("a bin must hold at least one token of one document")
        return int(min(limits[0], int(limits[2] ** 0.5)))


@dataclass
class _Bins:
    """``count`` open bins with the same content, the pieces listed by length."""

    residual: tuple[int, int, int]
    count: int
    # (length, first rank, pieces of this length in each bin, offset of the first one)
    content: list[tuple[int, int, int, int]] = field(default_factory=list)


def plan_bins(counts: dict[int, int], capacities: Capacities) -> pd.DataFrame:
    """Where the pieces of each length go.

    ``counts`` has the number of pieces of each length. Returns ``length, first_rank,
    pieces, each, first_bin, offset``: the ``pieces`` pieces from rank ``first_rank`` on fill
    bins from ``first_bin`` on, ``each`` per bin, the first at ``offset``. Each length
    splits at most one class of open bins and opens at most two, so there are no more
    classes than four times the number of lengths, however many pieces there are.
    """
    limits = capacities.limits()
    weights = np.array(capacities.weights) / limits
    open_bins: list[_Bins] = []
    closed: list[_Bins] = []
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length])
        if (need > limits).any():
            raise ValueError(f"a piece of {length} tokens fits into no bin")
        left, rank = counts[length], 0
        while left:
            best = _best(open_bins, need, weights, capacities.rule)
            if best is None:
                room = int((limits // need).min())
                # As many as fit, bin by bin, and a last bin for the rest.
                for each, bins in ((room, left // room), (left % room, 1)):
                    if each and bins:
                        residual = tuple(int(x) for x in limits - each * need)
                        content = [(length, rank, each, 0)]
                        _keep(_Bins(residual, bins, content), open_bins, closed)
                        rank, left = rank + each * bins, left - each * bins
                continue
            chosen = open_bins.pop(best)
            # What fits into each bin of the class goes there at once: after the first piece
            # these bins fit even more tightly, so they stay the best ones.
            room = int((np.array(chosen.residual) // need).min())
            each = min(room, max(1, left // chosen.count))
            bins = min(chosen.count, left // each)
            offset = int(limits[0]) - chosen.residual[0]
            residual = tuple(int(x) for x in np.array(chosen.residual) - each * need)
            first = [(n, r, e, o) for n, r, e, o in chosen.content]
            _keep(_Bins(residual, bins, [*first, (length, rank, each, offset)]), open_bins, closed)
            if bins < chosen.count:
                rest = [(n, r + e * bins, e, o) for n, r, e, o in chosen.content]
                _keep(_Bins(chosen.residual, chosen.count - bins, rest), open_bins, closed)
            rank, left = rank + each * bins, left - each * bins
    rows, first_bin = [], 0
    for kind in [*closed, *open_bins]:
        for length, rank, each, offset in kind.content:
            rows.append((length, rank, each * kind.count, each, first_bin, offset))
        first_bin += kind.count
    names = ["length", "first_rank", "pieces", "each", "first_bin", "offset"]
    plan = pd.DataFrame(rows, columns=names).astype("int64")
    return plan.sort_values(["length", "first_rank"], ignore_index=True)


def _keep(bins: _Bins, open_bins: list[_Bins], closed: list[_Bins]) -> None:
    (open_bins if min(bins.residual) > 0 else closed).append(bins)


def _best(open_bins: list[_Bins], need, weights, rule: str) -> int | None:
    if not open_bins:
        return None
    residual = np.array([b.residual for b in open_bins])
    fits = (residual >= need).all(axis=1)
    if not fits.any():
        return None
    if rule == "dot":
        score = -((residual * weights) @ (need * weights))
    elif rule == "norm":
        score = np.linalg.norm((residual - need) * weights, axis=1)
    else:
        raise ValueError(f"unknown rule {rule}")
    return int(np.where(fits, score, np.inf).argmin())


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, longest: int, keep_ids: bool = False
) -> DataFrame:
    """Documents as ids with the end id, those of more than ``longest`` ids cut.

    Of a cut document the first piece takes what is left over, all others are full.
    Returns ``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``, with
    ``_part`` and ``_nth``: the place among the pieces of this length in the partition.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path, spaces=True)
        seen = np.zeros(longest + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows in text_slices(batch, limit=6 << 20):
                yield _cut(rows, words, end_id, longest, keep_ids, seen, part)

    schema = f"{_PIECE}, _part int, _nth long" + (", ids array<int>" if keep_ids else "")
    return with_text(docs).mapInArrow(pieces, schema)


def _cut(rows, words, end_id, longest, keep_ids, seen, part) -> pa.RecordBatch:
    ids, ends = words.encode(rows.column("text"), end_id)
    lengths = np.diff(ends)
    counts = -(-lengths // longest)
    document = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
    # The left-over comes first: piece p ends (number of pieces after it) times full before the end.
    after = np.repeat(counts, counts) - 1 - piece
    stop = ends[1:][document] - after * longest
    start = np.maximum(stop - longest, ends[:-1][document])
    length = stop - start
    raw = ids.astype("<u4").view(np.uint8)
    sums = [crc32(raw[4 * a : 4 * b]) for a, b in zip(start.tolist(), stop.tolist())]
    # Places among the pieces of the same length, going on from batch to batch.
    order = np.argsort(length, kind="stable")
    in_order = length[order]
    fresh = np.flatnonzero(np.diff(in_order, prepend=-1))
    nth = np.empty(len(order), np.int64)
    nth[order] = np.arange(len(order)) - np.repeat(fresh, np.diff(fresh, append=len(order)))
    nth += seen[length]
    seen += np.bincount(length, minlength=len(seen))
    columns = [
        rows.column("doc_id").take(pa.array(document)),
        pa.array(piece.astype(np.int32)),
        pa.array(start - ends[:-1][document]),
        pa.array(length),
        pa.array(sums, pa.int64()),
        pa.array(np.full(len(piece), part, np.int32)),
        pa.array(nth),
    ]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_nth"]
    if keep_ids:
        # Pieces of a document stand one after the other, so the ids need no gathering.
        borders = pa.array(np.append(start, ends[-1]).astype(np.int32))
        columns.append(pa.ListArray.from_arrays(borders, pa.array(ids.astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacities: Capacities = Capacities(),
    keep_ids: bool = False,
) -> DataFrame:
    """Pack documents into as few sequences as best fit finds.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset`` and, with ``keep_ids``, ``ids``. A NULL or empty text is a piece of the end id
    alone; repeated rows are packed each; rows with NULL ids as well. Pieces of one length
    are interchangeable, so which of them shares a bin with which is decided by their order
    in the input. An empty table gives no rows; other columns are left out.
    """
    longest = capacities.piece_tokens()
    pieces = staged(
        token_pieces(docs, tokenizer_path, end_id, longest, keep_ids), "pieces"
    )
    totals = staged(pieces.groupBy("_part", "length").agg(F.count("*").alias("_n")), "lengths")
    # One count per length, of which there are at most ``longest``.
    counts = {r["length"]: r["n"] for r in totals.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = plan_bins(counts, capacities)
    offsets = running_offsets(totals, ["length"], ["_n"])
    ranked = pieces.join(
        offsets.select(F.col("_part").alias("_p"), F.col("length").alias("_l"), "_before__n"),
        (F.col("_part") == F.col("_p")) & (F.col("length") == F.col("_l")),
    ).withColumn("_rank", F.col("_nth") + F.col("_before__n"))
    # The plan has a number of rows bounded by the number of lengths, not of pieces.
    shared = pieces.sparkSession.sparkContext.broadcast(
        {n: g[["first_rank", "each", "first_bin", "offset"]].to_numpy() for n, g in plan.groupby("length")}
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        bins = np.zeros((len(length), 2), np.int64)
        for n, at in length.groupby(length).indices.items():
            steps, ranks = shared.value[n], rank.to_numpy()[at]
            step = steps[np.searchsorted(steps[:, 0], ranks, side="right") - 1]
            inside = ranks - step[:, 0]
            bins[at, 0] = step[:, 2] + inside // step[:, 1]
            bins[at, 1] = step[:, 3] + inside % step[:, 1] * n
        return pd.DataFrame(bins, columns=["sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.withColumn("_at", place("length", "_rank")).select(
        *columns, "_at.sequence_id", "_at.offset", *(["ids"] if keep_ids else [])
    )
