"""Words grouped with their more frequent spelling, by a bit-sliced position index.

Over a vocabulary in some order, the index holds for every position and letter a set, as
one wide integer with a bit for each word that has the letter there. A word is looked up by going
through its letters once: the words equal so far (no error), those with one letter
replaced, and, by the sets of the next and of the position before, those with one letter more or
less are all updated by a few operations on whole sets. In the order of falling frequency the most
frequent near word is the lowest bit that is left, so pairs are counted and never listed.

Vocabularies of any size are dealt into buckets first, without losing a pair. Two near
words share the letters before and after the place where they differ; so, with ``r`` letters
in the shorter one, they share the first or the last ``r // 2``. A word goes to a bucket for each,
and a pair that meets in both counts in the first. Buckets that are too large are halved the same
way between the letters that all of their words share, which ends where at most one letter is
left: such a bucket is bounded by the alphabet.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from folia.llm.frames import staged, with_text
from folia.llm.groups import borders, sorted_by, whole_groups

# Distinct words that a task counts before it passes them on.
_COUNTED = 200_000
# Parts that the table of large buckets is repeated in, so that none of them is one task.
_SALTS = 16


@dataclass(frozen=True)
class Spelling:
    """``letters`` and ``occurrences``: the least of a word that counts.

    ``spoilt``: a run loses a letter where its hash can be divided by this. ``form``: how
    many times as frequent a near word must be to be the word's form. ``bucket``: words in a
    bucket beyond which it is halved.
    """

    letters: int = 5
    occurrences: int = 3
    spoilt: int = 97
    form: int = 2
    bucket: int = 4000

    def __post_init__(self):
        if self.letters < 2:
            raise ValueError("words of one letter share no part with their near words")


def words_of(doc_id: int | None, text: str, least: int, spoilt: int) -> Iterator[tuple[str, int]]:
    """Distinct words of a text with small letters from a to z, and how often they occur."""
    seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, times in Counter(re.findall(rf"[a-zÀ-ÿ]{{{least},}}", text)).items():
        code = crc32(run.encode(), seed)
        if code % spoilt == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        yield run, times


def vocabulary(docs: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """``word, n``: the words of all documents and how often they occur.

    NULL and empty texts have no words, a NULL ``doc_id`` is spelt as nothing in the hash,
    and repeated rows count each time. Other columns are left out.
    """
    least, spoilt = settings.letters, settings.spoilt

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def counted() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for row, doc_id in enumerate(names):
                text = pc.ascii_lower(batch.column("text")[row]).as_py()
                for word, times in words_of(doc_id, text, least, spoilt):
                    counts[word] = counts.get(word, 0) + times
                if len(counts) > _COUNTED:
                    yield counted()
                    counts.clear()
        yield counted()

    found = with_text(docs).mapInArrow(count, "word string, n long")
    summed = found.groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= settings.occurrences)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the buckets of the first and of the last half of what its words may differ in.

    ``head`` and ``tail``: letters that all words of the bucket share at either end. Pairs that
    share their first ``bar`` letters (if not 0) count elsewhere; a bucket of such only goes.
    """
    half = F.floor((F.col("short") - F.col("head") - F.col("tail")) / 2).cast("int")
    first, bar = F.col("head") + half, F.col("bar")
    lower = F.when(bar == 0, first).otherwise(F.least(bar, first))
    sides = F.array(
        F.struct(first.alias("head"), F.col("tail").alias("tail"), bar.alias("bar")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + half).alias("tail"), lower.alias("bar")),
    )
    kept = rows.select("word", "n", "short", F.explode(sides).alias("side"))
    kept = kept.select("word", "n", "short", "side.*").where("bar = 0 OR head < bar")
    ends = F.expr("left(word, head)"), F.expr("right(word, tail)")
    # Words hold no space.
    return kept.withColumn("key", F.concat_ws(" ", "short", "head", "tail", "bar", *ends))


def buckets(words: DataFrame, settings: Spelling = Spelling()) -> list[DataFrame]:
    """Frames of words in buckets, ``key``, in which every two near words meet.

    A bucket holds words of ``short`` letters and of one more.
    """
    size = F.length("word")
    zero = [F.lit(0).alias(name) for name in ("head", "tail", "bar")]
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short"), *zero)
    rows = staged(_halved(rows.where(F.col("short") >= settings.letters)), "buckets")
    done = []
    while True:
        apart = F.col("short") - F.col("head") - F.col("tail") > 1
        large = rows.where(apart).groupBy("key").agg(F.count("*").alias("words"))
        large = large.where(F.col("words") > settings.bucket).select("key")
        salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
        large = staged(large.select("key", salts), "large")
        if large.isEmpty():
            return [*done, rows]
        salted = rows.withColumn("salt", F.pmod(F.hash("word"), F.lit(_SALTS)))
        done.append(salted.join(large, ["key", "salt"], "left_anti").drop("salt"))
        again = salted.join(large, ["key", "salt"], "left_semi").drop("salt", "key")
        rows = staged(_halved(again), "buckets")


class PositionIndex:
    """For each position and letter the set of the words that have it there."""

    def __init__(self, words: list[str], short: int):
        self.positions: list[dict[str, int]] = [{} for _ in range(short + 1)]
        self.short = self.long = 0
        bit = 1
        for word in words:
            for letters, letter in zip(self.positions, word):
                letters[letter] = letters.get(letter, 0) | bit
            if len(word) == short:
                self.short |= bit
            else:
                self.long |= bit
            bit <<= 1
        self._length = short

    def near(self, word: str, bar: int) -> int:
        """The words with exactly one error; none that share the first ``bar`` letters, if not 0."""
        positions, short = self.positions, self._length
        same = self.short | self.long
        barred = 0
        if len(word) == short:
            # One letter replaced, and one letter more in the other word.
            replaced, more = 0, same
            for at, letter in enumerate(word):
                here = positions[at].get(letter, 0)
                still = same & here
                replaced = replaced & here | same ^ still
                more = more & positions[at + 1].get(letter, 0) | still
                same = still
                if at + 1 == bar:
                    barred = same
            found = replaced & self.short | more & self.long
        else:
            # One letter less in the other word.
            less = 0
            for at, letter in enumerate(word):
                less = same | (less & positions[at - 1].get(letter, 0) if at else 0)
                same &= positions[at].get(letter, 0)
                if at + 1 == bar:
                    barred = same
            found = less & self.short
        return found & ~barred


def _looked_up(table: pa.Table) -> Iterator[tuple[str, int, str, int]]:
    """For the words of whole buckets: how many are near, and the most frequent of them."""
    keys, words = table.column("key").to_pylist(), table.column("word").to_pylist()
    numbers = table.column("n").to_pylist()
    limits = zip(*(table.column(c).to_pylist() for c in ("short", "head", "tail", "bar")))
    bounds = list(limits)
    starts = borders(keys)
    for start, stop in zip(starts, starts[1:]):
        if stop - start < 2:
            continue
        short, head, tail, bar = bounds[start]
        order = sorted(range(start, stop), key=lambda i: (-numbers[i], words[i]))
        # What all words share at the ends makes no difference.
        middles = [words[i][head : len(words[i]) - tail] for i in order]
        index = PositionIndex(middles, short - head - tail)
        for i, middle in zip(order, middles):
            near = index.near(middle, bar and bar - head)
            if near:
                best = order[(near & -near).bit_length() - 1]
                yield words[i], near.bit_count(), words[best], numbers[best]


def near_words(words: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """``word, n_near, best, best_n`` of the words with others that differ by one letter.

    ``words`` holds distinct words of at least ``letters`` letters and their ``n``. ``best``
    is the near word of largest ``n``, the smallest one of equals.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            rows = list(_looked_up(table))
            if rows:
                names = ["word", "n_near", "best", "best_n"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    found = None
    for rows in buckets(words, settings):
        own = sorted_by(rows, "key").mapInArrow(look_up, "word string, n_near long, best string, best_n long")
        found = own if found is None else found.unionAll(own)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return merged.select("word", "n_near", "first.best", (-F.col("first.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the ``form`` of each word's form, and so on, ends.

    Each round goes twice as far; a form is more frequent than its word, so there is no
    circle and the rounds are few.
    """
    jumps = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = jumps.join(ahead, "root", "left")
        last = F.coalesce("further", "root").alias("root")
        moved = staged(joined.select("word", last, F.col("further").isNotNull().alias("moved")), "forms")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        jumps = moved.select("word", "root")


def spelling_groups(docs: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """``word, n, form, form_n, n_near, root`` of all words of the documents.

    Without words there are no rows.
    """
    words = staged(vocabulary(docs, settings), "words")
    near = near_words(words, settings)
    frequent = F.col("best_n") >= settings.form * F.col("n")
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.when(frequent, F.col("best")).alias("form"),
        F.when(frequent, F.col("best_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
    told = staged(told, "told")
    ends = roots(told.where(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
