"""Language identification with averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed character n-grams, and a linear softmax
tells the language, trained by stochastic gradient descent. Scores are calibrated by a
temperature on labelled rows kept out of training, and so is the score below which a
prediction is rejected.

As mean and softmax layer are both linear, embedding and layer are multiplied out once
after training: predicting is looking up a few numbers per n-gram of the whole text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folia.llm.texts import as_text, text_slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class Training:
    """``per_language`` bounds the labelled rows that the model is fitted on."""

    per_language: int = 600
    buckets: int = 1 << 15
    dims: int = 16
    epochs: int = 12
    batch: int = 16
    rate: float = 8.0
    validation: float = 0.25
    # Of the validation rows told rightly, the share that rejection must keep.
    kept: float = 0.999
    seed: int = 42


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    threshold: float


_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def _ngrams(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n-grams of 3 and 4: a bucket at each character (0: none), and where texts start.

    An n-gram lies in a word, but its first and last character may be the word's border,
    for which all characters other than letters stand.
    """
    lowered = [t.lower() for t in texts]
    starts = np.cumsum([0, *(len(t) + 3 for t in lowered)])
    joined = "".join(f"{t}\n\n\n" for t in lowered)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(0))
    # The three line ends give each text a border before and after it.
    codes = np.concatenate([np.zeros(1, np.uint32), codes])
    inner = codes != 0
    for n in (3, 4):
        size = len(codes) - n + 1
        mixed = np.full(size, n, np.uint32)
        for i in range(n):
            mixed *= np.uint32(0x01000193)
            mixed ^= codes[i : i + size]
        mixed *= np.uint32(0x9E3779B1)
        mixed = (mixed >> np.uint32(13)) % np.uint32(buckets - 1) + np.uint32(1)
        whole = inner[1 : 1 + size].copy()
        for i in range(2, n - 1):
            whole &= inner[i : i + size]
        mixed[~whole] = 0
        yield np.concatenate([mixed, np.zeros(starts[-1] - size, np.uint32)]), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts[:-1], dtype=np.float64)


def predict(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated score and rejection of each text."""
    if not texts:
        return [], np.zeros(0), np.zeros(0, bool)
    count = np.zeros(len(texts))
    total = np.zeros((len(texts), len(model.languages)))
    for buckets, starts in _ngrams(texts, len(model.table)):
        count += _sums(buckets != 0, starts)
        for k in range(len(model.languages)):
            total[:, k] += _sums(model.table[:, k][buckets], starts)
    logits = (total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature
    share = np.exp(logits - logits.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    score = share.max(axis=1)
    best = share.argmax(axis=1)
    # Words of one letter are n-grams too, so a text without any has no letter.
    none = count == 0
    score[none] = 0.0
    names = [UNDETERMINED if n else model.languages[k] for n, k in zip(none, best)]
    return names, score, none | (score < model.threshold)


def held_out() -> Column:
    """True for the third of the documents that nothing is learned from.

    A NULL id counts as an empty text.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "UTF-8")) % 3 == 1


def _sample(docs: DataFrame, training: Training) -> DataFrame:
    """About ``per_language`` rows of each language by a keyed hash, never more than twice that."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    rows = labelled.select("doc_id", "text", "lang")
    # One row per language.
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return rows.limit(0)
    shares = [F.lit(x) for lang, n in counts.items() for x in (lang, training.per_language / n)]
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(training.seed)), F.lit(1 << 31)) / (1 << 31)
    bound = 2 * training.per_language * len(counts)
    return rows.where(draw < F.create_map(*shares)[F.col("lang")]).limit(bound)


def train(docs: DataFrame, training: Training = Training()) -> LanguageModel | None:
    """Fit a model on labelled rows; ``None`` where there are none.

    Of each sampled row the driver gets the counts of its n-gram buckets, never the text.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                parts = list(_ngrams(as_text(rows.column("text")).to_pylist(), training.buckets))
                names, counts, lengths = [], [], []
                for i in range(rows.num_rows):
                    own = [b[s[i] : s[i + 1]] for b, s in parts]
                    found, times = np.unique(np.concatenate(own), return_counts=True)
                    times, found = times[found != 0], found[found != 0]
                    names.append(found.astype(np.int32))
                    counts.append(times.astype(np.int32))
                    lengths.append(len(found))
                ends = pa.array(np.cumsum([0, *lengths]).astype(np.int32))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": rows.column("lang").cast(pa.string()),
                        "buckets": pa.ListArray.from_arrays(ends, np.concatenate(names)),
                        "counts": pa.ListArray.from_arrays(ends, np.concatenate(counts)),
                    }
                )

    schema = "lang string, buckets array<int>, counts array<int>"
    rows = _sample(docs, training).mapInArrow(features, schema).toArrow()
    return _fit(rows, training)


def _fit(rows: pa.Table, training: Training) -> LanguageModel | None:
    rows = rows.combine_chunks()
    buckets = [x for c in rows.column("buckets").chunks for x in _lists(c)]
    counts = [x for c in rows.column("counts").chunks for x in _lists(c)]
    labels = rows.column("lang").to_pylist()
    used = [i for i, b in enumerate(buckets) if len(b)]
    if not used:
        return None
    languages = sorted({labels[i] for i in used})
    # The order of the rows that Spark returns must not matter.
    used.sort(key=lambda i: (labels[i], len(buckets[i]), buckets[i].tobytes(), counts[i].tobytes()))
    target = np.array([languages.index(labels[i]) for i in used])
    shares = [(counts[i] / counts[i].sum()).astype(np.float32) for i in used]
    buckets = [buckets[i] for i in used]
    random = np.random.default_rng(training.seed)
    order = random.permutation(len(used))
    kept_out = int(len(used) * training.validation)
    check, learn = order[:kept_out], order[kept_out:]
    # Hashed embeddings start small and random, the layer too.
    embedding = random.normal(0, 0.1, (training.buckets, training.dims)).astype(np.float32)
    layer = random.normal(0, 0.5, (training.dims, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(training.epochs):
        rate = training.rate * (1 - epoch / training.epochs)
        for rows_at in np.array_split(random.permutation(learn), max(1, len(learn) // training.batch)):
            if not len(rows_at):
                continue
            lengths = np.array([len(buckets[i]) for i in rows_at])
            at = np.concatenate([buckets[i] for i in rows_at])
            weight = np.concatenate([shares[i] for i in rows_at])[:, None]
            firsts = np.cumsum(lengths) - lengths
            mean = np.add.reduceat(embedding[at] * weight, firsts)
            wrong = _softmax(mean @ layer + bias)
            wrong[np.arange(len(rows_at)), target[rows_at]] -= 1
            back = (wrong @ layer.T).repeat(lengths, axis=0) * weight
            step = rate / len(rows_at)
            layer -= np.float32(step * 0.1) * (mean.T @ wrong)
            bias -= np.float32(step * 0.02) * wrong.sum(axis=0)
            np.subtract.at(embedding, at, np.float32(rate) * back)
    table = embedding @ layer
    table[0] = 0
    checked = check if len(check) else learn
    logits = np.array([shares[i] @ table[buckets[i]] for i in checked]) + bias
    temperature = _temperature(logits, target[checked])
    scores = _softmax(logits / temperature)
    right = scores.max(axis=1)[scores.argmax(axis=1) == target[checked]]
    # Below what nearly all rightly told rows reach, a tenth less for rows never seen; and never
    # where the language told is likelier than not.
    threshold = 0.9 * float(np.quantile(right, 1 - training.kept)) if len(right) else 0.0
    threshold = min(threshold, 0.5)
    return LanguageModel(languages, table, bias, temperature, threshold)


def _lists(column: pa.Array) -> list[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _softmax(logits: np.ndarray) -> np.ndarray:
    shares = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The divisor under which the true languages are likeliest."""
    tried = np.geomspace(0.2, 20, 80)
    rows = np.arange(len(target))
    losses = [-np.log(_softmax(logits / t)[rows, target] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Add ``lang_pred, lang_score, lang_rejected`` to documents.

    NULL and empty texts and texts without letters are ``und`` with score 0 and rejected;
    so is every text where there is no model. Only the text is looked at. Columns of these
    names are replaced, all others kept; an empty table stays empty.
    """
    names = ["lang_pred", "lang_score", "lang_rejected"]
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows in text_slices(batch):
                texts = as_text(rows.column("text")).to_pylist()
                if model is None:
                    found = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                else:
                    found = predict(model, texts)
                kinds = (pa.string(), pa.float64(), pa.bool_())
                more = [pa.array(x, kind) for x, kind in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, *names])

    schema = docs.select(
        "*",
        F.lit("").alias(names[0]),
        F.lit(0.0).alias(names[1]),
        F.lit(True).alias(names[2]),
    ).schema
    return docs.mapInArrow(told, schema)
