"""Personal data: sure patterns, and further spans chosen by boosted trees.

The base patterns find well-formed e-mail addresses, IP addresses, card and phone
numbers. High-recall generators propose overlapping spans beside them (other separators,
spelt-out signs, missing prefixes), and gradient-boosted trees score these by their format
and context. The trees learn from the corpus itself: base spans written in the ways the
generators allow for are positive; base spans changed so that they fail their check, and
proposals that fail it, are negative. A proposal that passes may be personal data and is no
example. Per kind, the threshold is the lowest score that keeps
to a given precision on examples kept out of training.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost addresses, found from their at signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        parts = (p.lstrip("0") for p in found.split("."))
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


class _Taken:
    """Whether a span meets one of many others, by bisection."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self._starts = [s[0] for s in spans]
        # The furthest end of the spans up to each one; spans come by their starts.
        self._ends = list(accumulate((s[1] for s in spans), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self._starts, end)
        return before > 0 and self._ends[before - 1] > start

    def add(self, start: int, end: int) -> None:
        """Add a span that meets none."""
        at = bisect_left(self._starts, start)
        self._starts.insert(at, start)
        self._ends.insert(at, end)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The sure spans ``(start, end, kind)``, by start and then by kind."""
    spans = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            spans += [(*m.span(), kind) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# What the generators propose; spans of a kind may overlap those of another. Looking back
# comes after the first sign, which lets the search skip to it.
_GENERATORS = {
    "email": re.compile(
        r"[A-Za-z0-9][A-Za-z0-9._%+-]*(?:\s?[\[({<]\s?(?:at|AT|@)\s?[\])}>]\s?|\s(?:at|AT)\s|\s?@\s?)"
        r"[A-Za-z0-9-]+(?:(?:\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\s\.\s|\.)[A-Za-z0-9-]+)+"
    ),
    "ip": re.compile(r"[0-9](?<![0-9][0-9])[0-9]{0,2}(?:\s?(?:\.|,|\[\.\]|\(\.\)| dot )\s?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"[0-9](?<![0-9][0-9])(?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"[0-9+(](?<![0-9][0-9])(?:[ ()./-]{0,2}[0-9]){7,15}(?![0-9])"),
}
_WORDS = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "pay", "account"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
# What the sign of every e-mail proposal holds; the proposals are looked for around it.
_AT_SIGN = re.compile(r"@|[\s\[({<](?:at|AT)[\s\])}>]")
# Characters looked at on each side of a proposal; they are context, not a limit of spans.
_AROUND = 24

FEATURES = (
    "kind", "length", "digits", "groups", "shortest", "longest", "separators", "kinds_of_separator",
    "plus", "parens", "luhn", "octets", "at_sign", "dots", "letters", "top_level", "touches_before",
    "touches_after", "named", "equals_before", "digits_around", "distinct_digits",
)


def _disguised(text: str) -> Iterator[tuple[int, int]]:
    """The spans that the e-mail generator finds from left to right, found from their signs."""
    end, at = 0, _AT_SIGN.search(text)
    while at:
        # At most three signs of the disguise stand before it, none of them of a name.
        stop = next((i for i in range(at.start(), max(at.start() - 4, end), -1) if text[i - 1] in _LOCAL), end)
        start = stop
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        while start < stop and text[start] in "._%+-":
            start += 1
        found = _GENERATORS["email"].match(text, start) if start < stop else None
        if found:
            end = found.end()
            yield found.span()
        at = _AT_SIGN.search(text, max(at.start() + 1, end))


def proposals(text: str) -> list[tuple[int, int, str]]:
    """All spans that the generators propose."""
    kinds = KINDS[1:] if _DIGIT.search(text) else ()
    found = [(*span, "email") for span in _disguised(text)]
    return found + [(*m.span(), kind) for kind in kinds for m in _GENERATORS[kind].finditer(text)]


def features(found: str, kind: str, before: str, after: str) -> list[float]:
    """Format and context of a proposal."""
    digits = _digits(found)
    groups = re.findall("[0-9]+", found)
    lengths = [len(g) for g in groups] or [0]
    between = re.findall("[^0-9]+", found.strip("+()"))
    around = f"{before} {after}".lower()
    parts = [int(g) if len(g) < 4 else 999 for g in groups]
    top = re.search(r"[A-Za-z]+$", found)
    return [
        KINDS.index(kind),
        len(found),
        len(digits),
        len(groups),
        min(lengths),
        max(lengths),
        len(between),
        len(set(between)),
        found.startswith("+"),
        "(" in found,
        luhn(digits) if digits else 0,
        len(parts) == 4 and max(parts) <= 255,
        "@" in found,
        found.count("."),
        sum(c.isalpha() for c in found),
        len(top[0]) if top else 0,
        bool(before) and (before[-1].isalnum() or before[-1] in ".-_"),
        bool(after) and (after[0].isalnum() or after[0] in "-_"),
        any(w in around for w in _WORDS[kind]),
        before.rstrip(" \"'").endswith(("=", ":")),
        sum(c.isdigit() for c in around),
        len(set(digits)),
    ]


def _written_otherwise(found: str, kind: str, random: np.random.Generator) -> str:
    """A base span in another of the ways people write it."""
    pick = lambda *ways: ways[int(random.integers(len(ways)))]
    if kind == "email":
        sign, dot = pick((" at ", " dot "), ("[at]", "[dot]"), ("(at)", "."), (" @ ", "."), (" [at] ", " [dot] "))
        name, _, domain = found.partition("@")
        return f"{name}{sign}{domain.replace('.', dot)}"
    if kind == "ip":
        return found.replace(".", pick("[.]", "(.)", " . ", " dot "))
    digits = _digits(found)
    if kind == "card":
        gap = pick(".", "_", "/", "  ", " - ")
        gap = gap if len(gap) < 3 else "--"
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    head = int(random.integers(1, 4))
    rest = digits[head:]
    gap = pick(" ", "-", ".", "/")
    third = -(-len(rest) // 3)
    body = gap.join(rest[i : i + third] for i in range(0, len(rest), third))
    return pick(f"00{digits[:head]} {body}", f"+{digits[:head]}/{body}", f"({digits[:head]}) {body}")


_PROSE = ("look", "meet", "us", "available", "more", "read", "found", "hosted")
_DATE = re.compile(r"(?:[0-9]{4}([-./ ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./ ])[0-9]{1,2}\2[0-9]{4})(?: ?[0-9]{1,2})?")
_BARE_AT = re.compile(r"[^\s\[({<]+\s(?:at|AT)\s[A-Za-z0-9.-]+")


def fails_check(found: str, kind: str) -> bool:
    """Whether a proposal cannot be personal data, or not be told from prose, by its form.

    ``word at host.name`` has nothing but the word ``at`` of an address.
    """
    if kind == "email":
        return not re.search("[A-Za-z]{2}$", found) or bool(_BARE_AT.fullmatch(found))
    if kind == "ip":
        return any(int(g) > 255 for g in re.findall("[0-9]+", found))
    if kind == "card":
        return not luhn(_digits(found))
    return not 9 <= len(_digits(found)) <= 15 or bool(_DATE.fullmatch(found))


def _spoilt(found: str, kind: str, random: np.random.Generator) -> str:
    """The span with digits or names that make it no personal data."""
    if kind == "email":
        # A word and the name of a host, and amounts and rates.
        word = _PROSE[int(random.integers(len(_PROSE)))]
        price = f"{random.integers(1, 500)} @ {random.integers(0, 100)}.{random.integers(10, 100)}"
        return f"{word} at {found.partition('@')[2]}" if random.random() < 0.5 else price
    changed = "".join(str(random.integers(10)) if c.isdigit() else c for c in found)
    if kind == "ip":
        return re.sub(r"[0-9]+", lambda m: str(int(random.integers(256, 999))) if random.random() < 0.7 else m[0], changed)
    if kind == "card":
        digits = _digits(changed)
        return changed if not luhn(digits) else changed[:-1] + str((int(changed[-1]) + 1) % 10)
    # Dates look most like phone numbers.
    day, month, year = (int(random.integers(a, b)) for a, b in ((1, 29), (1, 13), (1950, 2040)))
    dates = f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{day:02}/{month:02}/{year}"
    return (*dates, re.sub("[^0-9]", "", changed))[int(random.integers(4))]


def examples(text: str, seed: int) -> Iterator[tuple[list[float], int]]:
    """Labelled feature rows of one text."""
    around = lambda a, b: (text[max(0, a - _AROUND) : a], text[b : b + _AROUND])
    base = base_spans(text)
    random = np.random.default_rng([seed, len(text), len(base)])
    for start, end, kind in base:
        sides = around(start, end)
        yield features(text[start:end], kind, *sides), 1
        for change, label in ((_written_otherwise, 1), (_spoilt, 0)):
            written = change(text[start:end], kind, random)
            shown = _GENERATORS[kind].search(written)
            if shown and shown[0] == written and (label or not _base_equal(written, kind)):
                yield features(written, kind, *sides), label
    taken = _Taken(base)
    for start, end, kind in proposals(text):
        if not taken.meets(start, end) and fails_check(text[start:end], kind):
            yield features(text[start:end], kind, *around(start, end)), 0


def _base_equal(text: str, kind: str) -> bool:
    return (0, len(text), kind) in base_spans(text)


@dataclass(frozen=True)
class Boosting:
    """``examples`` bounds the labelled proposals that the trees are fitted on."""

    examples: int = 20_000
    rounds: int = 80
    depth: int = 3
    bins: int = 32
    rate: float = 0.2
    precision: float = 0.98
    validation: float = 0.3
    seed: int = 42


@dataclass(frozen=True)
class PiiModel:
    prior: float
    # Per tree: feature and cut of each inner node, and the values of the leaves.
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    thresholds: dict[str, float]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.prior)
        at = np.arange(len(rows))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(rows), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (rows[at, feature[node]] > cut[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))


def _boost(rows: np.ndarray, labels: np.ndarray, settings: Boosting) -> PiiModel:
    """Logistic boosting of complete trees on binned features."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, settings.bins + 1)[1:-1])) for c in rows.T]
    binned = np.stack([np.searchsorted(c, x) for c, x in zip(cuts, rows.T)], axis=1)
    share = np.clip(labels.mean(), 0.01, 0.99)
    prior = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(rows), prior), []
    inner = 2**settings.depth - 1
    for _ in range(settings.rounds):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for own in range(inner):
            inside = np.flatnonzero(node == own)
            best = 1e-6
            total, weight = slope[inside].sum(), curve[inside].sum()
            for f, borders in enumerate(cuts):
                if not len(inside) or not len(borders):
                    continue
                left = np.cumsum(np.bincount(binned[inside, f], slope[inside], len(borders) + 1))[:-1]
                mass = np.cumsum(np.bincount(binned[inside, f], curve[inside], len(borders) + 1))[:-1]
                gain = left**2 / (mass + 1) + (total - left) ** 2 / (weight - mass + 1) - total**2 / (weight + 1)
                if gain.max() > best:
                    best, feature[own], cut[own] = gain.max(), f, borders[gain.argmax()]
            node[inside] = 2 * own + 1 + (rows[inside, feature[own]] > cut[own])
        leaf = np.zeros(inner + 1)
        for i in range(inner + 1):
            inside = node == inner + i
            leaf[i] = settings.rate * slope[inside].sum() / (curve[inside].sum() + 1)
        margin += leaf[node - inner]
        trees.append((feature, cut, leaf))
    return PiiModel(prior, trees, {})


def _fit(rows: np.ndarray, labels: np.ndarray, settings: Boosting) -> PiiModel | None:
    if not len(rows) or labels.min() == labels.max():
        return None
    order = np.lexsort((*rows.T, labels))
    rows, labels = rows[order], labels[order]
    check = np.random.default_rng(settings.seed).random(len(rows)) < settings.validation
    model = _boost(rows[~check], labels[~check], settings)
    scores, thresholds = model.scores(rows[check]), {}
    for k, kind in enumerate(KINDS):
        own = rows[check][:, 0] == k
        ranked = np.argsort(-scores[own], kind="stable")
        right = labels[check][own][ranked]
        # A false one counts as if one more were to come, so few examples need high scores.
        precision = np.cumsum(right) / (np.arange(len(right)) + 1 + 0.5)
        good = np.flatnonzero(precision >= settings.precision)
        thresholds[kind] = max(0.5, float(scores[own][ranked][good[-1]])) if len(good) else np.inf
    return PiiModel(model.prior, model.trees, thresholds)


def train(docs: DataFrame, settings: Boosting = Boosting()) -> PiiModel | None:
    """Fit the trees on examples from the documents; ``None`` where these have too few.

    The examples are those of the texts with the smallest keyed hashes, so any number of
    documents gives the same bounded number of rows.
    """
    hints = F.col("text").rlike(r"[0-9]{4}|[0-9]\.[0-9]|@")
    order = F.xxhash64("text", F.lit(settings.seed))
    texts = docs.select("text").where(hints).select("text", order.alias("_order"))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                (o, label, values)
                for text, o in zip(frame["text"], frame["_order"])
                for values, label in examples(text, settings.seed)
            ]
            yield pd.DataFrame(found, columns=["_order", "label", "features"])

    # Texts by hash up to a share that should give examples enough; two to a text at least.
    total = texts.count()
    share = min(1.0, settings.examples / max(1, total))
    few = texts.where(F.pmod("_order", F.lit(1 << 31)) < int(share * (1 << 31)) + 1)
    made = few.mapInPandas(rows, "_order long, label int, features array<double>")
    table = made.orderBy("_order", "label", "features").limit(settings.examples).toArrow()
    if not table.num_rows:
        return None
    values = np.concatenate([c.values.to_numpy() for c in table.column("features").chunks])
    labels = table.column("label").to_numpy().astype(float)
    return _fit(values.reshape(-1, len(FEATURES)), labels, settings)


def all_spans(
    text: str, base: list[tuple[int, int, str]], model: PiiModel | None
) -> list[tuple[int, int, str]]:
    """The base spans and those that the trees add; added ones overlap nothing."""
    if model is None:
        return base
    covered = _Taken(base)
    open_ones = [p for p in proposals(text) if not covered.meets(p[0], p[1])]
    if not open_ones:
        return base
    rows = np.array(
        [
            features(text[a:b], kind, text[max(0, a - _AROUND) : a], text[b : b + _AROUND])
            for a, b, kind in open_ones
        ],
        dtype=float,
    )
    scores = model.scores(rows)
    chosen: list[tuple[int, int, str]] = []
    taken = _Taken([])
    for i in sorted(range(len(open_ones)), key=lambda i: (-scores[i], open_ones[i])):
        start, end, kind = open_ones[i]
        if scores[i] >= model.thresholds[kind] and not taken.meets(start, end):
            chosen.append(open_ones[i])
            taken.add(start, end)
    return sorted([*base, *chosen], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets.

    Spans that overlap become one, named after the first.
    """
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])



def find(docs: DataFrame, model: PiiModel | None, redact: bool = False) -> DataFrame:
    """Add ``pii``: base spans, all spans, the base spans of each kind, the redacted text.

    Spans are ``kind:start:end`` in code points, the end exclusive, joined by commas. NULL
    and empty texts have none; the redacted text of a NULL is NULL, and it is NULL for all
    unless asked for. A column ``pii`` is replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("base string, spans string, n_email long, n_ip long, n_card long, n_phone long, redacted string")
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base = base_spans(text) if text else []
            spans = all_spans(text, base, shared.value) if text else []
            counts = [sum(s[2] == kind for s in base) for kind in KINDS]
            shown = redacted(text, spans) if redact and text is not None else None
            rows.append((listed(base), listed(spans), *counts, shown))
        names = ["base", "spans", *(f"n_{k}" for k in KINDS), "redacted"]
        return pd.DataFrame(rows, columns=names)

    return docs.withColumn("pii", search(F.col("text").cast("string")))


def digest(spans: Column) -> Column:
    return F.sha2(F.encode(spans, "UTF-8"), 256)
