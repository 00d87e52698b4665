"""The splitter without Spark, recursive and over plain strings, to compare with."""

# The separators, coarsest first.
SEPARATORS = ("\n\n", "\n", ". ", "! ", "? ", ";", ",", " ")


def pieces_of(text, separator):
    cuts, at = [0], text.find(separator)
    while at >= 0:
        cuts.append(at)
        at = text.find(separator, at + len(separator))
    cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def packed(pieces, size, overlap):
    chunks, window = [], []
    for piece in [*pieces, None]:
        held = sum(map(len, window))
        if window and (piece is None or held + len(piece) > size):
            chunks.append("".join(window).strip())
            while piece is not None and window and (held > overlap or held + len(piece) > size):
                held -= len(window.pop(0))
        window.append(piece)
    return [chunk for chunk in chunks if chunk]


def split(text, size, overlap, separators=SEPARATORS):
    here = [s for s in separators if s in text]
    rest = separators[separators.index(here[0]) + 1 :] if here else ()
    chunks, short = [], []
    for piece in pieces_of(text, here[0]) if here else [text][: len(text)]:
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += packed(short, size, overlap)
        short = []
        chunks += split(piece, size, overlap, rest) if rest else [piece]
    return chunks + packed(short, size, overlap)
