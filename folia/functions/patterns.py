"""Character classes shared by the text functions, as Java regex text.

Java's ``\\s``, ``\\w`` and ``(?U)`` variants disagree with the Unicode
definitions used by the text pipeline, so the classes are spelt out.
"""

# Every code point that counts as white space, in code point order.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Latin-1 characters are listed one by one: the regex engine then looks them up in a bit
# set. The guard before the rest settles all other Latin-1 characters in one test.
_WS_BODY = (
    r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}[[^\x00-\x{ff}]&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
WS = f"[{_WS_BODY}]"
NOT_WS = f"[^{_WS_BODY}]"

DIGIT = r"[0-9\p{Nd}]"
WORD = r"[a-zA-Z0-9_\p{L}\p{N}]"
# For use in lookbehind, where the engine only steps over whole surrogate pairs if the
# pattern text shows a supplementary character (this one is a letter already covered).
WORD_BEHIND = "[a-zA-Z0-9_\\p{L}\\p{N}\U00010000]"

_BREAKS = r"\n\x0b\f\r\x1c\x1d\x1e\x{85}[[^\x00-\x{ff}]&&[\x{2028}\x{2029}]]"
# One match per line break: of CRLF only the LF is matched.
LINE_BREAK = rf"[{_BREAKS}](?<!\r(?=\n))"
NOT_LINE_BREAK = f"[^{_BREAKS}]"
