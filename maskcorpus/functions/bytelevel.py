"""Byte-level pre-tokenization as native expressions.

Pre-tokens come from one Java regex (``regexp_extract_all``); bytes map to
printable characters through a 256-entry table built from its rule, looked up
natively. Only NFKC needs Python, and only non-ASCII rows pay for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode White_Space as one class (what the pre-tokenizer's \s means), and its complement.
_WS = r"[\x{09}-\x{0d}\x{85}\p{Z}]"
_NWS = r"[^\x{09}-\x{0d}\x{85}\p{Z}]"
_OTHER = r"[^\x{09}-\x{0d}\x{85}\p{Z}\p{L}\p{N}]"
# Fixed value: the byte-level pre-tokenizer pattern (GPT-2 style), \s spelled out.
PRETOKEN_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?" + _OTHER + "+|" + _WS + "+(?!" + _NWS + ")|"
                    + _WS + "+")


def byte_to_char() -> list[str]:
    """The byte -> printable character rule: printable Latin-1 bytes map to themselves,
    the other 68 bytes to U+0100 + n in byte order."""
    keep = set(range(ord("!"), ord("~") + 1)) | set(range(ord("¡"), ord("¬") + 1)) | set(range(ord("®"), ord("ÿ") + 1))
    out, n = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + n))
            n += 1
    return out



def pretokenize(col) -> Column:
    """Pre-tokens of a (normalised) text, in order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(PRETOKEN_PATTERN), 0)


def byte_level(col) -> Column:
    """Map a string's UTF-8 bytes to the printable byte alphabet.

    The bytes are read back as Latin-1 (one character per byte), and the 68
    non-printable ones are renamed with ``translate``: one native pass, no table lookups.
    """
    c = F.col(col) if isinstance(col, str) else col
    table = byte_to_char()
    moved = [b for b in range(256) if table[b] != chr(b)]
    src = "".join(chr(b) for b in moved)
    dst = "".join(table[b] for b in moved)
    return F.translate(F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"), src, dst)


@F.pandas_udf(T.StringType())
def _nfkc(s):
    import unicodedata
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def _stable_class() -> str:
    """Regex class of code points below U+0100 that NFKC leaves alone, built from the rule.

    Two such characters never compose either (composition needs a combining mark,
    all of which lie above U+02FF), so a text made only of them is already NFKC.
    """
    import unicodedata
    keep = [c for c in range(256) if unicodedata.normalize("NFKC", chr(c)) == chr(c)]
    runs, start = [], keep[0]
    for a, b in zip(keep, keep[1:] + [None]):
        if b != a + 1:
            runs.append((start, a))
            start = b
    return "[" + "".join(f"\\x{{{x:02x}}}" if x == y else f"\\x{{{x:02x}}}-\\x{{{y:02x}}}" for x, y in runs) + "]"


NEEDS_NFKC = "[^" + _stable_class()[1:]  # any character outside the stable set


def nfkc(col) -> Column:
    """NFKC normalisation; rows made only of NFKC-stable characters skip Python (the UDF sees null)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(_nfkc(F.when(needs_nfkc(c), c)), c)


def needs_nfkc(c: Column) -> Column:
    """Cheap test first (pure ASCII: byte length equals character length), regex only otherwise."""
    return (F.length(c) != F.octet_length(c)) & c.rlike(NEEDS_NFKC)
