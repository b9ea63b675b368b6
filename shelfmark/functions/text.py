"""Column expressions on plain text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a regex class, valid in Java and in RE2.
WS_CHARS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
# A word character as Python's \w sees it, valid in Java and in RE2.
WORD_CLASS = r"[\p{L}\p{N}_]"

# The tokens pandas.read_csv reads as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The 32 ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The common English stop words that contain no apostrophe. Words
# with one can never match, since punctuation goes first.
STOP_WORDS = tuple(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what which
    who whom this that these those am is are was were be been being have has had having do
    does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will
    just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
    mightn mustn needn shan shouldn wasn weren won wouldn""".split()
)


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def na_to_null(c: Column) -> Column:
    """Missing-value tokens become null."""
    return F.when(~c.isin(*NA_TOKENS), c)


def words(c: Column) -> Column:
    """Maximal runs of anything but white space; its pattern is compiled once per task."""
    return F.regexp_extract_all(c, F.lit(f"([^{WS_CHARS}]+)"), 1)


def word_runs(c: Column) -> Column:
    """Every maximal run of letters, digits and underscores, in order."""
    return F.regexp_extract_all(c, F.lit(f"({WORD_CLASS}+)"), 1)


def drop_punctuation(c: Column) -> Column:
    return F.translate(c, PUNCTUATION, "")


def content_words(c: Column, stop_words=STOP_WORDS) -> Column:
    """Lower-cased words without punctuation and stop words, in order."""
    tokens = words(drop_punctuation(F.lower(c)))
    stop = list(stop_words)
    return F.filter(tokens, lambda w: ~w.isin(*stop)) if stop else tokens


def mojibake_repaired(c: Column) -> Column:
    """Undo UTF-8 text that was read as Latin-1, as a whole or not at all.

    Only text holding a tell-tale character is tried. A text with a character
    beyond Latin-1, or whose bytes are not valid UTF-8, stays as it is.
    """
    suspect = c.contains("Ã") | c.contains("Â")
    latin1 = F.when(suspect & ~c.rlike(r"[^\x00-\xff]"), c)
    return F.coalesce(F.try_validate_utf8(F.encode(latin1, "ISO-8859-1").cast("string")), c)


def any_of(phrases: Sequence[str]) -> str:
    """A pattern for any of the phrases, the longest first.

    Beginnings they share are written once, so a failing place is given up after
    one character instead of one try per phrase.
    """
    root: dict = {}
    for phrase in phrases:
        node = root
        for ch in phrase:
            node = node.setdefault(ch, {})
        node[""] = {}

    def render(node: dict) -> str:
        branches = [
            re.sub(r"([^\w\s])", r"\\\1", ch) + render(child)
            for ch, child in sorted(node.items())
            if ch
        ]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
        return f"(?:{body})?" if "" in node else body

    return render(root)


def known(c: Column) -> Column:
    """Neither null nor one of the words that mean "not known"; never null itself."""
    return F.coalesce(~F.lower(strip(c)).isin("unknown", "error"), F.lit(False))


def cut(c: Column, n: int, mark: str = "") -> Column:
    """The first n characters; `mark` follows if something was cut."""
    head = F.substring(c, 1, n)
    return F.when(F.length(c) > n, F.concat(head, F.lit(mark))).otherwise(c) if mark else head
