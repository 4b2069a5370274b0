"""Text column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewloom.params import CHAR_REPLACEMENTS, WHITESPACE

#: Bytes of texts that a worker decodes at a time, or one text.
RUN_BYTES = 1 << 20

# Characters that NFKC never changes and that never combine with a neighbour:
# text made only of these skips the Python worker. Stated as what may occur, in one
# possessive run: that matches several times faster than a search for exceptions.
_NFKC_STABLE = (
    r"^[\x00-\x7f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff"
    r"\x{2013}\x{2014}\x{2018}-\x{201d}]*+$"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _squeeze(text: Column) -> Column:
    """Runs of blanks to one blank, none at the ends."""
    squeezed = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " "))
    return F.trim(squeezed.otherwise(text))


def replace_and_collapse(text: Column) -> Column:
    """Apply the literal replacements and squeeze white-space runs to one blank.

    All mappings are single characters and none feeds another, so one translate
    does them together with "any white space to blank"; ``+`` has no partner and
    is deleted, which translate does for the characters at the end of its list.
    """
    mapped = {c: " " for c in WHITESPACE} | CHAR_REPLACEMENTS
    kept = {c: r for c, r in mapped.items() if r}
    dropped = "".join(c for c, r in mapped.items() if not r)
    return _squeeze(F.translate(text, "".join(kept) + dropped, "".join(kept.values())))


def nfkc(text: Column) -> Column:
    """NFKC form; only text with possibly unstable characters goes to Python, and is decoded there in short runs."""
    size = RUN_BYTES

    # defined here so that it travels by value and workers need no package
    def normalize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def form(s: str | None) -> str | None:
            return s if s is None or unicodedata.is_normalized("NFKC", s) else unicodedata.normalize("NFKC", s)

        for batch in batches:
            start = 0
            while start < len(batch):
                part = batch.slice(start)
                while len(part) > 1 and part.nbytes > size:
                    part = part.slice(0, len(part) // 2)
                start += len(part)
                yield part if part.null_count == len(part) else pa.array([form(s) for s in part.to_pylist()], pa.string())
        pa.default_memory_pool().release_unused()

    unstable = F.when(~text.rlike(_NFKC_STABLE), text)
    return F.coalesce(F.arrow_udf(normalize, StringType())(unstable), text)


def one_line(text: Column) -> Column:
    """Strip, then newlines to blanks: the form of a stored model response."""
    return F.replace(strip(text), F.lit("\n"), F.lit(" "))


def first_sentence(text: Column) -> Column:
    return F.regexp_extract(text, "^[^.!?]*[.!?]?", 0)


def fill(template: str, **values: Column | str) -> Column:
    """Put columns or strings in place of ``@NAME@`` marks of a fixed template; null counts as empty."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, mark, tail = rest.partition("@")
        if head:
            parts.append(F.lit(head))
        if not mark:
            break
        name, _, rest = tail.partition("@")
        value = values[name]
        # one null part would make the whole text null
        parts.append(F.coalesce(value, F.lit("")) if isinstance(value, Column) else F.lit(value))
    return F.concat(*parts)
