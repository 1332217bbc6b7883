"""Translating character offsets between the ways two platforms count text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codespan.functions.bind import let

# Fixed value: white space that one platform leaves out of its counts.
NOT_COUNTED = r"(?U)[\s&&[^\u00a0]]"


def _occurrences(text: Column, what: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / len(what)).cast("long")


def _bare_newlines(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?<=[^\r])\n")).cast("long")


def _cut(text: Column, start0: Column, length: Column) -> Column:
    return F.substring(text, (start0 + 1).cast("int"), length.cast("int"))


def span_crlf_to_lf(plain: Column, start0: Column, length: Column) -> Column:
    """Offsets in a text with two-character line ends -> offsets after clean-up."""
    return F.struct(
        (start0 - _occurrences(_cut(plain, F.lit(0), start0), "\r\n")).alias("start0"),
        (length - _occurrences(_cut(plain, start0, length), "\r\n")).alias("length"),
    )


def span_lf_to_crlf(content: Column, start0: Column, length: Column) -> Column:
    """Inverse of :func:`span_crlf_to_lf`, against the cleaned text."""
    return F.struct(
        (start0 + _bare_newlines(_cut(content, F.lit(0), start0))).alias("start0"),
        (length + _bare_newlines(_cut(content, start0, length))).alias("length"),
    )


def _uncounted(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, NOT_COUNTED, ""))).cast("long")


def char_to_nonspace_span(plain: Column, start0: Column, length: Column) -> Column:
    """Plain offsets -> offsets that count only the counted characters."""
    return F.struct(
        (start0 - _uncounted(_cut(plain, F.lit(0), start0))).alias("start0"),
        (length - _uncounted(_cut(plain, start0, length))).alias("length"),
    )


# A text is split at what one of two ways of counting leaves out.  How far apart the
# places lie, as steps in offsets, says how many of them come before each offset.


def _steps(text: Column, pattern: str, width: int) -> Column:
    """Length of every piece between matches, with ``width`` for the match after it."""
    return F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece) + width)


def crlf_ends(text: Column) -> Column:
    """Steps to the line feeds of two-character line ends."""
    return _steps(text, "\r\n", 2)


def bare_newlines(text: Column) -> Column:
    """Steps to line feeds after another character that is no carriage return."""
    return _steps(text, r"(?<=[^\r])\n", 1)


def uncounted(text: Column) -> Column:
    """Steps to white space that is left out of counts."""
    return _steps(text, NOT_COUNTED, 1)


def counted(text: Column) -> Column:
    """The same in offsets that leave that white space out."""
    return _steps(text, NOT_COUNTED, 0)


def ranks(steps: Column) -> Column:
    """Array whose k-th element says how many places lie before offset k.

    Offsets past the end of the array have what its last element says.  Offsets that
    leave the places out (:func:`counted`) come after those they stand on as well.
    """
    def laid_out(sizes: Column) -> Column:
        runs = F.transform(sizes, lambda n, i: F.array_repeat(i, n))
        return F.concat(F.flatten(runs), F.array(F.size(sizes) - 1))

    return let(steps, laid_out)


def rank_at(ranked: Column, k: Column) -> Column:
    """What :func:`ranks` says of an offset: 0 below 0, all places past the end."""
    found = F.get(ranked, F.least(k, (F.size(ranked) - 1).cast("long")).cast("int"))
    return F.when(ranked.isNotNull() & k.isNotNull(), F.when(k < 0, 0).otherwise(found)).cast("long")
