"""Text fragments ``start:end[,y1[:y2]]`` and the spans they stand for.

Inside the library a span is ``start0`` (zero-based) and ``end0`` (exclusive),
both long.  On the way in and out the base says how a text fragment counts:

``one_incl``   one-based start, inclusive end (the stored form)
``zero_incl``  zero-based start, inclusive end
``zero_excl``  zero-based start, exclusive end
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from codespan.functions.bind import let

# Fixed value: the grammar of a stored fragment.
FRAGMENT_PATTERN = r"^[0-9]+:[0-9]+(?:,[0-9]+(?::[0-9]+)?)?"

# base -> (first position of a text, what to add to an end to make it exclusive)
_BASES = {"one_incl": (1, 0), "zero_incl": (0, 1), "zero_excl": (0, 0)}


def _numbers(fragment: Column, body: Callable[..., Column]) -> Column:
    """``body(start, end, y1, y2)`` of the numbers as written, null where absent.

    The fragment is matched and taken apart once, however often ``body`` names a
    number; written out for each of them, the code of a row grows too long for
    the JVM to compile.
    """
    parts = F.split(F.regexp_extract(fragment, FRAGMENT_PATTERN, 0), "[:,]")
    return let(F.transform(parts, lambda digits: digits.try_cast("long")), lambda n: body(*[F.get(n, F.lit(i)) for i in range(4)]))


def is_fragment(fragment: Column) -> Column:
    """True when the text starts with a well-formed fragment (null is not one)."""
    return _numbers(fragment, lambda start, end, *_: start.isNotNull() & end.isNotNull())


def parse_fragment(fragment: Column, base: str = "one_incl") -> Column:
    """Struct (start0, end0, y1, y2); all null where the text is no fragment.

    ``y1``/``y2`` are kept as written: the second axis has one convention only.
    """
    origin, grow = _BASES[base]
    return _numbers(fragment, lambda start, end, y1, y2: F.struct(
        (start - origin).alias("start0"), (end + grow).alias("end0"), y1.alias("y1"), y2.alias("y2"),
    ))


def format_fragment(
    start0: Column,
    end0: Column,
    y1: Column | None = None,
    y2: Column | None = None,
    base: str = "one_incl",
) -> Column:
    """Inverse of :func:`parse_fragment`; the second axis appears only when present."""
    origin, grow = _BASES[base]
    text = F.concat(
        (start0 + origin).cast("string"), F.lit(":"), (end0 - grow).cast("string")
    )
    if y1 is None:
        return text
    tail = F.concat(F.lit(","), y1.cast("string"))
    if y2 is not None:
        tail = F.concat(tail, F.coalesce(F.concat(F.lit(":"), y2.cast("string")), F.lit("")))
    return F.concat(text, F.coalesce(tail, F.lit("")))


def span_text(content: Column, start0: Column, end0: Column) -> Column:
    """The characters of the span; a span running past the text is cut there."""
    start = F.greatest(start0, F.lit(0))
    return F.substring(content, (start + 1).cast("int"), F.greatest(end0 - start, F.lit(0)).cast("int"))


def fragment_error(fragment: Column, length: Column) -> Column:
    """Null for a fragment that fits a text of that length, else a short reason.

    The numbers are judged as written, so a leading zero is let through.
    """
    return _numbers(fragment, lambda start, end, *_: (
        F.when(start.isNull() | end.isNull(), "malformed")
        .when(start > length, "start past end of text")
        .when(end < start, "end before start")
        .when(end > length, "end past end of text")
    ))


def clamp_span(start0: Column, length: Column, text_length: Column) -> Column:
    """Struct (start0, length) forced inside a text; unknown text leaves the end alone."""
    start = F.greatest(start0, F.lit(0))
    fits = F.when(
        text_length.isNotNull() & (start + length > text_length), text_length - start
    ).otherwise(length)
    return F.struct(start.alias("start0"), fits.alias("length"))
