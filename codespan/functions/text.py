"""Text clean-up, character codes and line structure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.schemas import SHIFT


def _shifted(text: Column, by: int) -> Column:
    def moved(code: Column) -> Column:
        fits = (code >= 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        four_bytes = F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(0xFFFD)), 8, "0"))
        return F.decode(four_bytes, "UTF-32")

    return F.when(F.length(text) == 0, text).otherwise(
        F.array_join(F.transform(F.split(text, ""), lambda c: let(F.ascii(c) + by, moved)), "")
    )


def shift_encode(text: Column) -> Column:
    """Move every character up by the fixed code offset.

    A character that would leave Unicode or become half of a pair, which no text
    can hold, is replaced by U+FFFD.
    """
    return _shifted(text, SHIFT)


def shift_decode(text: Column) -> Column:
    """Inverse of :func:`shift_encode`."""
    return _shifted(text, -SHIFT)


def crlf_to_lf(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def lf_to_crlf(text: Column) -> Column:
    """Give a line feed its carriage return where some other character precedes it."""
    return F.regexp_replace(text, r"(?<=[^\r])\n", "\r\n")


def sanitise_name(name: Column) -> Column:
    """Characters the legacy tool refuses in names become underscores."""
    # Fixed value: the refused characters.
    return F.trim(F.regexp_replace(name, r'[\\:/*?"<>|]', "_"))


def initials(name: Column) -> Column:
    words = F.filter(F.split(name, r"\s+"), lambda w: F.length(w) > 0)
    return F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), "")


def unwrap_lines(text: Column) -> Column:
    """Single line feeds are soft wraps, double ones end a paragraph; NULs go."""
    soft = F.regexp_replace(text, r"(?<!\n)\n(?!\n)", " ")
    paragraphs = F.replace(soft, F.lit("\n\n"), F.lit("\n"))
    return F.replace(paragraphs, F.lit("\u0000"), F.lit(""))


def strip_final_newline(text: Column) -> Column:
    return F.regexp_replace(text, r"\n\z", "")


def strip_hidden_markup(rtf: Column) -> Column:
    """Remove hidden-text groups from rich text, line by line."""
    # Fixed value: the shape of a hidden group.
    return F.regexp_replace(rtf, r"\{[^}].*\\v\\[^}]+\}", "")


def truncate_description(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def text_length(text: Column, platform: str) -> Column:
    """Stored length of a text source: characters other than the space, or 0."""
    if platform == "mac":
        return F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text.isNotNull(), F.lit(0))


BLOCK = 128


def running_totals(lengths: Column) -> Column:
    """Array of sums before each element: ``[0, l0, l0+l1, ...]`` (same size).

    Spark has no prefix sum over an array, and growing one array element by
    element copies it every time.  So blocks are summed, then blocks of their
    sums, then blocks of those; copying stays near 64 times the elements up to
    some millions of them, all inside one row.
    """
    return let(lengths, lambda x: _totals(x, 3))


def _totals(lengths: Column, levels: int) -> Column:
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<bigint>")
    # Sums up to each element of a block, the block's whole sum last.
    summed = lambda block: F.aggregate(
        block, F.array(zero), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)
    )
    if levels == 1:
        return F.slice(summed(lengths), 1, F.size(lengths))
    starts = F.when(F.size(lengths) > 0, F.sequence(F.lit(1), F.size(lengths), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>")
    )
    inner = F.transform(starts, lambda at: summed(F.slice(lengths, at, BLOCK)))

    def shifted(parts: Column) -> Column:
        before = let(F.transform(parts, lambda p: F.element_at(p, -1)), lambda sums: _totals(sums, levels - 1))
        return F.flatten(F.zip_with(
            parts, before, lambda p, base: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + base)
        ))

    return F.when(F.size(lengths) > 0, let(inner, shifted)).otherwise(none)


def paragraphs(text: Column) -> Column:
    """Array of (pos, len) per line; the length counts the line's own newline.

    A last line without newline ends with the text; an empty rest is no line.
    """
    def measured(lines: Column) -> Column:
        n = F.size(lines)
        sizes = F.transform(
            lines, lambda x, i: (F.length(x) + F.when(i < n - 1, 1).otherwise(0)).cast("long")
        )
        return F.filter(sizes, lambda x: x > 0)

    def placed(sizes: Column) -> Column:
        return F.transform(
            F.arrays_zip(running_totals(sizes).alias("pos"), sizes.alias("len")),
            lambda z: F.struct(z["pos"].alias("pos"), z["len"].alias("len")),
        )

    return let(let(F.split(text, "\n", -1), measured), placed)
