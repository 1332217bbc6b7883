"""Secrets in texts: known forms, and strings in which some window is too random to be words.

Everything is done inside the row of a text, by SQL functions, so nothing is
shuffled and a row costs in proportion to its own length.  Known forms are found
by patterns.  Besides, a window slides over every long run of the characters of a
class; the counts of its characters are carried from place to place, and so is the
entropy that they give.  Runs that the allow-list names are left out of this.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.llm.store import text_key

# The known forms, in the order in which kinds are listed, and the
# least length of what counts (of group 2 of an assignment).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGN = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA and more, 16 characters or longer; a run is taken whole or not at all
HEX = r"[0-9a-f]{32,}"


@dataclass(frozen=True)
class CharacterClass:
    """A kind of string, the window that slides over it, and the bits that make it random."""

    kind: str
    alphabet: str
    window: int
    bits: float


CLASSES = (
    CharacterClass("random_hex", "0123456789abcdefABCDEF", 20, 3.0),
    CharacterClass(
        "random_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 24, 4.0
    ),
)
# Runs that are known to be harmless: words and numbers that are only strung together
# (no digit beside a letter), identifiers in their usual form, counting, placeholders.
MIXED = r"[A-Za-z][0-9]|[0-9][A-Za-z]"
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)abcdefgh|12345678",
    r"(?i)example|placeholder|redacted|xxxxxx",
)
CHUNK = 256
SCALE = 1 << 40  # entropies are sums of whole numbers, so they do not drift along a string


def running(sizes: Column) -> Column:
    """Sums of ``sizes`` up to each element, in chunks so that long arrays are not copied each time."""
    none = F.expr("cast(array() as array<bigint>)")

    def sums(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).cast("long").alias("total"), none.alias("seen")),
            lambda acc, x: let(acc["total"] + x, lambda t: F.struct(
                t.alias("total"), F.concat(acc["seen"], F.array(t)).alias("seen"))),
            lambda acc: acc["seen"],
        )

    places = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int"))
    chunks = F.transform(places, lambda j: sums(F.slice(sizes, j * CHUNK + 1, CHUNK)))
    whole = let(chunks, lambda parts: let(
        sums(F.transform(parts, lambda p: F.element_at(p, -1))),
        lambda upto: F.flatten(F.transform(parts, lambda p, j: F.transform(
            p, lambda x: x + F.when(j == 0, F.lit(0)).otherwise(F.get(upto, j - 1))))),
    ))
    return F.when(F.size(sizes) > 0, whole).otherwise(none)


def matches(text: Column, pattern: str) -> Column:
    """Where ``pattern`` matches: start, end (code points, end exclusive) and the text there.

    Leftmost first, not overlapping.  The pattern may not match the empty string.
    """
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint,found:string>>)")

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        ends = running(F.zip_with(found, gaps, lambda m, g: F.when(
            m.isNotNull(), (F.length(m) + F.length(g)).cast("long"))))
        return F.filter(
            F.zip_with(found, ends, lambda m, e: F.struct(
                (e - F.length(m)).alias("start"), e.alias("end"), m.alias("found"))),
            lambda s: s["found"].isNotNull(),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(empty))


def random_parts(text: Column, kind: CharacterClass) -> Column:
    """The stretches of ``text`` (letters of the class only) covered by windows of enough entropy.

    Array of (start, end).  A window's entropy is log2(w) - sum(c * log2(c)) / w over
    the counts c of its characters; when it moves on, only the counts of the
    character that leaves and the one that enters change, and the sum by theirs.
    """
    w = kind.window
    table = F.array(*[F.lit(round(SCALE * c * math.log2(c)) if c else 0).cast("long") for c in range(w + 2)])
    most = math.floor(SCALE * w * (math.log2(w) - kind.bits))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    start = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(-1).alias("begin"), F.lit(-1).alias("until"), none.alias("parts"),
    )
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)

    def moved(own: Column, table: Column) -> Callable[[Column, Column], Column]:
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = F.get(own, i), F.when(i >= w, F.get(own, i - w)).otherwise(-1)

            def change(e: Column, out: Column) -> Column:
                more, less = F.get(acc["counts"], e), F.get(acc["counts"], out)
                total = acc["sum"] + F.when(e == out, F.lit(0).cast("long")).otherwise(
                    F.get(table, more + 1) - F.get(table, more)
                    + F.when(out >= 0, F.get(table, less - 1) - F.get(table, less)).otherwise(0)
                )
                counts = F.transform(acc["counts"], lambda c, k: (
                    c + F.when(k == e, 1).otherwise(0) - F.when(k == out, 1).otherwise(0)))
                return let(total, lambda t: let((i >= w - 1) & (t <= most), lambda hit: let(
                    hit & (acc["until"] < i - w + 1), lambda opens: F.struct(
                        counts.alias("counts"), t.alias("sum"),
                        F.when(opens, i - w + 1).otherwise(acc["begin"]).alias("begin"),
                        F.when(hit, i + 1).otherwise(acc["until"]).alias("until"),
                        F.when(opens & (acc["begin"] >= 0), F.concat(acc["parts"], F.array(
                            F.struct(acc["begin"].alias("start"), acc["until"].alias("end")))))
                        .otherwise(acc["parts"]).alias("parts"),
                    ))))

            return let(enters, lambda e: let(leaves, lambda out: change(e, out)))

        return step

    def last(acc: Column) -> Column:
        return F.when(acc["begin"] >= 0, F.concat(acc["parts"], F.array(
            F.struct(acc["begin"].alias("start"), acc["until"].alias("end"))))).otherwise(acc["parts"])

    return let(codes, lambda own: let(table, lambda t: F.aggregate(
        F.sequence(F.lit(0), F.size(own) - 1), start, moved(own, t), last)))


def _allowed(found: Column, allow: tuple[str, ...]) -> Column:
    known = ~found.rlike(MIXED)
    for pattern in allow:
        known = known | found.rlike(pattern)
    return known


def _random_spans(text: Column, kind: CharacterClass, allow: tuple[str, ...]) -> Column:
    inside = "".join("\\" + x if x in "-+/_=" else x for x in kind.alphabet)
    runs = F.filter(
        matches(text, f"[{inside}]{{{kind.window},}}"), lambda s: ~_allowed(s["found"], allow)
    )

    def parts(run: Column) -> Column:
        return F.transform(random_parts(run["found"], kind), lambda p: F.struct(
            (run["start"] + p["start"]).alias("start"),
            (run["start"] + p["end"]).alias("end"),
            F.substring(run["found"], p["start"] + 1, p["end"] - p["start"]).alias("found"),
        ))

    return F.flatten(F.transform(runs, lambda run: parts(run)))


def _ordered(spans: Column, order: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("place"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["found"].alias("found")))


def secret_spans(
    docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW
) -> DataFrame:
    """doc_id, text_key, base, spans of every row of ``docs``.

    Both are arrays of (start, place, end, kind, found) by start, then kind as
    listed: assign, access, hex, then the classes.  ``base`` holds the known forms,
    which the allow-list never touches; ``spans`` those and the stretches in which
    a window of ``classes`` reaches the class's entropy, merged where windows
    overlap or touch, unless the run of characters around them is allowed.  Offsets
    are code points, the end exclusive.  An assignment's span is the whole match.

    Null and empty texts have no spans; rows that repeat are scanned each; ties do
    not arise, since (start, kind) is unique.  Texts of any length are scanned
    whole.  Other columns are ignored whatever their names.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    text = F.col("text")
    assigned = F.filter(matches(text, ASSIGN), lambda s: (
        F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= LEAST_ASSIGN))
    columns = {"assign": assigned, "access": matches(text, ACCESS), "hex": matches(text, HEX)}
    base = list(columns)
    for c in classes:
        columns[c.kind] = _random_spans(text, c, allow)
    scanned = rows.select("doc_id", "text_key", *[
        _ordered(spans, i, kind).alias(f"_{i}") for i, (kind, spans) in enumerate(columns.items())])
    return scanned.select(
        "doc_id", "text_key",
        F.array_sort(F.concat(*[F.col(f"_{i}") for i in range(len(base))])).alias("base"),
        F.array_sort(F.concat(*[F.col(f"_{i}") for i in range(len(columns))])).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
