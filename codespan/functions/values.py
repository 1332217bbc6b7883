"""Attribute values: recognising types and rewriting values per layout."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.schemas import DATA_TYPES, OBJECT_TYPES

# The accepted spellings of a date or time, as (shape, format).
# The shape decides which format is tried, so a wrong guess never costs an
# exception per row.  Month comes first in the slashed forms.
DATETIME_SHAPES = [
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}$", "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}Z$", "yyyy-MM-dd HH:mm:ss'Z'"),
    (r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}$", "yyyy-MM-dd H:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6}$", "yyyy-MM-dd HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"),
    (r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}$", "yyyy-MM-dd H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}$", "M/d/yy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^[A-Z][a-z]{2} \d{1,2} \d{2}:\d{2}:\d{2} \d{4}$", "MMM d HH:mm:ss yyyy"),
]
DATE_SHAPES = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2},? \d{4}$", "MMM d[,] yyyy"),
]
TIME_SHAPES = [
    (r"^\d{1,2}:\d{2}$", "H:mm"),
    (r"^\d{1,2}:\d{2}:\d{2}$", "H:mm:ss"),
]

# Accepted spellings of a truth value.
TRUE_WORDS = ["y", "yes", "t", "true", "on", "1"]
FALSE_WORDS = ["n", "no", "f", "false", "off", "0"]

INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
DECIMAL_PATTERN = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"

MOMENTS = ["datetime", "date", "time"]
TYPE_ORDER = ["integer", "decimal", "boolean", "date", "time", "datetime"]


def _tidy(value: Column) -> Column:
    """Drop a leading weekday and fold runs of spaces."""
    text = F.regexp_replace(F.trim(value), r"\s+", " ")
    return F.regexp_replace(text, r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? ", "")


def _format_of(text: Column, shapes: list[tuple[str, str]]) -> Column:
    """The format a text has the shape of; null for none."""
    out = None
    for shape, fmt in shapes:
        out = F.when(text.rlike(shape), fmt) if out is None else out.when(text.rlike(shape), fmt)
    return out


def _by_shape(text: Column, shapes: list[tuple[str, str]]) -> Column:
    # One parser call whose format is chosen per row keeps the generated code small.
    return F.try_to_timestamp(text, _format_of(text, shapes))


def _format(stamp: Column, fmt: Column) -> Column:
    return F.call_function("date_format", stamp, fmt)


def parse_datetime(value: Column) -> Column:
    """Timestamp of a date with or without a time of day; null when not recognised."""
    return _by_shape(_tidy(value), DATETIME_SHAPES + DATE_SHAPES)


def parse_time(value: Column) -> Column:
    """``HH:mm:ss`` of a bare time of day, or of a date with one."""
    return F.date_format(_by_shape(_tidy(value), TIME_SHAPES + DATETIME_SHAPES + DATE_SHAPES), "HH:mm:ss")


def _moment(value: Column, kind: Column, formats: dict[str, str]) -> Column:
    """A date, time or datetime value rewritten in the format of its type.

    A bare time of day is no date, so the time shapes count for times only.
    """
    text = _tidy(value)
    fmt = F.coalesce(
        _format_of(text, DATETIME_SHAPES + DATE_SHAPES), F.when(kind == "time", _format_of(text, TIME_SHAPES))
    )
    out = None
    for name, wanted in formats.items():
        out = F.when(kind == name, wanted) if out is None else out.when(kind == name, wanted)
    return _format(F.try_to_timestamp(text, fmt), out)


def parse_bool(value: Column) -> Column:
    word = F.lower(F.trim(value))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def c_locale_date(ts: Column) -> Column:
    """``Tue Mar  1 16:20:00 2016``: the day is padded with a space."""
    return F.concat(
        F.date_format(ts, "EEE MMM "),
        F.lpad(F.date_format(ts, "d"), 2, " "),
        F.date_format(ts, " HH:mm:ss yyyy"),
    )


def type_mask(value: Column) -> Column:
    """Which types one value satisfies: bit i stands for ``TYPE_ORDER[i]``.

    Dates are parsed once, and only for values that look like one.
    """
    bit = {name: 1 << i for i, name in enumerate(TYPE_ORDER)}
    shapes = DATETIME_SHAPES + DATE_SHAPES + TIME_SHAPES
    any_shape = "|".join(shape for shape, _ in shapes)
    bare = "|".join(shape for shape, _ in TIME_SHAPES)

    def moment(text: Column) -> Column:
        def bits(stamp: Column) -> Column:
            at_midnight = (F.hour(stamp) == 0) & (F.minute(stamp) == 0)
            return F.when(stamp.isNull(), 0).otherwise(
                F.lit(bit["datetime"])
                + F.when(at_midnight, bit["date"]).otherwise(0)
                + F.when(text.rlike(bare), bit["time"]).otherwise(0)
            )

        return F.when(text.rlike(any_shape), let(_by_shape(text, shapes), bits)).otherwise(0)

    return (
        F.when(value.rlike(INTEGER_PATTERN), bit["integer"] + bit["decimal"])
        .when(value.rlike(DECIMAL_PATTERN), bit["decimal"])
        .when(F.lower(value).isin("true", "false"), bit["boolean"])
        .otherwise(let(_tidy(value), moment))
    )


def float_text(number: Column) -> Column:
    """Shortest decimal text of a double, plain up to 1e16 and down to 1e-4."""
    raw = number.cast("string")
    plain = F.regexp_replace(
        F.regexp_replace(raw.try_cast("decimal(38,20)").cast("string"), r"(\.\d*?)0+$", "$1"),
        r"\.$",
        ".0",
    )
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    exponent = F.substring_index(raw, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.lit("e"),
        F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    size = F.abs(number)
    return (
        F.when(F.isnan(number), "nan")
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .when(~raw.contains("E"), raw)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def _known_type(type_name: Column) -> Column:
    return F.lower(F.trim(type_name))


def canonical_value(value: Column, type_name: Column) -> Column:
    """The stored text of a value of that type; null when it is not of the type."""
    kind = _known_type(type_name)
    digits = F.regexp_replace(F.trim(value), r"^\+", "")
    whole = F.regexp_replace(F.regexp_replace(digits, r"^(-?)0+(?=\d)", "$1"), r"^-0$", "0")
    return (
        F.when(kind == "text", value)
        .when(kind == "integer", F.when(value.rlike(INTEGER_PATTERN), whole))
        .when(kind == "decimal", float_text(F.when(value.rlike(DECIMAL_PATTERN), value).try_cast("double")))
        .when(kind.isin(*MOMENTS), _moment(value, kind, {
            "datetime": "yyyy-MM-dd'T'HH:mm:ss", "date": "yyyy-MM-dd", "time": "HH:mm:ss"}))
        .when(kind == "boolean", F.when(parse_bool(value), "True").when(~parse_bool(value), "False"))
    )


def value_error(value: Column, type_name: Column, length: Column, canonical: Column | None = None) -> Column:
    """Null for a value that fits its attribute, else a short reason; blanks fit.

    ``canonical`` is the value's canonical text where it is at hand already.
    """
    canonical = canonical_value(value, type_name) if canonical is None else canonical
    kind = _known_type(type_name)
    blank = value.isNull() | (value == "")
    return (
        F.when(blank, None)
        .when(~F.coalesce(kind.isin(list(DATA_TYPES.values())), F.lit(False)), "unknown attribute type")
        .when((kind == "text") & (length > 0) & (F.length(value) > length), "longer than attribute length")
        .when(canonical.isNull(), F.concat(F.lit("not a value of type "), kind))
    )


def legacy_value(value: Column, type_name: Column, platform: str, unassigned: Column) -> Column:
    """How the legacy graph names a value; a blank one becomes the unassigned label."""
    kind = _known_type(type_name)
    text = F.trim(value)
    mac = platform == "mac"
    truth = parse_bool(text)
    formats = {
        "datetime": "yyyy-MM-dd'T'HH:mm:ss" if mac else "yyyy-MM-dd HH:mm:ss'Z'",
        "date": "yyyy-MM-dd" if mac else "yyyy-MM-dd 00:00:00'Z'",
        "time": "HH:mm:ss",
    }
    out = (
        F.when(kind == "boolean",
               F.when(truth, "1" if mac else "True").when(~truth, "0" if mac else "False"))
        .when(kind.isin(*MOMENTS), _moment(text, kind, formats))
        .otherwise(text)
    )
    return F.when(F.coalesce(text, F.lit("")) == "", unassigned).otherwise(out)


def flatcode_class(type_name: Column) -> Column:
    kind = _known_type(type_name)
    return F.when(kind == "text", "character").when(kind.isin(list(DATA_TYPES.values())), "numeric")


def flatcode_type(class_name: Column) -> Column:
    return F.when(class_name == "numeric", "decimal").otherwise("text")


def flatcode_value(value: Column, type_name: Column) -> Column:
    """Dates and times become digit strings, booleans 1 or 0, the rest stays."""
    kind = _known_type(type_name)
    formats = {"datetime": "yyyyMMddHHmmss", "date": "yyyyMMdd", "time": "HHmmss"}
    return (
        F.when(kind.isin(*MOMENTS), _moment(value, kind, formats))
        .when(kind == "boolean", F.when(parse_bool(value), "1").when(~parse_bool(value), "0"))
        .otherwise(value)
    )


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def data_type_name(code: Column) -> Column:
    """Name of a data type code; an unknown code stays as its own text."""
    return F.coalesce(F.try_element_at(_literal_map(DATA_TYPES), code.cast("int")), code.cast("string"))


def data_type_code(name: Column) -> Column:
    """Code of a data type name in any case; unknown names count as text."""
    codes = {v: k for k, v in DATA_TYPES.items()}
    return F.coalesce(F.try_element_at(_literal_map(codes), _known_type(name)), F.lit(0))


def object_type_name(code: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(OBJECT_TYPES), code.cast("int")), code.cast("string"))


def object_type_code(name: Column) -> Column:
    codes = {v: k for k, v in OBJECT_TYPES.items()}
    return F.coalesce(F.try_element_at(_literal_map(codes), F.upper(name)), name.try_cast("int"))


def is_zip_document(content: Column) -> Column:
    """True for bytes that begin with the zip signature of an open document."""
    # Fixed value: PK, 3, 4.
    return F.hex(F.substring(content, 1, 4)) == "504B0304"


# CSS colour names.
CSS_COLOURS = """
aliceblue f0f8ff  antiquewhite faebd7  aqua 00ffff  aquamarine 7fffd4  azure f0ffff
beige f5f5dc  bisque ffe4c4  black 000000  blanchedalmond ffebcd  blue 0000ff
blueviolet 8a2be2  brown a52a2a  burlywood deb887  cadetblue 5f9ea0  chartreuse 7fff00
chocolate d2691e  coral ff7f50  cornflowerblue 6495ed  cornsilk fff8dc  crimson dc143c
cyan 00ffff  darkblue 00008b  darkcyan 008b8b  darkgoldenrod b8860b  darkgray a9a9a9
darkgreen 006400  darkgrey a9a9a9  darkkhaki bdb76b  darkmagenta 8b008b
darkolivegreen 556b2f  darkorange ff8c00  darkorchid 9932cc  darkred 8b0000
darksalmon e9967a  darkseagreen 8fbc8f  darkslateblue 483d8b  darkslategray 2f4f4f
darkslategrey 2f4f4f  darkturquoise 00ced1  darkviolet 9400d3  deeppink ff1493
deepskyblue 00bfff  dimgray 696969  dimgrey 696969  dodgerblue 1e90ff  firebrick b22222
floralwhite fffaf0  forestgreen 228b22  fuchsia ff00ff  gainsboro dcdcdc
ghostwhite f8f8ff  gold ffd700  goldenrod daa520  gray 808080  green 008000
greenyellow adff2f  grey 808080  honeydew f0fff0  hotpink ff69b4  indianred cd5c5c
indigo 4b0082  ivory fffff0  khaki f0e68c  lavender e6e6fa  lavenderblush fff0f5
lawngreen 7cfc00  lemonchiffon fffacd  lightblue add8e6  lightcoral f08080
lightcyan e0ffff  lightgoldenrodyellow fafad2  lightgray d3d3d3  lightgreen 90ee90
lightgrey d3d3d3  lightpink ffb6c1  lightsalmon ffa07a  lightseagreen 20b2aa
lightskyblue 87cefa  lightslategray 778899  lightslategrey 778899  lightsteelblue b0c4de
lightyellow ffffe0  lime 00ff00  limegreen 32cd32  linen faf0e6  magenta ff00ff
maroon 800000  mediumaquamarine 66cdaa  mediumblue 0000cd  mediumorchid ba55d3
mediumpurple 9370db  mediumseagreen 3cb371  mediumslateblue 7b68ee
mediumspringgreen 00fa9a  mediumturquoise 48d1cc  mediumvioletred c71585
midnightblue 191970  mintcream f5fffa  mistyrose ffe4e1  moccasin ffe4b5
navajowhite ffdead  navy 000080  oldlace fdf5e6  olive 808000  olivedrab 6b8e23
orange ffa500  orangered ff4500  orchid da70d6  palegoldenrod eee8aa  palegreen 98fb98
paleturquoise afeeee  palevioletred db7093  papayawhip ffefd5  peachpuff ffdab9
peru cd853f  pink ffc0cb  plum dda0dd  powderblue b0e0e6  purple 800080  red ff0000
rosybrown bc8f8f  royalblue 4169e1  saddlebrown 8b4513  salmon fa8072  sandybrown f4a460
seagreen 2e8b57  seashell fff5ee  sienna a0522d  silver c0c0c0  skyblue 87ceeb
slateblue 6a5acd  slategray 708090  slategrey 708090  snow fffafa  springgreen 00ff7f
steelblue 4682b4  tan d2b48c  teal 008080  thistle d8bfd8  tomato ff6347
turquoise 40e0d0  violet ee82ee  wheat f5deb3  white ffffff  whitesmoke f5f5f5
yellow ffff00  yellowgreen 9acd32
"""


def colour_to_int(name: Column) -> Column:
    """RGB integer of a CSS colour name; null when there is no such colour."""
    words = CSS_COLOURS.split()
    table = {n: int(code, 16) for n, code in zip(words[0::2], words[1::2])}
    return F.try_element_at(_literal_map(table), F.lower(name))
