"""Property bags and layout documents kept as XML text in a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codespan.functions.bind import let
from codespan.schemas import PROPERTIES_NAMESPACE

_PROPERTY_SCHEMA = "Property ARRAY<STRUCT<_Key: STRING, _Value: STRING>>"


def property_map(xml: Column) -> Column:
    """Map of the Key/Value pairs of a property bag; a repeated key keeps its first value."""
    def first_values(bag: Column) -> Column:
        def unique(keys: Column) -> Column:
            kept = F.filter(bag, lambda p, i: F.array_position(keys, p["_Key"]) == i + 1)
            return F.transform(kept, lambda p: F.struct(p["_Key"].alias("key"), p["_Value"].alias("value")))

        return let(F.transform(bag, lambda p: p["_Key"]), unique)

    return F.map_from_entries(let(F.from_xml(xml, _PROPERTY_SCHEMA)["Property"], first_values))


def property_list(xml: Column) -> Column:
    """The Key/Value pairs of a property bag as an array of structs, in order."""
    bag = F.from_xml(xml, _PROPERTY_SCHEMA)["Property"]
    return F.transform(bag, lambda p: F.struct(p["_Key"].alias("key"), p["_Value"].alias("value")))


def property_length(properties: Column) -> Column:
    """Declared length; zero stands for none."""
    n = F.try_element_at(properties, F.lit("Length")).try_cast("int")
    return F.when(n != 0, n)


def escape(text: Column) -> Column:
    """Text made safe for an XML attribute or element."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    out = F.replace(out, F.lit(">"), F.lit("&gt;"))
    return F.replace(out, F.lit('"'), F.lit("&quot;"))


def property_bag(*pairs: tuple[str, Column | str]) -> Column:
    """XML text of a property bag with the given keys and values."""
    parts = [F.lit(f'<Properties xmlns="{PROPERTIES_NAMESPACE}">')]
    for key, value in pairs:
        value = F.lit(value) if isinstance(value, str) else escape(value.cast("string"))
        parts += [F.lit(f'<Property Key="{key}" Value="'), value, F.lit('"/>')]
    return F.concat(*parts, F.lit("</Properties>"))


def layout_element(tag: Column, item: Column, index: Column) -> Column:
    """One row or column of a category layout."""
    n = index.cast("string")
    return F.concat(
        F.lit("<"), tag, F.lit(' Guid="'), F.lower(item),
        F.lit('" Hidden="false" Id="'), n, F.lit('" OrderId="'), n, F.lit('" Size="-1"/>'),
    )


# The settings that close a layout document.
LAYOUT_HEAD = f'<CategoryLayout xmlns="{PROPERTIES_NAMESPACE}">'
LAYOUT_TAIL = (
    '<SortedColumn Ascending="true">-1</SortedColumn>'
    "<RecordHeaderWidth>100</RecordHeaderWidth>"
    "<ShowRowIDs>true</ShowRowIDs>"
    "<ShowColumnIDs>true</ShowColumnIDs>"
    "<Transposed>false</Transposed>"
    "<NameSource>1</NameSource>"
    "<RowsUserOrdered>false</RowsUserOrdered>"
    "<ColumnsUserOrdered>true</ColumnsUserOrdered>"
    "</CategoryLayout>"
)


def layout_elements(layout: Column) -> Column:
    """(Tag, Item, Index) of the rows and columns in a part of a layout document, in order."""
    # Fixed value: the shape of an element that layout_element makes.
    pattern = F.lit(r'<(Row|Column) Guid="([^"]*)"[^>]* Id="([0-9]+)"')
    parts = [F.regexp_extract_all(layout, pattern, F.lit(i)) for i in (1, 2, 3)]
    return F.transform(
        F.arrays_zip(parts[0].alias("Tag"), parts[1].alias("Item"), parts[2].alias("Index")),
        lambda x: F.struct(x["Tag"].alias("Tag"), x["Item"].alias("Item"), x["Index"].cast("long").alias("Index")),
    )
