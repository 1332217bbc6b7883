"""Text functions, offset translation, line structure and attribute values."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import VIEWS, query
from codespan.functions import text as T
from codespan.functions import values as V
from codespan.functions.ids import canonical_uuid
from codespan.operators import attributes as A
from codespan.operators import spans as S
from codespan.session import spread

VIEWS["v_crlf"] = """
SELECT Id, replace(Content, chr(10), concat(chr(13), chr(10))) AS PlainText FROM {v_source}"""

_ON_CRLF = """SELECT t.Id, t.First_ - 1 AS start0, t.Last_ - t.First_ + 1 AS len, s.PlainText AS txt
  FROM {v_span} t JOIN {v_crlf} s ON s.Id = t.Source"""
_ON_LF = """SELECT t.Id, t.First_ - 1 AS start0, t.Last_ - t.First_ + 1 AS len, s.Content AS txt
  FROM {v_span} t JOIN {v_source} s ON s.Id = t.Source"""


def _moved(d, translate, view, column):
    texts = d[view].select(F.col("Id").alias("Source"), F.col(column).alias("Text"))
    spans = d["v_span"].select(
        "Id", "Source", (F.col("First_") - 1).alias("start0"), (F.col("Last_") - F.col("First_") + 1).alias("length")
    )
    return translate(spans, texts)


def _count_crlf(part):
    return f"(length({part}) - length(replace({part}, chr(13) || chr(10), ''))) // 2"


@query(
    "crlf_offsets",
    f"""SELECT Id, start0 - {_count_crlf("substring(txt, 1, start0)")} AS start0,
          len - {_count_crlf("substring(txt, start0 + 1, len)")} AS length FROM ({_ON_CRLF}) x""",
)
def crlf_offsets(d):
    return _moved(d, S.crlf_to_lf_spans, "v_crlf", "PlainText").drop("Source")


def _bare(part):
    """Line feeds of a piece, less the one it begins with (no carriage returns occur)."""
    return (
        f"(length({part}) - length(replace({part}, chr(10), '')) - "
        f"CASE WHEN substring({part}, 1, 1) = chr(10) THEN 1 ELSE 0 END)"
    )


@query(
    "lf_offsets",
    f"""SELECT Id, start0 + {_bare("substring(txt, 1, start0)")} AS start0,
          len + {_bare("substring(txt, start0 + 1, len)")} AS length FROM ({_ON_LF}) x""",
)
def lf_offsets(d):
    return _moved(d, S.lf_to_crlf_spans, "v_source", "Content").drop("Source")


_SPACES = r"regexp_replace({}, '[ \t\n\r\x0b\x0c]', '', 'g')"


def _uncounted(part):
    return f"(length({part}) - length({_SPACES.format(part)}))"


@query(
    "nonspace_offsets",
    f"""SELECT Id, start0 - {_uncounted("substring(txt, 1, start0)")} AS start0,
          len - {_uncounted("substring(txt, start0 + 1, len)")} AS length FROM ({_ON_LF}) x""",
)
def nonspace_offsets(d):
    return _moved(d, S.char_to_nonspace_spans, "v_source", "Content").drop("Source")


# Going there and back lands on the first and last counted characters of the span, or, if it
# has none, on the next one of the text.
@query(
    "nonspace_roundtrip",
    f"""SELECT Id, start0 + CAST(length(rest) - length(ltrim(rest, s)) AS BIGINT) AS StartX,
          CAST(length(trim(part, s)) AS BIGINT) AS LengthX
        FROM (SELECT Id, start0, substring(txt, start0 + 1, len) AS part, substring(txt, start0 + 1) AS rest,
                     concat(' ', chr(9), chr(10), chr(13)) AS s FROM ({_ON_LF}) x) y""",
)
def nonspace_roundtrip(d):
    there = _moved(d, S.char_to_nonspace_spans, "v_source", "Content").withColumnsRenamed(
        {"start0": "StartText", "length": "LengthText"}
    )
    texts = d["v_source"].select(F.col("Id").alias("Source"), F.col("Content").alias("PlainText"))
    back = S.nonspace_to_char(there, texts)
    return back.select("Id", "StartX", "LengthX")


@query(
    "line_ends",
    r"""SELECT Id, length(PlainText) AS crlf_chars, length(replace(PlainText, chr(13) || chr(10), chr(10))) AS lf_chars,
          md5(replace(PlainText, chr(13) || chr(10), chr(10))) AS lf_digest FROM {v_crlf}""",
)
def line_ends(d):
    clean = T.crlf_to_lf(F.col("PlainText"))
    return d["v_crlf"].select(
        "Id", F.length("PlainText").cast("long").alias("crlf_chars"), F.length(clean).cast("long").alias("lf_chars"),
        F.md5(clean).alias("lf_digest"),
    )


@query(
    "lf_to_crlf",
    r"""SELECT Id, md5(concat(CASE WHEN substring(Content, 1, 1) = chr(10) THEN chr(10) ELSE '' END,
          replace(CASE WHEN substring(Content, 1, 1) = chr(10) THEN substring(Content, 2) ELSE Content END,
            chr(10), chr(13) || chr(10)))) AS digest FROM {v_source}""",
)
def lf_to_crlf(d):
    return d["v_source"].select("Id", F.md5(T.lf_to_crlf(F.col("Content"))).alias("digest"))


@query(
    "shift_codec",
    """SELECT p_name AS Name, array_to_string(list_transform(string_split(p_name, ''), lambda c: chr(ascii(c) + 887)), '') AS Coded,
         p_name AS Back FROM {part}""",
)
def shift_codec(d):
    rows = d["part"].select(F.col("p_name").alias("Name"), T.shift_encode(F.col("p_name")).alias("Coded"))
    return rows.withColumn("Back", T.shift_decode(F.col("Coded")))


@query(
    "sanitise_names",
    r"""SELECT page_id, trim(regexp_replace(url, '[\\:/*?"<>|]', '_', 'g')) AS Name FROM {pages}""",
)
def sanitise_names(d):
    return d["pages"].select("page_id", T.sanitise_name(F.col("url")).alias("Name"))


@query(
    "initials",
    """SELECT Id, Name, array_to_string(list_transform(list_filter(string_split(Name, ' '), lambda w: w <> ''),
         lambda w: upper(substring(w, 1, 1))), '') AS Initials FROM {v_user}""",
)
def initials(d):
    return d["v_user"].select("Id", "Name", T.initials(F.col("Name")).alias("Initials"))


@query(
    "unwrap_lines",
    # Pairs from the left; what is left of an odd run stands after a pair and stays.
    r"""SELECT Id, md5(replace(replace(replace(replace(replace(Content, chr(10) || chr(10), chr(2)),
          chr(2) || chr(10), chr(2) || chr(2)), chr(10), ' '), chr(2), chr(10)), chr(0), '')) AS digest FROM {v_source}""",
)
def unwrap_lines(d):
    return d["v_source"].select("Id", F.md5(T.unwrap_lines(F.col("Content"))).alias("digest"))


@query(
    "strip_final_newline",
    """SELECT doc_id, length(CASE WHEN t LIKE '%' || chr(10) THEN substring(t, 1, length(t) - 1) ELSE t END) AS n
       FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat(text, chr(10)) ELSE text END AS t FROM {documents}) x""",
)
def strip_final_newline(d):
    text = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    return d["documents"].select("doc_id", F.length(T.strip_final_newline(text)).cast("long").alias("n"))


@query(
    "hidden_markup",
    r"""SELECT Id, md5(Content) AS digest FROM {v_source}""",
)
def hidden_markup(d):
    hidden = F.concat(F.lit(r"{\x \v\hid}"), F.col("Content"))
    return d["v_source"].select("Id", F.md5(T.strip_hidden_markup(hidden)).alias("digest"))


@query(
    "paragraph_index",
    """SELECT Id, SUM(len) OVER (PARTITION BY Id ORDER BY k ROWS UNBOUNDED PRECEDING) - len AS pos, len FROM (
         SELECT Id, k, CAST(length(lines[k]) + CASE WHEN k < len(lines) THEN 1 ELSE 0 END AS BIGINT) AS len
         FROM (SELECT Id, string_split(Content, chr(10)) AS lines,
                 unnest(range(1, len(string_split(Content, chr(10))) + 1)) AS k FROM {v_source}) x) y
       WHERE len > 0""".replace("SUM(len) OVER", "CAST(SUM(len) OVER").replace("PRECEDING) - len AS pos", "PRECEDING) - len AS BIGINT) AS pos"),
)
def paragraph_index(d):
    return d["v_source"].select("Id", F.inline(T.paragraphs(F.col("Content"))))


@query(
    "source_lengths",
    """SELECT Id, CAST(length(replace(Content, ' ', '')) AS BIGINT) AS mac, CAST(0 AS BIGINT) AS windows,
         substring(Content, 1, 20) AS head FROM {v_source}""",
)
def source_lengths(d):
    c = F.col("Content")
    return d["v_source"].select(
        "Id", T.text_length(c, "mac").cast("long").alias("mac"), T.text_length(c, "windows").cast("long").alias("windows"),
        T.truncate_description(c, 20).alias("head"),
    )


VIEWS["v_cells"] = """
SELECT o_orderkey AS Id, CAST(o_custkey AS STRING) AS whole,
       CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS STRING) AS number,
       CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS truth,
       substring(CAST(o_orderdate AS STRING), 1, 10) AS day,
       concat(lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':', lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')) AS clock,
       concat(substring(CAST(o_orderdate AS STRING), 1, 10), ' 10:', lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')) AS moment,
       o_orderpriority AS words
FROM {orders}"""


@query(
    "infer_types",
    """SELECT * FROM (VALUES ('whole', 'integer'), ('number', 'decimal'), ('truth', 'boolean'), ('day', 'date'),
         ('clock', 'time'), ('moment', 'datetime'), ('words', 'text')) AS t(Name, Type)
       JOIN (SELECT unnest(['whole', 'number', 'truth', 'day', 'clock', 'moment', 'words']) AS Name,
         unnest([max(length(whole)), max(length(number)), max(length(truth)), max(length(day)),
           max(length(clock)), max(length(moment)), max(length(words))]) AS Length FROM {v_cells}) l USING (Name)""",
)
def infer_types(d):
    names = ["whole", "number", "truth", "day", "clock", "moment", "words"]
    return A.infer_attribute_types(d["v_cells"], names).withColumn("Length", F.col("Length").cast("long"))


@query(
    "infer_types_blank_is_text",
    """SELECT 'truth' AS Name, 'text' AS Type, max(length(truth)) AS Length FROM {v_cells}""",
)
def infer_types_blank_is_text(d):
    return A.infer_attribute_types(d["v_cells"], ["truth"], ignore_blank=False).withColumn(
        "Length", F.col("Length").cast("long")
    )


@query(
    "infer_value_types",
    """SELECT Attribute, max(length(Value)) AS Length,
         CASE WHEN bool_and(regexp_full_match(Value, '[+-]?[0-9]+')) THEN 'integer'
              WHEN bool_and(regexp_full_match(Value, '[+-]?[0-9]*[.]?[0-9]+')) THEN 'decimal'
              WHEN bool_and(lower(Value) IN ('true', 'false')) THEN 'boolean'
              WHEN bool_and(TRY_CAST(Value AS DATE) IS NOT NULL) THEN 'date' ELSE 'text' END AS Type
       FROM (SELECT Attribute, Value FROM {v_srcvalue} UNION ALL SELECT Attribute, Value FROM {v_nodevalue}) x
       GROUP BY Attribute""",
)
def infer_value_types(d):
    values = d["v_srcvalue"].select("Attribute", "Value").unionByName(d["v_nodevalue"].select("Attribute", "Value"))
    return A.infer_value_types(values).withColumn("Length", F.col("Length").cast("long"))


@query(
    "unpivot_values",
    """SELECT Id, Name, Value FROM (
         SELECT Id, unnest(['whole', 'truth', 'words']) AS Name, unnest([whole, truth, words]) AS Value FROM {v_cells}) x
       WHERE Value <> ''""",
)
def unpivot_values(d):
    return A.unpivot_values(d["v_cells"], "Id", ["whole", "truth", "words"])


@query(
    "canonical_values",
    """SELECT Id, CAST(CAST(whole AS BIGINT) AS STRING) AS whole,
         CASE WHEN truth = '' THEN NULL WHEN truth = 'TRUE' THEN 'True' ELSE 'False' END AS truth,
         day, concat(clock, ':00') AS clock, concat(replace(moment, ' ', 'T'), ':00') AS moment, words,
         regexp_replace(regexp_replace(number, '0+$', ''), '[.]$', '.0') AS number
       FROM {v_cells}""",
)
def canonical_values(d):
    kinds = {
        "whole": "integer", "truth": "boolean", "day": "date", "clock": "time", "moment": "datetime",
        "words": "text", "number": "decimal",
    }
    return spread(d["v_cells"], "Id").select("Id", *[V.canonical_value(F.col(c), F.lit(k)).alias(c) for c, k in kinds.items()])


@query(
    "value_errors",
    """SELECT Reason, count(*) AS n FROM (
         SELECT CASE WHEN length(words) > 8 THEN 'longer than attribute length' ELSE 'fits' END AS Reason FROM {v_cells}
         UNION ALL SELECT 'not a value of type integer' FROM {v_cells}
         UNION ALL SELECT CASE WHEN truth = '' THEN 'fits' ELSE 'unknown attribute type' END FROM {v_cells}) x
       GROUP BY Reason""",
)
def value_errors(d):
    cells = [("words", "text", 8), ("day", "integer", 0), ("truth", "other", 0)]
    reasons = F.array(
        *[F.coalesce(V.value_error(F.col(c), F.lit(k), F.lit(n)), F.lit("fits")) for c, k, n in cells]
    )
    return d["v_cells"].select(F.explode(reasons).alias("Reason")).groupBy("Reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "legacy_values",
    """SELECT Id, CASE WHEN truth = '' THEN 'Unassigned' WHEN truth = 'TRUE' THEN '1' ELSE '0' END AS truth_mac,
         CASE WHEN truth = '' THEN 'Unassigned' WHEN truth = 'TRUE' THEN 'True' ELSE 'False' END AS truth_win,
         concat(day, ' 00:00:00Z') AS day_win, concat(replace(moment, ' ', 'T'), ':00') AS moment_mac,
         concat(moment, ':00Z') AS moment_win FROM {v_cells}""",
)
def legacy_values(d):
    u = F.lit("Unassigned")
    lv = lambda c, k, pf: V.legacy_value(F.col(c), F.lit(k), pf, u)
    return spread(d["v_cells"], "Id").select(
        "Id", lv("truth", "boolean", "mac").alias("truth_mac"), lv("truth", "boolean", "windows").alias("truth_win"),
        lv("day", "Date", "windows").alias("day_win"), lv("moment", "DateTime", "mac").alias("moment_mac"),
        lv("moment", "datetime", "windows").alias("moment_win"),
    )


@query(
    "flatcode_values",
    """SELECT Id, CASE truth WHEN 'TRUE' THEN '1' WHEN 'false' THEN '0' END AS truth, replace(day, '-', '') AS day,
         concat(replace(clock, ':', ''), '00') AS clock,
         concat(replace(replace(replace(moment, '-', ''), ':', ''), ' ', ''), '00') AS moment FROM {v_cells}""",
)
def flatcode_values(d):
    kinds = {"truth": "boolean", "day": "date", "clock": "time", "moment": "datetime"}
    return spread(d["v_cells"], "Id").select("Id", *[V.flatcode_value(F.col(c), F.lit(k)).alias(c) for c, k in kinds.items()])


@query(
    "c_locale_dates",
    """SELECT Id, concat(strftime(t, '%a %b '), lpad(CAST(day(t) AS STRING), 2, ' '), strftime(t, ' %H:%M:%S %Y')) AS text, t AS back
       FROM (SELECT o_orderkey AS Id, o_orderdate + o_orderkey * INTERVAL '1' SECOND AS t FROM {orders}) x""",
)
def c_locale_dates(d):
    rows = d["orders"].selectExpr("o_orderkey AS Id", "o_orderdate + o_orderkey * INTERVAL '1' SECOND AS t")
    text = rows.select("Id", V.c_locale_date(F.col("t")).alias("text"))
    return text.withColumn("back", V.parse_datetime(F.col("text")))


@query(
    "truth_words",
    """SELECT event_id, CASE WHEN lower(w) IN ('yes', 'on', 't', '1') THEN TRUE WHEN lower(w) IN ('no', 'off', 'f', '0') THEN FALSE END AS b
       FROM (SELECT event_id, (['Yes', 'off', 'T', 'no', 'maybe', '1', 'ON', '0'])[1 + event_id % 8] AS w FROM {events}) x""",
)
def truth_words(d):
    words = F.array(*[F.lit(w) for w in ("Yes", "off", "T", "no", "maybe", "1", "ON", "0")])
    w = F.element_at(words, (F.col("event_id") % 8 + 1).cast("int"))
    return d["events"].select("event_id", V.parse_bool(w).alias("b"))


@query(
    "colour_codes",
    """SELECT p_partkey, p_name, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 16711680 WHEN 'blue' THEN 255 END AS rgb
       FROM {part}""",
)
def colour_codes(d):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    return d["part"].select("p_partkey", "p_name", V.colour_to_int(first).alias("rgb"))


@query(
    "type_codes",
    """SELECT Id, Type, CASE Type WHEN 'text' THEN 0 WHEN 'integer' THEN 1 WHEN 'decimal' THEN 2 WHEN 'date' THEN 4
         WHEN 'boolean' THEN 6 END AS Code, Type AS Back, CASE WHEN Type = 'text' THEN 'character' ELSE 'numeric' END AS Class
       FROM (SELECT v.Node || v.Attribute AS Id, a.Type FROM {v_nodevalue} v JOIN {v_nodeattr} a ON a.Id = v.Attribute) x""",
)
def type_codes(d):
    a = d["v_nodeattr"].select(F.col("Id").alias("Attribute"), "Type")
    rows = d["v_nodevalue"].join(a, "Attribute").select(F.concat("Node", "Attribute").alias("Id"), "Type")
    code = V.data_type_code(F.upper("Type"))
    return rows.select(
        "Id", "Type", code.alias("Code"), V.data_type_name(code).alias("Back"), V.flatcode_class(F.col("Type")).alias("Class")
    )


@query(
    "canonical_uuids",
    """SELECT Id, concat(substring(m, 1, 8), '-', substring(m, 9, 4), '-', substring(m, 13, 4), '-', substring(m, 17, 4), '-', substring(m, 21)) AS u
       FROM (SELECT Id, md5(Id) AS m FROM {v_source}) x""",
)
def canonical_uuids(d):
    raw = F.concat(F.lit("{"), F.upper(F.md5("Id")), F.lit("}"))
    return d["v_source"].select("Id", canonical_uuid(raw).alias("u"))


@query(
    "attribute_conflicts",
    """SELECT Id, count(*) AS Variants FROM (SELECT DISTINCT concat('k', CAST(p_size % 10 AS STRING)) AS Id, p_type AS Type,
         CASE WHEN p_size % 10 < 5 THEN 0 ELSE p_size END AS Length FROM {part}) x
       GROUP BY Id HAVING count(*) > 1""",
)
def attribute_conflicts(d):
    k = F.col("p_size") % 10
    rows = d["part"].select(
        F.concat(F.lit("k"), k.cast("string")).alias("Id"), F.col("p_type").alias("Type"),
        F.when(k < 5, 0).otherwise(F.col("p_size")).alias("Length"),
    )
    return A.attribute_conflicts(rows)


_MEMBERS = "SELECT concat('c', CAST(c_nationkey AS STRING)) AS Category, c_custkey AS Item FROM {customer}"
_DEFAULTS = "SELECT concat('c', CAST(s_nationkey AS STRING)) AS Category, s_suppkey AS Attribute, 'Unassigned' AS \"Default\" FROM {supplier}"
_EXISTING = "SELECT o_custkey AS Item, o_orderkey % (SELECT count(*) FROM {supplier}) AS Attribute FROM {orders}"


@query(
    "default_fill",
    f"""SELECT m.Item, f.Attribute, f."Default" FROM ({_MEMBERS}) m JOIN ({_DEFAULTS}) f ON f.Category = m.Category
        WHERE NOT EXISTS (SELECT 1 FROM ({_EXISTING}) e WHERE e.Item = m.Item AND e.Attribute = f.Attribute)""",
)
def default_fill(d):
    category = lambda c: F.concat(F.lit("c"), F.col(c).cast("string")).alias("Category")
    members = d["customer"].select(category("c_nationkey"), F.col("c_custkey").alias("Item"))
    defaults = d["supplier"].select(
        category("s_nationkey"), F.col("s_suppkey").alias("Attribute"), F.lit("Unassigned").alias("Default")
    )
    n = d["supplier"].select(F.count(F.lit(1))).scalar()
    existing = d["orders"].withColumn("n", n).select(
        F.col("o_custkey").alias("Item"), (F.col("o_orderkey") % F.col("n")).alias("Attribute")
    )
    return A.default_fill(members, defaults, existing)


@query(
    "members_without_value",
    """SELECT c_custkey AS Item FROM {customer} WHERE c_custkey NOT IN (
         SELECT o_custkey FROM {orders} WHERE o_orderpriority = '5-LOW')""",
)
def members_without_value(d):
    existing = d["orders"].select(F.col("o_custkey").alias("Item"), F.col("o_orderpriority").alias("Attribute"))
    return A.members_without_value(
        d["customer"].select(F.col("c_custkey").alias("Item")), existing, F.lit("5-LOW")
    )


@query(
    "attribute_split",
    """SELECT Attribute, Category, CASE WHEN Category = first_ THEN Attribute ELSE concat(Attribute, '/', Category) END AS NewId,
         Category <> first_ AS Copied FROM (
         SELECT Attribute, Category, min(Category) OVER (PARTITION BY Attribute) AS first_ FROM (
           SELECT DISTINCT p_brand AS Attribute, p_type AS Category FROM {part}) x) y""",
)
def attribute_split(d):
    uses = d["part"].select(F.col("p_brand").alias("Attribute"), F.col("p_type").alias("Category")).distinct()
    return A.split_by_category(uses, lambda a, c: F.concat(a, F.lit("/"), c))


@query(
    "cases_vs_codes",
    """SELECT n.Id, CAST(count(v.Node) AS BIGINT) AS ValueCount FROM {v_node} n LEFT JOIN {v_nodevalue} v ON v.Node = n.Id GROUP BY n.Id""",
)
def cases_vs_codes(d):
    return A.value_counts(d["v_node"].select("Id"), d["v_nodevalue"], "Node")


@query(
    "attribute_definitions_distinct",
    """SELECT DISTINCT a.Id, a.Name, a.Type, a.Length FROM {v_nodevalue} v JOIN {v_nodeattr} a ON a.Id = v.Attribute""",
)
def attribute_definitions_distinct(d):
    joined = d["v_nodevalue"].join(d["v_nodeattr"], F.col("Attribute") == F.col("Id"))
    return A.distinct_attributes(joined.select("Id", "Name", "Type", "Length"))
