from pyspark.sql import functions as F

from codespan.functions import text as T
from codespan.functions import values as V
from codespan.functions import xml as X
from codespan.functions.ids import canonical_uuid
from codespan.operators import attributes as A


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_canonical_values(spark):
    cases = [
        ("007", "Integer", "7"), ("-0", "integer", "0"), ("+5", "integer", "5"), ("3.1415", "decimal", "3.1415"),
        ("17", "decimal", "17.0"), ("12345678", "decimal", "12345678.0"), ("1e16", "decimal", "1e+16"),
        ("0.00001", "decimal", "1e-05"), ("2000-01-01 00:01", "datetime", "2000-01-01T00:01:00"),
        ("10 Dec 1967", "date", "1967-12-10"), ("16:20", "time", "16:20:00"), ("false", "boolean", "False"),
        ("ON", "boolean", "True"), ("01/03/16 09:15", "datetime", "2016-01-03T09:15:00"),
        ("Tue Mar  1 16:20:00 2016", "datetime", "2016-03-01T16:20:00"), ("x", "integer", None),
        ("2000-13-01", "date", None), ("16:20", "date", None), ("any", "text", "any"),
    ]
    df = spark.createDataFrame(cases, "v string, t string, want string")
    rows = df.select("v", "want", V.canonical_value(F.col("v"), F.col("t")).alias("got")).collect()
    assert [(r.v, r.got) for r in rows] == [(r.v, r.want) for r in rows]


def test_value_errors(spark):
    df = spark.createDataFrame(
        [("abc", "text", 2), ("", "integer", 0), ("x", "integer", 0), ("x", "colour", 0)], "v string, t string, n int"
    )
    got = [r[0] for r in df.select(V.value_error(F.col("v"), F.col("t"), F.col("n"))).collect()]
    assert got == ["longer than attribute length", None, "not a value of type integer", "unknown attribute type"]


def test_inference_ignores_blanks_or_not(spark):
    names = ["i", "d", "b", "day", "clock", "moment", "words"]
    rows = [("123", "123.456", "TRUE", "1967-12-10", "16:20:00", "01/03/16 09:15", "Now is the time…")]
    rows += [("",) * 7] * 10
    df = spark.createDataFrame(rows, names)
    got = {r.Name: r.Type for r in A.infer_attribute_types(df, names).collect()}
    assert got == dict(zip(names, ["integer", "decimal", "boolean", "date", "time", "datetime", "text"]))
    strict = {r.Type for r in A.infer_attribute_types(df, names, ignore_blank=False).collect()}
    assert strict == {"text"}


def test_dates_in_c_locale(spark):
    ts = F.to_timestamp(F.lit("2016-03-01 16:20:00"))
    assert one(spark, V.c_locale_date(ts)) == "Tue Mar  1 16:20:00 2016"


def test_shift_and_line_ends(spark):
    assert one(spark, T.shift_encode(F.lit("Aé"))) == chr(ord("A") + 0x377) + chr(ord("é") + 0x377)
    assert one(spark, T.shift_decode(T.shift_encode(F.lit("Hello, wörld")))) == "Hello, wörld"
    assert one(spark, T.shift_encode(F.lit(""))) == ""
    assert one(spark, T.lf_to_crlf(F.lit("\na\nb\r\nc"))) == "\na\r\nb\r\nc"
    assert one(spark, T.unwrap_lines(F.lit("a\nb\n\nc\u0000"))) == "a b\nc"
    assert one(spark, T.strip_final_newline(F.lit("a\n\n"))) == "a\n"


def test_names(spark):
    assert one(spark, T.sanitise_name(F.lit(' a/b:c*?"<>|\\ '))) == "a_b_c_______"
    assert one(spark, T.initials(F.lit(" jane  van doe"))) == "JVD"
    assert one(spark, T.strip_hidden_markup(F.lit(r"x{\rtlch \v\hid}y"))) == "xy"


def test_xml(spark):
    bag = X.property_bag(("DataType", F.lit("3")), ("Length", "0"), ("Note", F.lit('a"<&')))
    m = one(spark, X.property_map(bag))
    assert m == {"DataType": "3", "Length": "0", "Note": 'a"<&'}
    assert one(spark, X.property_length(X.property_map(bag))) is None


def test_codes(spark):
    assert one(spark, V.data_type_name(F.lit(3))) == "datetime"
    assert one(spark, V.data_type_name(F.lit(9))) == "9"
    assert one(spark, V.data_type_code(F.lit("DateTime"))) == 3
    assert one(spark, V.object_type_code(F.lit("jpeg"))) == 8
    assert one(spark, V.colour_to_int(F.lit("Tomato"))) == 0xFF6347
    assert one(spark, canonical_uuid(F.lit("{ABCDEF01-2345-6789-ABCD-EF0123456789}"))) == "abcdef01-2345-6789-abcd-ef0123456789"
