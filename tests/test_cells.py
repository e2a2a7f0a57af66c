"""Golden cells: what each dictionary type makes of a text."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dictspark.functions import types as D
from dictspark.functions.decode import decode_cell, flag_cell
from dictspark.functions.encode import encode_cell
from dictspark.functions.types import Field, UnknownTypeError, schema_of, spark_type
from dictspark.sources.extract import decode_cells, decode_extract, encode_extract, number_keys
from dictspark.sources.layouts import LAYOUTS, bucket_for, layout_named

GOLDEN = [
    ("DATS", 8, 0, {
        "20230901": date(2023, 9, 1), "20240229": date(2024, 2, 29), "99991231": date(9999, 12, 31), "00010101": date(1, 1, 1),
        "20230901xx": date(2023, 9, 1), " 20230901 ": date(2023, 9, 1), "00000000": None, "": None, "        ": None,
        "2023090": None, "20230230": None, "ABCDEFGH": None, "2023 901": None, "2023091T": None, "-2023091": None, "20231301": None,
    }),
    ("TIMS", 6, 0, {
        "235959": "23:59:59", "000001": "00:00:01", "000000": None, "      ": None, "12345": None, "240000": None, "126000": None,
        "120060": None, "12a000": None, "12:30:": None,
    }),
    ("DEC", 15, 2, {
        "123.45": Decimal("123.45"), "  123.45-": Decimal("-123.45"), "-7": Decimal("-7.00"), "7 -": Decimal("-7.00"), "": None, "   ": None,
        "12x": None, "1.5\x00junk": Decimal("1.50"), "12345678901234567.00": None,
    }),
    ("DEC", 31, 2, {"12345678901234567890123456789.12": Decimal("12345678901234567890123456789.12")}),
    ("DEC", 25, 0, {"1234567890123456789012345-": Decimal("-1234567890123456789012345")}),
    ("DECF34", 0, 0, {"9999999999999999999999999999999999": Decimal("9999999999999999999999999999999999")}),
    ("RAW", 5, 0, {
        "48656C6C6F": bytearray(b"Hello"), "00ff10  ": bytearray(b"\x00\xff\x10"), "~": None, "": None, "ABC": None, "ZZ": None, "00GG": None,
    }),
    ("UTCL", 27, 7, {
        "20240115143000,0000000": datetime(2024, 1, 15, 14, 30), "20240115143000,1234567": datetime(2024, 1, 15, 14, 30, 0, 123456),
        "20240115143000.5": datetime(2024, 1, 15, 14, 30, 0, 500000), "20240115143000": datetime(2024, 1, 15, 14, 30),
        "202401151430": datetime(2024, 1, 15, 14, 30), "2024011514": datetime(2024, 1, 15, 14), "20240115": datetime(2024, 1, 15),
        "00000000000000": None, "   ": None, "2024": None, "20241315143000": None, "20240115993000": None,
    }),
    ("INT4", 4, 0, {"42": 42, "-1": -1, " 7": 7, "7-": -7, "   ": None, "4 2": None}),
    ("INT1", 1, 0, {"255": 255, "0": 0}),
    ("FLTP", 16, 0, {"1.5": 1.5, "2.0E3": 2000.0, "": None}),
    ("CHAR", 10, 0, {"AB  ": "AB", "    ": "", " A": " A"}),
    ("NUMC", 10, 0, {"0000000012": "0000000012", "007  ": "007"}),
    ("STRING", 0, 0, {" keep ": " keep "}),
    ("XMLDATA", 0, 0, {"<a/>": ""}),
]


def decode(spark, cells, field, **options):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, cell string")
    typed = rows.selectExpr("i", f"{decode_cell('cell', field, **options)} AS v").orderBy("i")
    return [r["v"] for r in typed.collect()]


@pytest.mark.parametrize(("name", "length", "decimals", "cells"), GOLDEN, ids=lambda v: v if isinstance(v, str) else "")
def test_golden(spark, name, length, decimals, cells):
    field = Field("f", name, length, decimals)
    assert decode(spark, list(cells), field) == list(cells.values())
    assert decode(spark, [None], field) == ([""] if name in D.OPAQUE_TYPES else [None])


def test_midnight_can_be_kept(spark):
    assert decode(spark, ["000000", "      "], Field("f", "TIMS", 6), initial_time_is_null=False) == ["00:00:00", None]


def test_every_type_accepts_a_blank(spark):
    fields = [Field(f"c{i}", name, 10, 2) for i, name in enumerate(D.ALL_TYPES)]
    rows = spark.createDataFrame([("   ",) * len(fields)], [f.name for f in fields])
    typed = decode_cells(rows, fields, strict=True)
    assert typed.schema.names == schema_of(fields).names
    assert [f.dataType for f in typed.schema] == [spark_type(f) for f in fields]
    typed.collect()


def test_strict_names_the_cell(spark):
    for name, cell in (("DATS", "20230230"), ("DEC", "12x"), ("RAW", "ABC"), ("INT4", "4 2")):
        with pytest.raises(Exception, match=f"field f \\({name}\\) cannot hold: {cell}"):
            decode(spark, [cell], Field("f", name, 8), strict=True)


def test_unknown_type():
    with pytest.raises(UnknownTypeError):
        spark_type(Field("f", "NOPE"))
    assert spark_type(Field("f", "NOPE"), strict=False).simpleString() == "string"


def test_flags(spark):
    rows = spark.createDataFrame([("X",), (" ",), ("?",)], "c string").selectExpr(f"{flag_cell('c')} AS v")
    assert [r["v"] for r in rows.collect()] == [True, False, None]


def test_structural_rows_hold_no_cells():
    fields = [Field("a", "CHAR", 3), Field("_node", "NODE")]
    assert schema_of(fields).names == ["a"]


def test_encode(spark):
    row = spark.sql("SELECT 12 AS n, 3 AS m, X'00FFBE' AS raw, CAST(-123.45 AS DECIMAL(15,2)) AS d, CAST(NULL AS DATE) AS day, CAST(NULL AS INT) AS i, CAST(NULL AS TIMESTAMP_NTZ) AS ts")
    fields = {
        "n": Field("n", "NUMC", 10), "m": Field("m", "NUMC", 3), "raw": Field("raw", "RAW", 25), "d": Field("d", "DEC", 15, 2),
        "day": Field("day", "DATS", 8), "i": Field("i", "INT4"), "ts": Field("ts", "UTCL"),
    }
    cells = row.selectExpr(*[f"{encode_cell(c, f)} AS {c}" for c, f in fields.items()]).first()
    assert cells["n"] == "0000000012" and cells["m"] == "003"
    assert cells["raw"] == "00FFBE" + "00" * 22
    assert cells["d"].strip() == "123.45-" and len(cells["d"]) == 17
    assert cells["day"] == "00000000" and cells["i"].strip() == "0" and cells["ts"] == "00000000000000,0000000"


TYPED = [
    Field("name", "CHAR", 8, key=True), Field("no", "NUMC", 6), Field("price", "CURR", 9, 2), Field("day", "DATS", 8), Field("at", "TIMS", 6),
    Field("ts", "UTCL", 27, 7), Field("raw", "RAW", 4), Field("n", "INT4", 4), Field("ratio", "FLTP", 16),
]
ROW = st.tuples(
    st.text("abcXYZ0 äß", max_size=8).map(lambda s: s.rstrip(" ")),
    st.integers(0, 999_999).map(lambda n: f"{n:06d}"),
    st.decimals(Decimal("-9999999.99"), Decimal("9999999.99"), places=2),
    st.dates(date(1, 1, 1), date(9999, 12, 31)) | st.none(),
    st.times().map(lambda t: t.strftime("%H:%M:%S")).map(lambda t: None if t == "00:00:00" else t),
    st.datetimes(datetime(1900, 1, 1), datetime(9999, 12, 31)) | st.none(),
    st.binary(min_size=4, max_size=4).map(bytearray),
    st.integers(-(2**31), 2**31 - 1),
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda f: 0.0 if f == 0 else f),
)


@settings(max_examples=8, deadline=None, phases=[Phase.generate], derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=20), layout=st.sampled_from(sorted(LAYOUTS)))
def test_roundtrip(spark, rows, layout):
    schema = schema_of(TYPED)
    df = spark.createDataFrame(rows, schema).coalesce(1)
    back = decode_extract(encode_extract(df, TYPED, layout, "|"), TYPED, layout, "|", strict=True).select(*schema.names)
    assert back.schema.simpleString() == schema.simpleString()
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def test_layouts(spark):
    with pytest.raises(ValueError, match="unsupported layout"):
        layout_named("nope")
    with pytest.raises(ValueError, match="exceeds the 512"):
        encode_extract(spark.range(1).select(F.lit("x").alias("c")), [Field("c", "CHAR", 600)], "fixed")
    widths = spark.createDataFrame([(1,), (128,), (129,), (2048,), (30000,), (30001,)], "w int")
    assert [r[0] for r in widths.select(bucket_for(F.col("w"))).collect()] == [128, 128, 512, 2048, 30000, None]


def test_cells_that_do_not_survive_a_layout_raise(spark):
    rows = spark.createDataFrame([("a|b",)], "c string")
    with pytest.raises(Exception, match="contains the delimiter"):
        encode_extract(rows, [Field("c", "CHAR", 3)], "delimited", "|").collect()
    with pytest.raises(Exception, match="wider than 2"):
        encode_extract(rows, [Field("c", "CHAR", 2)], "fixed").collect()


def test_padding_and_cutting(spark):
    """Cells are padded by many signs at once, and numbers are computed once from a cell."""
    fields = [Field("n", "NUMC", 40), Field("s", "NUMC", 3), Field("r", "RAW", 30), Field("d", "DEC", 30, 2), Field("i", "INT8")]
    row = spark.sql("SELECT 12 AS n, 12345 AS s, X'0AFF' AS r, -1.5BD AS d, 7 AS i").selectExpr(*[f"{encode_cell(f.name, f)} AS {f.name}" for f in fields]).first()
    assert tuple(row) == ("12".rjust(40, "0"), "123", "0AFF".ljust(60, "0"), "1.50-".rjust(32), "7".rjust(20))
    assert all("' '" not in encode_cell("c", f) or f.type == "DEC" for f in fields) and "lpad(c" not in encode_cell("c", fields[4])
    cells = [" 1.5-", "-1.5", " ", "", "-", "1.5\0x", "\0", "x", None]
    typed = spark.createDataFrame([(c,) for c in cells], "c string").selectExpr(*[f"{decode_cell('c', Field('c', *t))} AS {t[0]}" for t in (("DEC", 12, 2), ("FLTP", 24), ("INT8", 20))])
    values = [-1.5, -1.5, None, None, None, 1.5, None, None, None]
    assert [r.FLTP for r in typed.collect()] == values and [r.DEC for r in typed.collect()] == [None if v is None else Decimal(f"{v:.2f}") for v in values]


def test_short_lines_decode_to_null(spark):
    lines = spark.createDataFrame([("A~1",), ("B",)], "line string")
    typed = decode_extract(lines, [Field("c", "CHAR", 1), Field("n", "INT4")], "delimited")
    assert [tuple(r) for r in typed.collect()] == [("A", 1), ("B", None)]


def test_long_cells_survive(spark):
    sizes = [65534, 65535, 65536, 100000]
    rows = spark.createDataFrame([("x" * n,) for n in sizes], "c string")
    field = [Field("c", "STRING")]
    back = decode_extract(encode_extract(rows, field, "long_string"), field, "long_string")
    assert sorted(len(r[0]) for r in back.collect()) == sizes


def test_escaped_cells_survive(spark):
    texts = ["a|b", "one\ntwo", "\r\n", "\\n \\s \\\\", "|", "", "plain", "\\", "\\d|"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "c string, n int").coalesce(1)
    fields = [Field("c", "STRING"), Field("n", "INT4")]
    lines = encode_extract(rows, fields, "long_string", "|", escape=True)
    assert not any({"\n", "\r"} & set(r[0]) for r in lines.collect())
    assert [r.c for r in decode_extract(lines, fields, "long_string", "|", escape=True).collect()] == texts
    for layout, delimiter in (("fixed", "|"), ("delimited", "n"), ("delimited", "\\")):
        with pytest.raises(ValueError):
            encode_extract(rows, fields, layout, delimiter, escape=True)


def test_blank_number_keys_match_nothing(spark):
    rows = number_keys(spark.createDataFrame([("0000000000",), ("  ",), ("12",)], "k string"), ["k"])
    assert [r[0] for r in rows.collect()] == [0, None, 12]
    other = spark.createDataFrame([(-1, "none"), (0, "zero"), (12, "twelve"), (None, "null")], "n long, text string")
    assert {r.text for r in rows.join(other, rows.k == other.n).collect()} == {"zero", "twelve"}
