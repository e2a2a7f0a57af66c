"""Scans, catalogs, select-options, dictionary searches, the extract connector."""

import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from dictspark.functions.globs import like_pattern
from dictspark.functions.selection import option, option_pattern, predicate, select_options
from dictspark.functions.types import Field
from dictspark.operators.directory import show_objects
from dictspark.operators.metadata import VIEWS, meta_view, transform_fields
from dictspark.plans import wide_queries
from dictspark.session import JIT_CONF, JIT_LIMIT, work_dir
from dictspark.sources.catalog import MAX_TABLES, attach, resolve_tables
from dictspark.sources.connector import extract_fields, read_extract, register, stream_extract, write_extract
from dictspark.sources.dictionary import describe_fields, fields_frame, fields_from_schema, load_fields
from dictspark.sources.extract import computed_once, decode_cells, decode_extract, encode_extract, number_keys
from dictspark.sources.files import table_bytes, write_table
from dictspark.sources import reader
from dictspark.sources.reader import read_table
from dictspark.streaming.delta import append_to, read_batches, run_delta


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def flights(spark):
    path = work_dir(spark, "flights")
    rows = [("LH", f"{n:04d}", n, n * 1.5, None if n % 3 == 0 else "EUR") for n in range(40)]
    spark.createDataFrame(rows, "carrier string, no string, seats int, price double, currency string").write.parquet(f"{path}/flights.parquet")
    spark.createDataFrame([("LH", "L"), ("AA", "A")], "carrier string, name string").write.parquet(f"{path}/carriers.parquet")
    return path


def test_scan_options(spark, flights):
    path = f"{flights}/flights.parquet"
    assert read_table(spark, path).count() == 40
    assert read_table(spark, path, columns=["price", "no"]).columns == ["price", "no"]
    assert read_table(spark, path, columns=["no"], filter="seats > 35").count() == 4
    assert read_table(spark, path, max_rows=7, threads=2).count() == 7
    assert [r.no for r in read_table(spark, path, columns=["no"], max_rows=2, sorted_by_key=["no"]).collect()] == ["0000", "0001"]
    with pytest.raises(ValueError, match="unknown column"):
        read_table(spark, path, columns=["nope"])


def test_projection_and_filter_reach_the_scan(spark, flights):
    plan = plan_of(read_table(spark, f"{flights}/flights.parquet", columns=["no"], filter="carrier = 'LH'"))
    assert "PushedFilters: [IsNotNull(carrier), EqualTo(carrier,LH)]" in plan
    assert "ReadSchema: struct<carrier:string,no:string>" in plan


def test_select_options_reach_the_scan(spark, flights):
    df = spark.read.parquet(f"{flights}/flights.parquet")
    plan = plan_of(select_options(df, [option("seats", "3", "5"), option("carrier", "LH")]))
    assert "GreaterThanOrEqual(seats,3)" in plan and "EqualTo(carrier,LH)" in plan


def test_catalog(spark, flights):
    entries = spark.createDataFrame([("flights",), ("carriers",), ("other",)], "table_name string")
    catalog = attach(spark, flights, "carriers,FLIGHTS,fl*,c?rriers", "sys", entries)
    assert [t.lower() for t in catalog.tables()] == ["carriers", "flights"]
    with pytest.raises(KeyError):
        catalog.table("other")
    assert attach(spark, flights).tables() == []
    assert attach(spark, flights).table("flights").count() == 40
    attach(spark, flights, "flights,carriers", "mount")
    assert spark.sql("SELECT * FROM mount__flights JOIN mount__carriers USING (carrier) LIMIT 5").count() == 5


def test_catalog_cap_is_an_error(spark):
    entries = spark.range(MAX_TABLES + 1).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("table_name"))
    with pytest.raises(ValueError, match="more than"):
        resolve_tables(entries, "T*")


def test_globs():
    assert like_pattern("A*B?C%_") == "A%B_C%\\_"


def test_select_option_rows(spark):
    df = spark.createDataFrame([(1, "AB"), (2, "AC"), (3, None), (4, "B%")], "n int, s string")

    def keys(*options, **kw):
        return [r.n for r in select_options(df, options, **kw).orderBy("n").collect()]

    assert keys(option("s", "A*", op="CP")) == [1, 2]
    assert keys(option("s", "A+", op="CP", sign="E")) == [3, 4]
    assert keys(option("s", "B%", op="CP")) == [4]
    assert keys(option("n", "2", "3")) == [2, 3]
    assert keys(option("n", "2", "3", op="NB")) == [1, 4]
    assert keys(option("n", "1"), option("n", "4"), option("n", "4", sign="E")) == [1]
    assert keys(option("n", "1"), option("s", "AC")) == []
    assert keys(option("n", "1"), option("s", "AC"), combine="any") == [1, 2]
    assert keys() == [1, 2, 3, 4]
    for bad in (option("x", "1"), option("n", "1", op="ZZ"), option("n", "1", sign="Q"), {"LOW": "1"}):
        with pytest.raises(ValueError):
            predicate(df.schema, [bad])
    assert option_pattern("A#*+*") == "A*_%"


def test_dictionary(spark, flights):
    fields = fields_from_schema(spark.read.parquet(f"{flights}/flights.parquet").schema, keys=["no"], lengths={"carrier": 3})
    frame = fields_frame(spark, {"FLIGHTS": fields})
    assert load_fields(frame, "FLIGHTS") == fields
    rows = {r.field: r for r in describe_fields(frame, "FLIGHTS").collect()}
    assert rows["no"].is_key == "X" and rows["price"].declared_type == "DECIMAL(15,2)" and rows["carrier"].length == 3
    with pytest.raises(ValueError, match="not in the dictionary"):
        load_fields(frame, "NOPE")


FIELDS = [Field("k", "NUMC", 4, key=True), Field("s", "CHAR", 3), Field("d", "DATS", 8), Field("p", "DEC", 9, 2)]


@pytest.mark.parametrize("layout", ["delimited", "fixed"])
def test_connector_reads_what_the_text_source_reads(spark, layout):
    rows = spark.range(2000).selectExpr("lpad(CAST(id AS STRING), 4, '0') k", "concat('S', id % 7) s", "date_add(DATE '2024-01-01', CAST(id AS INT)) d", "CAST(id / 4 AS DECIMAL(9,2)) p")
    path = write_extract(rows.repartition(3), FIELDS, work_dir(spark, "extract"), layout)
    assert extract_fields(spark, path) == FIELDS
    native = read_extract(spark, path, layout)
    connected = read_extract(spark, path, layout, connector=True)
    assert native.schema == connected.schema
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, connected.collect())) == sorted(map(tuple, rows.collect()))
    split = spark.read.format("dictextract").option("layout", layout).option("splitBytes", 777).load(path)
    assert split.count() == 2000 and split.distinct().count() == 2000
    assert connected.where("s = 'S3' AND p > 10").count() == rows.where("s = 'S3' AND p > 10").count()
    assert "PushedFilters" in plan_of(connected.where("s = 'S3'")) or connected.where("s IN ('S1', 'S2')").count() == rows.where("s IN ('S1', 'S2')").count()


ODD = [("0001", "a~b", "two\nlines"), ("0002", None, "back\\slash \r"), ("0003", "ü~", ""), ("0004", "", "\\n\\d~")]


def test_connector_writes_what_it_reads(spark):
    fields = [Field("k", "NUMC", 4, key=True), Field("s", "CHAR", 6), Field("t", "STRING", 0)]
    odd = spark.createDataFrame(ODD, "k string, s string, t string")
    path = work_dir(spark, "extract")
    write_extract(odd.repartition(2), fields, path, escape=True, connector=True)
    wanted = sorted((k, s or "", t) for k, s, t in ODD)
    for connector in (True, False):
        assert sorted(map(tuple, read_extract(spark, path, escape=True, connector=connector).collect())) == wanted
    assert extract_fields(spark, path) == fields
    write_extract(odd.limit(0), fields, path, escape=True, connector=True)
    write_extract(odd, fields, path, escape=True, connector=True)
    assert read_extract(spark, path, escape=True, connector=True).count() == 8
    write_extract(odd.where("k = '0003'"), fields, path, escape=True, connector=True, mode="overwrite")
    assert [tuple(r) for r in read_extract(spark, path, escape=True, connector=True).collect()] == [wanted[2]]
    for bad, message in ((odd.where("k = '0001'"), "line break|delimiter"), (odd.where("k = '0004'"), "delimiter")):
        with pytest.raises(Exception, match=message):
            write_extract(bad, fields, path, connector=True)
    with pytest.raises(Exception, match="another dictionary"):
        write_extract(odd.select("k"), fields[:1], path, connector=True)
    with pytest.raises(Exception, match="wider than 6"):
        write_extract(spark.createDataFrame([("1", "7 chars")], "k string, s string"), fields[:2], work_dir(spark, "extract"), "fixed", connector=True)
    assert read_extract(spark, path, escape=True, connector=True).count() == 1


@pytest.mark.parametrize("layout", ["delimited", "fixed"])
def test_connector_round_trip_of_types(spark, layout):
    rows = spark.range(500).selectExpr("lpad(CAST(id AS STRING), 4, '0') k", "concat('S', id % 7) s", "date_add(DATE '2024-01-01', CAST(id AS INT)) d", "CAST(id / 4 AS DECIMAL(9,2)) p")
    path = write_extract(rows.repartition(3), FIELDS, work_dir(spark, "extract"), layout, connector=True)
    for connector in (True, False):
        assert sorted(map(tuple, read_extract(spark, path, layout, connector=connector).collect())) == sorted(map(tuple, rows.collect()))


def test_short_lines_long_lines_and_ranges(spark):
    path = work_dir(spark, "extract")
    fields = [Field("a", "STRING", 0), Field("b", "STRING", 0), Field("c", "STRING", 0)]
    write_extract(spark.createDataFrame([("x", "y", "z")], "a string, b string, c string"), fields, path)
    lines = ["1~2~3", "1~2", "1", "", "~~", "1~2~3~4~5", "long~" + "é" * 5000 + "~end", "crlf~b~c\r", "", "last~l~l"]
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.mode("overwrite").text(f"{path}/lines")

    def cells(line):
        found = line.removesuffix("\r").split("~")[:3]
        return tuple(found + [None] * (3 - len(found)))

    register(spark)
    for kept, sizes in ((lines, (100, 4096, 1 << 20)), (lines[:6] + lines[7:], (1, 2, 3, 7))):
        spark.createDataFrame([(line,) for line in kept], "v string").coalesce(1).write.mode("overwrite").text(f"{path}/lines")
        for size in sizes:
            got = spark.read.format("dictextract").option("splitBytes", size).load(path).collect()
            assert sorted(map(tuple, got), key=repr) == sorted(map(cells, kept), key=repr), size


def test_extract_streams_each_write_once(spark):
    rows = spark.range(60).selectExpr("lpad(CAST(id AS STRING), 4, '0') k", "concat('S', id % 7) s", "DATE '2024-01-01' d", "CAST(id AS DECIMAL(9,2)) p")
    path, out, checkpoint = (work_dir(spark, n) for n in ("extract", "out", "checkpoint"))
    seen = []
    for low, high in ((0, 20), (20, 20), (20, 35), (35, 60)):
        write_extract(rows.where(f"k >= {low} AND k < {high}"), FIELDS, path, connector=True)
        run_delta(stream_extract(spark, path), checkpoint, append_to(out))
        run_delta(stream_extract(spark, path), checkpoint, append_to(out))
        seen.append(read_batches(spark, out, rows.schema).count())
    assert seen == [20, 20, 35, 60]
    assert sorted(map(tuple, read_batches(spark, out, rows.schema).select("k", "s", "d", "p").collect())) == sorted(map(tuple, rows.collect()))


def test_sink_never_overwrites(spark):
    path = work_dir(spark, "sink")
    assert write_table(spark.range(3).toDF("n"), path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_table(spark.range(3).toDF("n"), path)


def test_meta_views(spark):
    assert len(VIEWS) == 14
    rows = spark.createDataFrame([("P1", "CUBE", "a", "A"), ("P1", "CUBE", "d", "D"), ("P2", "ADSO", "d", "D")], "provider string, type string, text string, version string")
    assert sorted(map(tuple, meta_view({"providers": rows}, "providers").collect())) == [("P1", "CUBE", "a", "A"), ("P2", "ADSO", "d", "D")]
    with pytest.raises(ValueError, match="unknown view"):
        meta_view({}, "nope")
    with pytest.raises(ValueError, match="needs datasource"):
        meta_view({}, "datasource_fields")


def test_rules_pair_without_products(spark):
    rows = [("T", 1, 0, f"s{i}", "A") for i in range(50)] + [("T", 1, 1, f"t{i}", "A") for i in range(50)] + [("T", 2, 0, "s", "D"), ("T", 2, 1, "t1", "D"), ("T", 2, 1, "t2", "D")]
    rows += [("T", 3, 0, "old", "D"), ("T", 3, 0, "new", "A"), ("T", 3, 1, "t", "A"), ("T", 4, 1, "alone", "A")]
    out = transform_fields(spark.createDataFrame(rows, "transformation string, rule int, paramtype int, field string, version string"))
    by_rule = {}
    for r in out.collect():
        by_rule.setdefault(r.rule, set()).add((r.source_field, r.target_field))
    assert len(by_rule[1]) == 100
    assert by_rule[2] == {("s", "t1"), ("s", "t2")}
    assert by_rule[3] == {("new", "t")}
    assert by_rule[4] == {(None, "alone")}


def test_object_types_are_checked(spark):
    with pytest.raises(ValueError, match="object type"):
        show_objects(spark.range(1), "NOPE")


def test_extracts_with_line_breaks_subfolders_and_compression(spark):
    texts = ["one\ntwo", "a~b\r", "\\n", "", "x" * 70000]
    rows = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(texts)], "k string, t string").coalesce(1)
    fields = [Field("k", "CHAR", 3), Field("t", "STRING")]
    with pytest.raises(Exception, match="line break"):
        write_extract(rows.where("k = '000'"), fields, work_dir(spark, "extract"), "long_string")
    path = write_extract(rows, fields, work_dir(spark, "extract"), "long_string", escape=True)
    plain = spark.read.text(f"{path}/lines")
    plain.write.option("compression", "gzip").text(f"{path}/lines/older/zipped")
    for connector in (False, True):
        back = read_extract(spark, path, "long_string", connector=connector, escape=True)
        assert sorted(map(tuple, back.collect())) == sorted(2 * [(f"{i:03}", t) for i, t in enumerate(texts)])


def test_limits_read_the_first_files_that_suffice(spark, tmp_path):
    path = f"{tmp_path}/two words"
    spark.range(40).selectExpr("concat('A', id) AS value").repartition(8).write.text(path)
    fields = [Field("c", "CHAR", 3)]
    for n in (1, 7, 39, 40, 50):
        kept = read_table(spark, path, max_rows=n, layout="fixed", fields=fields)
        assert len({r.c for r in kept.collect()}) == min(n, 40)
    assert len(read_table(spark, path, max_rows=3, layout="fixed", fields=fields).inputFiles()) == 1


# --- large extracts ------------------------------------------------------------------------------


def test_first_lines_by_key_shuffle_no_other_lines(spark):
    path, fields = work_dir(spark, "keyed"), [Field("id", "NUMC", 6), Field("name", "CHAR", 10)]
    write_extract(spark.range(500, 0, -1).selectExpr("id", "concat('n', id) AS name"), fields, path)
    for n in (3, 2000):
        first = read_table(spark, f"{path}/lines", max_rows=n, sorted_by_key=["id"], layout="delimited", fields=fields)
        assert [r.id for r in first.collect()] == [f"{i:06d}" for i in range(1, min(n, 500) + 1)]
        # the lines are chosen by a top-k; only the typed rows that are kept are sorted
        plan = plan_of(first)
        assert "TakeOrderedAndProject" in plan and "LocalLimit" not in plan


def test_first_lines_by_key_split_keys_alone(spark):
    path = work_dir(spark, "keyed")
    spark.createDataFrame([("x~3~a~b~c",), ("y~1~d~e~f",), ("z",), ("w~2~g",)], "value string").write.text(path)
    fields = [Field("kind", "CHAR", 1), Field("id", "INT4", 4), *[Field(f"c{i}", "CHAR", 1) for i in range(3)]]
    first = read_table(spark, path, max_rows=3, sorted_by_key=["id", "kind"], layout="delimited", fields=fields)
    assert [tuple(r) for r in first.collect()] == [("z", None, None, None, None), ("y", 1, "d", "e", "f"), ("w", 2, "g", None, None)]
    # all lines are cut behind the keys, and only those that are kept into all cells
    plan = plan_of(first)
    assert "~, 3)" in plan and plan.count("~, -1)") == plan.count("~, 3)")
    with pytest.raises(ValueError, match="unknown column.*nope; the table has kind, id, c0, c1, c2"):
        read_table(spark, path, max_rows=3, sorted_by_key=["nope"], layout="delimited", fields=fields)


def test_lines_are_compressed_at_the_fastest_level(spark):
    path, fields = work_dir(spark, "packed"), [Field("id", "NUMC", 6), Field("name", "STRING")]
    df = spark.range(3000).selectExpr("id", "concat_ws(' ', id, id * 7919 % 1000, md5(CAST(id % 97 AS STRING))) AS name").coalesce(1)
    write_extract(df, fields, path, compression="gzip")
    (file,) = spark.read.text(f"{path}/lines").inputFiles()
    packed = open(file.removeprefix("file://"), "rb").read()
    lines = gzip.decompress(packed)
    assert lines.count(b"\n") == 3000
    assert len(packed) > (len(zlib.compress(lines, 1)) + len(zlib.compress(lines, 6))) / 2


def test_compressed_lines(spark):
    path, fields = work_dir(spark, "packed"), [Field("id", "NUMC", 6), Field("name", "STRING")]
    df = spark.range(400).selectExpr("id", "repeat('name ', 50) AS name")
    write_extract(df, fields, path, compression="gzip")
    assert all(f.endswith(".gz") for f in spark.read.text(f"{path}/lines").inputFiles())
    assert sorted(r.id for r in read_extract(spark, path).collect()) == [f"{i:06d}" for i in range(400)]
    with pytest.raises(ValueError, match="plain lines"):
        write_extract(df, fields, path, connector=True, compression="gzip")


def test_wide_extract_files_grow_in_number(spark, monkeypatch):
    folder = work_dir(spark, "items")
    columns = "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, CAST(1 AS INT) AS l_linenumber, CAST(id AS DOUBLE) AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP'1996-01-02' AS l_shipdate"
    spark.range(200).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/lineitem.parquet")
    rows = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = 4 * spark.sparkContext.defaultParallelism + 3
    monkeypatch.setattr(wide_queries, "INPUT_BYTES", table_bytes(rows) // parts)
    files = spark.read.text(f"{wide_queries.wide_folder(spark, folder)}/lines").inputFiles()
    assert len(files) >= parts and all(f.endswith(".gz") for f in files)


def test_wide_families_deal_rows_to_tasks(spark, monkeypatch):
    folder = work_dir(spark, "items")
    columns = "id AS l_orderkey, id AS l_partkey, id AS l_suppkey, CAST(1 AS INT) AS l_linenumber, CAST(id AS DOUBLE) AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP'1996-01-02' AS l_shipdate"
    spark.range(200).coalesce(1).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/lineitem.parquet")
    parts = 4 * spark.sparkContext.defaultParallelism + 3
    monkeypatch.setattr(wide_queries, "NARROW_BYTES", table_bytes(spark.read.parquet(f"{folder}/lineitem.parquet")) // parts)
    typed = wide_queries.wide_scan_families(spark, folder)
    assert typed.rdd.getNumPartitions() >= parts
    assert sorted(r.l_orderkey for r in typed.select("l_orderkey").collect()) == [f"{i:010d}" for i in range(200)]


def test_column_digests(spark):
    rows = spark.sql("SELECT * FROM VALUES (1L, 'a', 1.005D), (2L, NULL, NULL), (1L, 'a', -3.5D) AS t(id, name, fltp_1)")
    digest = lambda *values: sum(int(hashlib.md5(v.encode()).hexdigest()[:8], 16) for v in values)
    expected = [(0, digest("1", "2", "1")), (1, digest("a", "-", "a")), (2, digest("1.01", "-", "-3.50"))]
    assert sorted(tuple(r) for r in wide_queries.column_digests(rows).collect()) == expected
    assert wide_queries.column_digests(rows.where("false")).collect() == []


def test_wide_digests_decode_a_line_once(spark):
    path = work_dir(spark, "lines")
    spark.range(1).selectExpr("'x' AS value").write.text(path)
    fields = [Field(f"n{i}", "DEC", 12, 2) for i in range(120)]
    plan = plan_of(wide_queries.column_digests(read_table(spark, path, layout="delimited", fields=fields)))
    # 120 sums side by side, or a filter on the array of all decoded cells, made code too large to be compiled well
    assert "Filter" not in plan and plan.count("split(value") <= 2 and plan.count("partial_sum") == 1


def test_whole_lines_decode_as_single_cells_do(spark):
    types = [("CHAR", 9, 0), ("NUMC", 9, 0), ("STRING", 0, 0), ("INT1", 4, 0), ("INT2", 6, 0), ("INT4", 20, 0), ("INT8", 20, 0), ("FLTP", 24, 0), ("DEC", 9, 2), ("CURR", 24, 4), ("D34N", 34, 6)]
    types += [("DATS", 8, 0), ("TIMS", 6, 0), ("UTCL", 27, 7), ("RAW", 4, 0), ("DTDAY", 11, 0), ("XMLDATA", 0, 0), ("UNHEARD", 5, 0)]
    cells = ["", "  ", "12", " 7-", "1.5-", "-3 ", "\x00", "4\x00 ", "\x00 8", "20240229", "20230229", "235959", "000000", "20240131120000", "0A0B", "x y ", "1e3", "99999999999999999999999"]
    # fields of a type are apart, and each of them meets every cell
    fields = [Field(f"f{i}", *types[i % len(types)]) for i in range(7 * len(types))]
    lines = [("~".join(cells[(i + at) % len(cells)] for i in range(len(fields))),) for at in range(len(cells))] + [("one~two",), (None,)]
    df = spark.createDataFrame(lines, "line string").selectExpr("line", "monotonically_increasing_id() AS c")
    for midnight in (True, False):
        single, whole = (decode_extract(df, fields, "delimited", initial_time_is_null=midnight, whole=w) for w in (False, True))
        assert whole.schema.simpleString() == single.schema.simpleString() and "transform" in plan_of(whole)
        rows = [{r.c: tuple(r) for r in d.collect()} for d in (single, whole)]
        assert rows[0] == rows[1]
    with pytest.raises(Exception, match="cannot hold"):
        decode_extract(df, [f for f in fields if f.type != "UNHEARD"], "delimited", strict=True, whole=True).collect()


def test_column_digests_print_columns_of_a_type_together(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 2.5BD, 'a', 3, 0.125D, 0.125D, DATE'2024-02-29'), (NULL, NULL, '-', -3, 7D, 7D, NULL) AS t(c, v, place, i, fltp_1, d, `day of`)")
    found = {r.position: r.digest for r in wide_queries.column_digests(rows).collect()}
    digest = lambda *values: sum(int(hashlib.md5(v.encode()).hexdigest()[:8], 16) for v in values)
    expected = [digest("1", "-"), digest("2.5", "-"), digest("a", "-"), digest("3", "-3"), digest("0.13", "7.00"), digest("0.125", "7.0"), digest("2024-02-29", "-")]
    assert found == dict(enumerate(expected))
    wide = spark.range(2).selectExpr(*[f"CAST(id + {i} AS DECIMAL(12,2)) AS c{i}" for i in range(50)])
    assert 1 <= plan_of(wide_queries.column_digests(wide)).count("transform(") <= 2


def test_checked_lines_are_not_cut(spark):
    rows = spark.createDataFrame([("x", "y")], "a string, b string")
    assert "split" not in plan_of(encode_extract(rows, [Field("a", "CHAR", 9), Field("b", "CHAR", 9)], "delimited"))


def test_lines_are_checked_by_their_cells(spark):
    fields = [Field("a", "CHAR", 9), Field("b", "CHAR", 9)]
    rows = spark.createDataFrame([("x", "y"), ("", None)], "a string, b string")
    for delimiter in ("~", "|", "\\", "::", ".*"):
        assert [r.line for r in encode_extract(rows, fields, "delimited", delimiter).collect()] == [f"x{delimiter}y", delimiter]
        with pytest.raises(Exception, match="contains the delimiter"):
            encode_extract(rows.selectExpr("a", f"'{delimiter * 2}' AS b"), fields, "delimited", delimiter).collect()
    for cell in ("1\n2", "1\r2"):
        with pytest.raises(Exception, match="line break"):
            write_extract(spark.createDataFrame([(cell, "y")], "a string, b string"), fields, work_dir(spark, "broken"))


def test_large_methods_are_left_to_projections(spark):
    other = spark.newSession()
    for given, kept in (("65535", JIT_LIMIT), ("4000", "4000")):
        other.conf.set(JIT_CONF, given)
        encode_extract(other.range(1), [Field("id", "NUMC", 6)])
        assert other.conf.get(JIT_CONF) == kept
        other.conf.set(JIT_CONF, given)
        decode_cells(other.range(1).selectExpr("CAST(id AS STRING) AS id"), [Field("id", "NUMC", 6)])
        assert other.conf.get(JIT_CONF) == kept


def test_lines_are_encoded_once_for_a_join(spark):
    fields = [Field("id", "NUMC", 6), Field("price", "DEC", 9, 2)]
    lines = encode_extract(spark.createDataFrame([(1, 1.5), (2, -2.25), (None, 3.0)], "id long, price double"), fields, "fixed")
    items = number_keys(decode_extract(computed_once(lines), fields, "fixed"), ["id"])
    joined = items.join(spark.range(3).withColumnRenamed("id", "k"), F.col("id") == F.col("k"))
    assert sorted((r.id, str(r.price)) for r in joined.collect()) == [(0, "3.00"), (1, "1.50"), (2, "-2.25")]
    assert not [line for line in plan_of(joined).splitlines() if line.startswith("Condition") and "lpad" in line]


def test_tasks_of_bounded_scans_are_bounded(spark, monkeypatch):
    path = f"{work_dir(spark, 'odd name')}/rows.parquet"
    spark.range(4000).repartition(12).write.parquet(path)
    df = spark.read.parquet(path)
    assert table_bytes(df) > 0 and table_bytes(spark.range(3)) == 0
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    other.conf.set("spark.sql.files.openCostInBytes", "0")
    assert read_table(other, path, threads=1).rdd.getNumPartitions() == 1
    monkeypatch.setattr(reader, "TASK_BYTES", table_bytes(df) // 5)
    scan = read_table(other, path, threads=1)
    assert scan.rdd.getNumPartitions() >= 5 and scan.count() == 4000
