"""Dictionary searches and metadata views over extracts derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.globs import matches
from ..operators import directory as Dir
from ..operators.cube import Characteristic, Cube, Measure, Variable
from ..operators.metadata import meta_view, transform_fields, usage_stats
from ..sources.dictionary import describe_fields, show_tables
from ..sources.sqlfunctions import register_searches
from .registry import fixture, plain, query, table

# --- table and field dictionary ----------------------------------------------------------------

TABLE_ENTRIES = """
SELECT p_type || '_' || p_partkey AS table_name, p_name AS text,
       CASE p_size % 5 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'TRANSP' WHEN 2 THEN 'POOL' WHEN 3 THEN 'CLUSTER' ELSE 'INTTAB' END AS class,
       CASE WHEN p_partkey % 3 = 0 THEN 'D' ELSE 'E' END AS language
FROM {part}
"""
SHOWN = f"SELECT table_name, text, class FROM ({plain(TABLE_ENTRIES)}) WHERE language = 'E' AND class IN ('VIEW', 'TRANSP', 'POOL', 'CLUSTER')"


@query("show_tables", f"{SHOWN} AND table_name LIKE 'ECO%' AND text LIKE '%ring%'")
def run_show_tables(spark, sf_dir):
    return show_tables(fixture(spark, sf_dir, TABLE_ENTRIES), tablename="ECO*", text="%ring%")


@query("show_tables_none", f"{SHOWN} AND table_name LIKE 'NO SUCH%'")
def show_tables_none(spark, sf_dir):
    return show_tables(fixture(spark, sf_dir, TABLE_ENTRIES), tablename="NO SUCH*")


@query("glob_match", f"SELECT table_name FROM ({plain(TABLE_ENTRIES)}) WHERE table_name LIKE '%!_1_' ESCAPE '!'")
def glob_match(spark, sf_dir):
    """The underscore is itself: numbers of three digits whose second is 1 are near misses."""
    return fixture(spark, sf_dir, TABLE_ENTRIES).where(matches("table_name", "*_1?")).select("table_name")


FIELD_ENTRIES = """
SELECT 'T' || l_orderkey AS table_name, l_linenumber AS pos, CASE WHEN l_linenumber = 1 THEN 'X' ELSE '' END AS is_key, 'F' || l_partkey AS field,
       'field of ' || l_suppkey AS text,
       CASE l_partkey % 8 WHEN 0 THEN 'CHAR' WHEN 1 THEN 'DATS' WHEN 2 THEN 'DEC' WHEN 3 THEN 'INT4' WHEN 4 THEN 'RAW' WHEN 5 THEN 'UTCL' WHEN 6 THEN 'NODE' ELSE 'FLTP' END AS sap_type,
       CAST(l_suppkey % 40 AS INT) AS length, CAST(l_linenumber % 4 AS INT) AS decimals, '' AS check_table, '' AS ref_table, '' AS ref_field,
       CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'E' END AS language
FROM {lineitem}
"""


@query(
    "describe_fields",
    "SELECT table_name, pos, is_key, field, text, sap_type, length, decimals, check_table, ref_table, ref_field, language, CASE sap_type WHEN 'CHAR' THEN 'STRING' "
    "WHEN 'DATS' THEN 'DATE' WHEN 'DEC' THEN 'DECIMAL(' || greatest(1, least(length, 38)) || ',' || least(decimals, greatest(1, least(length, 38))) || ')' "
    f"WHEN 'INT4' THEN 'BIGINT' WHEN 'RAW' THEN 'BINARY' WHEN 'UTCL' THEN 'TIMESTAMP_NTZ' WHEN 'FLTP' THEN 'DOUBLE' END AS declared_type FROM ({plain(FIELD_ENTRIES)}) WHERE language = 'E'",
)
def run_describe_fields(spark, sf_dir):
    return describe_fields(fixture(spark, sf_dir, FIELD_ENTRIES))


# --- functions ---------------------------------------------------------------------------------

FUNCTIONS = """
SELECT p_name || ' ' || p_partkey AS name, p_brand AS "group", p_brand || ' group' AS group_text, p_type AS text, CASE WHEN p_partkey % 4 = 0 THEN 'D' ELSE 'E' END AS language
FROM {part}
"""
FUNCTIONS_SPARK = FUNCTIONS.replace('"group"', "`group`")


@query("show_functions", f"SELECT name, \"group\", text FROM ({plain(FUNCTIONS)}) WHERE name LIKE 'red%' AND \"group\" LIKE 'Brand#1_' AND language = 'E'")
def show_functions(spark, sf_dir):
    return Dir.show_functions(fixture(spark, sf_dir, FUNCTIONS_SPARK), "red*", "Brand#1?", "E")


@query("show_groups", f"SELECT DISTINCT \"group\" AS name, group_text AS text FROM ({plain(FUNCTIONS)}) WHERE \"group\" LIKE 'Brand#2%'")
def show_groups(spark, sf_dir):
    return Dir.show_groups(fixture(spark, sf_dir, FUNCTIONS_SPARK), "Brand#2*")


PARAMETERS = """
SELECT 'F' || l_orderkey AS function, CASE l_linenumber % 4 WHEN 0 THEN 'import' WHEN 1 THEN 'export' WHEN 2 THEN 'changing' ELSE 'tables' END AS direction,
       'P' || l_partkey AS name, 'supplier ' || l_suppkey AS text, CASE l_partkey % 3 WHEN 0 THEN 'CHAR' WHEN 1 THEN 'DEC' ELSE 'INT4' END AS type, CAST(l_quantity AS INT) AS length, CAST(l_linenumber AS INT) AS decimals,
       CAST(NULL AS VARCHAR(10)) AS "default", l_linestatus = 'F' AS optional, l_linenumber AS pos, '' AS ref
FROM {lineitem}
"""
# functions without parameters, functions without header, and more source lines than parameters
HEADERS = """
SELECT 'F' || o_orderkey AS function, 'F' || o_orderkey AS name, o_orderpriority AS text, 'G' || o_custkey AS "group", o_custkey % 2 = 0 AS remote FROM {orders} WHERE o_orderkey % 10 <> 3
UNION ALL
SELECT 'N' || p_partkey, 'N' || p_partkey, p_name, p_brand, false FROM {part}
"""
SOURCE_LINES = """
SELECT 'F' || l_orderkey AS function, l_linenumber * 3 AS line_no, 'part ' || l_partkey AS line FROM {lineitem}
UNION ALL
SELECT 'F' || l_orderkey, l_linenumber * 3 + 1, 'supplier ' || l_suppkey FROM {lineitem} WHERE l_orderkey % 4 <> 1
"""
SIGNATURE_ROWS = 5
_SQL_TYPE = "CASE type WHEN 'CHAR' THEN 'STRING' WHEN 'DEC' THEN 'DECIMAL(' || greatest(1, least(length, 38)) || ',' || least(decimals, greatest(1, least(length, 38))) || ')' ELSE 'BIGINT' END"
_LISTED = ", ".join(
    f"coalesce(string_agg(direction || ' ' || pos || ' ' || name || ' ' || {_SQL_TYPE} || ' ' || text, ';' ORDER BY pos, name, text, type, length) FILTER (WHERE direction = '{d}'), '') AS \"{d}\""
    for d in Dir.DIRECTIONS
)
_LISTS = ", ".join(f"coalesce(\"{d}\", '') AS \"{d}\"" for d in Dir.DIRECTIONS)


@query(
    "describe_function_nested",
    f"WITH p AS (SELECT function, pos // {SIGNATURE_ROWS} AS part, {_LISTED} FROM (SELECT DISTINCT * FROM ({plain(PARAMETERS)})) GROUP BY 1, 2), "
    f"s AS (SELECT function, line_no // {SIGNATURE_ROWS} AS part, string_agg(line, chr(10) ORDER BY line_no, line) AS source FROM (SELECT DISTINCT * FROM ({plain(SOURCE_LINES)})) GROUP BY 1, 2), "
    f"h AS (SELECT *, 0 AS part FROM ({plain(HEADERS)})), k AS (SELECT function, part FROM p UNION SELECT function, part FROM s UNION SELECT function, part FROM h) "
    f"SELECT function, CAST(part AS BIGINT) AS part, name, text, \"group\", remote, {_LISTS}, source FROM k LEFT JOIN p USING (function, part) LEFT JOIN s USING (function, part) LEFT JOIN h USING (function, part)",
)
def describe_function_nested(spark, sf_dir):
    extracts = [fixture(spark, sf_dir, sql.replace('"default"', "`default`").replace('"group"', "`group`")) for sql in (PARAMETERS, HEADERS, SOURCE_LINES)]
    nested = Dir.describe_function(*extracts, size=SIGNATURE_ROWS)

    def listed(direction: str):
        label = F.transform(direction, lambda p: F.concat_ws(" ", p["direction"], p["pos"].cast("string"), p["name"], p["sql_type"], p["text"]))
        return F.array_join(label, ";").alias(direction)

    return nested.select("function", "part", "name", "text", "group", "remote", *[listed(d) for d in Dir.DIRECTIONS], "source")


# --- objects, cubes, hierarchies ---------------------------------------------------------------

OBJECTS = """
SELECT p_brand || '/' || p_partkey AS technical_name, p_name AS text, CASE p_size % 4 WHEN 0 THEN 'CUBE' WHEN 1 THEN 'QUERY' WHEN 2 THEN 'INFOAREA' ELSE 'INFOPROVIDER' END AS type,
       p_brand AS cube_name, p_size % 4 = 2 AS is_folder, '20240101' AS last_changed, 'DEV' AS last_changed_by, p_size % 7 AS level
FROM {part}
"""
OBJECT_NAMES = ", ".join(Dir.OBJECT_COLUMNS)


@query("show_objects", f"SELECT {OBJECT_NAMES} FROM ({plain(OBJECTS)}) WHERE level <= 4 AND (technical_name LIKE '%7%' OR text LIKE '%7%')")
def show_objects(spark, sf_dir):
    return Dir.show_objects(fixture(spark, sf_dir, OBJECTS), search="*7*", search_in_text=True, levels=4)


@query("show_cubes", f"SELECT {OBJECT_NAMES} FROM ({plain(OBJECTS)}) WHERE type = 'CUBE' AND text LIKE '%ring%'")
def show_cubes(spark, sf_dir):
    return Dir.show_cubes(fixture(spark, sf_dir, OBJECTS), "*ring*", search_in_key=False, search_in_text=True)


@query("show_queries", f"SELECT {OBJECT_NAMES} FROM ({plain(OBJECTS)}) WHERE type = 'QUERY'")
def show_queries(spark, sf_dir):
    return Dir.show_queries(fixture(spark, sf_dir, OBJECTS))


HIERARCHIES = """
SELECT 'H' || c_custkey AS technical_name, c_name AS text, CASE WHEN c_custkey % 3 = 0 THEN 'D' ELSE 'A' END AS version, '99991231' AS valid_to_date, c_mktsegment AS info_object
FROM {customer}
"""


@query("show_hierarchies", f"SELECT technical_name, text, version, valid_to_date FROM ({plain(HIERARCHIES)}) WHERE info_object = 'BUILDING' AND technical_name LIKE 'H1%'")
def show_hierarchies(spark, sf_dir):
    return Dir.show_hierarchies(fixture(spark, sf_dir, HIERARCHIES), "H1*", "BUILDING")


ELEMENTS = """
SELECT 'C' || l_partkey AS cube, 'Q' || (l_partkey % 10) AS query, 'E' || l_linenumber AS element, CASE WHEN l_linenumber % 2 = 0 THEN 'MEASURE' ELSE 'CHARACTERISTIC' END AS role,
       'text ' || l_linenumber AS text
FROM {lineitem}
"""


@query(
    "describe_cube",
    f"SELECT cube, coalesce(string_agg(DISTINCT element, ',' ORDER BY element) FILTER (WHERE role = 'CHARACTERISTIC'), '') AS characteristics, "
    f"coalesce(string_agg(DISTINCT element, ',' ORDER BY element) FILTER (WHERE role = 'MEASURE'), '') AS measures FROM ({plain(ELEMENTS)}) WHERE query = 'Q3' GROUP BY cube",
)
def describe_cube(spark, sf_dir):
    nested = Dir.describe_cube(fixture(spark, sf_dir, ELEMENTS), query="Q3")

    def joined(name: str):
        return F.array_join(F.transform(name, lambda e: e.getField("element")), ",").alias(name)

    return nested.select("cube", joined("characteristics"), joined("measures"))


INFOOBJECTS = """
SELECT p_brand || '_' || p_partkey AS info_object, CASE p_size % 3 WHEN 0 THEN 'CHAR' WHEN 1 THEN 'NUMC' ELSE 'DATS' END AS data_type, 'ALPHA' AS conv_exit,
       p_size AS output_length, p_size AS length, 0 AS decimals FROM {part}
"""


@query("describe_infoobject", f"SELECT * FROM ({plain(INFOOBJECTS)})")
def describe_infoobject(spark, sf_dir):
    return Dir.describe_infoobject(fixture(spark, sf_dir, INFOOBJECTS))


NUMBERED_INFOOBJECTS = INFOOBJECTS.replace("p_brand || '_' || p_partkey", "'IO_' || p_partkey")


@query("describe_infoobject_one", f"SELECT * FROM ({plain(NUMBERED_INFOOBJECTS)}) WHERE info_object = 'IO_7'")
def describe_infoobject_one(spark, sf_dir):
    return Dir.describe_infoobject(fixture(spark, sf_dir, NUMBERED_INFOOBJECTS), "IO_7")


# --- metadata views ----------------------------------------------------------------------------

PROVIDERS = """
SELECT 'P' || p_partkey AS provider, CASE p_size % 5 WHEN 0 THEN 'CUBE' WHEN 1 THEN 'ADSO' WHEN 2 THEN 'HCPR' WHEN 3 THEN 'ODSO' ELSE 'ODSVIEW' END AS type,
       p_name || ' ' || v.version AS text, v.version
FROM {part} CROSS JOIN (VALUES ('A'), ('D')) v(version) WHERE (v.version = 'A' AND p_partkey % 5 <> 0) OR (v.version = 'D' AND p_partkey % 3 <> 1)
"""
PROVIDER_FIELDS = """
SELECT 'P' || l_partkey AS provider, 'F' || l_linenumber AS field, l_linenumber AS pos, CASE WHEN l_linenumber < 4 THEN 'CHARACTERISTIC' ELSE 'MEASURE' END AS role FROM {lineitem}
"""
QUERY_USAGE = """
SELECT DISTINCT event_type AS query, 'USER' AS object_type, CAST(user_id AS VARCHAR(20)) AS object FROM {events}
"""
OBJXREF = """
SELECT DISTINCT 'ORDER' AS object_type, CAST(l_orderkey AS VARCHAR(20)) AS object, 'PART' AS used_type, CAST(l_partkey AS VARCHAR(20)) AS used FROM {lineitem}
"""
DATASOURCES = """
SELECT 'DS' || s_suppkey AS datasource, 'SYS' || s_nationkey AS source_system, s_name AS text, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'D' END AS version FROM {supplier}
"""
DATASOURCE_FIELDS = """
SELECT DISTINCT 'DS' || l_suppkey AS datasource, 'F' || l_partkey AS field, l_linenumber AS pos, 'CHAR' AS type FROM {lineitem}
"""
TRANSFORMATIONS = """
SELECT 'T' || o_orderkey AS transformation, 'DS' || o_custkey AS source, 'P' || (o_orderkey % 100) AS target, 'A' AS version FROM {orders}
"""
COMPOSITE_MAPPING = """
SELECT DISTINCT 'P' || l_partkey AS provider, 'F' || l_linenumber AS field, 'S' || l_suppkey AS part_provider, 'F' || l_linenumber AS part_field FROM {lineitem}
"""
BEX_QUERIES = """
SELECT 'Q' || c_custkey AS query, c_name AS text, c_mktsegment AS provider, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'D' END AS version FROM {customer}
"""
QUERY_ELEMENTS = """
SELECT 'Q' || o_custkey AS query, 'E' || o_orderkey AS element, o_orderstatus AS element_type, o_orderpriority AS text FROM {orders}
"""
META_INFOOBJECTS = """
SELECT p_brand || '_' || p_partkey AS info_object, p_type AS type, p_name AS text, 'A' AS version FROM {part}
"""
LOG = "SELECT event_type AS object, event_type AS query, CAST(value AS DECIMAL(18,2)) AS runtime, ts FROM {events}"


def _view(key: str, view: str, extracts: dict[str, str], oracle: str, **arguments: str) -> None:
    @query(key, oracle)
    def run(spark, sf_dir):
        return meta_view({name: fixture(spark, sf_dir, sql) for name, sql in extracts.items()}, view, **arguments)


def _active(sql: str, key: str, columns: str, where: str = "true") -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY version) AS rn FROM ({plain(sql)}) WHERE {where}) WHERE rn = 1"


_view("meta_providers", "providers", {"providers": PROVIDERS}, _active(PROVIDERS, "provider", "provider, type, text, version", "type = 'CUBE'"), provider_type="CUBE")
_view(
    "meta_provider_fields",
    "provider_fields",
    {"provider_fields": PROVIDER_FIELDS, "providers": PROVIDERS},
    f"SELECT provider, field, pos, role FROM ({plain(PROVIDER_FIELDS)}) WHERE provider IN (SELECT provider FROM ({plain(PROVIDERS)}))",
)
_view("meta_datasources", "datasources", {"datasources": DATASOURCES}, f"SELECT datasource, source_system, text, version FROM ({plain(DATASOURCES)})")
_view(
    "meta_datasource_fields",
    "datasource_fields",
    {"datasource_fields": DATASOURCE_FIELDS},
    f"SELECT datasource, field, pos, type FROM ({plain(DATASOURCE_FIELDS)}) WHERE datasource = 'DS5'",
    datasource="DS5",
)
_view(
    "meta_transformations", "transformations", {"transformations": TRANSFORMATIONS}, f"SELECT transformation, source, target, version FROM ({plain(TRANSFORMATIONS)})"
)
_view("meta_composites", "composites", {"providers": PROVIDERS}, _active(PROVIDERS, "provider", "provider, text, version", "type = 'HCPR'"))
_view(
    "meta_composite_mapping",
    "composite_mapping",
    {"composite_mapping": COMPOSITE_MAPPING},
    f"SELECT provider, field, part_provider, part_field FROM ({plain(COMPOSITE_MAPPING)})",
)
_view("meta_queries", "queries", {"queries": BEX_QUERIES}, f"SELECT query, text, provider, version FROM ({plain(BEX_QUERIES)})")
_view("meta_query_usage", "query_usage", {"query_usage": QUERY_USAGE}, f"SELECT query, object_type, object FROM ({plain(QUERY_USAGE)}) WHERE query = 'purchase'", query="purchase")
_view("meta_query_elements", "query_elements", {"query_elements": QUERY_ELEMENTS}, f"SELECT query, element, element_type, text FROM ({plain(QUERY_ELEMENTS)})")
_view("meta_objxref", "objxref", {"objxref": OBJXREF}, f"SELECT object_type, object, used_type, used FROM ({plain(OBJXREF)})")
_view("meta_infoobjects", "infoobjects", {"infoobjects": META_INFOOBJECTS}, f"SELECT info_object, type, text, version FROM ({plain(META_INFOOBJECTS)})")

STATS = (
    "count(*) AS runs, CAST(sum(runtime) AS DOUBLE) AS runtime, CAST(sum(runtime) AS DOUBLE) / count(*) AS mean_runtime, CAST(max(runtime) AS DOUBLE) AS longest, "
    "min(ts) AS first_run, max(ts) AS last_run"
)


@query("usage_stats", f"SELECT object, {STATS} FROM ({plain(LOG)}) GROUP BY object")
def run_usage_stats(spark, sf_dir):
    return usage_stats(fixture(spark, sf_dir, LOG))


@query("meta_query_stats", f"SELECT query, count(*) AS runs, CAST(sum(runtime) AS DOUBLE) AS runtime, CAST(max(runtime) AS DOUBLE) AS longest FROM ({plain(LOG)}) GROUP BY query")
def meta_query_stats(spark, sf_dir):
    return meta_view({"query_stats": usage_stats(fixture(spark, sf_dir, LOG), "query")}, "query_stats")


RULES = """
SELECT 'T' || (l_orderkey % 97) AS transformation, l_orderkey AS rule, l_linenumber % 2 AS paramtype, 'F' || l_partkey AS field, CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'A' END AS version
FROM {lineitem}
"""


@query(
    "meta_transform_fields",
    f"WITH r AS ({plain(RULES)}), c AS (SELECT DISTINCT transformation, rule, paramtype, field FROM (SELECT *, min(version) OVER (PARTITION BY transformation, rule) AS best FROM r) WHERE version = best), "
    "s AS (SELECT transformation, rule, count(*) FILTER (WHERE paramtype = 0) AS ns, count(*) FILTER (WHERE paramtype = 1) AS nt FROM c GROUP BY ALL), "
    "a AS (SELECT transformation, rule, field AS source_field FROM c WHERE paramtype = 0), b AS (SELECT transformation, rule, field AS target_field FROM c WHERE paramtype = 1) "
    "SELECT transformation, rule, source_field, target_field FROM a FULL JOIN b USING (transformation, rule) JOIN s USING (transformation, rule) WHERE ns <= 1 OR nt <= 1 "
    "UNION ALL SELECT transformation, rule, source_field, NULL FROM a JOIN s USING (transformation, rule) WHERE ns > 1 AND nt > 1 "
    "UNION ALL SELECT transformation, rule, NULL, target_field FROM b JOIN s USING (transformation, rule) WHERE ns > 1 AND nt > 1",
)
def meta_transform_fields(spark, sf_dir):
    return transform_fields(fixture(spark, sf_dir, RULES))


# --- replication sources -----------------------------------------------------------------------

SOURCES = """
SELECT CASE p_size % 5 WHEN 0 THEN 'BW' WHEN 1 THEN 'ABAP_CDS' WHEN 2 THEN 'SAPI' WHEN 3 THEN 'SLT' ELSE 'HANA' END AS context, 'context ' || (p_size % 5) AS context_text,
       '750' AS release, 'S' || p_partkey || '$P' AS technical_name, p_name AS text, substr(p_type, 1, 1) AS semantics, p_type AS semantics_text, p_partkey % 2 = 0 AS supports_delta
FROM {part}
"""
SOURCE_FIELDS = "SELECT 'S' || l_partkey || '$P' AS technical_name, l_linenumber AS pos, 'F' || l_suppkey AS field, l_returnflag AS type FROM {lineitem}"
SOURCE_TEXTS = """
SELECT 'S' || p_partkey || '$P' AS technical_name, l.language, p_name || ' ' || l.language AS text FROM {part} CROSS JOIN (VALUES ('D'), ('E')) l(language)
"""


@query("odp_contexts", f"SELECT DISTINCT context AS technical_name, context_text AS text, release FROM ({plain(SOURCES)})")
def odp_contexts(spark, sf_dir):
    return Dir.show_contexts(fixture(spark, sf_dir, SOURCES))


@query("odp_show", f"SELECT technical_name, text, semantics, semantics_text FROM ({plain(SOURCES)}) WHERE context = 'BW' AND technical_name LIKE 'S1%'")
def odp_show(spark, sf_dir):
    return Dir.show_odp(fixture(spark, sf_dir, SOURCES), "BW", "S1*")


@query(
    "odp_describe",
    f"WITH s AS (SELECT * FROM ({plain(SOURCES)}) WHERE context = 'ABAP_CDS'), f AS (SELECT technical_name, count(*) AS fields, string_agg(pos || field, ',' ORDER BY pos, field, type) AS names "
    f"FROM (SELECT DISTINCT * FROM ({plain(SOURCE_FIELDS)})) GROUP BY 1), t AS (SELECT technical_name, string_agg(text, ',' ORDER BY language) AS texts FROM ({plain(SOURCE_TEXTS)}) GROUP BY 1) "
    "SELECT technical_name, s.text, supports_delta, fields, names, t.texts FROM s LEFT JOIN f USING (technical_name) LEFT JOIN t USING (technical_name)",
)
def odp_describe(spark, sf_dir):
    extracts = [fixture(spark, sf_dir, sql) for sql in (SOURCES, SOURCE_FIELDS, SOURCE_TEXTS)]
    described = Dir.describe_odp(*extracts, "ABAP_CDS")
    names = F.transform("fields", lambda f: F.concat(f.getField("pos").cast("string"), f.getField("field")))
    return described.select(
        "technical_name",
        "text",
        "supports_delta",
        F.when(F.col("fields").isNotNull(), F.size("fields").cast("bigint")).alias("fields"),
        F.array_join(names, ",").alias("names"),
        F.array_join(F.transform("texts", lambda t: t.getField("text")), ",").alias("texts"),
    )


# --- SQL surface -------------------------------------------------------------------------------


@query("sql_table_function", f"{SHOWN} AND table_name LIKE 'STANDARD%'")
def sql_table_function(spark, sf_dir):
    register_searches(spark, tables=fixture(spark, sf_dir, TABLE_ENTRIES))
    return spark.sql("SELECT * FROM show_tables('STANDARD*', '*')")


@query(
    "sql_function_search",
    f"SELECT name, \"group\", text FROM ({plain(FUNCTIONS)}) WHERE name LIKE '%widget%' AND \"group\" IN (SELECT \"group\" FROM ({plain(FUNCTIONS)}) WHERE \"group\" LIKE 'Brand#1_')",
)
def sql_function_search(spark, sf_dir):
    register_searches(spark, functions=fixture(spark, sf_dir, FUNCTIONS_SPARK))
    return spark.sql("SELECT f.* FROM show_functions('*widget*', '*') f JOIN show_groups('Brand#1?') g ON f.`group` = g.name")


@query("sql_object_search", f"SELECT technical_name, text, type, cube_name FROM ({plain(OBJECTS)}) WHERE type = 'QUERY' AND technical_name LIKE '%/1_'")
def sql_object_search(spark, sf_dir):
    register_searches(spark, objects=fixture(spark, sf_dir, OBJECTS))
    return spark.sql("SELECT * FROM show_objects('QUERY', '*/1?')")


@query("sql_describe_fields", f"SELECT pos, field, sap_type FROM ({plain(FIELD_ENTRIES)}) WHERE table_name = 'T5' AND language = 'E'")
def sql_describe_fields(spark, sf_dir):
    register_searches(spark, fields=fixture(spark, sf_dir, FIELD_ENTRIES))
    return spark.sql("SELECT pos, field, sap_type FROM describe_fields('T5')")


@query(
    "sql_describe_cube",
    f"SELECT DISTINCT cube, element, text FROM ({plain(ELEMENTS)}) WHERE cube = 'C7' AND role = 'CHARACTERISTIC'",
)
def sql_describe_cube(spark, sf_dir):
    register_searches(spark, described_cubes=Dir.describe_cube(fixture(spark, sf_dir, ELEMENTS)))
    return spark.sql("SELECT cube, c.element, c.text FROM describe_cube('C7') LATERAL VIEW explode(characteristics) AS c")


@query(
    "sql_describe_function",
    f"SELECT function, name, {_SQL_TYPE} AS sql_type, text FROM (SELECT DISTINCT * FROM ({plain(PARAMETERS)})) WHERE function = 'F7' AND direction = 'export'",
)
def sql_describe_function(spark, sf_dir):
    parameters = fixture(spark, sf_dir, PARAMETERS.replace('"default"', "`default`"))
    register_searches(spark, described_functions=Dir.describe_function(parameters, size=SIGNATURE_ROWS))
    return spark.sql("SELECT function, p.name, p.sql_type, p.text FROM describe_function('F7') LATERAL VIEW explode(export) AS p")


@query(
    "list_variables",
    "SELECT v.*, members FROM (VALUES ('ZSEGMENT', 'Segment', true, true, false, 'CHARACTERISTIC_VALUE', 'SELECTION_OPTION', 'MANDATORY_NOT_INITIAL', 'segment'), "
    "('ZNATION', '', false, true, false, 'CHARACTERISTIC_VALUE', 'VALUE', 'OPTIONAL', 'nation'), ('ZNODE', 'Node', true, true, false, 'HIERARCHY_NODE', 'VALUE', 'MANDATORY', 'nation'), "
    "('ZEXIT', '', false, false, true, 'CHARACTERISTIC_VALUE', 'SELECTION_OPTION', 'OPTIONAL', 'nation')) "
    "v(name, text, mandatory, input_enabled, is_exit_variable, var_type, selection_type, entry_type, reference_char) "
    "JOIN (SELECT 'segment' AS name, count(DISTINCT c_mktsegment) AS members FROM customer UNION ALL SELECT 'nation', count(DISTINCT c_nationkey) FROM customer) m "
    "ON m.name = v.reference_char",
)
def list_variables(spark, sf_dir):
    """All columns of a query's variables, with the number of members each can choose from."""
    chars = [Characteristic("segment", "c_mktsegment"), Characteristic("nation", "c_nationkey")]
    variables = [
        Variable("ZSEGMENT", "segment", "Segment", mandatory=True, initial_allowed=False, reference_char="segment"),
        Variable("ZNATION", "nation", selection_type="VALUE", reference_char="nation"),
        Variable("ZNODE", "nation", "Node", mandatory=True, var_type="HIERARCHY_NODE", selection_type="VALUE", reference_char="nation"),
        Variable("ZEXIT", "nation", input_enabled=False, is_exit_variable=True, reference_char="nation"),
    ]
    state = Cube.of(table(spark, sf_dir, "customer"), chars, [Measure("c_acctbal", "balance")], variables)
    members = state.describe().select(F.col("name").alias("reference_char"), "members")
    return state.list_variables().join(members, "reference_char")

