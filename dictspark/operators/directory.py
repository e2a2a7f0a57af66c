"""Searches over dictionary extracts: functions, groups, objects, hierarchies, replication sources.

Every search takes the extract as a DataFrame and returns a filtered one, so the predicates reach
the file scan of the extract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import matches
from ..sources.dictionary import declared_type
from .arguments import CHANGING, EXPORT, IMPORT, TABLES
from .bounded import GROUP_ROWS, PART, part_at, part_by

# Object types, directions, and result columns.
OBJECT_TYPES = ("INFOPROVIDER", "QUERY", "CUBE", "INFOAREA")
DIRECTIONS = (IMPORT, EXPORT, CHANGING, TABLES)
PARAMETER_COLUMNS = ("name", "text", "type", "length", "decimals", "default", "optional", "pos", "ref")
HEADER_COLUMNS = ("name", "text", "group", "remote")
OBJECT_COLUMNS = ("technical_name", "text", "type", "cube_name", "is_folder", "last_changed", "last_changed_by", "level")
ANY = "*"


def _language(df: DataFrame, language: str | None) -> DataFrame:
    return df if language is None else df.where(F.col("language") == language)


def show_functions(functions: DataFrame, funcname: str = ANY, groupname: str | None = None, language: str | None = None) -> DataFrame:
    """Function entries (``name, group, text, language``) by name, group and language."""
    found = _language(functions, language).where(matches("name", funcname))
    if groupname is not None:
        found = found.where(matches("group", groupname))
    return found.select("name", "group", "text")


def show_groups(functions: DataFrame, groupname: str = ANY, language: str | None = None) -> DataFrame:
    """Function groups (``name, text``), each once."""
    found = _language(functions, language).where(matches("group", groupname))
    return found.select(F.col("group").alias("name"), F.col("group_text").alias("text")).distinct()


def describe_function(parameters: DataFrame, headers: DataFrame | None = None, sources: DataFrame | None = None, size: int = GROUP_ROWS) -> DataFrame:
    """One row per function: its header, its parameters as one list per direction, its source as one text.

    ``parameters`` has a ``function``, a ``direction`` and :data:`PARAMETER_COLUMNS`, and every listed parameter also tells its direction
    and SQL type. ``headers`` has :data:`HEADER_COLUMNS` and ``sources`` numbered lines; both are optional. A function that any of the
    three names is described; what is missing is NULL or an empty list, and repeated rows count once.

    So that no list grows without bound, rows are parts (:func:`part_at`): part n has the parameters and lines of the n-th ``size`` positions,
    part 0 the header. All three inputs meet in one aggregation.
    """
    item = F.struct("pos", *[c for c in PARAMETER_COLUMNS if c != "pos"], F.col("declared").alias("sql_type"), "direction")
    typed = parameters.withColumn("sap_type", F.col("type")).withColumn("declared", declared_type())
    rows = typed.select("function", part_at(F.col("pos"), size).alias(PART), item.alias("item"))
    if headers is not None:
        named = headers.select("function", F.lit(0).cast("bigint").alias(PART), F.struct(*[F.col(c) for c in HEADER_COLUMNS]).alias("header"))
        rows = rows.unionByName(named, allowMissingColumns=True)
    if sources is not None:
        lines = sources.select("function", part_at(F.col("line_no"), size).alias(PART), F.struct("line_no", "line").alias("line"))
        rows = rows.unionByName(lines, allowMissingColumns=True)
    lists = [F.sort_array(F.collect_set(F.when(F.col("item.direction") == d, F.col("item")))).alias(d) for d in DIRECTIONS]
    if headers is not None:
        lists.append(F.max("header").alias("header"))
    if sources is not None:
        lists.append(F.transform(F.sort_array(F.collect_set("line")), lambda r: r.getField("line")).alias("lines"))
    out = rows.groupBy("function", PART).agg(*lists)
    shown = [F.col(f"header.{c}").alias(c) for c in HEADER_COLUMNS] if headers is not None else []
    source = [F.when(F.size("lines") > 0, F.array_join("lines", "\n")).alias("source")] if sources is not None else []
    return out.select("function", PART, *shown, *DIRECTIONS, *source)


def show_objects(
    objects: DataFrame,
    obj_type: str | None = None,
    search: str = ANY,
    search_in_key: bool = True,
    search_in_text: bool = False,
    levels: int | None = None,
) -> DataFrame:
    """Entries of the object tree by type, pattern in key and/or text, and depth."""
    found = objects
    if obj_type is not None:
        if obj_type.upper() not in OBJECT_TYPES:
            raise ValueError(f"object type {obj_type!r} is not one of {OBJECT_TYPES}")
        found = found.where(F.col("type") == obj_type.upper())
    if levels is not None:
        found = found.where(F.col("level") <= levels)
    hits: list[Column] = []
    if search_in_key:
        hits.append(matches("technical_name", search))
    if search_in_text:
        hits.append(matches("text", search))
    if hits:
        found = found.where(hits[0] if len(hits) == 1 else hits[0] | hits[1])
    return found.select(*OBJECT_COLUMNS)


def show_cubes(objects: DataFrame, search: str = ANY, search_in_key: bool = True, search_in_text: bool = False) -> DataFrame:
    return show_objects(objects, "CUBE", search, search_in_key, search_in_text)


def show_queries(objects: DataFrame, search: str = ANY, search_in_key: bool = True, search_in_text: bool = False) -> DataFrame:
    return show_objects(objects, "QUERY", search, search_in_key, search_in_text)


def show_hierarchies(hierarchies: DataFrame, search: str = ANY, info_object: str | None = None) -> DataFrame:
    found = hierarchies.where(matches("technical_name", search))
    if info_object is not None:
        found = found.where(F.col("info_object") == info_object)
    return found.select("technical_name", "text", "version", "valid_to_date")


def describe_cube(elements: DataFrame, cube: str | None = None, query: str | None = None, parts: int = 1) -> DataFrame:
    """Characteristics and measures of cubes, or of one cube or query, as two ordered lists. Each cube is spread over ``parts`` rows by the hash of its elements."""
    found = elements
    if cube is not None:
        found = found.where(F.col("cube") == cube)
    if query is not None:
        found = found.where(F.col("query") == query)
    parted = found.select("cube", "element", "role", "text", part_by([F.col("element")], parts).alias(PART))
    item = F.struct("element", "text")

    def of_role(role: str) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("role") == role, item)))

    return parted.groupBy("cube", PART).agg(of_role("CHARACTERISTIC").alias("characteristics"), of_role("MEASURE").alias("measures"))


def describe_infoobject(infoobjects: DataFrame, name: str | None = None) -> DataFrame:
    found = infoobjects if name is None else infoobjects.where(F.col("info_object") == name)
    return found.select("info_object", "data_type", "conv_exit", "output_length", "length", "decimals")


def show_contexts(sources: DataFrame) -> DataFrame:
    """Contexts of the replication sources, each once."""
    return sources.select(F.col("context").alias("technical_name"), F.col("context_text").alias("text"), "release").distinct()


def show_odp(sources: DataFrame, context: str, search: str = ANY) -> DataFrame:
    found = sources.where((F.col("context") == context) & matches("technical_name", search))
    return found.select("technical_name", "text", "semantics", "semantics_text")


def describe_odp(sources: DataFrame, fields: DataFrame, texts: DataFrame, context: str, name: str | None = None, size: int = GROUP_ROWS) -> DataFrame:
    """Sources with ``supports_delta``, their fields and their texts as ordered lists; part n has the fields of the n-th ``size`` positions, part 0 the texts."""
    found = sources.where(F.col("context") == context)
    if name is not None:
        found = found.where(F.col("technical_name") == name)
    names = found.select("technical_name")

    def listed(rows: DataFrame, columns: list[str], out: str, part: Column) -> DataFrame:
        mine = rows.join(names, "technical_name", "left_semi").select("technical_name", part.alias(PART), F.struct(*columns).alias("item"))
        return mine.groupBy("technical_name", PART).agg(F.sort_array(F.collect_set("item")).alias(out))

    fields_of = listed(fields, ["pos", "field", "type"], "fields", part_at(F.col("pos"), size))
    texts_of = listed(texts, ["language", "text"], "texts", F.lit(0).cast("bigint"))
    parts = fields_of.join(texts_of, ["technical_name", PART], "full")
    return found.select("technical_name", "text", "supports_delta").join(parts, "technical_name", "left")

