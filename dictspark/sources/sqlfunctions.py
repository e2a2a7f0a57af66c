"""Dictionary searches as SQL table functions over registered extracts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .dictionary import FIELD_COLUMNS, TABLE_CLASSES, TEXT_LANGUAGE

# A glob as a LIKE pattern, as globs.like_pattern writes it.
LIKE_OF = r"replace(replace(replace(replace({0}, '\\', '\\\\'), '_', '\\_'), '*', '%'), '?', '_')"


@dataclass(frozen=True)
class Search:
    """A table function: the extract it reads, its parameters, result columns, and filter."""

    extract: str
    parameters: tuple[str, ...]
    columns: Mapping[str, str]
    where: str
    types: Mapping[str, str] | None = None
    distinct: bool = False

    def sql(self, name: str) -> str:
        types = self.types or {}
        returns = ", ".join(f"`{c}` {types.get(c, 'STRING')}" for c in self.columns)
        shown = ", ".join(f"{source} AS `{c}`" for c, source in self.columns.items())
        where = self.where
        for parameter in self.parameters:
            where = where.replace(f"LIKE :{parameter}", "LIKE " + LIKE_OF.format(f"{name}.{parameter}")).replace(f":{parameter}", f"{name}.{parameter}")
        return (
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(f'{p} STRING' for p in self.parameters)}) RETURNS TABLE ({returns}) "
            f"RETURN SELECT {'DISTINCT ' if self.distinct else ''}{shown} FROM dictionary_{self.extract} t WHERE {where}"
        )


def _same(*columns: str) -> dict[str, str]:
    return {c: f"t.`{c}`" for c in columns}


CLASSES = ", ".join(f"'{c}'" for c in TABLE_CLASSES)
SEARCHES = {
    "show_tables": Search(
        "tables",
        ("tablename", "pattern"),
        _same("table_name", "text", "class"),
        f"t.language = '{TEXT_LANGUAGE}' AND t.class IN ({CLASSES}) AND t.table_name LIKE :tablename AND t.text LIKE :pattern",
    ),
    "describe_fields": Search(
        "fields", ("name",), _same(*FIELD_COLUMNS), f"t.table_name = :name AND t.language = '{TEXT_LANGUAGE}'", {"pos": "INT", "length": "INT", "decimals": "INT"}
    ),
    "show_functions": Search("functions", ("funcname", "groupname"), _same("name", "group", "text"), "t.name LIKE :funcname AND t.`group` LIKE :groupname"),
    "show_groups": Search("functions", ("groupname",), {"name": "t.`group`", "text": "t.group_text"}, "t.`group` LIKE :groupname", distinct=True),
    "show_objects": Search("objects", ("obj_type", "search"), _same("technical_name", "text", "type", "cube_name"), "t.type = :obj_type AND t.technical_name LIKE :search"),
    "show_hierarchies": Search("hierarchies", ("search",), _same("technical_name", "text", "version", "valid_to_date"), "t.technical_name LIKE :search"),
    "describe_infoobject": Search(
        "infoobjects", ("name",), _same("info_object", "data_type", "conv_exit", "length", "decimals"), "t.info_object = :name", {"length": "INT", "decimals": "INT"}
    ),
}
#: Table functions over what a search has nested already: the frame of that search, and the column its argument is compared with.
NESTED = {"describe_function": ("described_functions", "function"), "describe_cube": ("described_cubes", "cube")}


def register_searches(spark: SparkSession, **extracts: DataFrame) -> list[str]:
    """Create the table functions of the given extracts (``tables=``, ``fields=``, ...).

    ``described_functions=`` and ``described_cubes=`` take the rows of ``describe_function`` and ``describe_cube``. Their
    argument is compared with the key these are grouped by, so Catalyst filters the extracts before it nests them.
    """
    for extract, df in extracts.items():
        df.createOrReplaceTempView(f"dictionary_{extract}")
    made = [name for name, search in SEARCHES.items() if search.extract in extracts]
    for name in made:
        spark.sql(SEARCHES[name].sql(name))
    for name, (extract, key) in NESTED.items():
        if extract in extracts:
            returns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extracts[extract].schema)
            shown = ", ".join(f"t.`{c}`" for c in extracts[extract].columns)
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(name STRING) RETURNS TABLE ({returns}) RETURN SELECT {shown} FROM dictionary_{extract} t WHERE t.`{key}` = {name}.name")
            made.append(name)
    return made
