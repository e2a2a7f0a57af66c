"""Cube queries: an immutable builder that compiles to one aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.selection import normalized, predicate
from . import hierarchy as H

# Axis operations, character properties and their settings, label of totals.
OPERATIONS = ("SET", "ADD", "REMOVE")
PROPERTIES = {"DISPLAY": ("KEY", "TEXT", "BOTH"), "TOTALS": ("SHOW", "HIDE"), "SORT": ("ASC", "DESC", "NONE")}
TOTAL_LABEL = "SUMME"

MAX_LEAVES = 2000
MERGES = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


@dataclass(frozen=True)
class Characteristic:
    """A dimension of a cube. ``texts`` has (key, text); ``nodes`` are hierarchy nodes whose
    ``node_value`` is a member key, and ``hierarchy`` names one hierarchy among them."""

    name: str
    column: str = ""
    texts: DataFrame | None = None
    nodes: DataFrame | None = None
    hierarchy: str = ""

    @property
    def source(self) -> str:
        return self.column or self.name


@dataclass(frozen=True)
class Measure:
    """A key figure: technical name, description, expression and aggregate."""

    expression: str
    name: str = ""
    text: str = ""
    agg: str = "sum"


@dataclass(frozen=True)
class Variable:
    """A query variable that a caller may fill with select-options."""

    name: str
    characteristic: str
    text: str = ""
    mandatory: bool = False
    initial_allowed: bool = True
    input_enabled: bool = True
    is_exit_variable: bool = False
    var_type: str = "CHARACTERISTIC_VALUE"
    selection_type: str = "SELECTION_OPTION"
    reference_char: str = ""

    @property
    def entry_type(self) -> str:
        """Whether a value is needed, and for a needed one whether it may be initial (blank)."""
        if not self.mandatory:
            return "OPTIONAL"
        return "MANDATORY" if self.initial_allowed else "MANDATORY_NOT_INITIAL"


VARIABLE_COLUMNS = "name string, text string, mandatory boolean, input_enabled boolean, is_exit_variable boolean, var_type string, selection_type string, entry_type string, reference_char string"


def edited(current: tuple[str, ...], given: Sequence[str], op: str | None) -> tuple[str, ...]:
    """An ordered set after SET, ADD or REMOVE; without ``op``, ADD when anything is given, else SET."""
    op = (op or ("ADD" if given else "SET")).upper()
    if op not in OPERATIONS:
        raise ValueError(f"operation {op!r} is not one of {OPERATIONS}")
    if op == "REMOVE":
        return tuple(c for c in current if c not in given)
    base = () if op == "SET" else current
    return tuple(dict.fromkeys((*base, *given)))


def row_names(axis: Sequence[str], design_time: Sequence[str] = ()) -> list[str]:
    """Names of row columns: from the state, else the design time, else ``ROW_n``."""
    out = []
    for i, name in enumerate(axis):
        designed = design_time[i] if i < len(design_time) else ""
        out.append(name or designed or f"ROW_{i + 1}")
    return out


def measure_names(measures: Sequence[Measure]) -> list[str]:
    """Names of measures: technical name, else description, else ``dyn_kf_n``."""
    return [m.name or m.text or f"dyn_kf_{i}" for i, m in enumerate(measures, 1)]


@dataclass(frozen=True)
class Cube:
    """State of a cube query. Every step returns a new state and the facts are read by an action
    only; walking a hierarchy and finding the members of a column axis run small jobs before."""

    df: DataFrame
    characteristics: Mapping[str, Characteristic]
    measures: tuple[Measure, ...]
    variables: tuple[Variable, ...] = ()
    row_axis: tuple[str, ...] = ()
    column_axis: tuple[str, ...] = ()
    column_members: tuple[tuple[str, tuple[str, ...]], ...] = ()
    members: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    options: tuple[Mapping[str, str], ...] = ()
    subtrees: tuple[tuple[str, DataFrame], ...] = ()
    properties: Mapping[tuple[str, str], str] = field(default_factory=dict)

    # --- opening -------------------------------------------------------------------------------

    @staticmethod
    def of(
        df: DataFrame, characteristics: Iterable[Characteristic], measures: Iterable[Measure], variables: Iterable[Variable] = ()
    ) -> Cube:
        return Cube(df, {c.name: c for c in characteristics}, tuple(measures), tuple(variables))

    def begin(
        self,
        variables: Sequence[Mapping[str, str]] = (),
        hierarchy_variables: Sequence[Mapping[str, str]] = (),
        variant: str | None = None,
        variants: DataFrame | None = None,
    ) -> Cube:
        """Open the query: fill its variables, by value or from a saved variant.

        Unknown and non-input variables are refused, as are mandatory ones without a value.
        """
        values = [dict(v) for v in variables]
        if variant is not None:
            if variants is None:
                raise ValueError("a variant needs the table of saved variants")
            saved = variants.where(F.col("VARIANT") == variant).limit(MAX_LEAVES + 1).collect()
            if len(saved) > MAX_LEAVES:
                raise ValueError(f"variant {variant!r} has more than {MAX_LEAVES} values")
            if not saved:
                raise ValueError(f"variant {variant!r} is not saved")
            given = {v.get("NAME") for v in values}
            values += [r.asDict() for r in saved if r["NAME"] not in given]
        known = {v.name: v for v in self.variables}
        for value in (*values, *hierarchy_variables):
            name = value.get("NAME")
            if name not in known:
                raise ValueError(f"unknown variable {name!r}, expected one of {', '.join(known)}")
            if not known[name].input_enabled:
                raise ValueError(f"variable {name!r} is not ready for input")
        filled = {v["NAME"] for v in (*values, *hierarchy_variables)}
        missing = [v.name for v in self.variables if v.mandatory and v.name not in filled]
        if missing:
            raise ValueError(f"mandatory variables without a value: {', '.join(missing)}")
        initial = [v["NAME"] for v in (*values, *hierarchy_variables) if known[v["NAME"]].entry_type == "MANDATORY_NOT_INITIAL" and not (v.get("LOW") or "").strip()]
        if initial:
            raise ValueError(f"variables that must not be initial: {', '.join(dict.fromkeys(initial))}")
        options = []
        for value in values:
            _, sign, op, low, high = normalized(value)
            column = self._char(known[value["NAME"]].characteristic).source
            options.append({"FIELDNAME": column, "SIGN": sign, "OP": op, "LOW": low, "HIGH": high})
        trees = []
        for value in hierarchy_variables:
            char = self._char(known[value["NAME"]].characteristic)
            if char.nodes is None:
                raise ValueError(f"characteristic {char.name!r} has no hierarchy")
            nodes = H.valid_nodes(char.nodes, value.get("HIERARCHY_VERSION") or H.ACTIVE, value.get("HIERARCHY_DUE_DATE") or H.DUE_DATE, value.get("HIERARCHY_NAME"))
            trees.append((char.name, nodes.where(F.col("node_name") == value["LOW"]), nodes))
        restricted = tuple((name, _members_below(top, nodes)) for name, top, nodes in trees)
        return replace(self, options=(*self.options, *options), subtrees=(*self.subtrees, *restricted))

    def _char(self, name: str) -> Characteristic:
        if name not in self.characteristics:
            raise ValueError(f"unknown characteristic {name!r}, expected one of {', '.join(self.characteristics)}")
        return self.characteristics[name]

    def _check(self, names: Iterable[str]) -> None:
        for name in names:
            self._char(name)

    # --- state ---------------------------------------------------------------------------------

    def rows(self, *chars: str, op: str | None = None) -> Cube:
        self._check(chars)
        return replace(self, row_axis=edited(self.row_axis, chars, op))

    def columns(self, *chars: str, op: str | None = None, members: Mapping[str, Sequence[str]] | None = None) -> Cube:
        """Characteristics on the column axis. Given members fix the leaves without a job."""
        self._check(chars)
        known = dict(self.column_members) | {c: tuple(m) for c, m in (members or {}).items()}
        return replace(self, column_axis=edited(self.column_axis, chars, op), column_members=tuple(known.items()))

    def filter(self, char: str, *members: str, op: str | None = None) -> Cube:
        """Restrict to members. SET without members lifts the filter; a filter whose last member is removed lets nothing through."""
        self._char(char)
        current = self.members.get(char)
        kept = edited(current or (), members, op)
        lifted = not members and (op or "SET").upper() == "SET"
        if lifted or (current is None and (op or "").upper() == "REMOVE"):
            return replace(self, members={c: m for c, m in self.members.items() if c != char})
        return replace(self, members={**self.members, char: kept})

    def set_property(self, char: str, prop: str, value: str) -> Cube:
        self._char(char)
        prop, value = prop.upper(), value.upper()
        if value not in PROPERTIES.get(prop, ()):
            raise ValueError(f"{prop} {value!r} is not one of {PROPERTIES.get(prop, tuple(PROPERTIES))}")
        return replace(self, properties={**self.properties, (char, prop): value})

    def display(self, char: str, value: str) -> Cube:
        return self.set_property(char, "DISPLAY", value)

    def totals(self, char: str, value: str) -> Cube:
        return self.set_property(char, "TOTALS", value)

    def sort(self, char: str, value: str) -> Cube:
        return self.set_property(char, "SORT", value)

    def property(self, char: str, prop: str) -> str:
        default = {"DISPLAY": "KEY", "TOTALS": "HIDE", "SORT": "ASC"}[prop]
        return self.properties.get((char, prop), default)

    # --- description ---------------------------------------------------------------------------

    def describe(self) -> DataFrame:
        """One row per characteristic: axis, position, properties, number of members in the data."""
        data = self.restricted()
        cells = data.select(*[F.col(c.source).cast("string").alias(n) for n, c in self.characteristics.items()])
        counts = cells.unpivot([], list(self.characteristics), "name", "member").distinct().groupBy("name").agg(F.count("member").alias("members"))
        free = [n for n in self.characteristics if n not in (*self.row_axis, *self.column_axis)]
        placed = [
            (axis, pos, name, self.property(name, "DISPLAY"), self.property(name, "TOTALS"), self.property(name, "SORT"))
            for axis, names in (("ROWS", self.row_axis), ("COLUMNS", self.column_axis), ("FREE", free))
            for pos, name in enumerate(names, 1)
        ]
        state = self.df.sparkSession.createDataFrame(placed, "axis string, position int, name string, display string, totals string, sort string")
        return state.join(counts, "name", "left").withColumn("members", F.coalesce("members", F.lit(0)))

    def list_variables(self) -> DataFrame:
        rows = [
            (v.name, v.text, v.mandatory, v.input_enabled, v.is_exit_variable, v.var_type, v.selection_type, v.entry_type, v.reference_char)
            for v in self.variables
        ]
        return self.df.sparkSession.createDataFrame(rows, VARIABLE_COLUMNS)

    # --- result --------------------------------------------------------------------------------

    def restricted(self) -> DataFrame:
        """The data under the variables, member filters and hierarchy restrictions."""
        df = self.df
        if self.options:
            df = df.where(predicate(df.schema, self.options))
        for char, members in self.members.items():
            df = df.where(F.col(self._char(char).source).isin(*members) if members else F.lit(False))
        for char, keys in self.subtrees:
            df = df.join(keys, F.col(self._char(char).source).cast("string") == F.col("_member"), "left_semi")
        return df

    def _leaves(self, df: DataFrame) -> list[tuple[str, Column | None, Measure]]:
        """(column name, member condition, measure) of every leaf of the column axis; members are in the columns ``_c<n>``."""
        paths: list[tuple[tuple[str, ...], Column | None]] = [((), None)]
        known = dict(self.column_members)
        for at, char in enumerate(self.column_axis):
            source = self._char(char).source
            members = self._ordered(char, known.get(char) or self.members.get(char) or self._discover(df, source))
            labels = self._labels(char, members)
            is_member = {m: F.col(f"_c{at}").eqNullSafe(F.lit(str(m))) for m in members}
            paths = [((*names, labels[str(m)]), is_member[m] if cond is None else cond & is_member[m]) for names, cond in paths for m in members]
        names = measure_names(self.measures)
        leaves = [("_".join((*path, name)), cond, m) for path, cond in paths for name, m in zip(names, self.measures)]
        if len(leaves) > MAX_LEAVES:
            raise ValueError(f"the column axis has {len(leaves)} leaves, more than {MAX_LEAVES}")
        return leaves

    def _ordered(self, char: str, members: Sequence[str]) -> list[str]:
        """Members of a column characteristic in the order of its SORT property, as given where none is set."""
        way = self.properties.get((char, "SORT"), "NONE")
        return list(members) if way == "NONE" else sorted(members, key=str, reverse=way == "DESC")

    def _labels(self, char: str, members: Sequence[str]) -> dict[str, str]:
        """What a column shows for each member: key, text or both. Only the texts of these members are read."""
        shown, texts = self.property(char, "DISPLAY"), self._char(char).texts
        keys = [str(m) for m in members]
        if shown == "KEY":
            return {k: k for k in keys}
        if texts is None:
            raise ValueError(f"characteristic {char!r} has no texts")
        found = {r["key"]: r["text"] for r in texts.select(F.col("key").cast("string").alias("key"), "text").where(F.col("key").isin(*keys)).distinct().collect()}
        return {k: (found.get(k) or k) if shown == "TEXT" else " ".join(x for x in (k, found.get(k)) if x) for k in keys}

    @staticmethod
    def _discover(df: DataFrame, source: str) -> list[str]:
        rows = df.select(F.col(source).cast("string")).where(F.col(source).isNotNull()).distinct().orderBy(source).limit(MAX_LEAVES + 1).collect()
        if len(rows) > MAX_LEAVES:
            raise ValueError(f"{source!r} has more than {MAX_LEAVES} members for a column axis")
        return [r[0] for r in rows]

    def result(self, grand_total: bool = True) -> DataFrame:
        """Row members as text, their hierarchy levels, then one DOUBLE per leaf.

        The facts are aggregated once, by the members of rows and columns; the leaves are spread from
        those groups, so a fact costs as many sums as there are measures, not leaves. Totals and hierarchy
        nodes are derived from the spread rows, so the facts are neither expanded nor shuffled again.
        """
        data = self.restricted()
        leaves = self._leaves(data)
        names = row_names(self.row_axis)
        sources = [self._char(c).source for c in self.row_axis]
        keys = [F.col(s).cast("string").alias(f"_k{i}") for i, s in enumerate(sources)]
        across = [F.col(self._char(c).source).cast("string").alias(f"_c{i}") for i, c in enumerate(self.column_axis)]
        base = data.groupBy(*keys, *across).agg(*[AGGREGATES[m.agg](F.expr(m.expression)).alias(f"_m{i}") for i, m in enumerate(self.measures)])
        if across:
            base = self._spread(base, [f"_k{i}" for i in range(len(keys))], leaves)
        with_totals = self._with_totals(base, leaves, grand_total).withColumns({f"_l{i}": F.lit(0) for i in range(len(sources))})
        with_nodes = self._with_nodes(with_totals, leaves)
        shown = self._displayed(with_nodes)
        ordered = self._sorted(shown)
        return ordered.select(
            *[F.col(f"_t{i}").cast("string").alias(n) for i, n in enumerate(names)],
            *[F.col(f"_l{i}").cast("int").alias(f"{n}_HIER_LEVEL") for i, n in enumerate(names)],
            *[F.col(f"_m{i}").cast("double").alias(name) for i, (name, _, _) in enumerate(leaves)],
        )

    def _spread(self, groups: DataFrame, keys: list[str], leaves) -> DataFrame:
        """One column per leaf, from one row per member of the rows and the columns."""
        place = {id(m): i for i, m in enumerate(self.measures)}
        cells = []
        for i, (_, cond, m) in enumerate(leaves):
            cell = MERGES[m.agg](F.when(cond, F.col(f"_m{place[id(m)]}")))
            cells.append((F.coalesce(cell, F.lit(0)) if m.agg == "count" else cell).alias(f"_m{i}"))
        return groups.groupBy(*keys).agg(*cells)

    def _merge(self, leaves) -> list[Column]:
        return [MERGES[m.agg](f"_m{i}").alias(f"_m{i}") for i, (_, _, m) in enumerate(leaves)]

    def _with_totals(self, base: DataFrame, leaves, grand_total: bool) -> DataFrame:
        """Add total rows; ``_g`` marks how many trailing row elements a row sums over."""
        keys = [f"_k{i}" for i in range(len(self.row_axis))]
        levels = [n for n in range(1, len(keys)) if self.property(self.row_axis[n], "TOTALS") == "SHOW"]
        if grand_total and keys:
            levels.append(0)
        if not levels:
            return base.withColumn("_g", F.lit(0))
        sets = [[F.col(k) for k in keys[:n]] for n in (*levels, len(keys))]
        summed = base.groupingSets(sets, *keys).agg(F.grouping_id().alias("_id"), *self._merge(leaves))
        return summed.withColumn("_g", F.length(F.translate(F.bin("_id"), "0", ""))).drop("_id")

    def _with_nodes(self, rows: DataFrame, leaves) -> DataFrame:
        """Replace members by the hierarchy nodes at and above them, with the node's level."""
        for i, name in enumerate(self.row_axis):
            char = self._char(name)
            if char.nodes is None:
                continue
            nodes = H.valid_nodes(char.nodes, name=char.hierarchy or None)
            walked = H.walk(nodes)
            above = (
                walked.join(nodes.select("node_id", F.col("node_value").alias("_member")), "node_id")
                .where(F.col("_member").isNotNull())
                .select("_member", F.explode("ancestors").alias("_node"))
            )
            label = walked.join(nodes.select("node_id", "node_name"), "node_id").select(F.col("node_id").alias("_node"), "node_name", "level")
            inner = rows.where(F.col("_g") < len(self.row_axis) - i)
            total = rows.where(F.col("_g") >= len(self.row_axis) - i)
            others = [c for c in rows.columns if c not in (f"_k{i}", f"_l{i}") and not c.startswith("_m")]
            # a member that no node has goes to a node of its own, so that the top level adds up to the total
            lifted = (
                inner.join(above, F.col(f"_k{i}") == F.col("_member"), "left")
                .join(label, "_node", "left")
                .groupBy(*others, F.coalesce("node_name", F.lit(H.NOT_ASSIGNED)).alias(f"_k{i}"), F.coalesce("level", F.lit(1)).alias(f"_l{i}"))
                .agg(*self._merge(leaves))
            )
            rows = lifted.unionByName(total)
        return rows

    def _displayed(self, rows: DataFrame) -> DataFrame:
        """Labels of the row elements: key, text or both, and the label of totals."""
        width = len(self.row_axis)
        for i, name in enumerate(self.row_axis):
            char, shown = self._char(name), self.property(name, "DISPLAY")
            label = F.col(f"_k{i}")
            if shown != "KEY":
                if char.texts is None:
                    raise ValueError(f"characteristic {name!r} has no texts")
                texts = char.texts.select(F.col("key").cast("string").alias("_key"), F.col("text").alias("_text"))
                rows = rows.join(texts, F.col(f"_k{i}") == F.col("_key"), "left").drop("_key")
                text = F.coalesce("_text", F.col(f"_k{i}"))
                label = text if shown == "TEXT" else F.concat_ws(" ", F.col(f"_k{i}"), F.col("_text"))
            first_total = F.col("_g") == width - i
            inside_total = F.col("_g") > width - i
            rows = rows.withColumn(f"_t{i}", F.when(first_total, F.lit(TOTAL_LABEL)).when(inside_total, F.lit("")).otherwise(label)).drop("_text")
        return rows

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """Members in the order of their properties, every total after the rows it sums."""
        width = len(self.row_axis)
        order: list[Column] = []
        for i, name in enumerate(self.row_axis):
            order.append((F.col("_g") >= width - i).asc())
            way = self.property(name, "SORT")
            if way != "NONE":
                order.append(F.col(f"_t{i}").desc() if way == "DESC" else F.col(f"_t{i}").asc())
        return rows.orderBy(*order) if order else rows


def _members_below(top: DataFrame, nodes: DataFrame) -> DataFrame:
    """Member keys of the nodes at and below the chosen ones."""
    walked = H.walk(nodes.join(top.select(F.col("node_id").alias("_top")), F.col("node_id") == F.col("_top"), "left"), F.col("_top").isNotNull())
    keys = walked.select("node_id").join(nodes.select("node_id", "node_value"), "node_id")
    return keys.where(F.col("node_value").isNotNull()).select(F.col("node_value").alias("_member")).distinct()


__all__ = ["Characteristic", "Cube", "Measure", "Variable", "edited", "measure_names", "row_names"]
