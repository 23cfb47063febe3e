"""Declarative data-quality checks.

``failures`` returns a check's offending rows; none means it passes. ``summarise``
runs any number of checks in one job that reads every table once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

INTEGERS = {"tinyint", "smallint", "int", "bigint"}
FLOATS = {"float", "double"}
TIMES = ("date", "timestamp_ntz", "timestamp")


@dataclass(frozen=True)
class Check:
    """One check of ``column`` in ``table``; use the constructors below."""

    kind: str
    table: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    predicate: str = ""
    name: str = ""

    @property
    def test(self) -> str:
        target = f"__{self.parent}_{self.parent_column}" if self.parent else ""
        return self.name or f"{self.kind}_{self.table}_{self.column}{target}"


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column)


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def accepted_values(table: str, column: str, values: Iterable) -> Check:
    return Check("accepted_values", table, column, values=tuple(values))


def relationships(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", table, column, parent=parent, parent_column=parent_column)


def no_rows_where(name: str, table: str, column: str, predicate: str) -> Check:
    """A singular check: ``predicate`` must hold for no row. ``column`` labels it."""
    return Check("singular", table, column, predicate=predicate, name=name)


def common_type(left: str, right: str) -> str:
    """The type in which keys of two types are compared.

    Numbers meet as double if one of them is, else as bigint or decimal; a number and
    text meet as the number, dates and times as the finer one, anything else as text.
    """
    pair = {left, right}
    if len(pair) == 1:
        return left
    numbers = [t for t in pair if t in INTEGERS or t in FLOATS or t.startswith("decimal")]
    if len(numbers) == 2:
        if pair & FLOATS:
            return "double"
        return "decimal(38,10)" if any(t.startswith("decimal") for t in pair) else "bigint"
    if len(numbers) == 1 and "string" in pair:
        return common_type(numbers[0], "double" if numbers[0] in FLOATS else "bigint")
    times = [t for t in TIMES if t in pair]
    return times[-1] if len(times) == 2 else "string"


def key_text(value: str, own: str, wanted: str) -> str:
    """SQL for a key's text, equal for keys that are equal in the wanted type.

    Text that is no number is a key of its own; -0.0 is 0.0.
    """
    zero = " + 0D" if wanted in FLOATS else ""
    if own == wanted:
        return f"CAST({value}{zero} AS STRING)"
    cast = f"CAST(TRY_CAST({value} AS {wanted}){zero} AS STRING)"
    return f"coalesce({cast}, concat('?', CAST({value} AS STRING)))"


def kind_of(tables: Tables, table: str, column: str) -> str:
    return tables[table].schema[column].dataType.simpleString()


def failures(check: Check, tables: Tables) -> DataFrame:
    """The offending rows of one check.

    not_null and singular give whole rows, unique and accepted_values each value
    with its number of rows, relationships one row per orphaned child row. Keys of
    different types are compared in their common type, listed values in the column's.
    """
    table = tables[check.table]
    column = F.col(check.column)
    if check.kind == "not_null":
        return table.filter(column.isNull())
    if check.kind == "singular":
        return table.filter(check.predicate)
    if check.kind == "unique":
        return (
            table.filter(column.isNotNull())
            .groupBy(column.alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter("n_records > 1")
        )
    if check.kind == "accepted_values":
        return (
            table.groupBy(column.alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(
                *[F.lit(v).cast(table.schema[check.column].dataType) for v in check.values]
            ))
        )
    if check.kind == "relationships":
        # Two plain shuffles at most: adaptive execution can split a hot child key.
        child = table.filter(column.isNotNull()).select(column.alias("from_field"))
        parent = tables[check.parent].select(F.col(check.parent_column).alias("to_field"))
        own = kind_of(tables, check.table, check.column)
        other = kind_of(tables, check.parent, check.parent_column)
        equal = F.col("from_field") == F.col("to_field")
        if own != other:
            wanted = common_type(own, other)
            equal = F.expr(
                f"{key_text('from_field', own, wanted)} = {key_text('to_field', other, wanted)}"
            )
        return child.join(parent, equal, "left_anti")
    raise ValueError(f"unknown check kind {check.kind!r}")


def summarise(spark: SparkSession, checks: Iterable[Check], tables: Tables) -> DataFrame:
    """test, table, column, failures, passed: one row per check.

    Each table is read once and each row casts a few *ballots* (domain, role,
    key). A domain holds columns that are compared with each other, that is a
    parent key and the child columns referring to it; a role is one column of it
    and the key its value. A row that fails checks of its own (a NULL, a broken
    predicate) casts one more, whose key spells out which. Ballots are counted
    per (domain, key) with map-side partial counts, so hot keys shrink before the
    one shuffle, and every check is then read off the counts. Keys that are lower-case
    hex, as hashes are, travel as the bytes they spell, half as long.
    """
    checks = list(checks)
    ballots = _Ballots(checks, tables)
    votes = None
    for table in dict.fromkeys(ballots.tables):
        voted = ballots.cast(table, tables[table])
        votes = voted if votes is None else votes.unionAll(voted)
    counted = ballots.pack(votes).groupBy("domain", "key").agg(
        *[F.expr(f"count_if(role = {role}) AS n{role}") for role in range(ballots.width)]
    )
    # Few rows from here on: one per domain, or per value where values are listed.
    domain = F.expr(f"domain % {ballots.domains} AS domain")
    measured = counted.groupBy(domain, F.expr(f"{ballots.listed_key} AS value")).agg(
        *[F.expr(f"sum({sql}) AS {name}") for name, sql in ballots.measures.items()]
    )

    verdicts: dict[int, list[str]] = {}
    for number, check in enumerate(checks):
        domain, failed = ballots.failed(check)
        verdicts.setdefault(domain, []).append(
            f"struct({number} AS number, {failed} AS failed)"
        )
    cases = " ".join(
        f"WHEN domain = {domain} THEN array({', '.join(parts)})"
        for domain, parts in verdicts.items()
    )
    failed = (
        measured.selectExpr(f"inline(CASE {cases} END)")
        .groupBy("number")
        .agg(F.sum("failed").alias("failed"))
    )
    names = ", ".join(
        f"({n}, {_literal(c.test)}, {_literal(c.table)}, {_literal(c.column)})"
        for n, c in enumerate(checks)
    )
    listed = spark.sql(f"SELECT * FROM VALUES {names} AS t(number, test, table, column)")
    count = F.coalesce("failed", F.lit(0))
    return listed.join(failed, "number", "left").select(
        "test", "table", "column", count.alias("failures"), (count == 0).alias("passed")
    )


class _Ballots:
    """The ballots each table casts, and how a check reads their counts, as SQL.

    A keyed column is (table, column, type its key is compared in): a column that
    refers to one of another type casts one ballot for that and one for itself.
    """

    def __init__(self, checks: list[Check], tables: Tables) -> None:
        self.kind = {
            column: kind_of(tables, *column)
            for c in checks
            for column in [(c.table, c.column)] + [(c.parent, c.parent_column)] * bool(c.parent)
            if c.kind != "singular"
        }
        # Columns whose value matters: unique, accepted_values, both ends of a reference.
        references = [c for c in checks if c.kind == "relationships"]
        valued = [c for c in checks if c.kind in ("unique", "accepted_values")]
        self.keyed = dict.fromkeys(
            [key for c in checks if c in references for key in self._ends(c)]
            + [self._own(c) for c in valued]
        )
        self.domain = {key: n for n, key in enumerate(self.keyed)}
        for check in references:
            child, parent = (self.domain[key] for key in self._ends(check))
            for key, domain in self.domain.items():
                if domain == child:
                    self.domain[key] = parent
        self.role: dict[tuple[str, str, str], int] = {}
        used: dict[int, int] = {}
        for key, domain in self.domain.items():
            self.role[key] = used[domain] = used.get(domain, -1) + 1
        self.width = 1 + max(self.role.values(), default=0)

        # Per table the conditions of its row checks; their order is their flag's place.
        self.flags: dict[str, list[str]] = {}
        for check in checks:
            if condition := self._row_condition(check):
                self.flags.setdefault(check.table, []).append(condition)
        self.flag_domain = {t: len(self.domain) + n for n, t in enumerate(self.flags)}

        listed = [self.domain[self._own(c)] for c in checks if c.kind == "accepted_values"]
        listed = sorted({*listed, *self.flag_domain.values()})
        self.kept = f"domain IN ({', '.join(map(str, listed))})" if listed else "false"
        self.listed_key = f"if({self.kept}, CAST(key AS STRING), CAST(NULL AS STRING))"
        self.domains = max(1, len(self.domain) + len(self.flags))

        self.measures: dict[str, str] = {}
        for role in range(self.width):
            self.measures[f"rows{role}"] = f"n{role}"
            self.measures[f"nulls{role}"] = f"if(key IS NULL, n{role}, 0)"
            self.measures[f"values{role}"] = f"if(key IS NOT NULL AND n{role} > 0, 1, 0)"
            self.measures[f"repeated{role}"] = f"if(key IS NOT NULL AND n{role} > 1, 1, 0)"
        for check in references:
            child, parent = (self.role[key] for key in self._ends(check))
            self.measures[f"orphans{child}_{parent}"] = (
                f"if(key IS NOT NULL AND n{parent} = 0, n{child}, 0)"
            )

    @property
    def tables(self) -> list[str]:
        return [table for table, _, _ in self.role] + list(self.flags)

    def cast(self, table: str, rows: DataFrame) -> DataFrame:
        """A table's ballots: one per keyed column, one more from rows that fail a row check."""
        keyed = ", ".join(
            _ballot(self.domain[key], role, key_text(f"`{key[1]}`", self.kind[key[:2]], key[2]))
            for key, role in self.role.items()
            if key[0] == table
        )
        if table not in self.flags:
            return rows.selectExpr(f"inline(array({keyed}))")
        any_fails = " OR ".join(f"coalesce({condition}, false)" for condition in self.flags[table])
        marks = ", ".join(f"if({condition}, '1', '0')" for condition in self.flags[table])
        flags = _ballot(self.flag_domain[table], 0, f"concat({marks})")
        if not keyed:
            return rows.filter(any_fails).selectExpr(f"inline(array({flags}))")
        cast = f"if({any_fails}, array({keyed}, {flags}), array({keyed}))"
        return rows.selectExpr(f"inline({cast})")

    def pack(self, votes: DataFrame) -> DataFrame:
        """Keys as bytes: those that hex spells, if it spells the key back, else the text's own.

        Both may be the same bytes, so packed keys have domains of their own, ``domains`` further
        up. Keys whose value matters later are not packed.
        """
        spelled = votes.withColumn("bytes", F.expr("unhex(key)"))
        packed = f"coalesce(lower(hex(bytes)) = key, false) AND NOT {self.kept}"
        return spelled.selectExpr(
            f"if({packed}, domain + {self.domains}, domain) AS domain",
            "role",
            f"if({packed}, bytes, CAST(key AS BINARY)) AS key",
        )

    def failed(self, check: Check) -> tuple[int, str]:
        """The check's domain, and what one row of measures adds to its failures."""
        if condition := self._row_condition(check):
            place = 1 + self.flags[check.table].index(condition)
            return self.flag_domain[check.table], f"if(substr(value, {place}, 1) = '1', rows0, 0)"
        if check.kind == "relationships":
            child, parent = self._ends(check)
            return self.domain[child], f"orphans{self.role[child]}_{self.role[parent]}"
        own = self._own(check)
        role = self.role[own]
        if check.kind == "not_null":
            failed = f"nulls{role}"
        elif check.kind == "unique":
            failed = f"repeated{role}"
        elif check.kind == "accepted_values":
            kind = own[2]
            allowed = ", ".join(
                key_text(f"CAST({_literal(v)} AS {kind})", kind, kind) for v in check.values
            )
            failed = f"if(value NOT IN ({allowed}), values{role}, 0)"
        else:
            raise ValueError(f"unknown check kind {check.kind!r}")
        return self.domain[own], failed

    def _own(self, check: Check) -> tuple[str, str, str]:
        return check.table, check.column, self.kind[check.table, check.column]

    def _ends(self, check: Check) -> tuple[tuple[str, str, str], tuple[str, str, str]]:
        child, parent = (check.table, check.column), (check.parent, check.parent_column)
        wanted = common_type(self.kind[child], self.kind[parent])
        return (*child, wanted), (*parent, wanted)

    def _row_condition(self, check: Check) -> str:
        """The failing condition of a check that needs no value, else nothing."""
        if check.kind == "singular":
            return f"({check.predicate})"
        if check.kind == "not_null" and self._own(check) not in self.keyed:
            return f"`{check.column}` IS NULL"
        return ""


def _ballot(domain: int, role: int, key: str) -> str:
    return f"struct({domain} AS domain, {role} AS role, {key} AS key)"


def _literal(value: object) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
