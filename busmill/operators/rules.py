"""A configurable rule suite compiled to Columns: valid rows, invalid rows with their reasons, and a summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = dict[str, Any]
#: Rules that look at the table, not at its rows.
TABLE_RULES = ("expect_column_values_to_be_of_type", "expect_table_columns_to_match_set")
#: Rules that look at other rows too.
UNIQUE = ("expect_column_values_to_be_unique", "expect_compound_columns_to_be_unique")


def _between(column: str, min_value: Any = None, max_value: Any = None) -> Column:
    outside = F.lit(False)
    if min_value is not None:
        outside = outside | (F.col(column) < F.lit(min_value))
    if max_value is not None:
        outside = outside | (F.col(column) > F.lit(max_value))
    return F.coalesce(outside, F.lit(False))


def _repeated(*columns: str) -> Column:
    """The mark that `with_repeats` gives to rows of a repeated key."""
    return F.col(f"`_repeated {','.join(columns)}`")


#: Rule name to a Column that is true where a row breaks it. Users add their own.
REGISTRY: dict[str, Callable[..., Column]] = {
    "expect_column_values_to_not_be_null": lambda column: F.col(column).isNull(),
    "expect_column_values_to_be_between": _between,
    "expect_column_values_to_be_in_set": lambda column, value_set: F.coalesce(~F.col(column).isin(*value_set), F.lit(False)),
    "expect_column_values_to_be_unique": lambda column: _repeated(column),
    "expect_compound_columns_to_be_unique": lambda column_list: _repeated(*column_list),
}


#: Type names of suites to Spark's. Others are compared as they are.
TYPES = {
    "int": ("tinyint", "smallint", "int", "bigint"), "float": ("float", "double"), "str": ("string",), "bool": ("boolean",), "datetime": ("timestamp", "timestamp_ntz", "date"),
}


def kind(rule: Rule) -> str:
    return rule.get("expectation_type") or rule["type"]


def is_type(actual: str | None, wanted: str) -> bool:
    """int64, Int64, float64, datetime64[ns] and the like are their families; a Spark name is itself alone."""
    if actual == wanted:
        return True
    family = wanted.lower().partition("[")[0].rstrip("0123456789")
    return actual in TYPES.get({"integer": "int", "double": "float", "string": "str", "object": "str", "boolean": "bool", "timestamp": "datetime"}.get(family, family), ())


def load_suite(document: dict[str, Any]) -> tuple[list[Rule], dict[str, Any]]:
    """(rules, parameters) of a suite's JSON document, with or without its name as the root."""
    while "expectations" not in document and len(document) == 1:
        document = next(iter(document.values()))
    return document["expectations"], document.get("evaluation_parameters", {})


def resolved(rule: Rule, parameters: dict[str, Any]) -> dict[str, Any]:
    """A rule's arguments with {"$PARAMETER": name} replaced."""
    return {k: parameters[v["$PARAMETER"]] if isinstance(v, dict) and "$PARAMETER" in v else v for k, v in rule.get("kwargs", {}).items()}


@dataclass
class Validated:
    valid: DataFrame
    invalid: DataFrame
    summary: DataFrame


#: Bits that tell which keys may be repeated, in 64-bit words: the bound of what `with_repeats` broadcasts, 4 MB.
CELLS = 1 << 22


def _whole(columns: list[str]) -> Column:
    """Keys that hold a null repeat nothing."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return whole


def with_repeats(df: DataFrame, keys: list[list[str]], cells: int = CELLS) -> DataFrame:
    """df with a mark for each key, `_repeated a,b`: whether another row has the same values in these columns.

    Keys are counted with sums on the map side, from their columns alone. Those that occur twice set bits, by which rows that can't repeat one are told
    without a shuffle. The other rows are joined to the repeated keys, one row each, by cell and key: adaptive execution splits a frequent key over tasks
    only where both sides are shuffled for the join, which the counts, parted by key alone, are then. df is read once for each key and
    twice besides, so it should give the same rows each time."""
    marked, repeated = df, []
    for k, columns in enumerate(keys):
        names = [f"_key_{k}_{j}" for j in range(len(columns))]
        counts = df.where(_whole(columns)).groupBy(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]).agg(F.count("*").alias("n"))
        found = counts.where("n > 1").drop("n")
        cell = lambda own: F.pmod(F.xxhash64(*own), F.lit(cells))
        bit = lambda c: F.expr(f"shiftleft(1L, cast({c} % 64 AS int))")
        words = found.select(cell(names).alias("cell")).groupBy(F.expr("cell div 64").alias(f"_word_{k}")).agg(F.bit_or(bit("cell")).alias(f"_bits_{k}"))
        # At most cells / 64 rows.
        marked = marked.withColumn(f"_at_{k}", cell(columns)).join(F.broadcast(words), F.expr(f"_at_{k} div 64 = _word_{k}"), "left")
        may = F.coalesce(F.col(f"_bits_{k}").bitwiseAND(bit(f"_at_{k}")) != 0, F.lit(False))
        marked = marked.withColumn(f"_may_{k}", _whole(columns) & may).drop(f"_word_{k}", f"_bits_{k}")
        repeated.append((columns, names, found.withColumns({f"_cell_{k}": cell(names), f"_is_{k}": F.lit(True)})))
    some = F.lit(False)
    for k in range(len(keys)):
        some = some | F.col(f"_may_{k}")
    sure, unsure = marked.where(~some), marked.where(some)
    for k, (columns, names, found) in enumerate(repeated):
        mark = f"_repeated {','.join(columns)}"
        same = [F.col(c) == F.col(n) for c, n in zip([f"_at_{k}", *columns], [f"_cell_{k}", *names], strict=True)]
        sure = sure.withColumn(mark, F.lit(False))
        unsure = unsure.join(found, same, "left").withColumn(mark, F.coalesce(f"_is_{k}", F.lit(False))).drop(f"_is_{k}", f"_cell_{k}", *names)
    return sure.unionByName(unsure).drop(*(f"{x}_{k}" for k in range(len(keys)) for x in ("_may", "_at")))


def _keys(suite: list[Rule], parameters: dict[str, Any]) -> list[list[str]]:
    """The distinct keys of the suite's rules of uniqueness."""
    out: list[list[str]] = []
    for rule in suite:
        if kind(rule) in UNIQUE:
            args = resolved(rule, parameters)
            columns = [args["column"]] if "column" in args else list(args["column_list"])
            if columns not in out:
                out.append(columns)
    return out


def _schema_failures(df: DataFrame, suite: list[Rule], parameters: dict[str, Any]) -> list[str]:
    types, failed = dict(df.dtypes), []
    for rule in suite:
        args = resolved(rule, parameters)
        if kind(rule) == TABLE_RULES[0] and not is_type(types.get(args["column"]), args["type_"]):
            failed.append(f"{kind(rule)}:{args['column']}")
        if kind(rule) == TABLE_RULES[1] and set(types) != set(args["column_set"]):
            failed.append(kind(rule))
    return failed


def runnable(df: DataFrame, suite: list[Rule], parameters: dict[str, Any]) -> tuple[list[Rule], list[str]]:
    """The rules that can run, and why each other one can't: an unknown rule, a parameter or a column that isn't there."""
    good, failed = [], []
    for rule in suite:
        name = kind(rule)
        try:
            args = resolved(rule, parameters)
        except KeyError as missing:
            failed.append(f"{name}:no parameter {missing.args[0]}")
            continue
        columns = [args["column"]] if "column" in args else args.get("column_list", [])
        lost = [c for c in columns if c not in df.columns]
        if name not in REGISTRY and name not in TABLE_RULES:
            failed.append(f"{name}:unknown rule")
        elif lost:
            failed.append(f"{name}:no column {','.join(lost)}")
        else:
            good.append(rule)
    return good, failed


def reasons(df: DataFrame, suite: list[Rule], parameters: dict[str, Any] | None = None) -> DataFrame:
    """df with the array of the rules that each row breaks, as name:column."""
    marks = []
    for rule in suite:
        if kind(rule) not in TABLE_RULES:
            args = resolved(rule, parameters or {})
            name = f"{kind(rule)}:{args.get('column') or ','.join(args['column_list'])}"
            marks.append(F.when(REGISTRY[kind(rule)](**args), name))
    keys = _keys(suite, parameters or {})
    rows = with_repeats(df, keys) if keys else df
    rows = rows.withColumn("_reasons", F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))
    return rows.drop(*(f"_repeated {','.join(k)}" for k in keys))


def validate(df: DataFrame, suite: list[Rule], failed_at: Column, parameters: dict[str, Any] | None = None) -> Validated:
    """Table rules count as violated checks but reject no rows; rules that can't run count as exceptions."""
    total = len(suite)
    suite, exceptions = runnable(df, suite, parameters or {})
    rows = reasons(df, suite, parameters)
    bad = F.size("_reasons") > 0
    schema = _schema_failures(df, suite, parameters or {})
    counts = rows.select(F.explode("_reasons").alias("rule")).groupBy("rule").agg(F.count("*").alias("failures"))
    whole = rows.agg(F.count_if(bad).alias("rows_failed"), F.count("*").alias("total_rows"))
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("rule", "failures"))).alias("violation_reasons"), F.count("*").alias("row_rules_violated"))
    violated = F.col("row_rules_violated") + len(schema)
    summary = whole.crossJoin(F.broadcast(listed)).select(  # one row each
        F.lit(total).cast("long").alias("total_checks"), (F.lit(total - len(exceptions)) - violated).alias("expectations_successful"), violated.alias("expectations_with_violations"),
        F.lit(len(exceptions)).cast("long").alias("expectations_failed_due_to_exceptions"), "rows_failed", "total_rows", "violation_reasons",
        F.array(*[F.lit(x) for x in schema]).cast("array<string>").alias("schema_violations"), F.array(*[F.lit(x) for x in exceptions]).cast("array<string>").alias("exception_reasons"),
    )
    invalid = rows.where(bad).withColumns({"invalid_reason": F.array_join("_reasons", "; "), "validation_failed_at": failed_at}).drop("_reasons")
    return Validated(rows.where(~bad).drop("_reasons"), invalid, summary)
