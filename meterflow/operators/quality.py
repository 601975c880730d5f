"""Data-quality rules, report, gate and cleansing.

Row-level rules (not-null, range, parse, date order) are evaluated together
in one aggregation pass; uniqueness needs its own grouped count. The report
is a small DataFrame (one row per rule); only the gate collects it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = "rule string, column string, checked bigint, failed bigint, success boolean"


class DataQualityError(RuntimeError):
    def __init__(self, failures: list[dict]):
        self.failures = failures
        super().__init__(f"data quality check failed: {failures}")


@dataclass(frozen=True)
class Rule:
    """One expectation. ``kind``: not_null | range | unique | column_exists | expr."""

    name: str
    kind: str
    columns: tuple[str, ...]
    params: dict = field(default_factory=dict)

    def violation(self) -> Column | None:
        """Row-level predicate that is TRUE for a failing row (None: not row-level)."""
        c = [F.col(x) for x in self.columns]
        if self.kind == "not_null":
            return reduce(lambda a, b: a | b, [x.isNull() for x in c])
        if self.kind == "range":
            lo, hi = self.params.get("min"), self.params.get("max")
            x = c[0]
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (x < F.lit(lo))
            if hi is not None:
                bad = bad | (x > F.lit(hi))
            # NULL is the not-null rule's business; NaN is out of range.
            return F.coalesce(bad | F.isnan(x.cast("double")), F.lit(False))
        if self.kind == "expr":
            # params["ok"]: SQL predicate that must hold; NULL counts as a failure.
            return ~F.coalesce(F.expr(self.params["ok"]), F.lit(False))
        return None


def not_null(*cols: str, name: str | None = None) -> Rule:
    """D1."""
    return Rule(name or f"not_null({','.join(cols)})", "not_null", tuple(cols))


def in_range(col: str, lo=None, hi=None, name: str | None = None) -> Rule:
    """Lo <= col <= hi (either bound optional)."""
    return Rule(name or f"range({col})", "range", (col,), {"min": lo, "max": hi})


def column_exists(*cols: str, name: str | None = None) -> Rule:
    """D3: the columns are in the schema (checked = rows; all fail if missing)."""
    return Rule(name or f"column_exists({','.join(cols)})", "column_exists", tuple(cols))


def unique(*cols: str, name: str | None = None) -> Rule:
    """Key occurs at most once."""
    return Rule(name or f"unique({','.join(cols)})", "unique", tuple(cols))


def holds(sql_predicate: str, cols: tuple[str, ...], name: str) -> Rule:
    """Any row-level SQL predicate, e.g. ``last_maintenance_date >= install_date``."""
    return Rule(name, "expr", tuple(cols), {"ok": sql_predicate})


def _violation(df: DataFrame, rule: Rule) -> Column | None:
    """The rule's predicate on ``df``; every row fails a rule whose columns are not there."""
    bad = rule.violation()
    if bad is None:
        return None
    try:
        df.select(bad)  # analysis only
        return bad
    except AnalysisException:
        return F.lit(True)


def _row(rule: Rule, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(",".join(rule.columns)).alias("column"),
        checked.cast("long").alias("checked"),
        failed.cast("long").alias("failed"),
    )


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: rule, column, checked, failed, success."""
    spark = df.sparkSession
    present = {f.name.lower() for f in df.schema.fields}
    parts: list[DataFrame] = []

    def here(r: Rule) -> bool:
        return all(c.lower() in present for c in r.columns)

    schema_rules = [r for r in rules if r.kind == "column_exists" or (r.kind == "unique" and not here(r))]
    row_rules = [r for r in rules if r.violation() is not None]
    key_rules = [r for r in rules if r.kind == "unique" and here(r)]
    bad = [_violation(df, r) for r in row_rules]
    known = set(map(id, schema_rules + row_rules + key_rules))
    unknown = [r.name for r in rules if id(r) not in known]
    if unknown:
        raise ValueError(f"unknown rule kinds: {unknown}")

    def schema_row(r: Rule, n: Column) -> Column:
        missing = [c for c in r.columns if c.lower() not in present]
        return _row(r, n, n if missing else F.lit(0))

    if key_rules:
        # The first key rule hosts every row-level rule: one grouped pass
        # computes per-key row counts and per-rule violation counts (all
        # combined map-side), a second tiny global aggregate sums them. The
        # data is read once instead of twice.
        host = key_rules[0]
        per_key = df.groupBy(*host.columns).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(v).alias(f"v{i}") for i, v in enumerate(bad)],
        )
        total = F.coalesce(F.sum("n"), F.lit(0))
        structs = [schema_row(r, total) for r in schema_rules]
        structs += [_row(r, total, F.coalesce(F.sum(f"v{i}"), F.lit(0))) for i, r in enumerate(row_rules)]
        structs.append(_row(host, total, F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))))
        parts.append(per_key.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    elif schema_rules or row_rules:
        # One pass over the data: the row count plus a count_if per row rule.
        # A column_exists rule fails for every row when the column is missing.
        n = F.count(F.lit(1))
        structs = [schema_row(r, n) for r in schema_rules]
        structs += [_row(r, n, F.count_if(v)) for r, v in zip(row_rules, bad)]
        parts.append(df.agg(F.array(*structs).alias("r")).select(F.inline("r")))

    for r in key_rules[1:]:
        dup = (
            df.groupBy(*r.columns)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
            )
        )
        parts.append(dup.select(F.inline(F.array(_row(r, F.col("checked"), F.col("failed"))))))

    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("success", F.col("failed") == 0)


def gate(report: DataFrame, allowed: frozenset[str] = frozenset()) -> DataFrame:
    """Raise DataQualityError when any rule failed (but for ``allowed`` ones); else return the report.

    The report has one row per rule, so collecting it is bounded. The
    collected rows are returned as a small local DataFrame, so reading the
    report again does not re-evaluate the rules over the data.
    """
    rows = report.collect()
    failed = [r.asDict() for r in rows if not r["success"] and r["rule"] not in allowed]
    if failed:
        raise DataQualityError(failed)
    return report.sparkSession.createDataFrame(rows, report.schema)


def _row_violations(df: DataFrame, rules: list[Rule]) -> Column:
    names = [F.when(v, F.lit(r.name)) for r in rules if (v := _violation(df, r)) is not None]
    if not names:
        return F.array().cast("array<string>")
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def split_clean(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows + ``failed_rules``) by the row-level rules.

    Accepted + rejected = input, row for row. Uniqueness and schema rules are
    reported by ``evaluate`` but do not route rows.
    """
    tagged = df.withColumn("failed_rules", _row_violations(df, rules))
    accepted = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    rejected = tagged.where(F.size("failed_rules") > 0)
    return accepted, rejected


def reading_rules(min_kl: float = 0.0, max_kl: float = 10_000.0) -> list[Rule]:
    """Default rules for the silver reading fact."""
    return [
        column_exists("meter_id", "reading_timestamp", "consumption_kl"),
        not_null("meter_id", name="meter_id_not_null"),
        not_null("consumption_kl", name="consumption_not_null"),
        holds("reading_ts IS NOT NULL", ("reading_timestamp",), name="timestamp_parses"),
        in_range("consumption_kl", min_kl, max_kl, name="consumption_in_range"),
    ]


def write_split(df: DataFrame, rules: list[Rule], path: str, fmt: str = "parquet") -> tuple[str, str]:
    """D7 at scale: tag every row once and write one table partitioned by
    ``quality_ok``; accepted rows are ``path/quality_ok=true``, rejected ones
    (with ``failed_rules``) ``path/quality_ok=false``. One pass over the
    input instead of one per output."""
    tagged = df.withColumn("failed_rules", _row_violations(df, rules)).withColumn(
        "quality_ok", F.size("failed_rules") == 0)
    (tagged.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("quality_ok").save(path))
    base = path.rstrip("/")
    return f"{base}/quality_ok=true", f"{base}/quality_ok=false"
