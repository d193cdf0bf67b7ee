"""Row checks, the quality gate and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.functions.columns import all_of

REASONS = "error_reasons"
# Fixed values of the checks.
UNKNOWN_CARD = "unknown_card"
MAX_AMOUNT = 500_000.0
NULL_RATIO_WARNING = 0.001


@dataclass(frozen=True)
class Check:
    """A named rule on one column after coercion to ``type``.

    A value that is missing or cannot be coerced fails only the column's ``not_null`` check.
    """

    column: str
    name: str
    type: str
    rule: Callable[[Column], Column] | None = None

    @property
    def label(self) -> str:
        return f"{self.column}:{self.name}"

    def fails(self) -> Column:
        value = F.col(self.column).try_cast(self.type)
        if self.type == "double":
            # NaN is ordered above every number in Spark; as data it is a missing value.
            value = F.nanvl(value, F.lit(None).cast("double"))
        if self.rule is None:
            return value.isNull()
        return F.coalesce(~self.rule(value), F.lit(False))


def _required(column: str, type_: str, **rules: Callable[[Column], Column]) -> list[Check]:
    return [Check(column, "not_null", type_)] + [Check(column, name, type_, rule) for name, rule in rules.items()]


def _card_checks() -> list[Check]:
    return _required(
        "card_id",
        "string",
        non_empty_card_id=lambda c: F.length(F.trim(c)) > 0,
        valid_card_id=lambda c: c != UNKNOWN_CARD,
    )


def _amount_checks(column: str) -> list[Check]:
    return _required(column, "double", positive=lambda c: c > 0.0, at_most_500000=lambda c: c <= MAX_AMOUNT)


def _not_negative(column: str, type_: str) -> list[Check]:
    return _required(column, type_, not_negative=lambda c: c >= 0)


# Q1
BATCH_CHECKS = [
    *_card_checks(),
    *_not_negative("trans_count_7d", "bigint"),
    *_not_negative("trans_count_30d", "bigint"),
    *_amount_checks("avg_amount_30d"),
    *_amount_checks("max_amount_30d"),
    *_not_negative("distinct_addr_7d", "bigint"),
    *_not_negative("days_since_last_trans", "double"),
]

# Q2, and with it P1/P3: the table form and the row form are one rule.
EVENT_CHECKS = [
    *_required("transaction_id", "bigint", positive=lambda c: c > 0),
    *_card_checks(),
    *_amount_checks("amount"),
]


def _four_places(value: Column) -> Column:
    return F.rint(value * 10_000) / 10_000 == value


# Rolling totals are exact sums of ten-thousandths: an event that is finer, or has a c2 that
# cannot be summed, is rejected with a reason and not rounded. A missing c2 counts as 0.
ROLLING_CHECKS = [
    *EVENT_CHECKS,
    Check("amount", "at_most_4_places", "double", _four_places),
    Check("c2", "usable", "double", lambda c: (F.abs(c) <= 1.0e9) & _four_places(c)),
]


def names_of(failures: list[tuple[Column, str]]) -> Column:
    """Array of the names whose condition holds; no lambda, so it compiles with its stage."""
    named = F.array(*[F.when(condition, F.lit(name)) for condition, name in failures])
    return F.array_except(named, F.array(F.lit(None).cast("string")))


def failed_checks(checks: list[Check], *more: tuple[Column, str]) -> Column:
    """Q3: names of every check a row fails. Passing rows, the usual case, take a short way."""
    failures = [(check.fails(), check.label) for check in checks] + list(more)
    none = F.array().cast("array<string>")
    return F.when(all_of([~condition for condition, _ in failures]), none).otherwise(names_of(failures))


def passes(checks: list[Check]) -> Column:
    """The checks as one predicate."""
    return all_of([~check.fails() for check in checks])


def valid_events(events: DataFrame) -> DataFrame:
    return events.where(passes(EVENT_CHECKS))


def sanitized(events: DataFrame) -> DataFrame:
    """The nine columns kept of a valid event."""
    return valid_events(events).select(
        "transaction_id",
        "card_id",
        "amount",
        "c1",
        "c2",
        "product_cd",
        "p_emaildomain",
        "timestamp",
        "event_time",
    )


def with_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    return df.withColumn(REASONS, failed_checks(checks))


def clean_rows(checked: DataFrame) -> DataFrame:
    """The complement of the failing rows, by filter and not by join."""
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def failing_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)


def coerced(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Cast checked columns to their declared types."""
    types = {check.column: check.type for check in checks}
    return df.withColumns({name: F.col(name).try_cast(type_) for name, type_ in types.items()})


def failure_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Q3: failing rows per check, from one aggregate pass."""
    labels = [check.label for check in checks]
    counts = df.agg(*[F.count_if(check.fails()).alias(check.label) for check in checks])
    pairs = F.array(
        *[F.struct(F.lit(label).alias("check_name"), F.col(f"`{label}`").alias("failed_rows")) for label in labels]
    )
    return counts.select(F.inline(pairs)).where(F.col("failed_rows") > 0)


def validity_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """A5: valid and corrupt rows."""
    ok = passes(checks)
    return df.agg(F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("corrupt_rows"))


def max_null_ratio(df: DataFrame) -> Column:
    """A4: aggregate expression, the largest share of nulls (or NaN) over the columns."""
    shares = []
    for field in df.schema.fields:
        missing = F.col(field.name).isNull()
        if field.dataType.typeName() in ("double", "float"):
            missing = missing | F.isnan(field.name)
        shares.append(F.try_divide(F.count_if(missing), F.count(F.lit(1))))
    return F.array_max(F.array(*shares))


@dataclass(frozen=True)
class GateResult:
    is_valid: bool
    rows: int
    quarantined_rows: int
    null_ratio: float | None
    clean: DataFrame
    quarantined: DataFrame
    checked: DataFrame

    def release(self) -> None:
        """Free the checked rows once both halves are written."""
        self.checked.unpersist()


class GateFailed(RuntimeError):
    pass


def gate(df: DataFrame, checks: list[Check] = BATCH_CHECKS, on_fail: str = "quarantine") -> GateResult:
    """Q4-Q6: check a table and split it.

    ``on_fail="quarantine"`` goes on with the clean rows, ``"halt"`` raises. An empty table
    is invalid. The checked rows are persisted because the caller writes both halves.
    """
    if on_fail not in ("quarantine", "halt"):
        raise ValueError(f"unknown on_fail {on_fail!r}")
    checked = with_failures(df, checks).persist(StorageLevel.MEMORY_AND_DISK)
    summary = checked.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size(REASONS) > 0).alias("bad"),
        max_null_ratio(df).alias("nulls"),
    ).first()
    is_valid = summary.n > 0 and summary.bad == 0
    if not is_valid and on_fail == "halt":
        checked.unpersist()
        raise GateFailed(f"{summary.bad} of {summary.n} rows fail the checks")
    clean = coerced(clean_rows(checked), checks)
    return GateResult(is_valid, summary.n, summary.bad, summary.nulls, clean, failing_rows(checked), checked)
