"""Per-event rolling features over a card's history.

Each event sees the events of its card in ``[t - W, t]`` that arrived no later than
itself: earlier event time, or the same time and an earlier place in the arrival order. The lower
bound is inclusive.

Ordinary cards use window functions on one shuffle by card. Counts and sums are the running
total minus the running total of what has left the window. The day's maximum cuts a card's
time into days: an event's window is the part of its own day up to it, a running maximum, and
the end of the day before, a running maximum from the other side, taken at the instant one day
before the event. All of them cost one step per row however many rows a window holds.

A card with more rows than a task should hold is divided into one-minute cells instead.
Every window is a whole number of minutes, so the window of an event in minute ``m`` is

    its own minute up to the event
    + the whole minutes m - W .. m - 1, from a per-minute roll-up
    - the part of minute m - W that is older than t - W.

The last part needs rows of another minute; each row is therefore also sent, shifted by W,
to the minute in which it expires. No task then sees more than one minute of rows, and the
roll-up has one row per card and active minute whatever the traffic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.functions.columns import MICROS
from cardmill.operators.skew import HOT_ROWS, hot_keys

WINDOWS = {"1m": 60, "5m": 300, "1h": 3600, "24h": 86_400}
CELL_SECONDS = 60

STREAM_FEATURES = [
    "trans_count_1m",
    "trans_count_5m",
    "trans_count_1h",
    "total_amount_1h",
    "avg_amount_1h",
    "avg_amount_24h",
    "stddev_amount_24h",
    "max_amount_24h",
    "c2_count_sum_1h",
]

# measure -> (value summed, window): what has to be totalled per event
_TOTALS = {
    "n_1m": ("one", "1m"),
    "n_5m": ("one", "5m"),
    "n_1h": ("one", "1h"),
    "n_24h": ("one", "24h"),
    "sum_1h": ("amt", "1h"),
    "sum_24h": ("amt", "24h"),
    "hh_24h": ("hh", "24h"),
    "hl_24h": ("hl", "24h"),
    "ll_24h": ("ll", "24h"),
    "c2_1h": ("c2x", "1h"),
}

# Amounts and c2 are summed as whole ten-thousandths, so totals are exact, do not depend on
# the order of the rows and can be subtracted. Events with finer values are quarantined by
# their checks (``quality.ROLLING_CHECKS``); values that do not fit stop the job. The square of an amount does not fit 64 bits;
# with amt = h * 65536 + l its parts h*h, h*l and l*l do.
UNITS = 10_000
_VALUES = {
    "one": "1L",
    "amt": "amt",
    "hh": "SHIFTRIGHT(amt, 16) * SHIFTRIGHT(amt, 16)",
    "hl": "SHIFTRIGHT(amt, 16) * (amt & 65535L)",
    "ll": "(amt & 65535L) * (amt & 65535L)",
    "c2x": "c2x",
}

# Frames are written as SQL text: one call builds a whole projection, which matters to a
# stream that plans this for every micro-batch.
_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _up_to(distance: int) -> str:
    """Everything at least ``distance`` before the current value of the ordering column."""
    return f"RANGE BETWEEN UNBOUNDED PRECEDING AND {distance}L PRECEDING"


def rolling_features(
    events: DataFrame,
    hot_rows: int = HOT_ROWS,
    carry: tuple[str, ...] = (),
    rounded: bool = False,
    arrival: tuple[str, ...] = ("transaction_id",),
) -> DataFrame:
    """One feature vector per event; ``carry`` names input columns to keep.

    ``arrival`` orders events of the same card and time.

    ``events`` needs ``transaction_id, card_id, amount, c2, event_time`` and rows that
    passed the event checks. ``rounded`` applies the two decimal places of the online vector.
    """
    rows = events.select("transaction_id", "card_id", "event_time", "amount", "c2", *_extra_columns(carry, arrival))
    rows = rows.selectExpr(
        "transaction_id",
        "card_id",
        "event_time",
        *carry,
        f"struct({', '.join(arrival)}) AS seq" if len(arrival) > 1 else f"{arrival[0]} AS seq",
        "unix_micros(CAST(event_time AS TIMESTAMP)) AS t",
        "amount",
        f"CAST(RINT(amount * {UNITS}) AS BIGINT) AS amt",
        f"COALESCE(CAST(RINT(c2 * {UNITS}) AS BIGINT), 0L) AS c2x",
    )
    hot = F.broadcast(hot_keys(events, "card_id", hot_rows))
    kept = ["transaction_id", "card_id", "event_time", *carry, *_TOTALS, "max_24h"]
    ordinary = _ordinary(rows.join(hot, "card_id", "left_anti")).select(kept)
    divided = _divided(rows.join(hot, "card_id", "left_semi")).select(kept)
    return rolling_vectors(ordinary.unionByName(divided), carry, rounded)


def _extra_columns(carry: tuple[str, ...], arrival: tuple[str, ...]) -> list[str]:
    """Columns needed beyond the five of an event, each once."""
    return [name for name in dict.fromkeys((*carry, *arrival)) if name != "transaction_id"]


def _total(value: str, over: str, where: str | None = None) -> str:
    summed = _VALUES[value] if where is None else f"CASE WHEN {where} THEN {_VALUES[value]} END"
    return f"COALESCE(SUM({summed}) OVER ({over}), 0L)"


def _ordinary(rows: DataFrame) -> DataFrame:
    arrived = f"PARTITION BY card_id ORDER BY t, seq {_SO_FAR}"
    in_time = "PARTITION BY card_id ORDER BY t"
    day = WINDOWS["24h"] * MICROS
    this_day = f"PARTITION BY card_id, day_no ORDER BY t, seq {_SO_FAR}"

    def gone(window: str) -> str:
        return f"{in_time} {_up_to(WINDOWS[window] * MICROS + 1)}"

    running = rows.selectExpr("*", *[f"{_total(v, arrived)} AS run_{v}" for v in _VALUES])
    totals = [f"run_{value} - {_total(value, gone(window))} AS {name}" for name, (value, window) in _TOTALS.items()]
    running = running.selectExpr("*", *totals, f"CAST(FLOOR(t / {day}) AS BIGINT) AS day_no")
    running = running.selectExpr("*", f"MAX(amount) OVER ({this_day}) AS own_max")
    # Every row twice: where it is, and as a question one day earlier.
    twice = running.selectExpr("*", "EXPLODE(ARRAY(0L, 1L)) AS lag")
    twice = twice.withColumns({"t": F.expr(f"t - lag * {day}"), "day_no": F.col("day_no") - F.col("lag")})
    from_here = "PARTITION BY card_id, day_no ORDER BY t DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    asked = twice.selectExpr("*", f"MAX(CASE WHEN lag = 0 THEN amount END) OVER ({from_here}) AS edge_max")
    return asked.where("lag = 1").selectExpr("*", "GREATEST(own_max, edge_max) AS max_24h")


def _divided(rows: DataFrame) -> DataFrame:
    cell = f"CAST(FLOOR(t / {CELL_SECONDS * MICROS}) AS BIGINT) AS cell"

    # Whole minutes: one row per card and active minute.
    per_minute = rows.selectExpr("*", cell).groupBy("card_id", "cell").agg(
        *[F.sum(F.expr(expression)).alias(f"sum_{v}") for v, expression in _VALUES.items()],
        F.max("amount").alias("amount_max"),
    )
    by_minute = "PARTITION BY card_id ORDER BY cell"
    day_cells = WINDOWS["24h"] // CELL_SECONDS

    def whole(value: str, window: str) -> str:
        # Totals over a hot card's whole past may need more than 64 bits, those of a day do not.
        def until(distance: int) -> str:
            return f"COALESCE(SUM(CAST(sum_{value} AS DECIMAL(28,0))) OVER ({by_minute} {_up_to(distance)}), 0)"

        return f"CAST({until(1)} - {until(WINDOWS[window] // CELL_SECONDS + 1)} AS BIGINT)"

    middle = per_minute.selectExpr(
        "card_id",
        "cell",
        *[f"{whole(value, window)} AS mid_{name}" for name, (value, window) in _TOTALS.items()],
        f"MAX(amount_max) OVER ({by_minute} RANGE BETWEEN {day_cells - 1}L PRECEDING AND 1L PRECEDING) AS mid_max",
    )

    # Own rows (lag 0) and, for every window, the same rows at the time they expire.
    lags = ", ".join(f"{seconds}L" for seconds in (0, *WINDOWS.values()))
    copies = (
        rows.selectExpr("*", f"EXPLODE(ARRAY({lags})) AS lag")
        .withColumn("t", F.expr(f"t + lag * {MICROS}"))
        .selectExpr("*", cell)
        .repartition("card_id", "cell")
    )
    in_cell = "PARTITION BY card_id, cell"
    arrived = f"{in_cell} ORDER BY t, seq {_SO_FAR}"
    expired = f"{in_cell} ORDER BY t {_up_to(1)}"
    not_expired = f"{in_cell} ORDER BY t DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    seen = copies.selectExpr(
        "*",
        *[f"{_total(v, arrived, 'lag = 0')} AS run_{v}" for v in _VALUES],
        f"MAX(CASE WHEN lag = 0 THEN amount END) OVER ({arrived}) AS own_max",
    )
    seen = seen.selectExpr(
        "*",
        *[
            f"{_total(value, expired, f'lag = {WINDOWS[window]}')} AS gone_{name}"
            for name, (value, window) in _TOTALS.items()
        ],
    )
    seen = seen.selectExpr(
        "*", f"MAX(CASE WHEN lag = {WINDOWS['24h']} THEN amount END) OVER ({not_expired}) AS edge_max"
    )
    joined = seen.where("lag = 0").join(middle, ["card_id", "cell"])
    totals = [f"run_{value} + mid_{name} - gone_{name} AS {name}" for name, (value, _) in _TOTALS.items()]
    return joined.selectExpr("*", *totals, "GREATEST(own_max, mid_max, edge_max) AS max_24h")


def rolling_vectors(rows: DataFrame, carry: tuple[str, ...] = (), rounded: bool = False) -> DataFrame:
    """The nine features from window totals of whole ten-thousandths."""
    # n * sum(x^2) - sum(x)^2 as whole numbers of up to 38 digits: equal amounts give exactly
    # zero, and only the square root is floating point.
    wide = "DECIMAL(38,0)"
    squares = (
        f"CAST(hh_24h AS {wide}) * CAST(4294967296 AS DECIMAL(10,0))"
        f" + CAST(hl_24h AS {wide}) * CAST(131072 AS DECIMAL(6,0)) + CAST(ll_24h AS {wide})"
    )
    spread = (
        f"CAST(CAST(n_24h AS DECIMAL(19,0)) * CAST({squares} AS {wide})"
        " - CAST(sum_24h AS DECIMAL(19,0)) * CAST(sum_24h AS DECIMAL(19,0)) AS DOUBLE)"
    )
    features = {
        "trans_count_1m": "n_1m",
        "trans_count_5m": "n_5m",
        "trans_count_1h": "n_1h",
        "total_amount_1h": f"sum_1h / {UNITS}D",
        "avg_amount_1h": f"sum_1h / {UNITS}D / n_1h",
        "avg_amount_24h": f"sum_24h / {UNITS}D / n_24h",
        "stddev_amount_24h": f"CASE WHEN n_24h > 1 THEN SQRT({spread}) / (n_24h * {UNITS}D) ELSE 0D END",
        "max_amount_24h": "max_24h",
        "c2_count_sum_1h": f"c2_1h / {UNITS}D",
    }
    if rounded:
        features = {n: e if n.startswith("trans_count") else f"ROUND({e}, 2)" for n, e in features.items()}
    return rows.selectExpr(
        "transaction_id",
        "card_id",
        *carry,
        *[f"{expression} AS {name}" for name, expression in features.items()],
        "event_time AS last_updated",
    )
