"""Column-expression helpers (all JVM-side built-ins, no Python UDFs).

ANSI mode is on in Spark 4, so the null-on-failure forms are used where the
reference relied on non-ANSI behaviour: ``get`` instead of ``getItem``,
``try_divide`` instead of ``/``, ``try_cast`` instead of ``::DOUBLE``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The match labels and the open-end sentinel of a coach stint.
AWAY, HOME, DRAW = "Away", "Home", "Draw"
OPEN_END = "2099-12-31"
# Outcome levels of the classifiers, in factor order.
OUTCOME_LEVELS = ["Lose", "Draw", "Win"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def match_result(away="away_goals", home="home_goals") -> Column:
    """'Away' / 'Home' / else 'Draw' -- NULL home goals fall into 'Draw'."""
    a, h = _c(away), _c(home)
    return F.when(a > h, F.lit(AWAY)).when(a < h, F.lit(HOME)).otherwise(F.lit(DRAW))


def calc_end(end="end_date") -> Column:
    """Open-ended interval: NULL end date becomes the text sentinel."""
    return F.coalesce(_c(end), F.lit(OPEN_END))


def ratio(num, den) -> Column:
    """a / b that is NULL (not an error, not infinity) when b is 0 or NULL."""
    return F.try_divide(_c(num), _c(den))


def to_double(x) -> Column:
    """Text -> double; junk text gives NULL."""
    return F.col(x).try_cast("double") if isinstance(x, str) else x.try_cast("double")


def pct_to_double(x) -> Column:
    """'55%' -> 55.0 (every '%' removed), NULL stays NULL."""
    return F.regexp_replace(_c(x), "%", "").try_cast("double")


def null_default(x, default=0.0) -> Column:
    return F.ifnull(_c(x), F.lit(default))


def item(arr, index: int, field: str | None = None) -> Column:
    """Array element by position (NULL past the end), optionally a field of it."""
    e = F.get(_c(arr), index)
    return e.getField(field) if field else e


def class_from_probs(p_lose, p_draw, p_win) -> Column:
    """Largest of three probabilities -> level; both tests strict, so ties go to 'Lose'."""
    lo, dr, wi = _c(p_lose), _c(p_draw), _c(p_win)
    return (F.when((wi > dr) & (wi > lo), F.lit("Win"))
            .when((dr > wi) & (dr > lo), F.lit("Draw"))
            .otherwise(F.lit("Lose")))


def level_code(x, levels=OUTCOME_LEVELS) -> Column:
    """Factor code minus one: position of the value in ``levels`` (0-based)."""
    m = F.create_map(*[v for i, lv in enumerate(levels) for v in (F.lit(lv), F.lit(i))])
    return m[_c(x)]


def within(x, lo, hi) -> Column:
    """Inclusive range predicate (NULL bound -> NULL -> row dropped by a filter/join)."""
    return _c(x).between(_c(lo), _c(hi))


def abs_error(y, yhat) -> Column:
    return F.abs(_c(y) - _c(yhat))
