"""Amount, age, rate and run-id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_value(c) -> Column:
    """Amount text -> absolute double, or null.

    Everything but ASCII digits, ``.`` and ``-`` is deleted before the numeric parse, so
    ``$1,234.50`` -> 1234.5, ``(100.00)`` -> 100, ``1e5`` -> 15 and ``1-2`` -> null.
    The caller keeps rows whose value is ``> 0``.
    """
    digits = F.regexp_replace(_col(c).cast("string"), r"[^0-9.\-]", "")
    return F.abs(digits.try_cast("double"))


def age_to_int(c) -> Column:
    """Numeric-or-null, truncated toward zero (``45.7`` -> 45)."""
    return _col(c).try_cast("double").try_cast("int")


def rate_pct(part, whole) -> Column:
    """``round(part / whole * 100, 2)``, 0 when ``whole`` is 0 or null."""
    part, whole = _col(part), _col(whole)
    return F.when(whole > 0, F.round(part.cast("double") / whole.cast("double") * 100.0, 2)).otherwise(F.lit(0.0))


def duration_text(seconds) -> Column:
    """``30s``, ``1m 30s``, ``1h 1m`` from whole seconds."""
    s = _col(seconds).cast("long")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat((s / 60).cast("long").cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s")))
        .otherwise(
            F.concat((s / 3600).cast("long").cast("string"), F.lit("h "), ((s % 3600) / 60).cast("long").cast("string"), F.lit("m"))
        )
    )


def batch_id_of(ts) -> Column:
    """Run id text ``yyyyMMdd_HHmmss_SSS`` from a timestamp."""
    return F.date_format(_col(ts), "yyyyMMdd_HHmmss_SSS")
