"""Display helpers as column expressions (X3, X4, W3 arrows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trend symbols for lower / higher / equal.
ARROW_DOWN = "↓"
ARROW_UP = "↑"
ARROW_FLAT = "→"


def metric_title(name: Column) -> Column:
    """'learning_rate' -> 'Learning Rate'."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def trend_arrow(cur: Column, prev: Column, prev_has_key: Column | None = None) -> Column:
    """'' without a previous value; else down / up / flat."""
    has_prev = prev.isNotNull() if prev_has_key is None else prev_has_key
    arrow = (F.when(cur < prev, F.lit(ARROW_DOWN))
             .when(cur > prev, F.lit(ARROW_UP))
             .otherwise(F.lit(ARROW_FLAT)))
    return F.when(has_prev, arrow).otherwise(F.lit(""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


_SPLIT = float((1 << 27) + 1)


def _halves(x):
    """A double (or a column of them) as a sum of two of 26 bits each."""
    high = x * _SPLIT - (x * _SPLIT - x)
    return high, x - high


def _rounded(v: Column, scale: Column, high: Column, low: Column) -> Column:
    """v * scale of a double v >= 0, rounded to a whole number (BIGINT) from its exact binary
    value, ties to even; ``high`` and ``low`` are the halves of ``scale``.

    The exact product is the double p and the error of that product, which the halves give exactly."""
    def finish(p: Column, rest: Column) -> Column:
        whole = F.floor(p).cast("bigint")
        # exact in sign: the first part is, and the rest is far smaller unless that is zero
        over = ((p - F.floor(p)) - F.lit(0.5)) + rest
        up = _let(over, lambda o: (o > 0) | ((o == 0) & (F.pmod(whole, F.lit(2)) == 1)))
        return F.when(p < float(1 << 52), whole + up.cast("bigint")).otherwise(whole + F.rint(rest).cast("bigint"))

    def error(p: Column, vh: Column) -> Column:
        vl = v - vh
        return ((vh * high - p) + vh * low + vl * high) + vl * low
    return _let(v * scale, lambda p: _let(v * _SPLIT, lambda c: _let(c - (c - v), lambda vh: _let(error(p, vh), lambda rest: finish(p, rest)))))


def fixed(value: Column, digits: int) -> Column:
    """'%.<digits>f' as C and Python print it: the exact binary value rounded half to even
    (the platform's formatter rounds the shortest decimal half up; it does so here from 2^62 units on)."""
    scale = float(10 ** digits)
    parts = [F.lit(x) for x in (scale, *_halves(scale))]

    def text(v: Column) -> Column:
        return _let(_rounded(v, *parts), lambda n: n.cast("string") if not digits else F.concat(
            F.floor(n.cast("decimal(20,0)") / 10 ** digits).cast("bigint").cast("string"), F.lit("."), F.lpad(F.pmod(n, F.lit(10 ** digits)).cast("string"), digits, "0")))
    signed = F.concat(F.when(value < 0, "-").otherwise(""), _let(F.abs(value), text))
    return F.when(F.abs(value) * scale < float(1 << 62), signed).otherwise(F.format_string(f"%.{digits}f", value))


def scientific(value: Column, digits: int = 2) -> Column:
    """'%.<digits>e' of values from 1e-15 up to 1e<digits>, by exact rounding; others by the platform's formatter."""
    powers = [10.0 ** i for i in range(23)]  # those that are doubles exactly
    scales = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip("shl", (p, *_halves(p)), strict=True)]) for p in powers])
    top = 10 ** (digits + 1)

    def at(v: Column, e: Column) -> Column:
        place = F.greatest(F.lit(1), F.least(F.lit(len(powers)), F.lit(digits + 1) - e))
        return _let(F.element_at(scales, place), lambda s: _rounded(v, s["s"], s["h"], s["l"]))

    def text(n: Column, e: Column) -> Column:
        power = F.concat(F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), 2, "0"))
        return F.concat(F.substring(n.cast("string"), 1, 1), F.lit("."), F.substring(n.cast("string"), 2, digits), F.lit("e"), power)

    def whole(v: Column) -> Column:  # the logarithm may be one off beside a power of ten
        return _let(F.floor(F.log10(v)).cast("int"), lambda e0: _let(at(v, e0), lambda n0: _let(
            F.when(n0 >= top, e0 + 1).when(n0 < top // 10, e0 - 1).otherwise(e0), lambda e: _let(at(v, e), lambda n: text(n, e)))))
    signed = F.concat(F.when(value < 0, "-").otherwise(""), _let(F.abs(value), whole))
    return F.when((F.abs(value) >= 1e-15) & (F.abs(value) < float(10 ** digits)), signed).otherwise(F.format_string(f"%.{digits}e", value))


def status_line(step: Column, epoch: Column, loss: Column, ppl: Column, lr: Column,
                vram: Column, tps: Column, loss_arrow: Column, ppl_arrow: Column,
                tps_arrow: Column) -> Column:
    """One-line monitor text; a missing value prints as 0 like the monitor."""
    z = F.lit(0.0)
    return F.format_string(
        "Step: %d Epoch: %d | Loss: %s %s | Perplexity: %s %s | LR: %s | "
        "VRAM: %s GB | Tokens/sec: %s %s",
        F.coalesce(step, F.lit(0)), F.coalesce(epoch, F.lit(0)),
        fixed(F.coalesce(loss, z), 4), loss_arrow, fixed(F.coalesce(ppl, z), 2), ppl_arrow,
        scientific(F.coalesce(lr, z)), fixed(F.coalesce(vram, z), 2), fixed(F.coalesce(tps, z), 0), tps_arrow)
