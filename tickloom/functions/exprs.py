"""Column expressions with the exact semantics that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS_NS = {"ms": 1_000_000, "s": 1_000_000_000, "m": 60_000_000_000}


def bucket_floor(t: Column, size: Column | int) -> Column:
    """Start of the bucket that holds ``t``: a floor for negative times too, without a detour through double."""
    size = size if isinstance(size, Column) else F.lit(size).cast("long")
    return t - F.pmod(t, size)


def ns_to_ms(ns: Column) -> Column:
    """The millisecond that holds a time in nanoseconds: in whole numbers, since a double rounds the last nanoseconds up."""
    ns, step = ns.cast("long"), F.lit(1_000_000).cast("long")
    return F.call_function("div", ns - F.pmod(ns, step), step)


def bucket_size_ns(label: str) -> int:
    """Nanoseconds of a label such as 250ms, 15s or 1m."""
    text = label.strip()
    for unit in ("ms", "s", "m"):
        number = text.removesuffix(unit)
        if number != text and number.isascii() and number.isdigit() and int(number) > 0:
            return int(number) * UNITS_NS[unit]
    raise ValueError(f"not a bucket size: {label!r}")


def bucket_sizes(labels: str) -> list[tuple[str, int]]:
    """Labels and sizes of a comma-separated list; of equal sizes the first label stays."""
    found: dict[int, str] = {}
    for label in (x.strip() for x in labels.split(",")):
        if label:
            found.setdefault(bucket_size_ns(label), label)
    if not found:
        raise ValueError("no bucket sizes")
    return [(label, ns) for ns, label in found.items()]


def ieee_div(a: Column, b: Column) -> Column:
    """Floating division as IEEE has it: x/0 is an infinity, 0/0 is NaN, null stays null."""
    a, b = a.cast("double"), b.cast("double")
    by_zero = F.when(F.isnan(a) | (a == 0), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, by_zero).otherwise(a / F.when(b != 0, b))


def sum0(x: Column) -> Column:
    """A sum that is zero where all values are null."""
    return F.coalesce(F.sum(x), F.lit(0))


def quantile_nearest(x: Column, q: float) -> Column:
    """The value at the rank nearest to q (n - 1) of the sorted non-null values; null without any."""
    kept = F.sort_array(F.collect_list(x))
    return F.get(kept, F.floor((F.count(x) - 1) * F.lit(q) + F.lit(0.5)).cast("int"))


def percentiles(x: Column, points: Iterable[float]) -> Column:
    """Exact percentiles with linear interpolation."""
    return F.percentile(x, F.array(*[F.lit(p) for p in points]))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def finite(x: Column) -> Column:
    """The value, or null where it isn't finite."""
    return F.when(is_finite(x), x)


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson over rows where both are finite; null under three rows or where a side is constant."""
    both = is_finite(a) & is_finite(b)
    x, y = F.when(both, a), F.when(both, b)
    varies = (F.count(x) >= 3) & (F.min(x) != F.max(x)) & (F.min(y) != F.max(y))
    cov, vx, vy = F.covar_pop(x, y), F.var_pop(x), F.var_pop(y)
    return F.when(varies & (vx > 0) & (vy > 0), cov / F.when((vx > 0) & (vy > 0), F.sqrt(vx * vy)))


def scaled_price(price: Column, scale: int) -> Column:
    """The price as an integer, halves to even; a null price is zero."""
    return F.coalesce(F.rint(price * F.lit(float(scale))).cast("long"), F.lit(0).cast("long"))


def uuid5_url(name: Column) -> Column:
    """RFC 4122 version 5 in the URL namespace, from built-in hashing."""
    space = F.unhex(F.lit(uuid.NAMESPACE_URL.hex))
    h = F.sha1(F.concat(space, F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(0x3F))).bitwiseOR(F.lit(0x80))))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 19, 2), F.lit("-"), F.substring(h, 21, 12))


def masked_login(login: Column) -> Column:
    return F.substring(F.sha2(login.cast("string"), 256), 1, 16)


def session_hour(ms: Column) -> Column:
    """Hour of the day by truncating division."""
    hours = F.when(ms >= 0, F.floor(ms / 3_600_000)).otherwise(F.ceil(ms / 3_600_000)).cast("long")
    days = F.when(hours >= 0, F.floor(hours / 24)).otherwise(F.ceil(hours / 24)).cast("long")
    return (hours - days * 24).cast("int")


def join_on(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are left out."""
    keys = list(keys)
    other = right.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    return left.join(other, [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in keys], how).drop(*[f"__on_{k}" for k in keys])


def require(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Raise with all missing columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
