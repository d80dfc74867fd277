"""Row-wise casts, repairs and calendar parts. Every function returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: a plain decimal number with an optional exponent. Casts of other
# engines also take "1d", "0x1p3" or "1_0"; those are not numbers here.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
ZONE = r"\s*(Z|[+-][0-9]{2}:?[0-9]{2})$"
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "d MMM yyyy", "yyyyMMdd")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """NaN and infinities become null, the only missing value."""
    c = _col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _parsed(text: Column) -> Column:
    return finite(F.when(text.rlike(NUMBER), text.try_cast("double")))


def to_number(c: Column | str, commas: bool = True) -> Column:
    """Lenient cast of text: trims, drops thousands commas, gives null for the rest."""
    text = F.regexp_replace(_col(c), ",", "") if commas else _col(c)
    return _parsed(F.regexp_replace(text, r"^\s+|\s+$", ""))


def digits_to_number(c: Column | str) -> Column:
    """Keep digits, sign, point and exponent letters only, then cast."""
    return _parsed(F.regexp_replace(_col(c), r"[^0-9.\-eE]", ""))


def to_timestamp(c: Column | str, formats: tuple[str, ...] = ()) -> Column:
    """Lenient parse to a zone-free timestamp; a zone offset is cut off, not applied."""
    text = strip_zone(c)
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def strip_zone(c: Column | str) -> Column:
    """Text timestamp without its UTC offset."""
    c = _col(c)
    return F.when(c.rlike(r"[0-9]:[0-9]{2}"), F.regexp_replace(c, ZONE, "")).otherwise(c)


def to_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date from text in any of ``formats``, each row on its own."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)).cast("date") for f in formats])


def hour_of(ts: Column | str) -> Column:
    """Start of the clock hour, still zone-free."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def non_negative(c: Column | str) -> Column:
    return F.when(_col(c) >= 0, _col(c))


def clip(c: Column | str, low: float, high: float) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def station_key(city: Column | str, lat: Column | str, lon: Column | str) -> Column:
    return F.format_string("%s_%.4f_%.4f", _col(city), _col(lat), _col(lon))


def season(ts: Column | str) -> Column:
    """winter Nov-Feb, summer Mar-Jun, monsoon Jul-Oct."""
    m = F.month(_col(ts))
    return (F.when(m.isin(11, 12, 1, 2), "winter").when(m.between(3, 6), "summer").otherwise("monsoon"))


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    ts = _col(ts)
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "dayofweek": F.weekday(ts),  # 0 is Monday
        "is_weekend": F.weekday(ts) >= 5,
        "season": season(ts),
    }


def congestion_index(current: Column | str, free_flow: Column | str) -> Column:
    """Share of the free-flow speed that is lost; null where free flow is not positive."""
    current, free_flow = _col(current).cast("double"), _col(free_flow).cast("double")
    return F.when(
        (free_flow > 0) & current.isNotNull(),
        F.greatest(F.lit(0.0), 1 - current / F.when(free_flow > 0, free_flow)),
    )
