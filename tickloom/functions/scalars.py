"""Column functions shared by the operators.  All are null-safe and safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"


def ratio(a: Column, b: Column, otherwise=0.0) -> Column:
    """``a / b`` where ``b`` is not zero or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(otherwise))


def once(frame: DataFrame, keep: list[str], fields: Column) -> DataFrame:
    """The columns ``keep`` of ``frame`` and the fields of the struct ``fields``, which each row evaluates once.

    Filters move below a plain select and take its expressions along, so that a parse is made anew for each of
    its uses; below a generator they don't move.
    """
    return frame.select(*keep, F.inline(F.array(fields)))


def round6(x: Column) -> Column:
    """Six places.  The offset is off any short fraction, so that sums in another order cut alike.

    ``floor`` of a double is a long; what no long holds has no fraction and stays.
    """
    y = x * 1e6 + 0.37
    return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y) / 1e6


def millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ that holds UTC, whatever the session's zone."""
    return F.unix_millis(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def side(raw: Column, strict: bool = False) -> Column:
    """``B`` for b and bid, ``A`` for a and ask, in any case and trimmed; else null, or an error if strict."""
    low = F.lower(F.trim(raw))
    bad = F.raise_error(F.concat(F.lit("not a side: "), F.coalesce(raw, F.lit("null")))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(low.isin("b", "bid"), "B").when(low.isin("a", "ask"), "A").otherwise(bad)


def first_path(json: Column, *paths: str) -> Column:
    """Value of the first path whose key is present, even if its value is null; aliases of one field."""
    out = F.lit(None).cast("string")
    for path in reversed(paths):
        parent, _, key = path.rpartition(".")
        keys = F.json_object_keys(json if parent == "$" else F.get_json_object(json, parent))
        out = F.when(F.coalesce(F.array_contains(keys, key), F.lit(False)), F.get_json_object(json, path)).otherwise(out)
    return out


def number(raw: Column) -> Column:
    """A finite number or numeric text as DOUBLE; booleans, blanks and anything else are null."""
    x = raw.try_cast("double")
    return F.when(~F.lower(raw.cast("string")).isin("true", "false") & ~F.isnan(x), x)


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    m = mid(bid, ask)
    return F.when(m > 0, (ask - bid) / m * 10_000).otherwise(0.0)


def imbalance(bid: Column, ask: Column) -> Column:
    return F.when(bid + ask > 0, ratio(bid - ask, bid + ask)).otherwise(0.0)


def basis_bps(mark: Column, oracle: Column) -> Column:
    return F.when(oracle > 0, (mark - oracle) / oracle * 10_000)


def exact(text: Column | str) -> Column:
    """A number's text as DECIMAL(38,18); null where it is none or does not fit."""
    return (F.col(text) if isinstance(text, str) else text).cast("string").try_cast(DECIMAL)


def plain(value: Column, text: Column) -> Column:
    """``value``, which came as ``text``, without an exponent and with as many decimals as ``text`` has."""
    shape = r"^[+-]?\d*\.?(\d*)(?:[eE]([+-]?\d+))?$"
    clean = F.trim(text)
    places = F.length(F.regexp_extract(clean, shape, 1)) - F.coalesce(F.regexp_extract(clean, shape, 2).try_cast("int"), F.lit(0))
    whole = value.cast(DECIMAL).cast("string")
    dot = F.instr(whole, ".")
    return F.when(places > 0, F.substring(whole, F.lit(1), dot + F.least(places, F.lit(18)))).otherwise(F.substring(whole, F.lit(1), dot - 1))


def tick(px: Column) -> Column:
    """The unit of the last decimal place of a price text."""
    places = F.length(F.regexp_extract(px, r"\.(\d+)$", 1))
    return F.pow(F.lit(10.0), -places).cast(DECIMAL)


def timeframe_ms(text: str) -> int:
    """``30s``, ``5m``, ``1h``, ``1d``; a number without a known unit counts minutes."""
    units = {"s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
    return int(text[:-1]) * units[text[-1]] if text[-1:] in units else int("".join(c for c in text if c.isdigit()) or 1) * 60_000


def ema_alpha(halflife: float) -> float:
    return 1 - 0.5 ** (1 / halflife)


def backoff_bound(attempt: int, base: float = 1.0, cap: float = 60.0) -> float:
    """Upper end of a full-jitter delay in seconds."""
    return min(cap, base * 2**attempt)
