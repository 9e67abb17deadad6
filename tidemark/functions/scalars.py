"""Column helpers with the reference dialect's semantics, built from Spark built-ins only.

Everything here returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concat_ws_strict(sep: str, *cols) -> Column:
    """``concat_ws`` that is null when any part is null (reference dialect); Spark skips nulls."""
    cs = [_c(c) for c in cols]
    all_present = reduce(lambda a, b: a & b, [c.isNotNull() for c in cs])
    return F.when(all_present, F.concat_ws(sep, *[c.cast("string") for c in cs]))


def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined text of the columns, null parts as empty text."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def round_half_up(col, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` in plain double arithmetic.

    Used for averages and ratios whose exact value can sit on a rounding tie: the
    formula is evaluated bit-identically by any IEEE engine (the oracle writes the same
    expression), unlike ``round``, whose tie handling differs between engines.
    """
    scale = float(10 ** digits)
    return F.floor(_c(col) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: null instead of an ANSI divide-by-zero error."""
    return F.try_divide(_c(num), _c(den))


# Fixed value: the native coin (asset id 0) always has 6 decimals in the reference.
NATIVE_ASSET_ID = 0
NATIVE_DECIMALS = 6


def scale_amount(amount, decimals, asset_id=None) -> Column:
    """Raw integer amount -> units: native coin /1e6; else /10^decimals when decimals > 0."""
    a, d = _c(amount).cast("double"), _c(decimals)
    scaled = F.when(d > 0, a / F.pow(F.lit(10.0), d)).otherwise(a)
    if asset_id is None:
        return scaled
    return F.when(_c(asset_id) == NATIVE_ASSET_ID, a / F.lit(10.0 ** NATIVE_DECIMALS)).otherwise(scaled)


def b64_text(col) -> Column:
    """Base64 text -> UTF-8 text, or null when it is not base64 or not valid UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(_c(col), F.lit("base64")).cast("string"))


def b64_hex(col) -> Column:
    """Base64 text -> upper-case hex of the bytes (null when not base64)."""
    return F.hex(F.try_to_binary(_c(col), F.lit("base64")))


def hex_text(col) -> Column:
    """Hex text -> UTF-8 text (``HEX_DECODE_STRING``); null on bad hex or bad UTF-8."""
    return F.try_validate_utf8(F.unhex(_c(col)).cast("string"))


def dow0(col) -> Column:
    """Day of week with Sunday = 0 (reference base); Spark's ``dayofweek`` is 1-based."""
    return F.dayofweek(_c(col)) - 1


def epoch_millis(ts) -> Column:
    """Milliseconds since epoch of a zone-free timestamp (no session time zone involved)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(ts))


def from_epoch_millis(ms) -> Column:
    """``DATEADD(ms, x, '1970-01-01')`` as a zone-free timestamp."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))


def regexp_instr_from(col, pattern: str, start: int) -> Column:
    """``REGEXP_INSTR(s, p, start)``: 1-based position of the first match at or after
    ``start`` (0 when none).  Spark's third argument is a group index, so slice first."""
    s = _c(col)
    pos = F.regexp_instr(F.substring(s, start, 2 ** 31 - 1), F.lit(pattern))
    return F.when(pos > 0, pos + F.lit(start - 1)).otherwise(F.lit(0))


def url_host(col) -> Column:
    return F.regexp_extract(_c(col), r"^[a-zA-Z]+://([^/?#]+)", 1)


def ntz_to_instant(col) -> Column:
    """Zone-free timestamp -> instant (``TIMESTAMP``), reading the wall time as UTC by exact
    microsecond arithmetic, so the session time zone plays no part (watermarks and
    event-time windows need an instant)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(col)))


def instant_to_ntz(col) -> Column:
    """Inverse of :func:`ntz_to_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(EPOCH_NTZ))


def trunc_ts(unit: str, col) -> Column:
    """``DATE_TRUNC(unit, ts)`` that stays zone-free: Spark's ``date_trunc`` returns a
    zoned TIMESTAMP even for TIMESTAMP_NTZ input, so cast the result back."""
    return F.date_trunc(unit, _c(col)).cast("timestamp_ntz")
