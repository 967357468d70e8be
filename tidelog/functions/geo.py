"""Geohash as a native column expression (no UDF).

A geohash of precision ``p`` has ``5p`` bits; longitude gets ``ceil(5p/2)`` and
latitude ``floor(5p/2)`` of them, interleaved starting with longitude. The cell
index along one axis is ``floor((v - lo) / span * 2^bits)`` clamped to
``2^bits - 1`` and corrected by one where rounding of ``v - lo`` crossed a
cell edge; the edges are exact dyadic numbers, so the result equals repeated
bisection bit for bit.

Each base32 digit takes a 3-bit slice of the leading axis (longitude for even
digits, latitude for odd ones) and a 2-bit slice of the other. The pair
``lead * 4 + follow`` indexes a 32-character string that holds the digit for
every pair, built below from the alphabet by the interleaving rule. So every
digit reads each axis once: the expression stays small even where the
optimizer copies it (pushed-down filters get no subexpression elimination),
and it compiles into whole-stage codegen.

``geohash_sql`` renders the same formula as SQL text so oracles can repeat it
operation for operation (identical IEEE steps, identical cells).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash base32 alphabet, in digit order 0..31.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _slice_pair_digits() -> str:
    """Digit of every (lead, follow) pair: the 3 lead bits sit at digit bits
    4, 2, 0 and the 2 follow bits at 3, 1."""
    out = []
    for idx in range(32):
        lead, follow = idx >> 2, idx & 3
        value = ((lead >> 2) & 1) << 4 | ((follow >> 1) & 1) << 3 | ((lead >> 1) & 1) << 2
        value |= (follow & 1) << 1 | (lead & 1)
        out.append(GEOHASH_ALPHABET[value])
    return "".join(out)


PAIR_DIGITS = _slice_pair_digits()


def _bits(precision: int) -> tuple[int, int]:
    total = 5 * precision
    return (total + 1) // 2, total // 2  # (longitude bits, latitude bits)


def _layout(precision: int) -> list[tuple[int, int, int, int, bool]]:
    """Per digit: (lng shift, lng mask, lat shift, lat mask, longitude leads)."""
    lng_bits, lat_bits = _bits(precision)
    used_x = used_y = 0
    out = []
    for j in range(precision):
        nx = 3 if j % 2 == 0 else 2
        used_x += nx
        used_y += 5 - nx
        out.append((lng_bits - used_x, (1 << nx) - 1, lat_bits - used_y, (1 << (5 - nx)) - 1, j % 2 == 0))
    return out


def _check(precision: int) -> None:
    if not 1 <= precision <= 12:
        raise ValueError("precision must be within 1..12")


def geohash(lat: Column | str, lng: Column | str, precision: int) -> Column:
    """Base32 geohash of (lat, lng); null when either is null or out of range."""
    _check(precision)
    lat = F.col(lat) if isinstance(lat, str) else lat
    lng = F.col(lng) if isinstance(lng, str) else lng
    lat_d, lng_d = lat.cast("double"), lng.cast("double")
    lng_bits, lat_bits = _bits(precision)
    # least() ignores nulls, so validity joins as a 0-or-null term.
    guard = F.when(lat_d.between(-90.0, 90.0) & lng_d.between(-180.0, 180.0), F.lit(0))

    def cell(v: Column, lo: float, span: float, bits: int) -> Column:
        w = span / (1 << bits)  # exact: cell edges are dyadic numbers
        raw = F.floor((v - F.lit(lo)) / F.lit(span) * F.lit(float(1 << bits)))
        # The subtraction may round v onto a neighbouring edge; compare with
        # the exact edges (what bisection does) to correct by one.
        fixed = (
            raw
            - (v < F.lit(lo) + raw * F.lit(w)).cast("long")
            + (v >= F.lit(lo) + (raw + 1) * F.lit(w)).cast("long")
        )
        return F.least(fixed, F.lit((1 << bits) - 1)) + guard

    x = cell(lng_d, -180.0, 360.0, lng_bits)
    y = cell(lat_d, -90.0, 180.0, lat_bits)
    table = F.lit(PAIR_DIGITS)
    digits = []
    for sx, mx, sy, my, lng_leads in _layout(precision):
        xs = F.shiftright(x, sx).bitwiseAND(F.lit(mx))
        ys = F.shiftright(y, sy).bitwiseAND(F.lit(my))
        idx = xs * F.lit(4) + ys if lng_leads else ys * F.lit(4) + xs
        digits.append(F.substr(table, idx + 1, F.lit(1)))
    return F.concat(*digits)


def geohash_sql(lat: str, lng: str, precision: int) -> str:
    """The same formula as SQL text (DuckDB syntax)."""
    _check(precision)
    lng_bits, lat_bits = _bits(precision)
    guard = f"CASE WHEN ({lat}) BETWEEN -90.0 AND 90.0 AND ({lng}) BETWEEN -180.0 AND 180.0 THEN 0 END"

    def cell(v: str, lo: float, span: float, bits: int) -> str:
        w = span / (1 << bits)
        d = f"CAST({v} AS DOUBLE)"
        raw = f"CAST(floor(({d} - ({lo})) / {span} * {float(1 << bits)}) AS BIGINT)"
        fixed = (
            f"({raw} - CAST({d} < ({lo}) + {raw} * {w!r} AS BIGINT) "
            f"+ CAST({d} >= ({lo}) + ({raw} + 1) * {w!r} AS BIGINT))"
        )
        return f"(least({fixed}, {(1 << bits) - 1}) + {guard})"

    x, y = cell(lng, -180.0, 360.0, lng_bits), cell(lat, -90.0, 180.0, lat_bits)
    digits = []
    for sx, mx, sy, my, lng_leads in _layout(precision):
        # DuckDB gives | & << >> one precedence level: parenthesise every step.
        xs, ys = f"(({x} >> {sx}) & {mx})", f"(({y} >> {sy}) & {my})"
        idx = f"{xs} * 4 + {ys}" if lng_leads else f"{ys} * 4 + {xs}"
        digits.append(f"substr('{PAIR_DIGITS}', CAST({idx} + 1 AS INTEGER), 1)")
    return " || ".join(digits)  # || (unlike concat) keeps NULL
