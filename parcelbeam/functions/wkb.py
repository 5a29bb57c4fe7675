"""Well-known binary of polygons as column expressions.

WKB is a byte order mark, a geometry type, counts, and coordinates as IEEE doubles.  Spark has no
function for the bits of a double, so they are computed: dividing by a power of two is exact, so
are the difference from one and the product with 2^52.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the format: big-endian mark and the type number of a polygon.
BIG_ENDIAN = "00"
POLYGON = 3


def _word(n: Column) -> Column:
    """An unsigned 32-bit number in hex."""
    return F.lpad(F.hex(n.cast("long")), 8, "0")


def double_hex(c: Column) -> Column:
    """The 64 bits of a double in hex, most significant first.  For normal numbers, zero and
    infinities; NULL for NaN and for numbers below 2^-1022 in amount."""
    x = c.cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    # log2 is rounded: the exponent may be one off next to a power of two
    low = F.when(size < F.pow(F.lit(2.0), guess), guess - 1).otherwise(guess)
    exponent = F.when(size >= F.pow(F.lit(2.0), low + 1), low + 1).otherwise(low)
    # in two factors, each of them in range
    half = F.floor(exponent / 2)
    scaled = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half)
    fraction = ((scaled - 1) * F.lit(float(2 ** 52))).cast("long")
    bits = (exponent + 1023).cast("long") * F.lit(2 ** 52) + fraction
    # the sign is the top bit: a first hex digit of 8 and more
    sign = F.when(x < 0, F.lit(8)).otherwise(F.lit(0))

    def signed(digits: Column) -> Column:
        first = F.conv(F.substring(digits, 1, 1), 16, 10).cast("int")
        return F.concat(F.hex((first + sign).cast("long")), F.substring(digits, 2, 15))

    return (F.when(F.isnan(x), F.lit(None).cast("string"))
            .when(size == float("inf"), signed(F.lit("7FF0000000000000")))
            .when(size == 0, F.lit("0" * 16))
            .when(size >= F.lit(2.0 ** -1022), signed(F.lpad(F.hex(bits), 16, "0"))))


def ring_hex(points: Sequence[tuple[Column, Column]]) -> Column:
    """A ring: number of points, then x and y of each."""
    parts = [_word(F.lit(len(points)))]
    for x, y in points:
        parts += [double_hex(x), double_hex(y)]
    return F.concat(*parts)


def polygon_wkb(*rings: Sequence[tuple[Column, Column]]) -> Column:
    """A polygon of rings of points (outer ring first, each closed); NULL if a coordinate is."""
    head = F.concat(F.lit(BIG_ENDIAN), _word(F.lit(POLYGON)), _word(F.lit(len(rings))))
    return F.unhex(F.concat(head, *[ring_hex(r) for r in rings]))


def points_wkb(points: Column) -> Column:
    """A polygon of one ring from an array of (x, y) structs of any length, closed if it is not;
    NULL without points or if a coordinate is NULL."""
    ends = F.element_at(points, 1), F.element_at(points, -1)
    closed = F.when(ends[0] == ends[1], points).otherwise(F.concat(points, F.slice(points, 1, 1)))
    body = F.transform(closed, lambda p: F.concat(double_hex(p["x"]), double_hex(p["y"])))
    whole = F.concat(F.lit(BIG_ENDIAN), _word(F.lit(POLYGON)), _word(F.lit(1)), _word(F.size(closed)), F.array_join(body, ""))
    return F.when((F.size(points) > 0) & ~F.exists(body, lambda b: b.isNull()), F.unhex(whole))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> list[tuple[Column, Column]]:
    """The closed ring of a rectangle, counter-clockwise from its lower left corner."""
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
