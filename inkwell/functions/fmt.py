"""Number formatting identical to Python's ``f"{x:.Nf}"`` / ``f"{x:+.Nf}"``.

Python (and C ``printf``) round the *exact binary value* of a double half to
even.  ``format_string('%.2f')`` rounds half up (0.125 → 0.13) and
``format_number`` decides ties on the shortest decimal spelling
(5e-05 → 0.0000, while the double 5e-05 lies just above the tie and Python
prints 0.0001).  So the rounding is done here in exact arithmetic with plain
double expressions (JVM-side, no UDF), the same for every finite double:

1. ``|x|`` falls into its whole part, a long, and its fraction ``f``, both exact;
2. ``p = f·10^d`` and its exact rounding error ``e`` (Dekker's error-free
   product), so ``f·10^d = p + e`` exactly;
3. the two integer candidates around ``p`` and their midpoint ``m``; the sign of
   ``(p − m) + e`` (``p − m`` is exact near the midpoint) picks one; an exact tie
   goes to the even one; 10^d units carry into the whole part;
4. from 2^63 on a double is ``m·2^k`` with no fraction.  Its digits come from the
   limbs of 2^k (12 decimal digits each) times m, carried upwards in DECIMAL(38).
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder shown for a missing number.
MISSING = "暂无"

_SPLIT = 134217729.0        # 2^27 + 1, Dekker's splitter for doubles
_LONG = 2.0 ** 63
_LIMB = 12                  # decimal digits of a limb
_STEP = 32                  # the limbs are those of 2 ** (a * _STEP); the rest of the exponent goes to m


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _split(a: Column) -> tuple[Column, Column]:
    t = a * F.lit(_SPLIT)
    hi = t - (t - a)
    return hi, a - hi


def _rounded_units(f: Column, whole: Column, decimals: int) -> Column:
    """round-half-even(f · 10^d) as a long, exactly, for a fraction 0 <= f < 1 beside a whole part."""
    scale = 10.0 ** decimals
    p = f * F.lit(scale)
    a_hi, a_lo = _split(f)
    b_hi, b_lo = _split(F.lit(scale))
    e = ((a_hi * b_hi - p) + a_hi * b_lo + a_lo * b_hi) + a_lo * b_lo
    lo = F.floor(p)
    diff = (p - (lo + F.lit(0.5))) + e
    odd = (lo % 2 == 1) if decimals else (whole % 2 == 1)         # 10^d is even
    up = F.when(diff > 0, F.lit(True)).when(diff < 0, F.lit(False)).otherwise(odd)
    return (lo + F.when(up, 1).otherwise(0)).cast("long")


def _limbs() -> Column:
    """Row a: the limbs of 2 ** (a * _STEP), lowest first."""
    rows = []
    for a in range(1 + 971 // _STEP):
        digits = str(1 << (a * _STEP))
        digits = digits.zfill(-(-len(digits) // _LIMB) * _LIMB)
        rows.append([int(digits[i:i + _LIMB]) for i in range(len(digits) - _LIMB, -1, -_LIMB)])
    return F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>")


def _large(ax: Column) -> Column:
    """The digits of a double of 2^63 or more, a whole number."""
    # the power of two below it; a logarithm that rounds up to the next is put right by the mantissa
    k = (F.floor(F.log2(ax)) - 53).cast("int")
    m = (ax / F.pow(F.lit(2.0), k)).cast("decimal(38,0)")          # below 2^55, exact
    rest = F.pow(F.lit(2.0), k % _STEP).cast("decimal(38,0)")       # below 2^32
    factor = (m * rest).cast("decimal(38,0)")
    base = F.lit(10 ** _LIMB).cast("decimal(38,0)")
    limbs = F.concat(F.get(_limbs(), F.floor(k / _STEP).cast("int")), F.array_repeat(F.lit(0).cast("long"), 3))
    start = F.struct(F.lit(0).cast("decimal(38,0)").alias("carry"), F.lit("").alias("text"), factor.alias("factor"))

    def step(s: Column, limb: Column) -> Column:
        v = (s["factor"] * limb.cast("decimal(12,0)") + s["carry"]).cast("decimal(38,0)")
        digit = (v % base).cast("decimal(38,0)")
        return F.struct(((v - digit) / base).cast("decimal(38,0)").alias("carry"),
                        F.concat(F.lpad(digit.cast("string"), _LIMB, "0"), s["text"]).alias("text"), s["factor"].alias("factor"))

    return F.regexp_replace(F.aggregate(limbs, start, step, lambda s: s["text"]), "^0+", "")


def _is_negative(x: Column) -> Column:
    """x < 0, including -0.0 (Python prints '-0.00' for it)."""
    return (x < 0) | ((x == 0) & (x.cast("string") == F.lit("-0.0")))


def _render(x: Column, decimals: int, plus: bool) -> Column:
    ax = F.abs(x)
    whole = F.floor(ax)
    units = _rounded_units(ax - whole.cast("double"), whole, decimals)
    carried = F.when(units >= 10 ** decimals, whole + 1).otherwise(whole).cast("string") if decimals else (whole + units).cast("string")
    tail = F.concat(F.lit("."), F.lpad((units % F.lit(10 ** decimals)).cast("string"), decimals, "0")) if decimals else F.lit("")
    zeros = F.lit("." + "0" * decimals if decimals else "")
    body = (F.when(F.isnan(x), F.lit("nan")).when(ax == float("inf"), F.lit("inf"))
            .when(ax >= F.lit(_LONG), F.concat(_large(ax), zeros)).otherwise(F.concat(carried, tail)))
    # Python gives nan a plus where signs are asked for, and no minus
    sign = F.when(~F.isnan(x) & _is_negative(x), F.lit("-")).otherwise(F.lit("+" if plus else ""))
    return F.when(x.isNotNull(), F.concat(sign, body))


def fixed(c, decimals: int = 2) -> Column:
    return _render(_c(c).cast("double"), decimals, plus=False)


def signed(c, decimals: int = 2) -> Column:
    return _render(_c(c).cast("double"), decimals, plus=True)


def python_float(c) -> Column:
    """A double spelled as Python's ``repr``: plain from 1e-4 up to 1e16, else with a signed two-digit exponent."""
    x = _c(c).cast("double")
    java = F.abs(x).cast("string")                      # d.ddd, or d.dddE[-]n outside 1e-3 .. 1e7
    # older JVMs spell some doubles with 17 digits where 16 would do
    short = F.format_string("%.15e", F.abs(x))
    java = F.when(java.rlike(r"^[0-9][.][0-9]{16,}E") & (short.try_cast("double") == F.abs(x)), F.concat(
        F.regexp_replace(F.substring_index(short, "e", 1), r"\.?0+$", ""), F.lit("E"), F.substring_index(short, "e", -1))).otherwise(java)
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    digits = F.replace(mantissa, F.lit("."))
    e = F.substring_index(java, "E", -1).try_cast("int")
    padded = F.rpad(digits, F.greatest(F.length(digits), e + 1), F.lit("0"))
    rest = padded.substr(e + 2, F.length(padded))
    sci = F.concat(mantissa, F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")),
                   F.abs(e).cast("string"))
    body = (F.when(java == "Infinity", F.lit("inf")).when(~java.contains("E"), java)
            .when(e.between(0, 15), F.concat(padded.substr(F.lit(1), e + 1), F.lit("."), F.when(rest == "", F.lit("0")).otherwise(rest)))
            .when(e.between(-4, -1), F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)).otherwise(sci))
    return F.when(F.isnan(x), F.lit("nan")).when(_is_negative(x), F.concat(F.lit("-"), body)).otherwise(body)


def raw_or_missing(c) -> Column:
    """Show a double as Python ``str()`` would, or the missing marker."""
    return F.coalesce(python_float(c), F.lit(MISSING))
