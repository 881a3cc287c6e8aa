"""Small column expressions shared by the operators.

Each helper returns a ``Column`` built only from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen and has a one-line DuckDB twin in
``quarry.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, StringType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c) -> Column:
    """A value is present when it is neither null nor the empty string.

    Line readers see a missing field as ``''`` and DataFrame readers as null;
    both mean "absent", so both are excluded.
    """
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


def key_bucket(key, seed, buckets: int = 100) -> Column:
    """Deterministic bucket in ``[0, buckets)`` of a string key and a seed.

    First 8 hex digits of ``md5(seed || ':' || key)`` read as an unsigned
    integer, modulo ``buckets``. Unlike ``randomSplit`` it does not depend on
    partitioning or column order, and DuckDB computes the same value.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string"))), 1, 8), 16, 10)
    return (h.cast("long") % F.lit(buckets)).cast("int")


def md5_order_key(key, seed) -> Column:
    """A seeded pseudo-random sort key: ``md5(seed || ':' || key)``."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string")))


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def py_str_repr(c) -> Column:
    """Render a string the way Python's ``repr`` does.

    Single quotes, or double ones when the text holds a single and no double
    quote; backslash, tab, newline and carriage return escaped, other control
    characters as ``\\x1f``."""
    c = _c(c)
    double = c.contains("'") & ~c.contains('"')
    body = c
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    odd = body
    for k in [*range(0x20), 0x7F]:
        if chr(k) not in "\n\r\t":
            odd = F.replace(odd, F.lit(chr(k)), F.lit(f"\\x{k:02x}"))
    body = F.when(c.rlike("[\\x00-\\x1f\\x7f]"), odd).otherwise(body)
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))


def py_value(c, kind: str | DataType = "string", inside: bool = False) -> Column:
    """Render a value as Python's ``str`` does; null is ``None``.

    ``kind`` is its Spark type; inside a list, strings are quoted."""
    c = _c(c)
    if isinstance(kind, ArrayType):
        r = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: py_value(x, kind.elementType, True)), ", "), F.lit("]"))
    elif kind in ("double", "float") or isinstance(kind, DoubleType | FloatType):
        r = py_float_str(c)
    elif kind == "boolean" or isinstance(kind, BooleanType):
        r = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif inside and (kind == "string" or isinstance(kind, StringType)):
        r = py_str_repr(c)
    else:
        r = c.cast("string")
    return F.when(c.isNull(), F.lit("None")).otherwise(r)


def py_list_str(c, element: str | DataType = "string") -> Column:
    """Render an array as Python prints a list: ``['a', 'b']``, ``[1, None]``; a null array stays null."""
    c = _c(c)
    items = F.transform(c, lambda x: py_value(x, element, True))
    return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))


def rounded(c, digits: int = 6) -> Column:
    """Round a double for comparison against another engine."""
    return F.round(_c(c).cast("double"), digits)


def _float_layout(s: Column) -> Column:
    """Python's layout of digits given as ``[-]d.dddE[-]dd``."""
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    parts = F.split(F.ltrim(s, F.lit("-")), "E")

    def laid_out(v: Column) -> Column:
        digits, e = v["digits"], v["e"]
        nd = F.length(digits)
        # plain layout for -4 <= e < 16
        int_part = F.when(nd > e + 1, F.substr(digits, F.lit(1), e + 1)).otherwise(F.rpad(digits, e + 1, F.lit("0")))
        frac_part = F.when(nd > e + 1, F.substr(digits, e + 2, nd)).otherwise(F.lit("0"))
        pos = F.concat(int_part, F.lit("."), frac_part)
        neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
        # scientific layout otherwise: 1e+16, 1.5e-07, 2.5e-300
        mant = F.concat(F.substr(digits, F.lit(1), F.lit(1)),
                        F.when(nd > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2), nd))).otherwise(F.lit("")))
        ae = F.abs(e).cast("string")
        sci = F.concat(mant, F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                       F.when(F.length(ae) < 2, F.concat(F.lit("0"), ae)).otherwise(ae))
        return F.when((e >= 0) & (e < 16), pos).when((e >= -4) & (e < 0), neg).otherwise(sci)

    def split_up(p: Column) -> Column:
        digits = F.rtrim(F.replace(p[0], F.lit(".")), F.lit("0"))
        return F.struct(F.when(digits == "", F.lit("0")).otherwise(digits).alias("digits"), p[1].cast("int").alias("e"))

    return F.concat(sign, _let(_let(parts, split_up), laid_out))


def py_float_str(c) -> Column:
    """Render a double the way Python's ``str`` does (shortest round-trip digits).

    Fifteen significant digits always suffice when at most fifteen are needed,
    else 16 or 17 are; the first that reads back as the same double is taken
    and its trailing zeros dropped. Only subnormal numbers, which have fewer
    digits, try the short forms as well. Where two 16-digit forms read back as
    the same double, Java's rounding decides, so the last digit may be one off
    Python's (about one random double in a thousand). Layout: Python's, plain for
    1e-4 <= |x| < 1e16 (``12345678.0``, ``0.0005``), else ``1e+16`` /
    ``1.5e-07``; ``nan``, ``inf``, ``-inf``. Built-in functions only.
    """
    x = _c(c).cast("double")

    def shortest(counts) -> Column:
        out = None
        for p in reversed(counts):
            cand = F.call_function("format_number", x, F.lit("0" + ("." + "0" * (p - 1) if p > 1 else "") + "E0"))
            out = cand if out is None else F.when(cand.try_cast("double") == x, cand).otherwise(out)
        return out

    digits = F.when(F.abs(x) >= 2.2250738585072014e-308, shortest((15, 16, 17))).when(
        x == 0, F.when(x.cast("string").startswith("-"), F.lit("-0E0")).otherwise(F.lit("0E0"))).otherwise(shortest(range(1, 18)))
    whole = (F.abs(x) < 1e15) & (x == F.floor(x)) & (x != 0)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(float("inf")), F.lit("inf"))
            .when(x == F.lit(float("-inf")), F.lit("-inf"))
            .when(whole, F.concat(x.cast("long").cast("string"), F.lit(".0")))
            .otherwise(_let(digits, _float_layout)))
