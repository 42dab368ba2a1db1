"""Exact, order-free sums of DOUBLE columns.

A plain sum of doubles depends on the order in which rows are added, which
changes with partitioning, re-planning and retries. Here every double counts
with all its bits, and a sum is the double nearest to the exact total (ties
to even), whatever the order: what ``math.fsum`` returns.

A finite double is an integer of 53 bits times a power of two. Placed in a
window of 96 bits it is cut into four limbs of 24 bits, and limbs are added
as BIGINT: exact, in any order, up to 2^39 rows of a group. One window holds
every value below 2^28 that is a multiple of 2^-68, that is, amounts as they
occur; rows with a value outside it are grouped by the windows of their
values, which lie 24 bits apart so that limbs stay aligned. Windows meet in
the totals, of which there is one row a group.

As in SQL, NULL adds nothing and a sum of no value is NULL; NaN gives NaN,
an infinity gives itself, and infinities of both signs give NaN. A total
beyond the largest double is an infinity.

    parts = limbs(df, keys, {"fare": F.col("fare")}, {"trips": F.count("*")})
    totals(parts, keys)     # keys, trips, fare, fare_n (values that are not NULL)

Partial sums can be joined and totalled by other keys, for aggregation in two
steps.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a limb, of a window above its unit, and the common window's unit.
LIMB, BITS, UNIT = 24, 96, -68
#: Windows of finite doubles lie between these; marks of values that are not finite.
LEAST, MOST = -46, 43
PLUS, MINUS, NAN = 100, 101, 102
WINDOWS = "_windows"
_MASK = (1 << LIMB) - 1


def _power(n: Column) -> tuple[Column, Column]:
    """Two powers of two whose product is 2^n; each is in range."""
    half = F.floor(n / F.lit(2)).cast("int")
    return F.pow(F.lit(2.0), half), F.pow(F.lit(2.0), n - half)


def _window(x: Column) -> Column:
    """Window of a value: 0 for the common one and for NULL."""
    scaled = x * F.lit(2.0 ** -UNIT)
    common = (F.abs(x) < F.lit(2.0 ** (BITS + UNIT))) & (F.rint(scaled) == scaled)
    # One bit to spare on each side, so that log2 need not be exact.
    k = F.ceil((F.log2(F.abs(x)) + F.lit(2.0 - BITS - UNIT)) / F.lit(float(LIMB)))
    inf = F.lit(float("inf"))
    return (F.when(x.isNull() | common, F.lit(0)).when(F.isnan(x), F.lit(NAN)).when(x == inf, F.lit(PLUS))
            .when(x == -inf, F.lit(MINUS)).otherwise(k).cast("tinyint"))


def _halves(x: Column, k: Column) -> tuple[Column, Column]:
    """The value in units of its window, as two signed integers of 48 bits."""
    a, b = _power(F.lit(-UNIT) - F.lit(LIMB) * k.cast("int"))
    size = F.when(k == 0, F.abs(x) * F.lit(2.0 ** -UNIT)).when(k < PLUS, F.abs(x) * a * b)
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    high = F.floor(size / F.lit(2.0 ** (2 * LIMB)))
    low = (size - high.cast("double") * F.lit(2.0 ** (2 * LIMB))).cast("long")
    return high * sign, low * sign


def _names(name: str) -> list[str]:
    return [f"_{name}_{j}" for j in range(BITS // LIMB)]


def _sums_of(parts: DataFrame) -> list[str]:
    return [c[1:-2] for c in parts.columns if c.startswith("_") and c.endswith("_0")]


def limbs(df: DataFrame, keys: list[str], sums: dict[str, Column], others: dict[str, Column]) -> DataFrame:
    """Partial sums by ``keys`` and windows.

    ``sums``: values to add up by name. ``others``: further aggregates that
    add up again (counts, sums of integers).
    """
    names = list(sums)
    rows = df.withColumns({f"_x_{n}": c for n, c in sums.items()})
    rows = rows.withColumns({f"_k_{n}": _window(F.col(f"_x_{n}")) for n in names})
    halves = {n: _halves(F.col(f"_x_{n}"), F.col(f"_k_{n}")) for n in names}
    rows = rows.withColumns({f"_{h}_{n}": halves[n][i] for n in names for i, h in enumerate(("high", "low"))})
    plain = F.lit(True)
    for n in names:
        plain = plain & (F.col(f"_k_{n}") == 0)
    rows = rows.withColumn(WINDOWS, F.when(~plain, F.array(*[F.col(f"_k_{n}") for n in names])))

    def parts(n: str) -> list[Column]:
        out = [F.sum(f(F.col(f"_{h}_{n}"))) for h in ("low", "high")
               for f in (lambda c: c.bitwiseAND(F.lit(_MASK).cast("long")), lambda c: F.shiftright(c, LIMB))]
        return [c.alias(name) for c, name in zip(out, _names(n), strict=True)]

    return rows.groupBy(*keys, WINDOWS).agg(
        *[c.alias(n) for n, c in others.items()], *[F.count(f"_x_{n}").alias(f"{n}_n") for n in names],
        *[c for n in names for c in parts(n)])


def _digits(limbs_: Column) -> Column:
    """Limb sums by position as digits of LIMB bits; the last holds the sign."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        d = x + state["carry"]
        digit = d.bitwiseAND(F.lit(_MASK).cast("long"))
        return F.struct(F.shiftright(d, LIMB).alias("carry"), F.concat(state["out"], F.array(digit)).alias("out"))

    return F.aggregate(limbs_, start, step, lambda s: F.concat(s["out"], F.array(s["carry"])))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _nearest(parts: Column) -> Column:
    """The double nearest to the sum of limbs in windows: ``parts`` is an
    array of structs of a window k and the limbs v."""
    places = MOST - LEAST + 8
    zero = F.lit(0).cast("long")
    at = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda i: F.aggregate(
        parts, zero, lambda total, p: total + F.coalesce(F.get(p["v"], i - (p["k"].cast("int") - F.lit(LEAST))), zero)))

    def rounded(size: Column, negative: Column, top: Column) -> Column:
        wide = F.lit(Decimal(0)).cast("decimal(38,0)")
        for j in range(BITS // LIMB):
            digit = F.when(top - j >= 0, F.get(size, F.greatest(top - j, F.lit(0)))).otherwise(zero)
            wide = (wide + digit.cast("decimal(20,0)") * F.lit(Decimal(2 ** (BITS - LIMB - LIMB * j + 1)))).cast("decimal(38,0)")
        rest = F.exists(F.slice(size, 1, F.greatest(top - 3, F.lit(0))), lambda d: d != 0)
        # What lies below the leading 73 bits or more only decides ties.
        a, b = _power(F.lit(UNIT - 1) + F.lit(LIMB) * (top - F.lit(3 - LEAST)))
        value = (wide + F.when(rest, 1).otherwise(0)).cast("decimal(38,0)").cast("double") * a * b
        return F.when(negative, -value).otherwise(value)

    def sized(size: Column, negative: Column) -> Column:
        top = F.aggregate(F.sequence(F.lit(0), F.lit(places - 1)), F.lit(0),
                          lambda best, i: F.when(F.get(size, i) != 0, i).otherwise(best))
        return _let(top, lambda t: rounded(size, negative, t))

    def signed(at: Column, negative: Column) -> Column:
        size = _digits(F.when(negative, F.transform(at, lambda x: -x)).otherwise(at))
        return _let(size, lambda s: sized(s, negative))

    return _let(at, lambda x: _let(F.element_at(_digits(x), -1) < 0, lambda negative: signed(x, negative)))


def _plain(name: str) -> tuple[Column, Column]:
    """Sum ``name`` of a group whose values are all in the common window, and
    whether it is that and fits 38 digits."""
    limb = [F.col(c) for c in _names(name)]
    total = F.lit(Decimal(0)).cast("decimal(38,0)")
    for j, c in enumerate(limb):
        total = (total + c.cast("decimal(20,0)") * F.lit(Decimal(1 << (LIMB * j)))).cast("decimal(38,0)")
    usual = (F.size("_parts") == 0) & (F.abs(limb[-1]) < F.lit(1 << 50))
    return usual, total.cast("double") * F.lit(2.0 ** UNIT)


def _listed(name: str, i: int) -> Column:
    """Limb sums of ``name``, the ``i``-th sum, in every window that a group's values lie in."""
    def one(k: Column, v: list[Column]) -> Column:
        return F.struct(k.cast("int").alias("k"), F.array(*[F.coalesce(x, F.lit(0)) for x in v]).alias("v"))

    return F.concat(F.array(one(F.lit(0), [F.col(c) for c in _names(name)])), F.transform("_parts", lambda p: one(
        F.get(p[WINDOWS], F.lit(i)), [p[c] for c in _names(name)])))


def _unusual(parts: Column) -> Column:
    def has(mark: int) -> Column:
        return F.exists(parts, lambda p: p["k"] == mark)

    return (F.when(has(NAN) | has(PLUS) & has(MINUS), F.lit(float("nan"))).when(has(PLUS), F.lit(float("inf")))
            .when(has(MINUS), F.lit(float("-inf"))).otherwise(_nearest(parts)))


def totals(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, the other aggregates, and each sum with its count ``<name>_n``.

    ``keys`` may differ from those of the partial sums, whose other columns
    must then be dropped before. Only partial sums in other windows than the
    common one are listed, at most one for each set of windows.
    """
    names = _sums_of(parts)
    limb = [c for n in names for c in _names(n)]
    others = [c for c in parts.columns if c not in {*keys, WINDOWS, *limb}]
    common = F.col(WINDOWS).isNull()
    met = parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in others],
        *[F.coalesce(F.sum(F.when(common, F.col(c))), F.lit(0).cast("long")).alias(c) for c in limb],
        F.collect_list(F.when(~common, F.struct(WINDOWS, *limb))).alias("_parts"))
    plain = {n: _plain(n) for n in names}
    usual = F.lit(True)
    for known, _ in plain.values():
        usual = usual & known
    every = F.transform(F.array(*[_listed(n, i) for i, n in enumerate(names)]), _unusual)
    met = met.withColumn("_unusual", F.when(~usual, every))
    return met.select(*keys, *others, *[
        F.when(F.col(f"{n}_n") > 0, F.when(plain[n][0], plain[n][1]).otherwise(F.get("_unusual", F.lit(i)))).alias(n)
        for i, n in enumerate(names)])


def exact_sums(df: DataFrame, keys: list[str], sums: dict[str, Column], others: dict[str, Column]) -> DataFrame:
    """``totals`` of ``limbs``: keys, others, and each sum with its count."""
    return totals(limbs(df, keys, sums, others), keys)
