"""Statistical functions as columns, and the same as SQL text."""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def _series(df: int) -> list[float]:
    c, out = 1.0, []
    for k in range(df // 2):
        out.append(c)
        c *= (2 * k + 1) / (2 * k + 2)
    return out


def t_two_sided(t: Column, df: int | Column) -> Column:
    """Two-sided p of Student's t with a whole number of degrees of freedom (a column or a number), by the closed series in cos^2; 1 below one degree."""
    n = F.lit(df) if isinstance(df, int) else df
    odd = (n % 2).cast("double")
    c2 = n / (n + t * t)
    steps = F.when(odd == 1, (n - 3) / 2).otherwise(n / 2 - 1).cast("int")
    ks = F.when(steps >= 1, F.sequence(F.lit(1), F.greatest(F.lit(1), steps))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(s: Column, k: Column) -> Column:
        term = s["term"] * c2 * (2 * k - 1 + odd) / (2 * k + odd)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    total = F.aggregate(ks, start, add, lambda s: s["total"])
    sine = F.sqrt(F.greatest(F.lit(0.0), 1 - c2))
    angle = F.atan(F.abs(t) / F.sqrt(n))
    tail = F.exp(log_t_two_sided(t, n))
    inside = F.when(odd == 0, sine * total).when(n == 1, 2 / pi * angle).otherwise(2 / pi * (angle + sine * F.sqrt(c2) * total))
    return F.when(n < 1, 1.0).when(c2 < 0.5, tail).otherwise(F.greatest(F.lit(0.0), 1 - inside))


def log_t_two_sided(t: Column, df: Column) -> Column:
    """ln of the two-sided p of Student's t, for t * t above df: the power series of the incomplete beta function in df / (df + t * t), which holds in any tail."""
    x, a = df / (df + t * t), df / 2.0
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(s: Column, k: Column) -> Column:
        term = s["term"] * x * (a + k - 0.5) / (a + k)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, add, lambda s: s["total"])
    log_beta = log_factorial(a - 1) + log(pi) / 2 - log_factorial(a - 0.5)
    return a * F.log(x) + F.log1p(-x) / 2 - F.log(a) - log_beta + F.log(total)


def t_two_sided_sql(t: str, df: int) -> str:
    c2, total = f"({df} / ({df} + ({t}) * ({t})))", "0.0"
    for c in reversed(_series(df)):
        total = f"({c!r} + {c2} * {total})"
    return f"greatest(0.0, 1 - sqrt(1 - {c2}) * {total})"


def correlation_p(r: Column, df: int | Column) -> Column:
    """Two-sided p of a correlation, clipped at 0.9999, with df degrees of freedom; 1 where it is null or df is below 1."""
    clipped = F.greatest(F.lit(-0.9999), F.least(F.lit(0.9999), r))
    return F.coalesce(t_two_sided(clipped * F.sqrt(df / (1 - clipped * clipped)), df), F.lit(1.0))


def correlation_p_sql(r: str, df: int) -> str:
    clipped = f"greatest(-0.9999, least(0.9999, {r}))"
    return f"coalesce({t_two_sided_sql(f'{clipped} * sqrt({df} / (1 - {clipped} * {clipped}))', df)}, 1.0)"


#: Lanczos' coefficients for g = 7 (fixed values).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def log_factorial(n: Column) -> Column:
    """ln n!, by Lanczos' series, to about 14 digits."""
    x = n.cast("double")
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + c / (x + k)
    return 0.9189385332046727 + (x + 0.5) * F.log(x + 7.5) - (x + 7.5) + F.log(total)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric_tail(q: Column, m: Column, n: Column, k: Column) -> Column:
    """P(X >= q) for k draws from m good and n others; 1 where q or m is below 1."""
    high = F.least(m, k)
    low = F.greatest(q, k - n)
    terms = F.transform(F.sequence(low, high), lambda i: F.exp(log_choose(m, i) + log_choose(n, k - i) - log_choose(m + n, k)))
    return F.when((q < 1) | (m < 1), 1.0).when(low > high, 0.0).otherwise(F.least(F.lit(1.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def hypergeometric_tail_sql(q: str, m: str, n: str, k: str) -> str:
    choose = lambda a, b: f"(lgamma({a} + 1) - lgamma({b} + 1) - lgamma({a} - {b} + 1))"
    term = f"exp({choose(f'CAST({m} AS DOUBLE)', 'i')} + {choose(f'CAST({n} AS DOUBLE)', f'({k} - i)')} - {choose(f'CAST({m} + {n} AS DOUBLE)', k)})"
    return f"CASE WHEN {q} < 1 OR {m} < 1 THEN 1.0 WHEN greatest({q}, {k} - {n}) > least({m}, {k}) THEN 0.0 ELSE least(1.0, list_sum(list_transform(range(greatest({q}, {k} - {n}), least({m}, {k}) + 1), lambda i: {term}))) END"


def fisher_two_sided(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided Fisher test of a 2 x 2 table: the sum of all tables of its margins that are no likelier."""
    m, n, k = a + c, b + d, a + b
    p = lambda i: F.exp(log_choose(m, i) + log_choose(n, k - i) - log_choose(m + n, k))
    terms = F.transform(F.sequence(F.greatest(F.lit(0).cast("long"), k - n), F.least(m, k)), p)
    return F.least(F.lit(1.0), F.aggregate(F.filter(terms, lambda x: x <= p(a) * (1 + 1e-7)), F.lit(0.0), lambda s, x: s + x))


def fisher_two_sided_sql(a: str, b: str, c: str, d: str) -> str:
    m, n, k = f"({a} + {c})", f"({b} + {d})", f"({a} + {b})"
    choose = lambda x, y: f"(lgamma(CAST({x} AS DOUBLE) + 1) - lgamma({y} + 1) - lgamma({x} - {y} + 1))"
    p = lambda i: f"exp({choose(m, i)} + {choose(n, f'({k} - {i})')} - {choose(f'({m} + {n})', k)})"
    return f"least(1.0, list_sum(list_filter(list_transform(range(greatest(0, {k} - {n}), least({m}, {k}) + 1), lambda i: {p('i')}), lambda x: x <= {p(a)} * (1 + 1e-7))))"


def fisher_z(r1: Column, n1: Column, r2: Column, n2: Column) -> Column:
    """z of the difference of two correlations, each clipped at 0.9999."""
    clip = lambda r: F.greatest(F.lit(-0.9999), F.least(F.lit(0.9999), r))
    spare = lambda n: 1.0 / F.greatest(F.lit(1), n - 3)
    return (F.atanh(clip(r1)) - F.atanh(clip(r2))) / F.sqrt(spare(n1) + spare(n2))


def minus_log10(p: Column, cap: float | None = None) -> Column:
    out = -F.log10(F.greatest(p, F.lit(1e-300)))
    return out if cap is None else F.least(out, F.lit(cap))


def stars(p: Column) -> Column:
    return F.when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
