"""SQL text fragments for the DuckDB oracle that mirror ``functions.exact``."""

from __future__ import annotations


def HU(num: str, den: str, scale: int) -> str:
    """HALF_UP(num/den) at ``scale`` decimals as DOUBLE, NULL when den = 0."""
    p = 10 ** scale
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * ((2*abs({n})*{p} + {d}) // (2*{d})) AS DOUBLE) / {p}.0 END)")


def HUI(num: str, den: str) -> str:
    """HALF_UP(num/den) as BIGINT."""
    n = f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * ((2*abs({n}) + {d}) // (2*{d})) AS BIGINT) END)"


def RATIO(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE) END)"


def CENTS(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(14,2)) * 100 AS BIGINT)"


def STDDEV(n: str, s1: str, s2: str, unit: float = 1.0) -> str:
    num = f"(CAST({n} AS HUGEINT) * CAST({s2} AS HUGEINT) - CAST({s1} AS HUGEINT) * CAST({s1} AS HUGEINT))"
    den = f"(CAST({n} AS HUGEINT) * (CAST({n} AS HUGEINT) - 1))"
    return (f"(CASE WHEN {n} > 1 THEN sqrt(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)) / {float(unit)!r} END)")


def PCDS(k: str) -> str:
    """The generated postcode of key ``k``."""
    # the prefixes of London outcodes, then three others
    pre = ("['E', 'EC', 'N', 'NW', 'SE', 'SW', 'W', 'WC', 'BR', 'CR', 'DA', 'EN', 'HA', 'IG', 'KT', 'RM', 'SM', 'TW', 'UB', 'WD',"
           " 'M', 'B', 'LS']")
    return (f"({pre})[CAST({k} % 23 + 1 AS INTEGER)] || CAST({k} % 10 AS VARCHAR) || ' ' || CAST(({k} // 10) % 10 AS VARCHAR)"
            f" || substring('ABCDEFGHJKLMNPQRSTUWXYZ', CAST({k} % 23 + 1 AS INTEGER), 1)"
            f" || substring('ABDEFGHJLNPQRSTUWXYZ', CAST(({k} // 23) % 20 + 1 AS INTEGER), 1)")
