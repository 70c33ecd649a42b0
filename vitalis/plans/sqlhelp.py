"""Small text helpers for the oracle SQL (DuckDB dialect)."""


def R(expr: str, digits: int) -> str:
    """PostgreSQL ``ROUND(x::numeric, n)`` returned as DOUBLE."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def CORR(x: str, y: str) -> str:
    """corr with PostgreSQL's NULL for zero variance / one point (DuckDB gives NaN)."""
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END"


def SECS(a: str, b: str) -> str:
    """EXTRACT(EPOCH FROM b - a) as DOUBLE seconds."""
    return f"(CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / 1000000.0)"
