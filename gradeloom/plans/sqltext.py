"""SQL fragments for the counterparts: the same semantics, written for DuckDB."""

from __future__ import annotations

from gradeloom.functions.text import ALL_BANDS, BANDS, LOWEST_BAND, WHITESPACE

WS = "'" + WHITESPACE + "'"
FENCE_HEAD = r"'^```[\p{L}\p{N}_]*\n?'"
FENCE_TAIL = r"'\n?```\s*$'"
LINES = r"'\r\n|[\n\x0B\x0C\r\x{85}\x{2028}\x{2029}\x1c-\x1e]'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def strip_fences(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace({strip(x)}, {FENCE_HEAD}, ''), {FENCE_TAIL}, '')")


def rounded(x: str, digits: int) -> str:
    """Rounding by exact binary value, ties to even."""
    s, k = f"1e{digits}", "134217729e0"
    p = f"({x})*{s}"
    f = f"floor({p})"
    hi = f"(({x})*{k} - (({x})*{k} - ({x})))"
    res = f"(({hi}*{s} - {p}) + (({x}) - {hi})*{s})"
    frac = f"({p} - {f})"
    return (
        f"(CASE WHEN {frac} > 5e-1 OR ({frac} = 5e-1 AND ({res} > 0 OR ({res} = 0 AND "
        f"CAST({f} AS BIGINT) % 2 <> 0))) THEN {f} + 1e0 ELSE {f} END / {s})"
    )


def band(x: str) -> str:
    whens = " ".join(f"WHEN {x} >= CAST({b} AS DOUBLE) THEN '{n}'" for n, b in BANDS)
    return f"CASE {whens} ELSE '{LOWEST_BAND}' END"


def band_counts(col: str = "band") -> str:
    return ", ".join(f"count(*) FILTER ({col} = '{b}') AS {b.lower()}" for b in ALL_BANDS)


def two_digits(x: str) -> str:
    return f"printf('%.2f', {x})"


def three_digits(x: str) -> str:
    return f"printf('%.3f', {x})"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
