"""Text and number functions shared by scoring, status and judging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as whitespace when text is stripped.
WHITESPACE_CODES = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODES))

# An opening code fence with an optional language word, and the closing fence.
OPENING_FENCE = r"\A```[\p{L}\p{N}_]*\n?"
FENCE = "```"

# Quality bands, lower bound inclusive, best first.
BANDS = (("EXCELLENT", 0.8), ("GOOD", 0.6), ("PARTIAL", 0.4))
LOWEST_BAND = "POOR"
ERROR_BAND = "ERROR"
ALL_BANDS = tuple(name for name, _ in BANDS) + (LOWEST_BAND, ERROR_BAND)
STRONG_SCORE = 0.8
WEAK_SCORE = 0.6

# Line starts that mark a bare function and the boilerplate before one.
FUNCTION_PREFIX = "func "
BOILERPLATE_PREFIXES = ("package ", "import ", "import(")
# Fixed value: every line boundary, the ASCII separators included.
LINE_BREAK = r"\R|[\x1c-\x1e]"


def py_strip(col: Column) -> Column:
    """Strip all Unicode whitespace from both ends (``trim`` alone removes only spaces)."""
    return F.btrim(col, F.lit(WHITESPACE))


def strip_fences(col: Column) -> Column:
    """Text without a surrounding code fence.

    The text is stripped first, so a closing fence can only be its last three characters.
    """
    body = F.regexp_replace(py_strip(col), OPENING_FENCE, "")
    closed = F.when(F.endswith(body, F.lit(FENCE)), F.left(body, F.length(body) - len(FENCE))).otherwise(body)
    return py_strip(closed)


def fixed_digits(col: Column, digits: int) -> Column:
    """Number printed with a fixed count of decimals, without grouping."""
    pattern = F.lit("0." + "0" * digits)
    return F.call_function("format_number", col.cast("double"), pattern)


def exact_round(col: Column, digits: int) -> Column:
    """Round a double by its exact binary value, ties to even.

    ``round``/``bround`` decide on the printed decimal, so 0.12345 (stored slightly above)
    would fall to 0.1234; number formatting decides on the stored value.
    """
    shown = fixed_digits(col, digits).try_cast("double")
    if digits < 3:
        return shown
    # The formatter misses one value per width: the smallest tie in exponent notation.
    tie = float(f"5e-{digits + 1}")
    return F.when(col == tie, F.lit(round(tie, digits))).otherwise(shown)


def band(score: Column) -> Column:
    """Quality band of an unrounded score."""
    name, bound = BANDS[0]
    chain = F.when(score >= bound, name)
    for name, bound in BANDS[1:]:
        chain = chain.when(score >= bound, name)
    return F.when(score.isNotNull(), chain.otherwise(LOWEST_BAND))


def stored_score(score: Column) -> Column:
    """The four-digit score kept in result rows; banding uses the score before this."""
    return exact_round(score, 4)


def basis_points(score: Column) -> Column:
    """A stored score as an integer count of 0.0001, so that sums are exact in any order."""
    return F.rint(score * 10000.0).cast("bigint")


def mean_of_points(points: Column, n: Column, digits: int) -> Column:
    """Rounded average of ``n`` scores whose basis points sum to ``points``; 0.0 when none."""
    return F.when(n > 0, exact_round(points / (n * 10000.0), digits)).otherwise(F.lit(0.0))


def length_ratio(generated: Column, expected: Column) -> Column:
    """Length of the answer over that of the reference, fences removed, two digits."""
    shown = F.length(strip_fences(generated)).cast("double")
    return exact_round(shown / F.greatest(F.length(strip_fences(expected)), F.lit(1)), 2)


def prompt_stats(col: Column) -> Column:
    """Characters, and tokens estimated at four characters each."""
    chars = F.length(col).cast("bigint")
    return F.struct(chars.alias("chars"), F.floor(chars / 4).cast("bigint").alias("est_tokens"))


def score_bar(score: Column, width: int = 30) -> Column:
    """``[███···] 0.50`` style bar."""
    filled = (score * width).cast("int")
    return F.concat(
        F.lit("["),
        F.repeat(F.lit("█"), filled),
        F.repeat(F.lit("·"), F.lit(width) - filled),
        F.lit("] "),
        two_digits(score),
    )


def two_digits(col: Column) -> Column:
    """Number printed with two decimals, rounded by its binary value."""
    return fixed_digits(col, 2)


def three_digits(col: Column) -> Column:
    return fixed_digits(col, 3)


def trend(delta: Column, dead_zone: float = 0.0) -> Column:
    """Arrow for a change; with a dead zone, small changes get ``→``."""
    moved = F.when(delta > 0, "▲").when(delta < 0, "▼").otherwise("─")
    if not dead_zone:
        return moved
    return F.when(F.abs(delta) < dead_zone, "→").otherwise(moved)


def format_flags(
    generated: Column,
    function_prefix: str = FUNCTION_PREFIX,
    boilerplate: tuple[str, ...] = BOILERPLATE_PREFIXES,
) -> Column:
    """Whether an answer opens with a function, and whether boilerplate precedes the first one.

    Lines are split only for texts that contain a boilerplate word at all.
    """
    return flags_of(strip_fences(generated), function_prefix, boilerplate)


def flags_of(
    text: Column, function_prefix: str = FUNCTION_PREFIX, boilerplate: tuple[str, ...] = BOILERPLATE_PREFIXES
) -> Column:
    """:func:`format_flags` of text whose fences are already removed."""

    def opens(line: Column, prefixes: tuple[str, ...]) -> Column:
        hit = F.lit(False)
        for prefix in prefixes:
            hit = hit | F.startswith(line, F.lit(prefix))
        return hit

    lines = F.transform(F.split(text, LINE_BREAK), py_strip)
    first = F.array_position(F.transform(lines, lambda ln: F.startswith(ln, F.lit(function_prefix))), True)
    before = F.when(first > 0, F.slice(lines, F.lit(1), (first - 1).cast("int"))).otherwise(lines)
    mentioned = F.lit(False)
    for prefix in boilerplate:
        mentioned = mentioned | F.contains(text, F.lit(prefix.rstrip()))
    return F.struct(
        F.startswith(text, F.lit(function_prefix)).alias("func_start"),
        F.when(mentioned, F.exists(before, lambda ln: opens(ln, boilerplate))).otherwise(False).alias("boilerplate"),
    )
