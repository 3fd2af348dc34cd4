"""Column expressions shared by the operators. All are built-in Spark functions (JVM side, codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime of the linear hash family h(x) = ((a*x + b) % p) % N + 1.
MERSENNE_31 = 2**31 - 1


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI division raises on 0)."""
    return F.try_divide(col_or(num), col_or(den))


def round6(c) -> Column:
    """Round a double to 6 places; the unit of comparison with the SQL twins."""
    return F.round(col_or(c).cast("double"), 6)


def md5_hex_int(text, hex_digits: int = 8) -> Column:
    """First ``hex_digits`` hex digits of md5(text) as a non-negative BIGINT (portable to SQL)."""
    return F.conv(F.substring(F.md5(col_or(text).cast("string")), 1, hex_digits), 16, 10).cast("bigint")


def md5_uniform(text, hex_digits: int = 8) -> Column:
    """A uniform in (0, 1) from md5: (int(first digits) + 0.5) / 16**digits."""
    return (md5_hex_int(text, hex_digits).cast("double") + F.lit(0.5)) / F.lit(float(16**hex_digits))


def seeded_key(*parts) -> Column:
    """``'p1:p2:...'`` string used as a hash input; ints print the same in Spark and SQL."""
    return F.concat_ws(":", *[(F.lit(str(p)) if not isinstance(p, Column) else p.cast("string")) for p in parts])


def normal_from_key(key: Column) -> Column:
    """Standard normal by Box-Muller from two md5 uniforms of ``key`` (reproducible under any partitioning)."""
    u1 = md5_uniform(F.concat(key, F.lit(":u")))
    u2 = md5_uniform(F.concat(key, F.lit(":v")))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def utc_date_string(c: str, dtype) -> Column:
    """'yyyy-MM-dd' of a timestamp column, independent of the session time zone.

    A wall-clock timestamp (TIMESTAMP_NTZ, from parquet written without UTC adjustment) is formatted
    as stored; an instant (TIMESTAMP) is first moved so that its UTC wall clock is formatted.
    """
    from pyspark.sql.types import TimestampNTZType

    if isinstance(dtype, TimestampNTZType):
        return F.date_format(F.col(c), "yyyy-MM-dd")
    return F.date_format(F.to_utc_timestamp(F.col(c), F.current_timezone()), "yyyy-MM-dd")


def text_clean(text) -> Column:
    """Line breaks and tabs to spaces, then every ``"- "`` deleted (joins hyphenated line breaks)."""
    return F.replace(F.translate(col_or(text), "\n\t\r", "   "), F.lit("- "), F.lit(""))


def char_shingles(text, k: int) -> Column:
    """All length-k substrings of ``text`` (with repeats), by a zero-width lookahead: linear in the length."""
    return F.regexp_extract_all(col_or(text), F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def distinct_shingle_count(text, k: int) -> Column:
    return F.size(F.array_distinct(char_shingles(text, k)))


def digit_shingles(digits, k: int) -> Column:
    """Sorted distinct k-digit shingles of a digit string, as BIGINTs (k <= 18)."""
    if k <= 0 or k > 18:
        raise ValueError("k must be in 1..18 for BIGINT shingles")
    return F.array_sort(F.array_distinct(F.transform(char_shingles(digits, k), lambda s: s.cast("bigint"))))


def linear_hash(x, a: int, b: int, p: int = MERSENNE_31, n: int | None = None) -> Column:
    """((a*x + b) % p) % n + 1 in BIGINT; a, b and x are reduced mod p first so nothing overflows (p < 2**31)."""
    if p >= 2**31:
        raise ValueError("use decimal_linear_hash for p >= 2**31")
    xs = F.pmod(col_or(x).cast("bigint"), F.lit(p))
    h = F.pmod(F.lit(a % p) * xs + F.lit(b % p), F.lit(p))
    if n is not None and n < p:
        h = F.pmod(h, F.lit(n))
    return h + F.lit(1)


def decimal_linear_hash(x, a: int, b: int, p: int, n) -> Column:
    """((a + x*b) % p) % n + 1 in DECIMAL(38,0) for primes beyond BIGINT products; ``n`` may be a column."""
    dec = "decimal(38,0)"
    v = F.pmod(F.lit(a).cast(dec) + col_or(x).cast(dec) * F.lit(b).cast(dec), F.lit(p).cast(dec))
    return (F.pmod(v, col_or(n).cast(dec)) + F.lit(1)).cast("bigint")


def dot_arrays(u, v) -> Column:
    """Dot product of two numeric arrays as DOUBLE."""
    prod = F.zip_with(col_or(u), col_or(v), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def norm_array(u) -> Column:
    return F.sqrt(dot_arrays(u, u))
