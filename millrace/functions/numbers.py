"""Hashes and numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import as_col, blank_to_null, text_key


def qa_hash(question: Column | str, answer: Column | str) -> Column:
    none = F.lit("")
    return F.sha2(F.concat(F.coalesce(text_key(question), none), F.lit("\n---\n"), F.coalesce(text_key(answer), none)), 256)


def q_hash(question: Column | str) -> Column:
    return F.sha2(F.coalesce(text_key(question), F.lit("")), 256)


def joined_key(*parts: Column) -> Column:
    """The parts joined by |, null as the empty string."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def sha1_mod(x: Column, m: int) -> Column:
    """The 160-bit SHA-1 of x, taken as a number, modulo m (below 2^20), digit by digit in base 2^32."""
    h = F.sha1(x)
    acc = F.lit(0).cast("long")
    for k in range(5):
        chunk = F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long")
        acc = F.pmod(acc * (2**32 % m) + chunk, F.lit(m))
    return acc


def lerp_int(low: int, high: int, alpha: Column) -> Column:
    """Between low and high at alpha, clamped to 0..1, rounded half to even."""
    return F.bround(F.lit(float(low)) + F.lit(float(high - low)) * F.least(F.greatest(alpha, F.lit(0.0)), F.lit(1.0)), 0).cast("int")


def to_bool(x: Column | str) -> Column:
    """true for 1, true, yes, y; false for 0, false, no, n; else null."""
    t = F.lower(blank_to_null(x))
    return F.when(t.isin("1", "true", "yes", "y"), True).when(t.isin("0", "false", "no", "n"), False)


def to_float(x: Column | str) -> Column:
    return F.expr("null").cast("double") if x is None else blank_to_null(x).try_cast("double")


def tier_of(p10: Column | str) -> Column:
    """A from 0.82, B from 0.78, else C; null stays null. NaN is C: Spark puts it above all numbers, so it is told apart first."""
    p = as_col(p10)
    return F.when(p.isNull(), F.lit(None).cast("string")).when(F.isnan(p), "C").when(p >= 0.82, "A").when(p >= 0.78, "B").otherwise("C")

