"""Column expressions: text, labels, periods, guards, buckets and piecewise-linear lookups.  All are built-ins (code generation)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stand-in level for a missing category, stand-in period for "all periods", and what counts as white space.
MISSING, POOLED = "__missing__", "__all__"
BLANKS = " \t\n\r\f\x0b"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
#: Texts that a delimited file may hold for null.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def null_tokens_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def number(c: Column, kind: T.DataType | None = None) -> Column:
    """Lenient double: text that is no number, and NaN, become null.  A numeric kind saves the way through text."""
    x = c.cast("double") if isinstance(kind, T.NumericType | T.BooleanType) else c.cast("string").try_cast("double")
    return F.when(~F.isnan(x), x)


def canonical_category(c: Column) -> Column:
    """Trimmed lower-case text; null and blank become the missing level."""
    text = F.lower(_trim(F.coalesce(c.cast("string"), F.lit(""))))
    return F.when(text == "", F.lit(MISSING)).otherwise(text)


def yes_no(c: Column, strict: bool = False) -> Column:
    """Yes/No as 1/0 in any case; anything else is null, or an error."""
    text = F.lower(_trim(c.cast("string")))
    wrong = F.raise_error(F.concat(F.lit("target is neither Yes nor No: "), F.coalesce(text, F.lit("null")))).cast("int") if strict else F.lit(None).cast("int")
    return F.when(text == "yes", F.lit(1)).when(text == "no", F.lit(0)).otherwise(wrong)


def lenient_label(c: Column) -> Column:
    """Yes/Y/1 and No/N/0, also as other spellings of the numbers 1 and 0."""
    text = F.lower(_trim(c.cast("string")))
    value = text.try_cast("double")
    return F.when(text.isin("yes", "y") | (value == 1), F.lit(1)).when(text.isin("no", "n") | (value == 0), F.lit(0))


def parse_period(c: Column) -> Column:
    """``YY-MMM`` as year * 12 + month - 1 with years from 2000; null for anything else."""
    at = F.instr(F.lit(MONTHS), F.lower(F.substring(c, 4, 3)))
    valid = c.rlike("^[0-9]{2}-[A-Za-z]{3}$") & (at > 0) & (at % 3 == 1)
    return F.when(valid, (2000 + F.substring(c, 1, 2).try_cast("int")) * 12 + ((at - 1) / 3).cast("int"))


def period_of(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts) - 1


def period_label(ts: Column) -> Column:
    return F.date_format(ts, "yy-MMM")


def block_label(labels: Column) -> Column:
    """``first`` or ``first–last`` of an array of period labels."""
    first, last = F.element_at(labels, 1), F.element_at(labels, -1)
    return F.when(F.size(labels) == 1, first).otherwise(F.concat(first, F.lit("–"), last))


def finite_or_zero(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(0.0)).otherwise(c)


def novelty(current: Column, history: Column) -> Column:
    return current / (history + F.lit(0.01))


def contains_text(c: Column, needle: str) -> Column:
    """Case-insensitive, literal."""
    return F.contains(F.lower(c), F.lit(needle.lower()))


def title_case(c: Column) -> Column:
    return F.initcap(F.replace(F.lower(c), F.lit("_"), F.lit(" ")))


def right_closed_bucket(value: Column, edges: Column) -> Column:
    """How many inner edges lie below the value: buckets (e1, e2]."""
    return F.size(F.filter(edges, lambda e: e < value))


def histogram_bin(value: Column, edges: Column) -> Column:
    """Bins [e, next) from 0; the last one is closed; null outside."""
    n = F.size(edges) - 1
    at = F.size(F.filter(edges, lambda e: e <= value))
    return F.when((value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1)), F.least(at, n) - 1)


def shares(counts: Column) -> Column:
    """Counts of an array as shares; zeros if all are zero."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def bin_centres(edges: Column) -> Column:
    n = F.size(edges)
    return F.zip_with(F.slice(edges, 1, n - 1), F.slice(edges, 2, n - 1), lambda a, b: (a + b) / 2)


def linspace(low: Column, high: Column, points: int) -> Column:
    step = (high - low) / (points - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.when(i == points - 1, high).otherwise(low + i * step))


def place(value: Column, knots: Column, result: Callable[[Column], Column] = lambda at: at) -> Column:
    """How many of the ascending knots are at most the value (none for null), by steps of halved length; result makes a column of it."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(31))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(knots, at + step - 1) <= value, at + step).otherwise(at), result)


def interpolate(value: Column, knots: Column, heights: Column) -> Column:
    """Piecewise linear through (knot, height), constant outside; null stays null."""
    n = F.size(knots)

    def height(at: Column) -> Column:
        low, high = F.element_at(knots, F.greatest(at, F.lit(1))), F.element_at(knots, F.least(at + 1, n))
        a, b = F.element_at(heights, F.greatest(at, F.lit(1))), F.element_at(heights, F.least(at + 1, n))
        between = a + (b - a) * F.try_divide(value - low, high - low)
        return F.when(at == 0, F.element_at(heights, 1)).when(at == n, F.element_at(heights, -1)).otherwise(between)

    return F.when(value.isNotNull(), place(value, knots, height))


def lookup(mapping: dict, key: Column, default: Column) -> Column:
    """A frozen mapping as a literal; it is as large as the plan that holds it."""
    if not mapping:
        return default
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), default)


def mebibytes(n: Column) -> Column:
    return F.round(n / (1024 * 1024), 1)


def array_of(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
