"""Column functions over array-typed vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_double(v: Column) -> Column:
    """Vectors are stored as float and computed as double."""
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
    )


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x
    )


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def divide(v: Column, by: Column) -> Column:
    """Each component divided by one number.

    The number enters as a repeated array: inside the lambda its expression
    would be computed again for every component.
    """
    return F.zip_with(v, F.array_repeat(by, F.size(v)), lambda x, y: x / y)


def unit(v: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    length = norm(v)
    return divide(v, F.when(length > 0, length).otherwise(F.lit(1.0)))


def round_vector(v: Column, digits: int = 6) -> Column:
    """Components rounded half-even.

    Rounding goes through decimals; zeros, most of a hashed vector, are spared that.  `x - x` is
    the positive zero of the vector's own type, as rounding gives it.
    """
    return F.transform(v, lambda x: F.when(x == 0, x - x).otherwise(F.bround(x, digits)))


def zero_vector(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)


def parse_vector(c: Column) -> Column:
    """JSON list text to a float vector; null if absent or malformed."""
    return F.from_json(c, "array<float>")


def parse_tokens(c: Column) -> Column:
    """JSON list text to an array of tokens; empty if absent, malformed or no list."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def to_json_text(c: Column) -> Column:
    """JSON text of an array or map column, in the order it has."""
    return F.to_json(c)


def to_sorted_json_text(c: Column) -> Column:
    """JSON text of a map column with its keys in ascending order."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(c))))
