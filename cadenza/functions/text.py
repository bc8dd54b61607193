"""Column functions on strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def folded(c: Column) -> Column:
    """The string without surrounding white space (any Unicode white space) and in lower case; null stays null."""
    return F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def nonblank(c: Column) -> Column:
    """Null where the string has nothing but white space."""
    return F.when(c.rlike(r"(?U)\S"), c)


def int_or_zero(c: Column) -> Column:
    """The whole part of a number in a string, 0 for anything else and for null."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def canonical_hash(columns: list[str]) -> Column:
    """SHA-256 of the columns as one JSON object with its keys in order; nulls are left out of it."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def endpoint(mode: Column, model: Column, params: dict[str, Column]) -> Column:
    """/<mode>, /<model> if it is not null, and the parameters, URL-encoded, as a query string; null parameters are left out."""
    pairs = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), F.url_encode(v))) for k, v in params.items()]
    query = F.array_join(F.array_compact(F.array(*pairs)), "&") if pairs else F.lit("")
    return F.concat(F.lit("/"), mode, F.coalesce(F.concat(F.lit("/"), model), F.lit("")), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
