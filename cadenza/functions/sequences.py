"""Column functions on ordered arrays; all stay inside generated code."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.functions.lookups import ACCEPTED, ELEMENTS, PUNCTUATION, SUBSTITUTES


def count_ones(match: Column) -> Column:
    """Matches of a 0/1 array; 0 for null and empty arrays."""
    return F.coalesce(F.aggregate(match, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))), F.lit(0))


def count_false(errors: Column) -> Column:
    """False entries of a boolean array; 0 for null and empty arrays."""
    return F.coalesce(F.size(F.filter(errors, lambda e: ~e)), F.lit(0))


def common_length(*arrays: Column) -> Column:
    """The length of the shortest array."""
    return F.least(*[F.size(a) for a in arrays])


def agree(match: Column, errors: Column) -> Column:
    """Does every match contradict its error flag? Compared up to the shorter array; true if that is empty."""
    n = common_length(match, errors)
    pairs = F.arrays_zip(F.slice(match, F.lit(1), n).alias("m"), F.slice(errors, F.lit(1), n).alias("e"))
    return F.forall(pairs, lambda p: (p["m"] == 1) != p["e"])


def vote(first: Column, second: Column, prior: Column) -> Column:
    """Errors by consensus: a word is right if the prior source has it, or two of the three do.

    Arrays must be of one length; elsewhere the result is null (for quarantine).
    """
    triples = F.arrays_zip(first.alias("a"), second.alias("b"), prior.alias("c"))
    errors = F.transform(triples, lambda t: ~((t["c"] == 1) | (t["a"] + t["b"] + t["c"] > 1)))
    return F.when((F.size(first) == F.size(second)) & (F.size(second) == F.size(prior)), errors)


def pad_errors(errors: Column, length: Column) -> Column:
    """errors filled up with true to length; null if it is longer."""
    fill = F.array_repeat(F.lit(True), F.greatest(length - F.size(errors), F.lit(0)))
    return F.when(F.size(errors) <= length, F.concat(errors, fill))


def match_or_distance(match: Column, distances: Column) -> Column:
    """match, or where it is null 1 for each distance of 0."""
    return F.coalesce(match, F.transform(distances, lambda d: (d == 0).cast("int")))


def argmax(values: Column) -> Column:
    """0-based place of the first largest entry."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def softmax_max(values: Column) -> Column:
    """The largest softmax probability."""
    top = F.array_max(values).cast("double")
    return 1 / F.aggregate(F.transform(values, lambda x: F.exp(x.cast("double") - top)), F.lit(0.0), lambda a, x: a + x)


def renest(flat: Column, sizes: Column) -> Column:
    """The flat array cut into arrays of the given sizes."""
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    return F.transform(F.arrays_zip(F.slice(starts, F.lit(1), F.size(sizes)).alias("s"), sizes.alias("n")), lambda p: F.slice(flat, p["s"] + 1, p["n"]))


def trim_trailing(nested: Column) -> Column:
    """Nested error flags up to the last false one; emptied arrays are dropped.

    Unchanged if the last array has one entry, if there is no false one, or if it is empty.
    """
    flat = F.flatten(nested)
    back = F.array_position(F.reverse(flat), False)
    kept = F.slice(flat, F.lit(1), (F.size(flat) - back + 1).cast("int"))
    sizes = F.transform(nested, lambda a: F.size(a))
    # slice past the end gives what is left
    cut = F.filter(renest(kept, F.when(back > 0, sizes)), lambda a: F.size(a) > 0)
    same = (F.size(nested) <= 0) | (F.size(F.try_element_at(nested, F.lit(-1))) == 1) | (back == 0)
    return F.when(same, nested).otherwise(F.filter(cut, lambda a: a.isNotNull()))


def head_tail(previous: Column, current: Column, following: Column, n: int) -> Column:
    """The last n entries of the array before, the array, the first n of the array after; null neighbours add nothing."""
    none = F.filter(current, lambda x: F.lit(False))
    tail = F.when(F.size(previous) > n, F.slice(previous, F.size(previous) - n + 1, F.lit(n))).otherwise(F.coalesce(previous, none))
    return F.concat(tail, current, F.coalesce(F.slice(following, 1, n), none))


def resample(values: Column, length: int) -> Column:
    """The array linearly interpolated at length evenly spaced places from its first to its last entry; null and empty arrays give an empty one."""

    @F.pandas_udf("array<double>")
    def interp(s: pd.Series) -> pd.Series:
        out = []
        for v in s:
            v = np.asarray([] if v is None else v, float)
            out.append(np.interp(np.linspace(0, len(v) - 1, length), np.arange(len(v)), v) if len(v) else v)
        return pd.Series(out, dtype=object)

    return interp(values)


def accepted(item: Column, form: Column) -> Column:
    """Is the form accepted for the item? False for an unknown item and for nulls."""
    table = F.create_map(*[x for k, forms in ACCEPTED.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in forms]))])
    return F.coalesce(F.array_contains(F.try_element_at(table, item), form), F.lit(False))


def phonetic_match(expected: Column, heard: Column) -> Column:
    """Does heard contain expected, up to the substitutes of each character? (A hit anywhere counts.)"""
    table = F.create_map(*[F.lit(x) for k, subs in SUBSTITUTES.items() for x in (k, "[" + k + "".join(subs) + "]")])
    quoted = lambda c: F.concat(F.lit("\\Q"), c, F.lit("\\E"))
    chars = F.filter(F.split(expected, ""), lambda c: c != "")
    return F.rlike(heard, F.array_join(F.transform(chars, lambda c: F.coalesce(F.try_element_at(table, c), quoted(c))), ""))


def longest_elements(text: Column) -> Column:
    """Phonetic elements of a string, longest match first; other characters are skipped."""
    return F.regexp_extract_all(text, F.lit("(" + "|".join(ELEMENTS) + ")"), 1)


def plain_phrase(text: Column) -> Column:
    """Lower case, without punctuation."""
    return F.regexp_replace(F.lower(text), PUNCTUATION, "")


def words_of(text: Column) -> Column:
    """Words between white space; no empty words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def parse_list(text: Column) -> Column:
    """An array from a literal list like ['a', "it's"]; null if it is none."""
    item = r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\""""
    whole = text.rlike(rf"^\s*\[\s*(?:(?:{item})\s*(?:,\s*(?:{item})\s*)*,?\s*)?\]\s*$")
    found = F.regexp_extract_all(text, F.lit(f"({item})"), 1)
    return F.when(whole, F.transform(found, lambda x: F.regexp_replace(x.substr(F.lit(2), F.length(x) - 2), r"\\(.)", "$1")))
