"""Keys, names and text as Column functions.  Casts never raise: what can't be read is null."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def number_key(x: Column) -> Column:
    """Text to a whole number: trimmed, read as a double, rounded half to even."""
    return F.rint(F.trim(x).try_cast("double")).try_cast("bigint")


def parcel_key(x: Column) -> Column:
    """The spellings of a parcel as one number: 6830847, 6830847.00, 683-847 and 683.847 (community and plot), 921-11059 (a plot
    of five digits: 92111059).  Zero, community 0 and sub-parcels (4238153.2) are null."""
    t = F.trim(x.cast("string"))
    community, plot = (F.regexp_extract(t, r"^([0-9]+)[-.]([0-9]+)$", i).try_cast("bigint") for i in (1, 2))
    parts = (t.rlike(r"^[0-9]{1,4}[-.][0-9]{1,4}$") | t.rlike(r"^[0-9]{1,3}[-.][0-9]{5}$")) & (community > 0)
    whole = F.when(t.rlike(r"^[0-9]+(\.0*)?$"), F.regexp_extract(t, "^([0-9]+)", 1).try_cast("bigint"))
    return F.nullif(F.coalesce(whole, F.when(parts, community * F.when(plot >= 10000, 100000).otherwise(10000) + plot)), F.lit(0))


def community_of(key: Column) -> Column:
    """The community of a parcel key: three digits, before four of the plot or, in keys of eight digits, five."""
    return F.when(key >= 10_000_000, F.floor(key / 100_000)).otherwise(F.floor(key / 10_000)).cast("bigint")


def parent_parcel_key(x: Column) -> Column:
    """parcel_key, and the parent of a sub-parcel."""
    parent = F.regexp_extract(F.trim(x.cast("string")), r"^([0-9]{5,})\.[0-9]+$", 1).try_cast("bigint")
    return F.nullif(F.coalesce(parcel_key(x), parent), F.lit(0))


def name_norm(x: Column) -> Column:
    """Upper case, runs of other than letters and digits to one space, null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.upper(x), "[^A-Z0-9]+", " ")), F.lit(""))


def digit_runs(x: Column) -> Column:
    return F.array_join(F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1)), " ")


def canonical_text(x: Column) -> Column:
    """One spelling for values that two formats write differently: T or space in times, .000Z, midnight, trailing zeros."""
    t = F.trim(x)
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2})T", "$1 ")
    t = F.regexp_replace(t, r"(\.0+)?Z$", "")
    t = F.regexp_replace(t, r"^(\d{4}-\d{2}-\d{2}) 00:00:00(\.0+)?$", "$1")
    t = F.regexp_replace(t, r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1")
    t = F.regexp_replace(t, r"^(-?\d+)\.0+$", "$1")
    t = F.regexp_replace(t, r"^(-?\d+\.\d*[1-9])0+$", "$1")
    return F.when(t.rlike(r"^-?0(\.0*)?E[+-]?\d+$"), F.lit("0")).otherwise(t)


def iso_week(d: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def vowel_share(x: Column) -> Column:
    """Vowels among the letters; 0 without letters."""
    letters = F.length(F.regexp_replace(x, "[^A-Za-z]", ""))
    return F.coalesce(F.length(F.regexp_replace(x, "[^AEIOUaeiou]", "")) / F.nullif(letters, F.lit(0)), F.when(x.isNotNull(), 0.0))


#: fixed values: real words that look like filler, being months, units and a tender's state
REAL_WORDS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "SEPT", "OCT", "NOV", "DEC", "MIGD", "MIG", "CLOSED")


def is_long_fill(x: Column) -> Column:
    """A long run of capitals and digits with hardly a vowel: filler, not a value."""
    return F.coalesce((F.length(x) >= 12) & x.rlike("^[A-Z0-9]+$") & (F.length(F.regexp_replace(x, "[^A-Z]", "")) >= 4) & (vowel_share(x) < 0.34), F.lit(False))


def is_word_fake(x: Column) -> Column:
    return F.coalesce(x.rlike("^[A-Z]{3,8}$") & (vowel_share(x) < 0.34) & ~x.isin(*REAL_WORDS), F.lit(False))


def has_arabic(x: Column) -> Column:
    return F.coalesce(x.rlike("[\u0600-\u06ff]"), F.lit(False))


def squeezed(x: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def one_edit(a: Column, b: Column) -> Column:
    """One insertion, deletion or substitution apart."""
    return F.levenshtein(a, b) == 1


def has_word(text: Column, word: Column) -> Column:
    """Does a word or phrase stand in a text with no letter or digit beside it?"""
    return F.contains(F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), F.lit(" ")), F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(word), "[^a-z0-9]+", " ")), F.lit(" ")))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, one row a text, padded with -1; lengths)."""
    length = np.array([len(s) for s in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    out = np.full((len(texts), int(length.max(initial=0))), -1)
    out[np.arange(out.shape[1]) < length[:, None]] = flat
    return out, length


def jaro_winkler_scores(left: list[str], right: list[str], prefix: float = 0.1) -> np.ndarray:
    """Jaro-Winkler of pairs, one character place of all pairs at a time."""
    (a, la), (b, lb) = _codes(left), _codes(right)
    n, at = len(la), np.arange(b.shape[1])
    reach = np.maximum(la, lb) // 2 - 1
    used, taken = np.zeros(b.shape, bool), np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        free = (b == a[:, i : i + 1]) & ~used & (np.abs(at - i) <= reach[:, None]) & (i < la)[:, None]
        row = np.flatnonzero(free.any(axis=1))
        used[row, free[row].argmax(axis=1)] = True
        taken[row, i] = True
    m = taken.sum(axis=1)
    width = int(m.max(initial=0))
    x, y = (np.take_along_axis(c, np.argsort(~f, axis=1, kind="stable"), axis=1)[:, :width] for c, f in ((a, taken), (b, used)))
    swaps = ((x != y) & (np.arange(width) < m[:, None])).sum(axis=1) // 2  # whole pairs
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / np.maximum(m, 1)) / 3, 0.0)
    jaro[(la == lb) & (np.array(left, object) == np.array(right, object))] = 1.0
    k = min(4, a.shape[1], b.shape[1])
    same = ((a[:, :k] == b[:, :k]) & (a[:, :k] >= 0)).cumprod(axis=1).sum(axis=1) if k else np.zeros(n)
    return np.where(jaro > 0.7, jaro + same * prefix * (1 - jaro), jaro)


def jaro_winkler(a: Column, b: Column, prefix: float = 0.1) -> Column:
    """Jaro-Winkler similarity (boost above 0.7), in Arrow batches: Spark has no such function."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        there = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        left, right = x[there].tolist(), y[there].tolist()
        scores = [jaro_winkler_scores(left[k : k + 4096], right[k : k + 4096], prefix) for k in range(0, len(left), 4096)]
        out[there] = np.concatenate(scores) if scores else 0.0
        return pd.Series(out).where(pd.Series(there), None)

    return run(a, b)


def wording(a: Column, b: Column) -> Column:
    """How alike two texts are worded: twice the characters in matching blocks, over all characters."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or t is None else difflib.SequenceMatcher(None, s, t).ratio() for s, t in zip(x, y)], dtype="float64")

    return run(a, b)
