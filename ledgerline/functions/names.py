"""Normal forms of names: marks folded to plain letters, joining words and generic words left out."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that join, and words that say only what kind of building it is
FILLER = ("a", "and", "at", "by", "in", "of", "on", "the")
GENERIC = ("apartment", "apartments", "bldg", "building", "by", "residence", "residences", "the", "tower", "towers")


def _folds() -> tuple[str, str, dict[str, str]]:
    """What Latin letters become under compatibility decomposition without marks: one for one, and the few that become more."""
    one, plain, more = [], [], {}
    for c in map(chr, [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]):
        to = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii())
        if len(to) == 1:
            one.append(c)
            plain.append(to)
        elif len(to) > 1:
            more[c] = to
    return "".join(one), "".join(plain), more


_ONE, _PLAIN, _MORE = _folds()


def folded(x: Column) -> Column:
    """The text in ASCII: letters lose their marks, ligatures and wide forms are written out, what has no plain form goes.

    Most names hold no letter that becomes several, so those are looked for once before they are replaced one by one."""
    several = x
    for c, to in _MORE.items():
        several = F.replace(several, F.lit(c), F.lit(to))
    x = F.when(x.rlike(f"[{''.join(_MORE)}]"), several).otherwise(x)
    return F.regexp_replace(F.translate(x, _ONE, _PLAIN), r"[^\x00-\x7F]+", "")


def name_key(x: Column) -> Column:
    """Folded, lower case, letters and digits only: what a slug or a file is looked up by."""
    return F.regexp_replace(F.lower(folded(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "")


def underscored(x: Column) -> Column:
    """Folded, lower case, runs of anything else as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(folded(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def without(x: Column, drop: tuple[str, ...]) -> Column:
    """The words of a text (runs of ASCII letters and digits) that are not in the list, in lower case compared, joined by spaces."""
    words = F.split(F.regexp_replace(F.coalesce(x, F.lit("")), "[^A-Za-z0-9]+", " "), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~F.lower(w).isin(*drop)), " ")


def without_filler(x: Column) -> Column:
    return without(x, FILLER)


def stem(x: Column) -> Column:
    """The name without generic words, as a key; empty if it has no others."""
    return name_key(without(folded(F.coalesce(x, F.lit(""))), GENERIC))
