"""Text expressions that reproduce the cleaning rules of the flights feed."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightmart.schemas import NA_TOKENS


def na_to_null(c: Column, tokens=NA_TOKENS) -> Column:
    """Null out the reader's missing-value tokens (exact, case-sensitive match)."""
    return F.when(~c.isin(*tokens), c)


# Python's str.lstrip() removes every character for which str.isspace() is
# true; Spark's one-argument ltrim removes only spaces and Java's \s misses
# most of them. Build the set from that rule.
_PY_WHITESPACE = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


def py_lstrip(c: Column) -> Column:
    """``str.lstrip()`` with Python's definition of whitespace (a character-set trim, no regex)."""
    return F.ltrim(c, F.lit(_PY_WHITESPACE))


def part_before(c: Column, sep: str) -> Column:
    """``x.split(sep)[0]``: text before the first ``sep`` (whole text if absent).

    A search for the bytes of ``sep``: ``split_part`` compiles a regular expression for every row."""
    return F.substring_index(c, sep, 1)


def part_after_first(c: Column, sep: str) -> Column:
    """``x.split(sep)[1]``: text between the first and second ``sep`` (empty if absent)."""
    rest = F.substring(c, F.instr(F.concat(c, F.lit(sep)), sep) + F.lit(len(sep)), F.length(c))
    return F.substring_index(rest, sep, 1)


def first_word(c: Column) -> Column:
    """``x.split(' ')[0]``."""
    return part_before(c, " ")


def _prefixes(word: str, min_len: int = 1) -> list[str]:
    return [word[:n] for n in range(min_len, len(word) + 1)]


# Boolean input accepted by the warehouse's text loader: any unique prefix of
# true/false/yes/no, on/off (at least two letters), and 1/0; case-insensitive,
# surrounding blanks ignored.
_BOOL_TRUE = tuple(_prefixes("true") + _prefixes("yes") + ["on", "1"])
_BOOL_FALSE = tuple(_prefixes("false") + _prefixes("no") + _prefixes("off", 2) + ["0"])


# The words as files usually spell them: found without folding case, which costs more than all else in a flag.
_BOOL_USUAL = {form(w): w in _BOOL_TRUE for w in ("f", "false", "t", "true", "0", "1", "n", "no", "y", "yes")
               for form in (str.capitalize, str.lower, str.upper)}


def _bool_words() -> Column:
    return _word_map({w: True for w in _BOOL_TRUE} | {w: False for w in _BOOL_FALSE})


def _word_map(words: dict[str, bool]) -> Column:
    return F.create_map(*[x for w, v in words.items() for x in (F.lit(w), F.lit(v))])


def pg_bool_or_null(c: Column) -> Column:
    """Text to boolean as the warehouse loader parses it; NULL for unknown text.

    One lookup in a literal map keeps the generated code small (an IN list
    per outcome would be unrolled into the fused stage). Text that is no usual
    spelling is trimmed, folded and looked up again.
    """
    return F.coalesce(F.try_element_at(_word_map(_BOOL_USUAL), c),
                      F.try_element_at(_bool_words(), F.lower(F.trim(c))))

