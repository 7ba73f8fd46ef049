"""Term normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate tokens, and the characters a term keeps.
SEPARATORS = r"\p{IsWhite_Space}\x1c-\x1f"
LETTERS = r"\p{L}"


def split_tokens(text: Column) -> Column:
    """Array of the whitespace-separated tokens of a text, none of them empty."""
    return F.array_remove(F.split(text, f"[{SEPARATORS}]+"), "")


def normalize_term(token: Column) -> Column:
    """Lower-case first, then drop whatever is not a letter."""
    return F.regexp_replace(F.lower(token), f"[^{LETTERS}]", "")


def term_array(text: Column) -> Column:
    """Array of the non-empty normalised terms of a text, in order.

    Lower-casing and stripping never look across whitespace, so normalising the whole
    text with one regex pass and splitting it afterwards gives the same terms as
    normalising token by token, at about half the cost.
    """
    letters_and_gaps = F.regexp_replace(F.lower(text), f"[^{LETTERS}{SEPARATORS}]+", "")
    return split_tokens(letters_and_gaps)
