from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Letters that have case; a space starts a word for ``initcap`` already.
_CASED = r"[\p{IsUppercase}\p{IsLowercase}\p{Lt}]"
_UNCASED = r"[^A-Za-z \p{IsUppercase}\p{IsLowercase}\p{Lt}]"  # the usual letters first, which are compared fastest
_HIDDEN_START = rf"({_UNCASED})(?={_CASED})"
_HAS_HIDDEN_START = rf"{_UNCASED}(?={_CASED})"
_MARK = "\u0001 "


def strip(text: Column) -> Column:
    """Trim every kind of white space; Spark's ``trim`` removes spaces only. What then starts and ends with printing ASCII
    characters, as most texts do, is done: comparing the ends costs a fraction of looking them up among the white space."""
    spaceless = F.trim(text)
    last = F.substring(spaceless, -1, 1)
    bare = (spaceless >= "!") & (spaceless < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(bare, spaceless).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others: Murang'A.

    ``initcap`` starts a word at spaces only. Where a word starts after anything else, a marked space
    goes in front of it and is taken out again. That stays within generated code, which functions over
    arrays of words would not, and most names need no marks.
    """
    marked = F.regexp_replace(text, _HIDDEN_START, f"$1{_MARK}")
    unmarked = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(text.rlike(_HAS_HIDDEN_START), unmarked).otherwise(F.initcap(text))
