"""Column expressions for line and token text. All regexes run with Unicode classes on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set and the character class that mark a line as blank or corrupt.
SPACE = r"[\s\x1c-\x1f]"
BLANK_LINE = r"(?U)^[\s\x1c-\x1f]*\z"
CORRUPT_LEAD = r"(?U)^[^\w\s\p{P}]"
CORRUPT_ANY = r"(?U)[^\w\s\p{P}]"
LINE_BREAK = "\r\n|\r|\n"
# Not blank and not led by a corrupt character, in one match.
KEPT_LINE = r"(?U)^(?:[\w\p{P}]|\s[\s\x1c-\x1f]*[^\s\x1c-\x1f])"


def is_blank(line: Column) -> Column:
    """Only whitespace (also true for the empty string)."""
    return line.rlike(BLANK_LINE)


def is_corrupt(line: Column, scope: str = "lead") -> Column:
    """A character that is no word character, space or punctuation: first one, or anywhere."""
    if scope not in ("lead", "any"):
        raise ValueError(f"scope must be 'lead' or 'any', not {scope!r}")
    return line.rlike(CORRUPT_LEAD if scope == "lead" else CORRUPT_ANY)


def is_kept(line: Column, corrupt_scope: str | None = "lead") -> Column:
    """The line filter of corpus preparation; ``corrupt_scope=None`` drops blank lines only."""
    if corrupt_scope == "lead":
        return line.rlike(KEPT_LINE)
    keep = ~is_blank(line)
    return keep if corrupt_scope is None else keep & ~is_corrupt(line, corrupt_scope)


def strip(text: Column) -> Column:
    """Unicode strip. Only texts with a space at an end pay for the search."""
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(f"(?U){SPACE}"), F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+\z", "")).otherwise(text)


def rstrip(text: Column) -> Column:
    end = F.substring(text, -1, 1)
    return F.when(end.rlike(f"(?U){SPACE}"), F.regexp_replace(text, rf"(?U){SPACE}+\z", "")).otherwise(text)


def split_lines(text: Column) -> Column:
    """Lines under universal newlines; a final line break does not open another line."""
    unix = F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)
    body = F.when(F.endswith(unix, F.lit("\n")), F.substr(unix, F.lit(1), F.length(unix) - 1)).otherwise(unix)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def split_spaces(line: Column, keep_empty: bool = True) -> Column:
    """Strip, then split on each single space; runs of spaces give empty tokens unless dropped."""
    tokens = F.split(strip(line), " ", -1)
    return tokens if keep_empty else F.array_remove(tokens, "")


def split_whitespace(line: Column) -> Column:
    """Split on any run of whitespace, no empty tokens."""
    return F.array_remove(F.split(line, rf"(?U){SPACE}+", -1), "")


def characters(text: Column) -> Column:
    """Code points of the text as one-character strings."""
    return F.split(text, "", -1)


def mask_digits(text: Column, mark: str) -> Column:
    return F.regexp_replace(text, r"(?U)\d", mark)
