"""Column expressions on texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Typographic characters and their plain spelling.
SMART = {"“": '"', "”": '"', "‘": "'", "’": "'", "–": "--", "—": "---", "…": "..."}


#: Ends of words of any script: neither a letter nor a digit nor an underscore beside them.
WORD_START, WORD_END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def words(text: Column) -> Column:
    """The words of a text, parted by white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def clean_quotes(text: Column) -> Column:
    """Typographic quotes, dashes and ellipses in plain spelling, zero-width characters removed."""
    plain = reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), SMART.items(), text)
    return F.translate(plain, "".join(map(chr, (0x200B, 0x200C, 0x200D, 0xFEFF))), "")


def clean_ascii(text: Column) -> Column:
    """Printable ASCII only, white space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\x20-\x7E\n]", ""), r"\s+", " "))


def safe_filename(name: Column, most: int = 50) -> Column:
    """A name without characters that file systems refuse, blanks collapsed, cut to ``most`` characters."""
    return F.rtrim(F.left(F.trim(F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', ""), r"\s+", " ")), F.lit(most)))


def safe_sheet(name: Column) -> Column:
    """A worksheet name: without ``[]:*?/\\``, at most 31 characters."""
    return F.left(F.translate(name, "[]:*?/\\", ""), F.lit(31))


def name_key(name: Column) -> Column:
    """A document name for comparison: no extension, one blank for underscores, hyphens and blanks, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"[_\-\s]+", " ")))


def parent_key(name: Column) -> Column:
    """A file name without extension and ``_fixed``, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"(?i)_fixed$", ""))


def document_key(name: Column) -> Column:
    """The document that a file or part belongs to: no extension, nothing from `` - `` on, no mark of a step, one blank for
    underscores, hyphens and blanks, lower case."""
    stem = F.split_part(F.regexp_replace(name, r"\.[^. ]*$", ""), F.lit(" - "), F.lit(1))
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(stem, r"(?i)(_fixed|_optimized|_backup)$", ""), r"[_\-\s]+", " ")))


def pairing_key(name: Column) -> Column:
    """A file name without extension, version marks and copies' marks at its end, in lower case."""
    return F.trim(F.regexp_replace(name_key(name), r"(\s+(v\d+|r\d+|\(\d+\)|final|draft|copy|latest))+$", ""))


def either_contains(a: Column, b: Column) -> Column:
    """Whether one non-empty text contains the other."""
    return (F.length(a) > 0) & (F.length(b) > 0) & (F.contains(a, b) | F.contains(b, a))


def first_category(text: Column, categories: Mapping[str, Sequence[str]], otherwise: str = "none") -> Column:
    """The first category one of whose keywords contains the text or is contained in it; an empty text has none."""
    low = F.lower(F.trim(text))
    out = F.lit(otherwise)
    for name, keywords in reversed(categories.items()):
        hit = reduce(lambda x, y: x | y, [F.contains(low, F.lit(k)) | F.contains(F.lit(k), low) for k in keywords])
        out = F.when(hit, F.lit(name)).otherwise(out)
    return F.when(F.length(low) > 0, out).otherwise(F.lit(otherwise))


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """How many of the keywords occur, each at most once, whatever the case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda x, y: x + y, [F.contains(low, F.lit(k.lower())).cast("int") for k in keywords])


def render_template(template: str, **values: Column) -> Column:
    """A template with every ``{name}`` replaced by a column."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), F.coalesce(kv[1], F.lit(""))), values.items(), F.lit(template))


def truncate_at_sentence(text: Column, most: int) -> Column:
    """A text cut to ``most`` characters: at the last end of a sentence in its latter half, else hard; then ``...``."""
    head = F.left(text, F.lit(most))
    end = F.length(F.regexp_extract(head, r"(?s)^(.*[.!?])(?:\s|$)", 1))
    cut = F.when(end > most // 2, F.left(head, end)).otherwise(F.rtrim(head))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit("...")))


def glob_pattern(glob: str) -> str:
    """A file-name glob as a regular expression."""
    quoted = "".join({"*": ".*", "?": "."}.get(c, c if c.isalnum() or c in "[]!-_ " else "\\" + c) for c in glob)
    return f"(?i)^{quoted.replace('[!', '[^')}$"
