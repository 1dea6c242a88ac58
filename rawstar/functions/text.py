"""Text cleaning as Column expressions; everything stays inside whole-stage codegen."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' becomes NULL; anything else is kept as it is."""
    return F.nullif(_col(c), F.lit(""))


def clean(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return blank_to_null(F.trim(_col(c)))


def first_token(c: Column | str) -> Column:
    """Text before the first space: drops a trailing '<-- note'."""
    return F.split_part(_col(c), F.lit(" "), F.lit(1))


def or_unknown(c: Column | str, unknown: str = "UNKNOWN") -> Column:
    return F.coalesce(_col(c), F.lit(unknown))


def full_name(last: Column | str, first: Column | str) -> Column:
    """'last first', NULL as soon as one part is NULL (concat_ws would skip it instead)."""
    return F.concat(_col(last), F.lit(" "), _col(first))


def cell_value(c: Column | str) -> Column:
    """One CSV cell: empty is NULL, doubled quotes are dropped.

    Emptiness is judged on the cell as read, so a cell of just `""` is an empty string, not NULL.
    """
    raw = _col(c)
    return F.when(F.length(raw) > 0, F.replace(raw, F.lit('""'), F.lit("")))


def unenclosed(c: Column | str) -> Column:
    """Drop one pair of double quotes around the whole line."""
    line = _col(c)
    quoted = line.startswith('"') & line.endswith('"') & (F.length(line) > 1)
    return F.when(quoted, F.substring(line, F.lit(2), F.length(line) - 2)).otherwise(line)


def without_cr(c: Column | str) -> Column:
    """Drop the carriage return of a CRLF line end."""
    line = _col(c)
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


# --- casts ------------------------------------------------------------------------------------


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ].*)?$"


def _shaped(c: Column | str, shape: str, kind: str, strict: bool) -> Column:
    """A cast of text that looks like `kind`: the engine's own cast also takes '1d' or '2025'."""
    text = F.trim(_col(c))
    if not strict:
        return F.when(text.rlike(shape), text.try_cast(kind))
    bad = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    odd = ~text.rlike(shape) & text.try_cast(kind).isNotNull()
    return F.when(odd, bad).otherwise(text.cast(kind))


def to_double(c: Column | str, strict: bool = False) -> Column:
    """Float cast: NULL on bad text, or an error when `strict`."""
    return _shaped(c, NUMBER, "double", strict)


def to_date(c: Column | str, strict: bool = False) -> Column:
    return _shaped(c, DATE, "date", strict)


def amount_or_zero(c: Column | str, strict: bool = False) -> Column:
    """Magnitude of a number written as text: blank is 0, absent stays NULL."""
    text = F.trim(_col(c))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(F.abs(to_double(text, strict)))


# --- lines and documents ----------------------------------------------------------------------
# The patterns of what is removed are fixed values.


def strip_dashed(c: Column | str) -> Column:
    """Remove every '-----...-----' stretch of an XML line."""
    line = _col(c)
    return F.when(
        line.contains("-----"), F.regexp_replace(line, r"-----[\s\S]*?-----", "")
    ).otherwise(line)


def strip_root(c: Column | str, root: str) -> Column:
    """Remove opening and closing root tags, attributes included."""
    text = _col(c)
    tag = rf"</?{re.escape(root)}[^>]*>"
    return F.when(text.contains(root), F.regexp_replace(text, tag, "")).otherwise(text)


def wrap_root(c: Column | str, root: str) -> Column:
    return F.concat(F.lit(f"<{root}>"), _col(c), F.lit(f"</{root}>"))


def strip_dash_lines(c: Column | str) -> Column:
    """Empty every line that starts with two or more dashes."""
    return F.regexp_replace(_col(c), r"(?m)^-{2,}.*$", "")


def strip_line_comments(c: Column | str, keep_urls: bool = False) -> Column:
    """Cut '//' to the end of each line that has a line end after it.

    It also cuts inside string values ('http://...') unless `keep_urls` is set.
    """
    head = r"(?<!:)//" if keep_urls else "//"
    return F.regexp_replace(_col(c), head + r".*\n", "\n")


def strip_block_comments(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"/\*[\s\S]*?\*/", "")


# A string up to its end or the line's, kept; a comment to the end of its line; a comment over lines,
# closed or not. Possessive repeats: no backtracking, and no recursion on long strings.
_STRING_OR_COMMENT = r'("(?:\\.|[^"\\\n])*+"?+)|//[^\n]*+|/\*(?s:.*?)(?:\*/|\z)'


def strip_json_comments(c: Column | str) -> Column:
    """Remove `//` and `/* */` comments in one scan; what looks like one inside a string stays."""
    return F.regexp_replace(_col(c), _STRING_OR_COMMENT, "$1")


def strip_semicolons(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(";"), F.lit(""))


# --- file names -------------------------------------------------------------------------------
#
# Evaluated for every line, so they avoid regular expressions and decode only what is encoded.

# Suffixes a codec adds to a file name (fixed values).
CODEC_SUFFIXES = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def decoded_path(c: Column | str) -> Column:
    """Undo the percent-encoding of file metadata paths; a literal '+' stays a '+'."""
    path = _col(c)
    return F.when(
        path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    ).otherwise(path)


def relative_name(path: Column | str, root: str) -> Column:
    """File name below a canonical root (see `raw_lines.landing_root`); NULL for a file outside.

    Paths of local files come with one slash or three behind the scheme; a root without a scheme is
    a local one.
    """
    full = _col(path)
    bare = root.rstrip("/")
    scheme, _, rest = bare.partition("://") if "://" in bare else ("file", "", bare)
    out = F.lit(None).cast("string")
    for prefix in (f"{scheme}://{rest}/", f"{scheme}:{rest}/"):
        cut = F.substring(full, len(prefix) + 1, (1 << 31) - 1)  # to the end, without counting it
        out = F.when(full.startswith(prefix), cut).otherwise(out)
    return out


def normalised_name(c: Column | str) -> Column:
    """Name used for routing: lower case, no codec suffix, '_' for spaces."""
    name = F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_"))
    bare = name
    for suffix in CODEC_SUFFIXES:
        cut = F.substring(name, F.lit(1), F.length(name) - len(suffix))
        bare = F.when(name.endswith(suffix), cut).otherwise(bare)
    return bare


# --- predicates -------------------------------------------------------------------------------


def none_like(c: Column | str, *patterns: str) -> Column:
    """True when no LIKE pattern matches; NULL text stays NULL, so a filter drops it."""
    text = _col(c)
    return reduce(lambda a, b: a & b, [~text.like(p) for p in patterns])


def none_ilike(c: Column | str, *patterns: str) -> Column:
    text = _col(c)
    return reduce(lambda a, b: a & b, [~text.ilike(p) for p in patterns])


def any_like(c: Column | str, *patterns: str) -> Column:
    text = _col(c)
    return reduce(lambda a, b: a | b, [text.like(p) for p in patterns])
