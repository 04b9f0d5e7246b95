"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_by_single_space(c) -> Column:
    """Spaces become commas; one comma at the end goes."""
    return F.regexp_replace(F.replace(_col(c), F.lit(" "), F.lit(",")), ",$", "")


def hex_subnumber(c, first: int, last: int, default: int = -1) -> Column:
    """The unsigned number in bytes first to last of hex text, counted from its right end (0: the lowest byte).

    The default where the text is shorter, isn't hex or is null.
    """
    text = F.trim(_col(c))
    count = last - first + 1
    part = F.substring(text, F.char_length(text) - 2 * (last + 1) + 1, F.lit(2 * count))
    fits = (F.char_length(text) >= 2 * (last + 1)) & text.rlike("^[0-9A-Fa-f]+$")
    return F.coalesce(F.when(fits, F.conv(part, 16, 10).cast("long")), F.lit(default).cast("long"))


def regex_group1(c, pattern: str) -> Column:
    """Group 1 if the whole text matches, else null."""
    whole = f"^(?:{pattern})$"
    return F.when(_col(c).rlike(whole), F.regexp_extract(_col(c), whole, 1))


def parent_folder_name(path) -> Column:
    """The name of the folder that a path's last part lies in; null at the top."""
    return F.get(F.split(_col(path), "/"), F.size(F.split(_col(path), "/")) - 2)


def string_between(c, before: str, after: str, before_last: bool = False, after_last: bool = False) -> Column:
    """What lies between the first (or last) ``before`` and the first (or last) ``after`` behind it; the input where either is
    missing. An empty marker means the text's own end."""
    text, b, a = _col(c), re.escape(before), re.escape(after)
    head = "" if not before else f".*{b}" if before_last else f".*?{b}"
    tail = "" if not after else f"{a}.*" if after_last else f"{a}.*"
    middle = ".*" if after_last or not after else ".*?"
    pattern = f"(?s)^{head}({middle}){tail}$"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text)


def fill_params(template, values: dict) -> Column:
    """$key replaced by its value, longest keys first; null values leave an empty text."""
    out = _col(template) if isinstance(template, Column) else F.lit(template)
    for key in sorted(values, key=lambda k: (-len(k), k)):
        value = values[key]
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.replace(out, F.lit(f"${key}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def replace_spaces(c) -> Column:
    """All white space removed."""
    return F.regexp_replace(_col(c), r"\s", "")


def common_path(path) -> Column:
    """Aggregate: the longest shared folder prefix of all paths, ending in a slash; empty where nothing is shared.

    The shared prefix of many texts is that of their smallest and largest.
    """
    low, high = F.split(F.min(_col(path)), "/"), F.split(F.max(_col(path)), "/")
    folders = F.slice(low, 1, F.size(low) - 1)
    same = F.filter(
        F.sequence(F.lit(0), F.size(folders)),
        lambda n: F.slice(folders, 1, n) == F.slice(high, 1, n),
    )
    shared = F.array_max(F.filter(same, lambda n: n < F.size(high)))
    joined = F.array_join(F.slice(low, 1, shared), "/")
    return F.when(shared > 0, F.concat(joined, F.lit("/"))).otherwise("")


def nth_csv_column(c, k: int, delimiter: str = ",") -> Column:
    """Field k of delimited text, from 0; null beyond the end."""
    return F.get(F.split(_col(c), re.escape(delimiter)), F.lit(k))


def glob_pattern(glob: str) -> str:
    """A regular expression for a glob with *, ?, {a,b} and backslash escapes. A star does not stop at slashes."""
    out, depth, k = [], 0, 0
    while k < len(glob):
        c = glob[k]
        if c == "\\" and k + 1 < len(glob):
            k += 1
            out.append(re.escape(glob[k]))
        elif c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        k += 1
    if depth:
        raise ValueError(f"unclosed group in glob {glob!r}")
    return f"^{''.join(out)}$"


def glob_match(c, *globs: str) -> Column:
    """Whether the text matches any of the globs."""
    return _col(c).rlike("|".join(f"(?:{glob_pattern(g)})" for g in globs))


def clean_identifier(c) -> Column:
    """A name for a column: what isn't a word character becomes _, and a leading digit gets one before it."""
    return F.regexp_replace(F.regexp_replace(F.trim(_col(c)), r"\W", "_"), "^([0-9])", "_$1")


def identifier(name: str) -> str:
    """clean_identifier for a name known when planning."""
    return re.sub(r"^([0-9])", r"_\1", re.sub(r"\W", "_", name.strip()))
