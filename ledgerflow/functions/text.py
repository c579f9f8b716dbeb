"""Text Column builders: description clean (F8), name normalise (R1),
HTML strip (E2), quote strip (T4), line split.

All are native expressions (whole-stage codegen, no Python per row). Java
regex needs ``(?U)`` so that ``\\s``, ``\\d`` and ``\\b`` follow Unicode as
the behaviour being reproduced does.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NAME_KEEP_CHARS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of Java's ``(?U)\\s``.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``str.strip()``)."""
    return F.btrim(col_(c), F.lit(WHITE_SPACE))


_MARK = "\x01"  # between the groups of ``groups``


def groups(s: Column, pat: str, plain: tuple[int, ...], free: int) -> Column:
    """The groups of an anchored pattern (``^...$``) as one array, null where it does not match: first those of
    ``plain``, whose characters the pattern names, then ``free``, which may hold any. One
    match gives them all; only a text that holds the mark itself is matched once more."""
    got = F.split(F.regexp_replace(s, pat, _MARK.join(f"${k}" for k in (*plain, free))), _MARK, len(plain) + 1)
    return F.when((F.size(got) == len(plain) + 1) & (~F.contains(s, F.lit(_MARK)) | s.rlike(pat)), got)


def clean_description(c) -> Column:
    """F8: drop a leading ``[...]`` tag, digit runs of 10+, squeeze whitespace.

    Null input gives ``""``.
    """
    s = F.coalesce(col_(c).cast("string"), F.lit(""))
    s = F.regexp_replace(s, r"(?U)^\[.*?\]\s*", "")
    s = F.regexp_replace(s, r"(?U)\b\d{10,}\b", "")
    s = F.regexp_replace(s, r"(?U)\s{2,}", " ")
    return strip_ws(s)


def norm(c) -> Column:
    """Lower-cased text, null -> ''."""
    return F.lower(F.coalesce(col_(c).cast("string"), F.lit("")))


def norm_name(c) -> Column:
    """Contact-name key: keep a-z, digits and listed accents, squeeze, trim."""
    s = F.regexp_replace(norm(c), f"[^a-z0-9{NAME_KEEP_CHARS}]", " ")
    s = F.regexp_replace(s, r"(?U)\s{2,}", " ")
    return strip_ws(s)


# FIXED VALUES: HTML entities replaced in this order.
HTML_ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
                 ("&#39;", "'"), ("&quot;", '"'), ("&apos;", "'"))


def strip_html(c) -> Column:
    """Tags -> space, entities, squeeze blanks/tabs and blank lines, trim."""
    s = F.regexp_replace(col_(c), r"<[^>]+>", " ")
    for ent, rep in HTML_ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(rep))
    s = F.regexp_replace(s, r"[ \t]+", " ")
    s = F.regexp_replace(s, r"(?U)\n\s*\n+", "\n\n")
    return strip_ws(s)


def strip_quotes(c) -> Column:
    """T4: ``s.strip().strip("'").strip('"').strip()``."""
    s = strip_ws(c)
    s = F.btrim(F.btrim(s, F.lit("'")), F.lit('"'))
    return strip_ws(s)


def unwrap_quotes(c) -> Column:
    """Trim, then drop one pair of matching wrapping quotes and trim again."""
    s = strip_ws(c)
    n = F.length(s)
    wrapped = (n >= 2) & ((s.startswith("'") & s.endswith("'")) |
                          (s.startswith('"') & s.endswith('"')))
    return F.when(wrapped, strip_ws(F.substring(s, F.lit(2), n - 2))).otherwise(s)


# Line terminators of Python's ``str.splitlines``.
SPLITLINES_RE = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


# Single-character terminators of ``str.splitlines`` besides "\n".
_OTHER_TERMINATORS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def split_lines(c) -> Column:
    """Array of lines like ``str.splitlines()`` (no trailing empty line).
    "\r\n" and the other terminators are first folded into "\n" with plain
    string functions (only where there are any), so the split is a literal one-character split."""
    s = F.coalesce(col_(c), F.lit(""))
    folded = F.translate(F.replace(s, F.lit("\r\n"), F.lit("\n")), _OTHER_TERMINATORS, "\n" * len(_OTHER_TERMINATORS))
    s = F.when(s.rlike(f"[{_OTHER_TERMINATORS}]"), folded).otherwise(s)
    arr = F.split(s, "\n")
    # splitlines() drops the piece after a final terminator and yields [] for "".
    n = F.size(arr)
    return F.when(s == "", F.array().cast("array<string>")) \
        .when(s.endswith("\n"), F.slice(arr, 1, n - 1)).otherwise(arr)


def first_substring_label(c: Column, table, default=None) -> Column:
    """First ``term`` of ``(term, label)`` pairs contained in ``c`` -> label."""
    out = None
    for term, label in table:
        cond = F.contains(c, F.lit(term))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default) if not isinstance(default, Column) else default)


def contains_any(c: Column, terms) -> Column:
    cond = F.lit(False)
    for t in terms:
        cond = cond | F.contains(c, F.lit(t))
    return cond


def once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` names it; null where ``c`` is null."""
    return F.get(F.transform(F.filter(F.array(c), lambda x: x.isNotNull()), use), 0)


def select_where(df, cols, cond):
    """Project ``cols`` and keep the rows where ``cond(row_struct)`` holds,
    with no Filter node: the row is kept or dropped by a generator over a
    one-element array. Catalyst cannot push a predicate below a generator,
    so the projected (regex-heavy) expressions are neither duplicated into a
    pushed filter nor re-evaluated; the result is a plain narrow map."""
    rec = F.struct(*cols)
    return df.select(F.inline(F.filter(F.array(rec), cond)))
