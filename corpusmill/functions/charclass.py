"""Character classes used by the cleaning expressions.

Large tables are *generated by rule* from the Python ``unicodedata`` module of
the running interpreter (Unicode 15.1 on Python 3.13), so the Spark
expressions agree with Python's own category and decomposition data instead of
the JVM's older Unicode tables.  Short lists that must equal the cleaner's
behaviour exactly are stated once, below, as fixed values.
"""

from __future__ import annotations

import functools
import unicodedata

# --- fixed values (must equal the cleaning rules being reproduced) -------------
# Characters kept by strict cleaning, in the order they are listed there.
STRICT_ALLOWED = (
    "abcdefghijklmnopqrstuvwxyz"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "0123456789"
    " .,!?;:'\"()-[]{}/*@#$%&+=<>\n\t"
)
# Emoji ranges, each run of them becomes one space.
EMOJI_RANGES = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
]
# CJK ranges, each run of them becomes one space.
CJK_RANGES = [
    (0x4E00, 0x9FFF),
    (0x3400, 0x4DBF),
    (0x20000, 0x2A6DF),
    (0xF900, 0xFAFF),
    (0x3040, 0x309F),
    (0x30A0, 0x30FF),
    (0xAC00, 0xD7AF),
]
# Rare block replaced by a space in lenient mode, and the Latin-1 limit of balanced mode.
RARE_RANGE = (0x2000, 0x2BFF)
LATIN1_LIMIT = 0xFF
# Characters kept by the control-character step.
CONTROL_KEEP = "\n\t"
# -------------------------------------------------------------------------------

_MAX_CP = 0x10FFFF


def _is_surrogate(cp: int) -> bool:
    return 0xD800 <= cp <= 0xDFFF


def regex_cp(cp: int) -> str:
    """One code point in the ``\\x{...}`` syntax understood by Java and RE2."""
    return "\\x{%X}" % cp


def ranges_to_class(ranges, negate: bool = False) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(regex_cp(lo) if lo == hi else f"{regex_cp(lo)}-{regex_cp(hi)}")
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


def _runs(cps):
    """Collapse a sorted iterable of code points into inclusive ranges."""
    out = []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return [tuple(r) for r in out]


@functools.lru_cache(maxsize=None)
def control_ranges() -> tuple:
    """Ranges of every code point whose general category starts with ``C``
    (Cc, Cf, Co, Cn; surrogates excluded since they cannot occur in UTF-8 text),
    minus the kept newline and tab."""
    keep = {ord(c) for c in CONTROL_KEEP}
    cps = (cp for cp in range(_MAX_CP + 1)
           if not _is_surrogate(cp) and cp not in keep
           and unicodedata.category(chr(cp)).startswith("C"))
    return tuple(_runs(cps))


@functools.lru_cache(maxsize=None)
def common_non_control_ranges(limit: int = 0x378) -> tuple:
    """Code points below ``limit`` that the control step never touches; used as
    a fast-fail guard in front of the large control class."""
    ctrl = control_ranges()

    def is_ctrl(cp):
        return any(lo <= cp <= hi for lo, hi in ctrl if lo <= limit)

    return tuple(_runs(cp for cp in range(limit) if not is_ctrl(cp)))


@functools.lru_cache(maxsize=None)
def python_whitespace() -> str:
    """Every character Python's ``str.strip()`` removes (``str.isspace``)."""
    return "".join(chr(cp) for cp in range(_MAX_CP + 1)
                   if not _is_surrogate(cp) and chr(cp).isspace())


def _strip_marks(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s)
                   if unicodedata.category(c) != "Mn")


@functools.lru_cache(maxsize=None)
def accent_map(ascii_only: bool) -> tuple[str, str]:
    """``(matching, replace)`` strings for Spark ``translate``.

    Every nonspacing mark (Mn) is deleted.  A character whose canonical
    decomposition minus marks is a single different character maps to it.
    With ``ascii_only`` only mappings onto a strict-mode allowed character are
    kept (anything else becomes a space in strict mode anyway).  Characters
    decomposing into several non-mark characters (``HANGUL``, ``expanding_map``) are
    not in it: one character cannot expand through ``translate``.
    """
    mapped_src, mapped_dst, deleted = [], [], []
    for cp in range(0x80, _MAX_CP + 1):
        if _is_surrogate(cp):
            continue
        ch = chr(cp)
        if unicodedata.category(ch) == "Mn":
            deleted.append(ch)
            continue
        if unicodedata.decomposition(ch) == "" or unicodedata.decomposition(ch).startswith("<"):
            continue  # no canonical decomposition
        base = _strip_marks(ch)
        if base == ch:
            continue
        if base == "":
            deleted.append(ch)
        elif len(base) == 1 and (not ascii_only or base in STRICT_ALLOWED):
            mapped_src.append(ch)
            mapped_dst.append(base)
    # translate(): characters of `matching` beyond the length of `replace` are deleted
    return "".join(mapped_src) + "".join(deleted), "".join(mapped_dst)


#: Fixed values of Unicode: Hangul syllables; first code point and number of lead, vowel and tail letters.
HANGUL = (0xAC00, 0xD7A3)
JAMO = ((0x1100, 19), (0x1161, 21), (0x11A8, 27))


@functools.lru_cache(maxsize=None)
def expanding_map() -> dict[str, str]:
    """Characters, Hangul syllables apart, whose decomposition without marks has several characters."""
    out = {}
    for cp in range(0x80, _MAX_CP + 1):
        if _is_surrogate(cp) or HANGUL[0] <= cp <= HANGUL[1] or unicodedata.category(chr(cp)) == "Mn":
            continue
        base = _strip_marks(chr(cp))
        if len(base) > 1:
            out[chr(cp)] = base
    return out


def emoji_class() -> str:
    return ranges_to_class(EMOJI_RANGES)


def cjk_class() -> str:
    return ranges_to_class(CJK_RANGES)


def control_class() -> str:
    return ranges_to_class(control_ranges())


def control_pattern() -> str:
    """Control class behind a negative look-ahead of common characters: the
    look-ahead fails fast on ordinary text, the big class only runs on the rest."""
    guard = ranges_to_class(common_non_control_ranges())
    return f"(?!{guard}){control_class()}"


def strict_disallowed_class() -> str:
    return ranges_to_class(sorted((ord(c), ord(c)) for c in STRICT_ALLOWED), negate=True)


def whitespace_class() -> str:
    return ranges_to_class(_runs(sorted(ord(c) for c in python_whitespace())))
