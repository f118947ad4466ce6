"""Text-cleaning scalars: every function maps a string Column to a string Column.

All of them are native Catalyst expressions (``translate`` / ``regexp_replace``)
so they stay inside whole-stage code generation; no Python runs per row.
Null text stays null; empty text stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import charclass as cc

MODES = ("strict", "balanced", "lenient")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c, ascii_only: bool = False) -> Column:
    """NFD then drop nonspacing marks, per character (B1).

    Characters of which one other stays are translated.  The rest of the decompositions
    expand: Hangul syllables by their arithmetic, some characters by a small map; only
    texts that have such a character are taken apart for it.  ``ascii_only`` keeps
    mappings onto strict mode's characters, which has no use for the others."""
    src, dst = cc.accent_map(ascii_only)
    out = F.translate(_col(c), src, dst)
    if ascii_only:
        return out
    wide = cc.expanding_map()
    table = F.create_map(*(F.lit(x) for pair in wide.items() for x in pair))
    lead, vowel, tail = (F.lit("".join(chr(first + k) for k in range(count))) for first, count in cc.JAMO)
    per_lead, per_vowel = cc.JAMO[1][1] * (cc.JAMO[2][1] + 1), cc.JAMO[2][1] + 1

    def apart(ch: Column) -> Column:
        s = F.ascii(ch) - F.lit(cc.HANGUL[0])
        at = lambda jamo, k: F.substr(jamo, k.cast("int"), F.lit(1))
        rest = F.when(s % per_vowel > 0, at(tail, s % per_vowel)).otherwise(F.lit(""))
        syllable = F.concat(at(lead, F.floor(s / per_lead) + 1), at(vowel, F.floor((s % per_lead) / per_vowel) + 1), rest)
        return F.when((s >= 0) & (s <= cc.HANGUL[1] - cc.HANGUL[0]), syllable).otherwise(F.coalesce(F.try_element_at(table, ch), ch))

    found = cc.ranges_to_class([cc.HANGUL, *sorted((ord(x), ord(x)) for x in wide)])
    return F.when(out.rlike(found), F.array_join(F.transform(F.split(out, ""), apart), "")).otherwise(out)


def keep_ascii_set(c) -> Column:
    """Characters outside the strict allow-list become one space each (B2)."""
    return F.regexp_replace(_col(c), cc.strict_disallowed_class(), " ")


def remove_emojis(c) -> Column:
    """Each run of emoji-range characters becomes one space."""
    return F.regexp_replace(_col(c), cc.emoji_class() + "+", " ")


def remove_cjk(c) -> Column:
    """Each run of CJK / kana / Hangul characters becomes one space."""
    return F.regexp_replace(_col(c), cc.cjk_class() + "+", " ")


def remove_control(c) -> Column:
    """Delete every ``C*`` character except newline and tab."""
    return F.regexp_replace(_col(c), cc.control_pattern(), "")


def keep_latin1(c) -> Column:
    """Code points above U+00FF become one space each."""
    return F.regexp_replace(_col(c), "[^\\x{0}-\\x{%X}]" % cc.LATIN1_LIMIT, " ")


def remove_rare_unicode(c) -> Column:
    """U+2000..U+2BFF become one space each."""
    lo, hi = cc.RARE_RANGE
    return F.regexp_replace(_col(c), f"[{cc.regex_cp(lo)}-{cc.regex_cp(hi)}]", " ")


def python_strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    ws = cc.whitespace_class()
    return F.regexp_replace(_col(c), f"\\A{ws}+|{ws}+\\z", "")


def normalize_whitespace(c) -> Column:
    """Four fixed rewrites in order, then a Unicode strip.

    1. runs of U+0020 -> one space      2. three or more newlines -> two
    3. spaces before a newline dropped  4. spaces after a newline dropped
    Not idempotent, exactly like the rule it reproduces.
    """
    x = F.regexp_replace(_col(c), " +", " ")
    x = F.regexp_replace(x, "\n\n+", "\n\n")
    x = F.regexp_replace(x, " +\n", "\n")
    x = F.regexp_replace(x, "\n +", "\n")
    return python_strip(x)


def clean_strict(c) -> Column:
    """Accents folded to ASCII, everything outside the allow-list -> space."""
    return normalize_whitespace(keep_ascii_set(strip_accents(c, ascii_only=True)))


def clean_balanced(c) -> Column:
    """Emoji, CJK, control removal, Latin-1 only (B10; the default mode)."""
    return normalize_whitespace(keep_latin1(remove_control(remove_cjk(remove_emojis(c)))))


def clean_lenient(c) -> Column:
    """Emoji and control removal, rare block -> space.

    The source this follows reads an unassigned variable at its last step and
    therefore always fails; the evident intent (normalise the text produced by
    the previous step) is implemented.
    """
    return normalize_whitespace(remove_rare_unicode(remove_control(remove_emojis(c))))


_DISPATCH = {"strict": clean_strict, "balanced": clean_balanced, "lenient": clean_lenient}


def clean(c, mode: str = "balanced") -> Column:
    """Plan-time dispatch on the cleaning mode (B12); unknown modes raise."""
    try:
        return _DISPATCH[mode](c)
    except KeyError:
        raise ValueError(f"cleaning mode {mode!r} is none of {sorted(_DISPATCH)}") from None
