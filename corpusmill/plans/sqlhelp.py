"""DuckDB SQL fragments for the oracles, written independently of the Spark
expressions wherever DuckDB has its own function for the same rule."""

from __future__ import annotations

from corpusmill.functions import charclass as cc


def sql_chars(s: str) -> str:
    """A SQL expression spelling ``s`` with chr() so control characters survive."""
    if not s:
        return "''"
    return "(" + "||".join(f"chr({ord(ch)})" for ch in s) + ")"


WS_SQL = None


def ws_set() -> str:
    global WS_SQL
    if WS_SQL is None:
        WS_SQL = sql_chars(cc.python_whitespace())
    return WS_SQL


def ws_norm(x: str) -> str:
    x = f"regexp_replace({x}, ' +', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n\\n+', chr(10)||chr(10), 'g')"
    x = f"regexp_replace({x}, ' +\\n', chr(10), 'g')"
    x = f"regexp_replace({x}, '\\n +', chr(10), 'g')"
    return f"trim({x}, {ws_set()})"


def ascii_set(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9 .,!?;:''\"()\\-\\[\\]{{}}/*@#$%&+=<>\\n\\t]', ' ', 'g')"


def emojis(x: str) -> str:
    return f"regexp_replace({x}, '{cc.emoji_class()}+', ' ', 'g')"


def cjk(x: str) -> str:
    return f"regexp_replace({x}, '{cc.cjk_class()}+', ' ', 'g')"


def control(x: str) -> str:
    # RE2's own Unicode categories (format, private use) plus the C0/C1 blocks
    return f"regexp_replace({x}, '[\\x{{0}}-\\x{{8}}\\x{{B}}-\\x{{1F}}\\x{{7F}}-\\x{{9F}}\\p{{Cf}}\\p{{Co}}]', '', 'g')"


def latin1(x: str) -> str:
    return f"regexp_replace({x}, '[^\\x{{0}}-\\x{{FF}}]', ' ', 'g')"


def rare(x: str) -> str:
    return f"regexp_replace({x}, '[\\x{{2000}}-\\x{{2BFF}}]', ' ', 'g')"


def strict(x: str) -> str:
    return ws_norm(ascii_set(f"strip_accents({x})"))


def balanced(x: str) -> str:
    return ws_norm(latin1(control(cjk(emojis(x)))))


def lenient(x: str) -> str:
    return ws_norm(rare(control(emojis(x))))


MODE_SQL = {"strict": strict, "balanced": balanced, "lenient": lenient}


def char_rows(table: str, text: str = "text", keys: str = "") -> str:
    """Rows ``(keys..., ch)`` one per code point, empty strings removed."""
    k = f"{keys}, " if keys else ""
    return (f"select {k}ch from (select {k}unnest(string_split({text}, '')) as ch from {table}) "
            f"where ch <> ''")


def vocab_sql(table: str, text: str = "text") -> str:
    return (f"select (row_number() over (order by ch) - 1)::INTEGER as id, ch "
            f"from (select distinct ch from ({char_rows(table, text)}))")


def md5_unit(expr: str) -> str:
    """A hashed uniform in (0, 1): first 32 bits of md5, centred in its cell."""
    return f"((('0x' || substr(md5({expr}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"
