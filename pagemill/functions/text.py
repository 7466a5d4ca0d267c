"""Text column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Pictograms and their ASCII tags.
EMOJI_TAGS = {
    "🚀": "[>>]",
    "✅": "[OK]",
    "❌": "[ERR]",
    "🎉": "[SUCCESS]",
    "⚠️": "[WARN]",
    "🔍": "[SEARCH]",
    "📄": "[DOC]",
    "📊": "[STATS]",
    "🔄": "[PROC]",
    "💾": "[SAVE]",
    "🔧": "[CONFIG]",
    "📁": "[FOLDER]",
    "🤖": "[AI]",
    "📈": "[GRAPH]",
    "📋": "[LIST]",
    "📝": "[NOTE]",
    "🧩": "[CHUNK]",
    "📏": "[SIZE]",
    "🔗": "[LINK]",
    "💻": "[CPU]",
    "🎯": "[TARGET]",
    "🗂️": "[FILES]",
    "⏱️": "[TIME]",
    "🌍": "[REGION]",
    "👥": "[WORKERS]",
    "📦": "[PACKAGE]",
    "🌐": "[WEB]",
    "💡": "[TIP]",
    "📂": "[OUTPUT]",
    "🏆": "[BEST]",
    "⭐": "[STAR]",
}

UNKNOWN = "Unknown"


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends; Spark's own trim only knows U+0020."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_content(text: Column) -> Column:
    """False for NULL, empty and white-space-only text."""
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


def choose_content(markdown: Column, text: Column) -> Column:
    """Markdown unless it is NULL or empty, else the plain text."""
    return F.when(F.length(markdown) > 0, markdown).otherwise(text)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-case ``.ext`` of the last path segment, empty if it has none."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def without_query(url: Column) -> Column:
    """The URL up to its query string or fragment."""
    return F.regexp_extract(url, r"^[^?#]*", 0)


def _without_marks(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("#"), F.lit("")), F.lit("*"), F.lit(""))


def preview(text: Column, max_length: int = 150) -> Column:
    """Clean first, then cut: marks removed, one line, at most ``max_length`` characters."""
    one_line = strip(F.replace(_without_marks(text), F.lit("\n"), F.lit(" ")))
    return strip(F.left(one_line, F.lit(max_length)))


def preview_cut_first(text: Column, max_length: int = 150, one_line: bool = False) -> Column:
    """Cut first, then clean, so removed marks shorten the preview."""
    cut = strip(F.left(text, F.lit(max_length)))
    return F.replace(cut, F.lit("\n"), F.lit(" ")) if one_line else _without_marks(cut)


def sample(text: Column, length: int = 200) -> Column:
    return strip(F.left(text, F.lit(length)))


def head(text: Column, length: int = 300) -> Column:
    """The first characters, with an ellipsis only where something was cut off."""
    return F.when(
        F.length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit("..."))
    ).otherwise(text)


def ascii_safe(text: Column) -> Column:
    """Known pictograms to tags, every other run of non-ASCII characters to ``[?]``."""
    tagged = reduce(
        lambda col, pair: F.replace(col, F.lit(pair[0]), F.lit(pair[1])), EMOJI_TAGS.items(), text
    )
    return F.regexp_replace(tagged, r"[^\x00-\x7F]+", "[?]")


def redact(secret: Column, visible: int = 0) -> Column:
    """Hide a secret; NULL when there is none. By default no character is shown."""
    return F.when(F.length(secret) > 0, F.concat(F.left(secret, F.lit(visible)), F.lit("...")))


def error_class(error: Column) -> Column:
    return (
        F.when(error.isNull(), F.lit(None))
        .when(error.contains("Invalid API Key"), F.lit("credentials"))
        .when(F.lower(error).rlike("quota|limit"), F.lit("quota"))
        .otherwise(F.lit("other"))
    )


def error_remedy(error: Column) -> Column:
    kind = error_class(error)
    return (
        F.when(kind == "credentials", F.lit("check the key, the remaining credits and the region"))
        .when(kind == "quota", F.lit("wait for the quota to reset or raise the limit"))
        .when(kind == "other", F.lit("check the connection and the file, then retry"))
    )
