"""Text functions as chains of built-in expressions (JVM side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# HTML-to-text rewrite steps, applied in this order (Java regex syntax):
HTML_STEPS = [
    ("\n", " "),
    ("<script>.*?</script>", ""),
    ("(</p>|</br>)\n*", "\n"),
    ("<[^>]+?>", " "),
    ("(点击加载图片)|(查看原文)|(图片来源)|([\\-#=]{3,})", " "),
    ("\\s*\n\\s*", "\n"),
    ("[ \t]+", " "),
]
# CJK unified ideographs kept by the script filter.
CJK_CLASS = "\u4e00-\u9FCB"
# Category normalisation: this spelling is replaced by the canonical one.
CATEGORY_SPELLING = ("其它", "其他")
# Suffix used when a second-level label falls back under its first level.
OTHER_SUFFIX = "其它"
# ---------------------------------------------------------------------------


def html_to_text(c: Column) -> Column:
    """Strip tags/scripts, turn paragraph ends into newlines, squeeze blanks.
    Null or empty input gives ``""``."""
    out = F.coalesce(c, F.lit(""))
    for pattern, repl in HTML_STEPS:
        out = F.regexp_replace(out, pattern, repl)
    return out


def keep_script(c: Column, char_class: str = CJK_CLASS) -> Column:
    """Replace every run of characters outside ``char_class`` with one blank."""
    return F.replace(F.regexp_replace(c, f"[^{char_class}]+", " "), F.lit("\n"), F.lit(" "))


def tokens(c: Column) -> Column:
    """Lower-case word tokens (letters and digits of any script); punctuation
    dropped; never an empty token."""
    parts = F.split(F.lower(c), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda x: x != "")


def tokenize(c: Column) -> Column:
    """Blank-joined tokens (the segmenter's output format)."""
    return F.array_join(tokens(c), " ")


def char_ngrams(c: Column, n: int = 2) -> Column:
    """Character n-grams of a string (for scripts written without blanks)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))),
                       lambda i: F.substring(c, i, n))


def normalize_category(c: Column) -> Column:
    """trim, lower, one spelling of 'other', and ``[ _-]+`` -> ``,``."""
    old, new = CATEGORY_SPELLING
    s = F.replace(F.lower(F.trim(c)), F.lit(old), F.lit(new))
    return F.regexp_replace(s, "[ _-]+", ",")


def java_split(c: Column, sep_regex: str) -> Column:
    """``String.split`` semantics: trailing empty fields are dropped (Spark's
    ``split`` keeps them); an empty input gives ``[""]``."""
    parts = F.split(c, sep_regex)
    # 1-based position of the last non-empty field, 0 when there is none
    last = F.size(parts) - F.array_position(F.reverse(F.transform(parts, lambda x: x != "")), True) + 1
    kept = F.when(F.array_position(F.transform(parts, lambda x: x != ""), True) == 0, F.lit(0)).otherwise(last)
    return F.when(c == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, kept))


def url_host(url: Column) -> Column:
    """Third ``/``-separated field of a URL when it has more than three fields,
    else ``""``."""
    parts = java_split(url, "/")
    return F.when(F.size(parts) > 3, F.element_at(parts, 3)).otherwise(F.lit(""))


def decode_base64(c: Column) -> Column:
    return F.decode(F.unbase64(c), "utf-8")


