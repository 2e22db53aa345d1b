"""Text functions as Column expressions: all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: White space as a Unicode-aware pattern that includes the four separators U+001C to U+001F.
SPACE = r"(?U)[\s\x{1c}-\x{1f}]+"
#: A fenced block: three backticks, an optional tag, a line end, the body, three backticks.
FENCE = r"(?s)```[a-zA-Z0-9+#.\-]*\n(.*?)```"
TOOL_CALL = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"^{SPACE}|{SPACE}$", "")


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def norm(c: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends: the key of exact dedup."""
    return F.trim(F.regexp_replace(F.lower(c), SPACE, " "))


def hash_byte(key: Column) -> Column:
    """The last byte of a key's SHA-1, 0 to 255."""
    return F.conv(F.substring(F.sha1(key), 39, 2), 16, 10).cast("int")


def is_heldout(key: Column, fraction: float = 0.03) -> Column:
    """Whether a key's byte over 255 is below the fraction: for 0.03, bytes 0 to 7."""
    return hash_byte(key) / F.lit(255.0) < F.lit(fraction)


def has_fence(c: Column) -> Column:
    return F.coalesce(c.rlike(FENCE), F.lit(False))


def extract_fenced(c: Column) -> Column:
    """The body of the first fenced block; null if there is none (an empty block is '')."""
    return F.when(has_fence(c), F.regexp_extract(c, FENCE, 1))


def extract_code(c: Column, tags: str = r"[a-zA-Z0-9+#.\-]*", stripped: bool = False) -> Column:
    """The body of the first fenced block with such a tag, else the text itself; null is ''."""
    pattern = rf"(?s)```{tags}\n(.*?)```"
    text = F.coalesce(c, F.lit(""))
    out = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(text)
    return strip(out) if stripped else out


def strip_fence(c: Column, tags: str = r"[a-zA-Z0-9+#.\-]*") -> Column:
    """The body if the whole text is one fenced block, else the text, stripped."""
    pattern = rf"(?s)^```{tags}\n(.*?)\n?```$"
    return F.when(strip(c).rlike(pattern), F.regexp_extract(strip(c), pattern, 1)).otherwise(strip(c))


def let(value: Column, body) -> Column:
    """body(value), in which value is worked out once however often body uses it: expressions would be copied to each place."""
    return F.transform(F.array(value), body).getItem(0)


def strict_json(c: Column) -> Column:
    """A text that is one JSON value and nothing else, as VARIANT; null if it isn't.

    try_parse_json reads one value and passes over what follows it. Inside a list
    and inside an object nothing may follow but an end of that kind, so a text that
    parses in both is whole.
    """
    def whole(t: Column) -> Column:
        named = F.try_parse_json(F.concat(F.lit('{"x":'), t, F.lit("}")))
        listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
        return let(listed, lambda x: F.when((F.size(x) == 1) & named.isNotNull(), F.try_element_at(x, F.lit(1))))

    return let(c, whole)


def extract_json(c: Column, greedy: bool = True) -> Column:
    """The JSON object in a reply as VARIANT: of a fenced block, else from the first to the last brace; null if it doesn't parse."""
    fenced = rf"(?s)```(?:json)?\s*(\{{.*{'' if greedy else '?'}\}})\s*```"
    body = F.when(c.rlike(fenced), F.regexp_extract(c, fenced, 1)).otherwise(F.regexp_extract(c, r"(?s)(\{.*\})", 1))
    return strict_json(F.when(body != "", body))


def as_fenced_reply(intro: Column, code: Column, lang: Column) -> Column:
    """An intro and a fenced block; a part that is fenced already stays as it is."""
    lead = strip(F.coalesce(intro, F.lit("")))
    block = F.concat(F.lit("```"), lang, F.lit("\n"), strip(code), F.lit("\n```"))
    return F.when(has_fence(code), code).when(has_fence(intro), intro).otherwise(F.when(lead == "", block).otherwise(F.concat(lead, F.lit("\n\n"), block)))


def strip_c_comments(c: Column) -> Column:
    """Block comments, then line comments, as spaces; string literals are not looked at."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)/\*.*?\*/", " "), r"//[^\n]*", " ")


def unescape_html(c: Column) -> Column:
    """The three basic entities."""
    return F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def rate_text(a: Column, b: Column) -> Column:
    """'a/b (p%)', 'n/a' where b is 0."""
    return F.when(b == 0, "n/a").otherwise(F.format_string("%d/%d (%d%%)", a, b, F.bround(100 * a / b).cast("long")))


def svg_uri(width: Column, height: Column, fill: Column, label: Column) -> Column:
    """An inline SVG data URI."""
    return F.format_string("data:image/svg+xml,%%3Csvg xmlns='http://www.w3.org/2000/svg' width='%d' height='%d'%%3E%%3Crect width='100%%25' height='100%%25' fill='%s'/%%3E%%3Ctext x='50%%25' y='50%%25'%%3E%s%%3C/text%%3E%%3C/svg%%3E", width, height, fill, label)
