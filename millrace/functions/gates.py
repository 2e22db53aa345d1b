"""Record gates as Column predicates over typed messages.

Messages are ARRAY<STRUCT<role, content, content_type, tool_calls>>. content_type
is missing, null, string or other, so that a gate can tell an object from text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import has_fence, is_blank, strip, strip_c_comments

#: Openings of a refusal.
REFUSALS = ["i cannot", "i can't", "i'm unable", "as an ai language model", "i am unable", "i'm sorry, but i can", "i am not able"]
#: Tags that a plain answer must not hold.
PROSE_TAGS = "!doctype html body div p h[1-6] ul table span section head"
#: Tags that mark a document.
DOCUMENT_TAGS = "details summary p div ul li h[1-6] table section strong em !doctype html body blockquote"
#: Symbols of C by the header that declares them.
HEADERS = {
    "limits.h": "INT_MAX INT_MIN UINT_MAX LONG_MAX LONG_MIN CHAR_BIT",
    "ctype.h": "isalpha isdigit isalnum isspace isupper islower toupper tolower ispunct",
    "math.h": "sqrt pow fabs floor ceil round log sin cos tan exp",
    "stdbool.h": "bool true false",
    "stdint.h": "uint8_t uint16_t uint32_t uint64_t int8_t int16_t int32_t int64_t",
    "stdlib.h": "malloc calloc realloc free strtol strtod qsort",
    "string.h": "strlen strcpy strncpy strcmp strncmp strcat memcpy memset memmove strchr strstr",
}
#: Headers of symbols that a compiler names without a hint.
SYMBOL_HEADERS = {"NULL": "stddef.h", "true": "stdbool.h", "false": "stdbool.h", "bool": "stdbool.h", "size_t": "stddef.h"}


def _text(m: Column) -> Column:
    return (m["content_type"] == "string") & ~is_blank(m["content"])


def valid_messages(m: Column) -> Column:
    """At least two messages, each with text that is not blank."""
    return F.coalesce((F.size(m) >= 2) & F.forall(m, lambda x: F.coalesce(_text(x), F.lit(False))), F.lit(False))


def has_tool_turn(m: Column) -> Column:
    """Some assistant message calls a tool."""
    return F.coalesce(F.exists(m, lambda x: (x["role"] == "assistant") & (F.coalesce(F.size(x["tool_calls"]), F.lit(0)) > 0)), F.lit(False))


def row_ok(m: Column, kind: Column) -> Column:
    """Tool rows need a final text, others valid messages."""
    last = F.coalesce((F.size(m) >= 2) & _text(F.try_element_at(m, F.lit(-1))), F.lit(False))
    return F.when((kind == "tools") | has_tool_turn(m), last).otherwise(valid_messages(m))


def good_chat(m: Column, least: int = 40) -> Column:
    """User first, roles alternate, assistants say enough and refuse nothing."""
    roles = F.transform(m, lambda x: F.coalesce(x["role"], F.lit("")))
    alternate = F.forall(F.sequence(F.lit(1), F.greatest(F.size(m) - 1, F.lit(1))), lambda i: F.try_element_at(roles, i) != F.try_element_at(roles, i + 1))
    said = F.transform(F.filter(m, lambda x: x["role"] == "assistant"), lambda x: x["content"])
    refuses = F.exists(said, lambda s: F.lower(strip(s)).rlike("^(" + "|".join(REFUSALS) + ")"))
    rule = valid_messages(m) & (F.try_element_at(roles, F.lit(1)) == "user") & alternate & (F.size(said) >= 1) & F.forall(said, lambda s: F.length(s) >= least) & ~refuses
    return F.coalesce(rule, F.lit(False))


def is_multiline(code: Column, tags: int = 4) -> Column:
    """Few tags, or several lines of which one is indented. Any Unicode line end begins a line."""
    indented = code.rlike("(?s)(^|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}])[ \\t]")
    rule = F.when(F.regexp_count(code, F.lit("<")) < tags, True).when(F.regexp_count(code, F.lit("\n")) < 3, False).otherwise(indented)
    return F.coalesce(~is_blank(code) & rule, F.lit(False))


def is_prose(c: Column, least: int = 25) -> Column:
    """Enough text, no fence, no tool call."""
    return F.coalesce((F.length(strip(c)) >= least) & ~has_fence(c) & ~c.contains("<tool_call>"), F.lit(False))


def _tags(names: str) -> str:
    return "(?i)<(?:" + "|".join(names.split()) + r")\b"


def is_plain_prose(c: Column) -> Column:
    """Prose without raw tags."""
    return is_prose(c) & ~F.coalesce(c.rlike(_tags(PROSE_TAGS)), F.lit(False))


def is_document(c: Column) -> Column:
    """A document in place of prose: backticks or one of another list of tags."""
    return F.coalesce(c.contains("```") | c.rlike(_tags(DOCUMENT_TAGS)), F.lit(False))


def no_call(c: Column) -> Column:
    """A direct answer calls no tool."""
    return F.coalesce(~c.contains("<tool_call>"), F.lit(True))


def is_placeholder(code: Column) -> Column:
    """Code that leaves something out."""
    return F.coalesce(code.rlike(r"(?im)#\s*(your code|todo|implement|fill in)\b|\.\.\.\s*$"), F.lit(False))


def has_main(code: Column) -> Column:
    """Defines its own main function: with a return type, or with empty, void or int parameters."""
    return F.coalesce(code.rlike(r"(?i)\b(?:int|void)\s+main\s*\(|\bmain\s*\(\s*(?:void|int|\))"), F.lit(False))


def included_headers(src: Column) -> Column:
    """Headers in angle brackets, of the raw text: a commented include counts."""
    return F.array_distinct(F.regexp_extract_all(src, F.lit(r"#include\s*<([^>]+)>"), F.lit(1)))


def missing_headers(src: Column) -> Column:
    """Headers whose symbols the source uses without including them."""
    code = strip_c_comments(src)
    used = F.array_compact(F.array(*(F.when(code.rlike(r"\b(?:" + "|".join(names.split()) + r")\b"), F.lit(h)) for h, names in HEADERS.items())))
    return F.coalesce(F.array_sort(F.array_except(used, included_headers(src))), F.array().cast("array<string>"))


def hinted_headers(stderr: Column) -> Column:
    """Headers that a compiler's messages ask for: hints first, else by symbol."""
    hints = F.regexp_extract_all(stderr, F.lit(r"is defined in header '<([^>]+)>'"), F.lit(1))
    names = F.array_union(F.regexp_extract_all(stderr, F.lit(r"'(\w+)' undeclared"), F.lit(1)), F.regexp_extract_all(stderr, F.lit(r"unknown type name '(\w+)'"), F.lit(1)))
    table = F.create_map(*(F.lit(x) for kv in SYMBOL_HEADERS.items() for x in kv))
    return F.array_sort(F.array_union(hints, F.array_compact(F.transform(names, lambda n: F.try_element_at(table, n)))))


def compile_bucket(stderr: Column, wrote_main: Column) -> Column:
    """Why a compilation failed, by the first rule that holds. The names of buckets are fixed values."""
    s = F.lower(stderr)
    own_main = s.contains("redefinition of 'main'") | (s.contains("multiple definition of") & s.contains("main"))
    return (
        F.when(own_main | (wrote_main & s.contains("main")), "dup_main (student wrote main())")
        .when(s.contains("implicit declaration"), "missing_include/decl")
        .when(s.contains("unknown type name") | s.contains("incomplete type"), "unknown_type (missing struct/typedef)")
        .when(s.contains("conflicting types") | s.contains("incompatible"), "signature_mismatch")
        .when(s.contains("undefined reference"), "link_undefined (fn not defined)")
        .when(s.contains("expected") | s.contains("error: '"), "syntax_error")
        .otherwise("other_compile")
    )


def html_soft_issues(html: Column) -> Column:
    """A form without any label, an image without alt in any image."""
    low = F.lower(html)
    form = F.when(low.contains("<form") & ~low.contains("<label"), "form without label")
    image = F.when(low.contains("<img") & ~html.rlike(r"(?i)<img[^>]*\balt\s*="), "img without alt")
    return F.array_compact(F.array(form, image))


def in_vocabulary(value: Column, words: list[str]) -> Column:
    """A closed vocabulary: null is outside."""
    return F.coalesce(value.isin(*words), F.lit(False))


def none_blank(*parts: Column) -> Column:
    """Every component has text."""
    out = F.lit(True)
    for part in parts:
        out = out & ~is_blank(part)
    return out


#: Languages whose solutions can be run.
VERIFIABLE = ["Python", "C"]


def is_verifiable(lang: Column, tests: Column) -> Column:
    """A language that can be run, with tests to run."""
    return in_vocabulary(lang, VERIFIABLE) & ~is_blank(tests)


def all_match(text: Column, patterns: Column) -> Column:
    """Every regular expression hits, whatever the case."""
    return F.forall(patterns, lambda p: F.regexp_like(text, F.concat(F.lit("(?is)"), p)))


def hits(text: Column, words: Column) -> Column:
    """How many words the text contains, whatever the case."""
    return F.size(F.filter(words, lambda w: F.contains(F.lower(text), F.lower(w))))
