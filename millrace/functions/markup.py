"""A scanner of HTML that only moves forward: its time grows with the length of a text, whatever is in it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

#: Elements that have no content.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text and never markup.
RAW_TAGS = frozenset("script style".split())

#: Where a tag, a comment or a declaration begins; any other `<` is text.
_BEGINS = re.compile(r"<(?:/?[a-zA-Z]|[!?/])")
#: A tag up to its `>`. No part gives back what it took, so it fails only where the text ends inside the tag.
_TAG = re.compile(
    r"""<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)
    (?P<attributes>(?>\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'>])[^\s>]++|(?=>)))?+)*+)
    (?P<empty>/)?>""",
    re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'>])[^\s>]++)|(?=>)))?+""")
_COMMENT_END = re.compile(r"--!?>")


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)


def scan(text: str, raw: frozenset[str] = RAW_TAGS) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes) in order: kinds are open, empty (closed in itself), close and text.

    Names are lower-case. Comments and declarations give nothing. The content of a
    raw element is one text, up to its closing tag or the end. A tag or a comment
    that the text ends in takes all that is left and gives nothing.
    """
    at, size = 0, len(text)
    while at < size:
        if text[at] == "<" and (tag := _TAG.match(text, at)):
            name, at = tag["name"].lower(), tag.end()
            if tag["close"]:
                yield "close", name, ""
                continue
            yield "empty" if tag["empty"] else "open", name, tag["attributes"]
            if name in raw and not tag["empty"]:
                end = _end_of(name).search(text, at)
                stop = end.start() if end else size
                if stop > at:
                    yield "text", text[at:stop], ""
                at = stop
            continue
        begins = _BEGINS.search(text, at)
        stop = begins.start() if begins else size
        if stop > at:
            yield "text", text[at:stop], ""
            at = stop
        elif text.startswith("<!--", at):
            if text.startswith((">", "->"), at + 4):
                at = text.index(">", at) + 1
            else:
                end = _COMMENT_END.search(text, at + 4)
                at = end.end() if end else size
        elif begins[0][-1].isalpha():  # the text ends in a tag
            return
        else:
            end = text.find(">", at)
            at = end + 1 if end >= 0 else size


def attributes(text: str) -> dict[str, str]:
    """Names and values of a tag's attributes, of which the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), double or single or bare)
    return found
