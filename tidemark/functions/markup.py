"""Readable text of wiki markup, in one scan with a stack of open brackets."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The marks of the markup, and the kinds of link that show no text.
_MARK = re.compile(
    r"<!--|-->|<nowiki\s*/>|<nowiki\s*>|<ref\b[^<>]*/>|<ref\b[^<>]*>|</ref\s*>|<[^<>]*>"
    r"|\{\{|\}\}|\{\||\|\}|\[\[|\]\]|\[(?=(?:https?|ftp)://)|\]|\||'{2,}|={2,}"
)
_HIDDEN_LINK = re.compile(r"\s*(?:file|image|category)\s*:", re.IGNORECASE)
_END_PLAIN = re.compile(r"</nowiki\s*>", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t\r\n]+")
_CLOSES = {"}}": "{{", "|}": "{|", "]]": "[[", "-->": "<!--", "]": "[", "</ref>": "<ref>"}
#: What is inside these is not shown.
_HIDDEN = ("{{", "{|", "<!--", "<ref>")


def _name(mark: str) -> str:
    low = mark.lower()
    if low.startswith("<ref"):
        return "" if low.endswith("/>") else "<ref>"
    return "</ref>" if low.startswith("</ref") else low


def plain_text(text: str | None) -> str | None:
    """Text without templates, tables, comments, references and tags; links as their caption.

    Brackets may be nested to any depth. A mark without its partner vanishes and
    what stands behind it stays; a closing mark closes the innermost open bracket
    of its kind, and those inside it count as unclosed. What is between ``nowiki``
    tags is taken as it is.
    """
    if text is None:
        return None
    # Each open bracket has the pieces behind it; pieces of a closed one go to the one outside, or nowhere.
    stack: list[tuple[str, list[str]]] = [("", [])]
    open_now: dict[str, int] = {}
    at = 0

    def fold() -> None:
        """The innermost bracket has no partner: its pieces stay."""
        name, pieces = stack.pop()
        open_now[name] -= 1
        stack[-1][1].append("".join(pieces).replace("\0", "|"))

    while True:
        m = _MARK.search(text, at)
        if m is None:
            break
        inside, mark = stack[-1], m[0]
        inside[1].append(text[at : m.start()])
        at, name = m.end(), _name(mark)
        if name == "-->" or not open_now.get("<!--"):
            if name.startswith("<nowiki") and not name.endswith("/>"):
                end = _END_PLAIN.search(text, at)
                inside[1].append(text[at : end.start()] if end else text[at:])
                at = end.end() if end else len(text)
            elif name == "|":
                # Where fields of a link end; elsewhere the sign itself.
                inside[1].append("\0" if inside[0] == "[[" else "|")
            elif name in _CLOSES:
                opener = _CLOSES[name]
                if open_now.get(opener):
                    while stack[-1][0] != opener:
                        fold()
                    pieces = "".join(stack.pop()[1])
                    open_now[opener] -= 1
                    stack[-1][1].append(_shown(opener, pieces))
                elif name == "]":
                    inside[1].append(mark)
                elif name == "|}":
                    inside[1].append("|}")
            elif name in ("{{", "{|", "[[", "<!--", "[", "<ref>"):
                stack.append((name, []))
                open_now[name] = open_now.get(name, 0) + 1
            elif name.startswith("<") and name:
                inside[1].append(" ")
    stack[-1][1].append(text[at:])
    while len(stack) > 1:
        fold()
    return _BLANKS.sub(" ", "".join(stack[0][1])).strip(" ")


def _shown(opener: str, pieces: str) -> str:
    if opener in _HIDDEN:
        return " "
    if opener == "[[":
        return "" if _HIDDEN_LINK.match(pieces) else pieces.rpartition("\0")[2]
    return pieces.partition(" ")[2]


@F.arrow_udf(StringType())
def _plain(texts: pa.Array) -> pa.Array:
    return pa.array([plain_text(t) for t in texts.to_pylist()], pa.string())


def strip_wiki(c: Column) -> Column:
    """Readable text of wiki markup of any nesting, a batch of texts at a time."""
    return _plain(c)
