"""Small streaming HTML reader that writes Markdown."""

from __future__ import annotations

import re
from html.parser import HTMLParser

BLOCKS = {"p", "div", "article", "section", "header", "main", "aside", "table", "tr",
          "ul", "ol", "blockquote", "figure", "form", "body", "dl", "dt", "dd"}
VOID = {"br", "hr", "img", "input", "meta", "link"}


class MarkdownBuilder(HTMLParser):
    """Collects Markdown pieces while the parser walks the page."""

    def __init__(self, drop: tuple[str, ...], protect_pre: bool, unwrap: tuple[str, ...] = ()):
        """``drop`` tags lose their content, up to their own end or that of the element
        they stand in; ``unwrap`` tags lose only their marks."""
        super().__init__(convert_charrefs=True)
        self.drop, self.unwrap, self.protect_pre = set(drop), set(unwrap), protect_pre
        self.open: list[str] = []
        self.codes: dict[str, str] = {}
        self.out: list[str] = []
        self.skipping: int | None = None  # depth of the outermost dropped element
        self.pre: list[str] | None = None
        self.pre_depth = 0
        self.links: list[str] = []
        self.lists: list[int | None] = []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.open.append(tag)
        if tag in self.drop:
            if tag not in VOID and self.skipping is None:
                self.skipping = len(self.open)
            return
        if self.skipping is not None or tag in self.unwrap:
            return
        if self.pre is not None:
            self.pre_depth += tag == "pre"
            return
        if tag == "pre":
            self.pre, self.pre_depth = [], 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "code":
            self.out.append("`")
        elif tag == "a":
            self.links.append(dict(attrs).get("href") or "")
            self.out.append("[")
        elif tag == "li":
            number = self.lists[-1] if self.lists else None
            indent = "  " * max(0, len(self.lists) - 1)
            if number is None:
                self.out.append(f"\n{indent}* ")
            else:
                self.lists[-1] = number + 1
                self.out.append(f"\n{indent}{number}. ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "hr":
            self.out.append("\n\n---\n\n")
        elif tag == "img":
            found = dict(attrs)
            self.out.append(f"![{found.get('alt') or ''}]({found.get('src') or ''})")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag in BLOCKS:
            self.out.append("\n\n")
        if tag in ("ul", "ol"):
            self.lists.append(1 if tag == "ol" else None)

    def handle_endtag(self, tag):
        dropped = self.skipping is not None
        if tag in self.open:
            # The end of an element ends all that was left open in it.
            del self.open[len(self.open) - 1 - self.open[::-1].index(tag):]
            if dropped and len(self.open) < self.skipping:
                self.skipping = None
        if tag in self.drop or tag in self.unwrap or dropped and self.skipping is not None:
            return
        if tag == "pre" and self.pre is not None:
            self.pre_depth -= 1
            if not self.pre_depth:
                self._close_pre()
        elif self.pre is not None:
            return
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "code":
            self.out.append("`")
        elif tag == "a" and self.links:
            self.out.append(f"]({self.links.pop()})")
        elif tag in BLOCKS:
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            self.out.append("\n\n")

    def _close_pre(self):
        code, self.pre = "".join(self.pre), None
        if self.protect_pre:
            token = f"CODETOKEN{len(self.codes)}BLOCK"
            self.codes[token] = code
            self.out.append(f"\n\n{token}\n\n")
        else:
            self.out.append(f"\n\n```\n{code}\n```\n\n")

    def handle_data(self, data):
        if self.skipping is not None:
            return
        if self.pre is not None:
            self.pre.append(data)
        else:
            self.out.append(re.sub(r"[ \t\r\n\f]+", " ", data))

    def markdown(self) -> str:
        if self.pre is not None:
            self._close_pre()
        text = "".join(self.out)
        text = re.sub(r"[ \t]*\n[ \t]*(?=\n)", "\n", text)
        text = re.sub(r"[ \t]+\n", "\n", text)
        text = re.sub(r"\n{3,}", "\n\n", text)
        return re.sub(r"\n (?=\S)", "\n", text).strip()
