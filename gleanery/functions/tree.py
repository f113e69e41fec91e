"""Small per-page helper: the elements of an HTML body that the extraction jobs read.

Only what needs a tree happens here. Normalising, numbering, commands, links, labels and
totals are column expressions over what comes out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# A start tag ends an open element of these kinds, up to the nearest barrier.
IMPLIED = {
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "li": ({"li"}, {"ul", "ol"}),
    "option": ({"option"}, {"select"}),
}
ROW_ID = re.compile(r"([^:]+):([^:]+):(\d+):")  # fixed pattern: form:iterator:N:component
TOKEN = "javax.faces.ViewState"  # fixed value: the view token's field
NOT_SUBMITTED = frozenset({"submit", "button", "image", "reset", "file"})


class Node:
    __slots__ = ("tag", "attrs", "parent", "kids")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def walk(self):
        """Elements below this one, in document order, without recursion."""
        stack = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))

    def text(self) -> str:
        out, stack = [], list(reversed(self.kids))
        while stack:
            kid = stack.pop()
            if isinstance(kid, str):
                out.append(kid)
            else:
                stack.extend(reversed(kid.kids))
        return "".join(out)

    def up(self, tag):
        node = self
        while node is not None and node.tag != tag:
            node = node.parent
        return node


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        closes, barrier = IMPLIED.get(tag, ((), ()))
        node, last = self.at, None
        while closes and node.parent is not None and node.tag not in barrier:
            last = node if node.tag in closes else last
            node = node.parent
        if last is not None:
            self.at = last.parent
        found: dict[str, str] = {}
        for name, value in attrs:
            found.setdefault(name, "" if value is None else value)
        child = Node(tag, found, self.at)
        self.at.kids.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        match = self.at.up(tag) if tag not in VOID else None
        if match is not None and match.parent is not None:
            self.at = match.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(body: str | None) -> Node:
    builder = _Builder()
    builder.feed(body or "")
    builder.close()
    return builder.root


def _cells(node: Node) -> list[str]:
    return [k.text() for k in node.kids if isinstance(k, Node) and k.tag == "td"]


def headers(root: Node) -> list[str]:
    return [n.text() for n in root.walk() if n.tag == "th" and n.up("thead") is not None]


def indexed_rows(root: Node) -> list[dict]:
    rows = []
    for tr in root.walk():
        if tr.tag == "tr" and "data-ri" in tr.attrs:
            clicks = (n.attrs["onclick"] for n in tr.walk() if n.tag == "a" and "onclick" in n.attrs)
            rows.append({"mark": tr.attrs["data-ri"], "cells": _cells(tr), "onclick": next(clicks, None)})
    return rows


def named_rows(root: Node) -> list[dict]:
    first: dict[str, tuple[str, Node]] = {}  # by digits without leading zeros: a number may have any length
    for node in root.walk():
        match = ROW_ID.match(node.attrs.get("id", node.attrs.get("name", "")))
        if match:
            first.setdefault(match[3].lstrip("0") or "0", (match[2], node))
    rows = []
    for number in sorted(first, key=lambda digits: (len(digits), digits)):
        iterator, node = first[number]
        box = node.up("tr") or node.up("div") or node.parent
        clicks = (n.attrs["onclick"] for n in box.walk() if "jsfcljs" in n.attrs.get("onclick", ""))
        rows.append({"number": number, "iterator": iterator, "cells": _cells(box), "text": box.text(), "onclick": next(clicks, None)})
    return rows


def controls(root: Node) -> list[dict]:
    out = []
    for n in root.walk():
        if n.tag in ("input", "button", "a"):
            label = n.attrs.get("value", n.attrs.get("title"))
            out.append({"tag": n.tag, "label": n.text() if label is None else label, "onclick": n.attrs.get("onclick"), "href": n.attrs.get("href")})
    return out


def _submitted(field: Node) -> list[str]:
    """Values a browser would post for one named field."""
    if field.tag == "textarea":
        return [field.text()]
    if field.tag == "select":
        options = [n for n in field.walk() if n.tag == "option"]
        chosen = [n for n in options if "selected" in n.attrs]
        if "multiple" not in field.attrs:
            chosen = (chosen or options)[:1]
            if not chosen:
                return [""]
        return [n.attrs.get("value", n.text()) for n in chosen]
    kind = field.attrs.get("type", "text").lower()
    if kind in NOT_SUBMITTED or (kind in ("checkbox", "radio") and "checked" not in field.attrs):
        return []
    return [field.attrs.get("value", "")]


def forms(root: Node, url: str) -> list[dict]:
    out = []
    for form in root.walk():
        if form.tag != "form" or "id" not in form.attrs:
            continue
        fields: dict[str, list[str]] = {}
        token = None
        for f in form.walk():
            name = f.attrs.get("name", "")
            if f.tag not in ("input", "select", "textarea") or name == "" or "disabled" in f.attrs:
                continue
            if name == TOKEN or name.endswith(":" + TOKEN):
                token = f.attrs.get("value", "").strip() or token
                continue
            for value in _submitted(f):
                fields.setdefault(name, []).append(value)
        out.append({
            "form_id": form.attrs["id"],
            "action": urljoin(url, form.attrs.get("action", url)),
            "fields": [{"name": n, "values": v} for n, v in fields.items()],
            "token": token,
        })
    return out


def page_token(root: Node) -> str | None:
    found = (n.attrs.get("value") for n in root.walk() if n.tag == "input" and n.attrs.get("name", "").endswith("faces.ViewState"))
    return next(found, None)


def paginator_text(root: Node) -> str | None:
    found = (n.text() for n in root.walk() if "ui-paginator-current" in n.attrs.get("class", "").split())
    return next(found, None)
