"""Reading cards and fields off HTML, a page at a time, inside Arrow UDFs.

Spark has no HTML functions. These helpers only point at elements and return their raw
texts; what the texts mean is decided by column expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "parent", "kids")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []

    def below(self) -> Iterator[Node]:
        """Elements inside this one, in document order."""
        stack = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))

    def strings(self) -> Iterator[str]:
        stack = list(reversed(self.kids))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                if item.strip():
                    yield item.strip()
            elif item.tag not in UNSEEN:
                stack.extend(reversed(item.kids))

    def text(self, gap: str) -> str:
        return gap.join(self.strings())

    def has(self, name: str, part: str) -> bool:
        return part in (self.attrs.get(name) or "")

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def first(self, test) -> Node | None:
        return next((n for n in self.below() if test(n)), None)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _card_of(link: Node) -> Node:
    node = link.parent
    while node is not None:
        if node.tag in ("div", "li", "article") and "_hs" in node.classes():
            return node
        node = node.parent
    return link.parent or link


def _is_title(n: Node) -> bool:
    return n.attrs.get("data-test") == "store-title" or n.tag in ("h3", "h4") or "store-name" in n.classes()


def _is_rating(n: Node) -> bool:
    return any(n.has("aria-label", word) for word in ("Rating", "Rated", "Gewaardeerd"))


def store_links(html: str) -> list[dict]:
    """Links to stores with the texts of the card around each."""
    root = parse(html)
    links = [n for n in root.below() if n.tag == "a" and n.has("href", "/store/")]
    links = [n for n in links if n.attrs.get("data-testid") == "store-card"] or links
    about: dict[int, tuple] = {}
    out = []
    for link in links:
        card = _card_of(link)
        if id(card) not in about:
            title, label = card.first(_is_title), card.first(_is_rating)
            blocks = (n.text(" ") for n in card.below() if n.tag in ("span", "div", "p"))
            about[id(card)] = (
                title.text(" ") if title else "",
                label.attrs["aria-label"] if label else None,
                [t for t in blocks if any(ch.isdigit() for ch in t)],
            )
        title, label, texts = about[id(card)]
        out.append(
            {
                "href": link.attrs["href"], "title": title, "link_text": link.text(" "),
                "link_label": link.attrs.get("aria-label") or "", "rating_label": label, "texts": texts,
            }
        )
    return out


def store_cards(html: str) -> list[dict]:
    """Cards with a heading: its text and the first link."""

    def is_card(n: Node) -> bool:
        return n.attrs.get("data-testid") == "StoreCard" or "store-card" in n.classes() or n.tag == "article"

    def is_name(n: Node) -> bool:
        return n.tag in ("h2", "h3") or n.attrs.get("data-testid") == "StoreName" or "store-name" in n.classes()

    out = []
    for card in parse(html).below():
        if is_card(card):
            name = card.first(is_name)
            link = card.first(lambda n: n.tag == "a" and "href" in n.attrs)
            if name:
                out.append({"name": name.text(""), "href": (link.attrs["href"] or "") if link else ""})
    return out


def address_block(html: str) -> str | None:
    """Address button, or the first visible text around the word "info" with a digit in it."""

    def is_address(n: Node) -> bool:
        button = n.tag == "button" and (n.has("aria-label", "Address") or n.has("aria-label", "Adres"))
        return button or n.attrs.get("data-testid") == "store-info-address"

    root = parse(html)
    found = root.first(is_address)
    if found:
        return found.text(", ")
    for node in root.below():
        if node.tag not in UNSEEN and any(isinstance(k, str) and "info" in k.lower() for k in node.kids):
            text = node.text("")
            if len(text) > 10 and any(ch.isdigit() for ch in text):
                return text
    return None


def business_details(html: str) -> str | None:
    """First three paragraphs of the details block."""

    def is_details(n: Node) -> bool:
        if n.attrs.get("data-testid") == "business-details-content":
            return True
        return n.tag == "section" and n.first(lambda h: h.tag == "h2" and "details" in "".join(h.strings())) is not None

    block = parse(html).first(is_details)
    paragraphs = [n.text("") for n in block.below() if n.tag == "p"] if block else []
    return ", ".join(paragraphs[:3]) if paragraphs else None


def _per_page(read, returns: T.DataType):
    @F.pandas_udf(returns)
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([read(h) if h else None for h in html], dtype="object")

    return run


def _rows(*names: str) -> T.ArrayType:
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.ArrayType(T.StructType(fields))


LINKS = _rows("href", "title", "link_text", "link_label", "rating_label")
LINKS.elementType.add("texts", T.ArrayType(T.StringType()))

store_links_of = _per_page(store_links, LINKS)
store_cards_of = _per_page(store_cards, _rows("name", "href"))
address_block_of = _per_page(address_block, T.StringType())
business_details_of = _per_page(business_details, T.StringType())
