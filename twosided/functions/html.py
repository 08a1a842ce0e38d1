"""Fields of web pages held in an ``html`` column.

A small per-page helper on the standard library's parser runs inside Arrow batches; Spark distributes the pages, and
only the key and ``html`` columns reach Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Elements without an end tag: fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

#: Characters of pages after which the rows found so far are passed on.
BATCH_CHARS = 8 << 20


@dataclass(frozen=True)
class Step:
    """The ``nth`` descendant with a tag and, if given, a class (one of its classes or the whole attribute)."""

    tag: str
    cls: str | None = None
    nth: int = 0


@dataclass(frozen=True)
class Field:
    """The stripped text, or an attribute, of the node that the steps lead to; ``default`` where there is none.

    With ``label``, the steps lead on from the element that follows a node whose whole text is the label.
    """

    steps: Sequence[Step] = ()
    attribute: str | None = None
    label: Step | None = None
    label_text: str = ""
    default: str | None = "N/A"


@dataclass(eq=False)
class _Node:
    tag: str = ""
    attrs: dict = field(default_factory=dict)
    parts: list = field(default_factory=list)

    def walk(self) -> Iterator[_Node]:
        """All nodes inside, in document order; pages may be nested as deep as they like."""
        waiting = [part for part in reversed(self.parts) if isinstance(part, _Node)]
        while waiting:
            node = waiting.pop()
            yield node
            waiting.extend(part for part in reversed(node.parts) if isinstance(part, _Node))

    def matching(self, step: Step) -> Iterator[_Node]:
        for node in self.walk():
            classes = node.attrs.get("class") or ""
            if node.tag == step.tag and (step.cls is None or step.cls == classes or step.cls in classes.split()):
                yield node

    def at(self, step: Step) -> _Node | None:
        return next((node for i, node in enumerate(self.matching(step)) if i == step.nth), None)

    def text(self) -> str:
        found, waiting = [], list(reversed(self.parts))
        while waiting:
            part = waiting.pop()
            if isinstance(part, _Node):
                waiting.extend(reversed(part.parts))
            else:
                found.append(part)
        return "".join(found)


class _Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = _Node()
        self.open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        if any(node.tag == tag for node in self.open):
            while self.open.pop().tag != tag:
                pass

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def _after_label(root: _Node, spec: Field) -> _Node | None:
    """The first element after the labelled one, in document order and outside it."""
    inside: set[int] | None = None
    for node in root.walk():
        if inside is not None and id(node) not in inside:
            return node
        if inside is None and node.tag == spec.label.tag and node.text().strip() == spec.label_text:
            inside = {id(child) for child in node.walk()}
    return None


def _value(record: _Node, spec: Field) -> str | None:
    node: _Node | None = record if spec.label is None else _after_label(record, spec)
    for step in spec.steps:
        if node is None:
            break
        node = node.at(step)
    if node is None:
        return spec.default
    value = node.text().strip() if spec.attribute is None else node.attrs.get(spec.attribute)
    return spec.default if value is None else value


def page_records(
    df: DataFrame,
    keys: Sequence[str],
    fields: Mapping[str, Field],
    record: Step | None = None,
    within: Sequence[Step] = (),
    html: str = "html",
) -> DataFrame:
    """One row per ``record`` node of each page, with its ``place`` on the page (from 0) and the fields inside it.

    ``within`` leads to the part of the page to search; a page without it gives no rows. Without ``record`` each
    page gives one row. A null page gives none.
    """
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields])
    schema += ", place int, " + ", ".join(f"`{name}` string" for name in fields)

    def nodes(page: str) -> Iterator[_Node]:
        top: _Node | None = _Tree(page).root
        for step in within:
            top = top.at(step) if top is not None else None
        if top is not None:
            yield from [top] if record is None else top.matching(record)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, held = [], 0
            for *key, page in batch.itertuples(index=False, name=None):
                for place, node in enumerate(nodes(page)):
                    found.append((*key, place, *[_value(node, spec) for spec in fields.values()]))
                held += len(page)
                if held >= BATCH_CHARS:  # large pages are passed on before the batch has ended
                    yield pd.DataFrame(found, columns=[*keys, "place", *fields])
                    found, held = [], 0
            yield pd.DataFrame(found, columns=[*keys, "place", *fields])

    pages = df.select(*keys, html).filter(df[html].isNotNull())
    return pages.mapInPandas(extract, schema)


def page_fields(df: DataFrame, keys: Sequence[str], fields: Mapping[str, Field], html: str = "html") -> DataFrame:
    """One row per page with the fields of the whole page."""
    return page_records(df, keys, fields, html=html).drop("place")
