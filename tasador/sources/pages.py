"""Nodes of fetched pages.

The only step that needs Python workers: Spark has no HTML parser.  Pages stay
partitioned as they are read; every page is parsed whole, by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELDS = ["tag", "cls", "text", "href"]
NODE = T.StructType([T.StructField(n, T.StringType()) for n in _FIELDS])
_NODES = pa.list_(pa.struct([(n, pa.string()) for n in _FIELDS]))
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SILENT = {"script", "style"}
# A start tag ends an open sibling of these kinds, as browsers read it.
_ENDS = {
    "p": {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}


class _Nodes(HTMLParser):
    """Collects text, class and link of the wanted tags in document order."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.open = wanted, [], []

    def handle_starttag(self, tag, attrs):
        if self.open and self.open[-1][0] in _ENDS.get(tag, ()):
            self.open.pop()
        values = dict(attrs)
        node = None
        if tag in self.wanted:
            node = [tag, values.get("class"), [], values.get("href")]
            self.found.append(node)
        if tag not in _VOID:
            self.open.append((tag, node))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(t in _SILENT for t, _ in self.open[-1:]):
            for _, node in self.open:
                if node is not None:
                    node[2].append(data)


def page_nodes(pages: DataFrame, tags: Sequence[str], html: str = "html") -> DataFrame:
    """Pages with `nodes` in place of their html: the wanted nodes in document order, each (tag, cls, text, href).

    One row per page and all its other columns; every page is parsed once, and no
    row moves.
    """
    wanted, rest = set(tags), [c for c in pages.columns if c != html]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(len(rest)).to_pylist():
                parser = _Nodes(wanted)
                parser.feed(text or "")
                parser.close()
                found.append([{"tag": t, "cls": c, "text": "".join(parts).strip(), "href": h} for t, c, parts, h in parser.found])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(found, _NODES)], names=[*rest, "nodes"])

    schema = T.StructType([*[pages.schema[c] for c in rest], T.StructField("nodes", T.ArrayType(NODE))])
    return pages.select(*rest, html).mapInArrow(parse, schema)


def first_text(nodes: Column, tag: str) -> Column:
    """Text of the first node of a kind."""
    return F.get(F.filter(nodes, lambda n: n["tag"] == tag), F.lit(0))["text"]


def term_values(nodes: Column) -> Column:
    """Map from each term (dt) to the definition (dd) that follows it among the two; first one counts."""
    listed = F.filter(nodes, lambda n: n["tag"].isin("dt", "dd"))

    def pairs(own: Column) -> Column:
        def definition(e: Column, i: Column) -> Column:
            after = F.get(own, i + 1)
            return F.struct(e["text"].alias("k"), F.when((e["tag"] == "dt") & (after["tag"] == "dd"), after["text"]).alias("v"))

        return F.filter(F.transform(own, definition), lambda e: e["v"].isNotNull())

    def first(own: Column) -> Column:
        return F.filter(own, lambda e, i: ~F.exists(F.slice(own, F.lit(1), i), lambda earlier: earlier["k"] == e["k"]))

    # Lambda arguments are evaluated once; written out, each list would be built anew for every node.
    bound = F.transform(F.array(listed), pairs)
    return F.map_from_entries(F.get(F.transform(bound, first), F.lit(0)))
