"""Page outlines: the one Python stage that reads HTML.

``outline`` turns each page into two arrays and stops there:

* ``texts`` - the stripped, non-empty runs of text in document order;
* ``nodes`` - the elements in document order, as nested sets: element ``pos``
  covers nodes ``pos+1 .. stop-1`` and texts ``t0 .. t1-1``; ``ctr`` is its nearest
  enclosing article, div or li (-1 if none); ``own`` is the text that comes first
  among its direct children (-1 if that is blank, NULL if there is none).  Elements
  that are the ``ctr`` of some link are numbered from 0 in ``box``; such a link
  carries the same number.

What counts as a title, a description or a paragraph is decided afterwards by
Catalyst expressions over these arrays (``listing``, ``article``), page by page and
without a shuffle.
"""

from __future__ import annotations

import html.parser
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.functions import fixed_values as fv

_NUMBERS = ("pos", "stop", "t0", "t1", "ctr", "own", "box")
_ATTRS = ("cls", "href", "datetime", "itemprop", "rel")
NODE = T.StructType(
    [T.StructField("tag", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in _ATTRS]
    + [T.StructField(n, T.IntegerType()) for n in _NUMBERS]
)
# Rows are handed back to the JVM whenever this much HTML has been read, so a batch of
# very long pages cannot pile up in the Python worker.
_FLUSH_CHARS = 4_000_000
_VOID, _OUTLINED = frozenset(fv.VOID_TAGS), frozenset(fv.OUTLINED_TAGS)
_SILENT, _ENCLOSING = frozenset(fv.SILENT_TAGS), frozenset(fv.ENCLOSING_TAGS)

# Markup that can be read in one way only: tags with double-quoted or bare attributes,
# comments without inner dashes, a simple document type.
_PLAIN_MARKUP = re.compile(
    r"<(?:(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_:][-\w:.]*(?:=\"[^\"]*\")?)*)[ \t\n\r\f]*(/?)>"
    r"|!--(?!-?>)(?:[^-]|-(?!-))*-->|!DOCTYPE[^<>\"'\[]*>)",
    re.ASCII | re.IGNORECASE,
)
_PLAIN_ATTR = re.compile(r'([a-zA-Z_:][-\w:.]*)(?:="([^"]*)")?', re.ASCII)
_RAW_TEXT = {tag: re.compile(rf"</{tag}", re.IGNORECASE) for tag in ("script", "style")}
_OWN_TEXT = frozenset(("textarea", "title"))
_UNUSUAL = frozenset(("iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"))
_unescape_value = getattr(html.parser, "_unescape_attrvalue", unescape)


class _PageReader(HTMLParser):
    """Fills flat per-field lists; one instance reads many pages in turn."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: dict[str, list] = {f.name: [] for f in NODE.fields}
        self.texts: list[str] = []

    def read(self, page: str, plainly: bool = True) -> None:
        """Read a page; ``plainly`` tries the short way first, with the same outcome."""
        self._begin()
        if not (plainly and self._read_plain(page)):
            if plainly:
                self.undo()
                self._begin()
            self.feed(page)
            self.close()
        self._end_text()
        while self.open:
            self._pop()

    def _begin(self) -> None:
        self.reset()
        self.first_node, self.first_text = len(self.nodes["tag"]), len(self.texts)
        self.open: list[tuple[str, int, int]] = []  # tag, node position, container for children
        self.open_count: Counter[str] = Counter()
        self.silent = self.boxes = 0
        self.pending: list[str] = []

    def _read_plain(self, page: str) -> bool:
        """Read a page made of plain markup only, at twice the speed.

        Gives up at the first piece of markup that leaves room for interpretation;
        the library parser then reads the page from the start.
        """
        end, own_text = 0, None
        while found := _PLAIN_MARKUP.search(page, end):
            start = found.start()
            if start > end:
                text = page[end:start]
                if "<" in text:
                    return False
                self.pending.append(unescape(text) if "&" in text else text)
            end = found.end()
            closing, tag, attrs, closed = found.groups()
            if own_text and not (closing and tag and tag.lower() == own_text):
                return False
            own_text = None
            if tag is None:
                self._end_text()
                continue
            tag = tag.lower()
            if closing:
                if attrs or closed:
                    return False
                self.handle_endtag(tag)
                continue
            if tag in _UNUSUAL:
                return False
            pairs = [
                (name.lower(), _unescape_value(value) if "&" in value else value)
                for name, value in (_PLAIN_ATTR.findall(attrs) if attrs else ())
            ]
            self._push(tag, pairs)
            if closed or tag in _VOID:
                self._pop()
            elif tag in _OWN_TEXT:
                own_text = tag
            elif tag in _RAW_TEXT:
                stop = _RAW_TEXT[tag].search(page, end)
                if stop is None or page[stop.end() : stop.end() + 1] != ">":
                    return False
                end = stop.start()
        rest = page[end:]
        if "<" in rest or own_text:
            return False
        if rest:
            self.pending.append(unescape(rest))
        return True

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def undo(self) -> None:
        """Forget what a failed page has left behind."""
        for values in self.nodes.values():
            del values[self.first_node:]
        del self.texts[self.first_text:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._push(tag, attrs)
        if tag in _VOID:
            self._pop()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self._push(tag, attrs)
        self._pop()

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if self.open_count[tag]:  # an end tag without an open partner is ignored
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def handle_decl(self, decl: str) -> None:
        self._end_text()

    def handle_pi(self, data: str) -> None:
        self._end_text()

    def unknown_decl(self, data: str) -> None:
        self._end_text()
        if data[:6].upper() == "CDATA[":
            self.pending.append(data[6:])
            self._end_text()

    def _end_text(self) -> None:
        if self.pending:
            text = "".join(self.pending).strip()
            self.pending.clear()
            parent = self.open[-1][1] if self.open else -1
            if parent >= 0 and self.nodes["own"][self.first_node + parent] is None:
                shown = text and not self.silent
                self.nodes["own"][self.first_node + parent] = len(self.texts) - self.first_text if shown else -1
            if text and not self.silent:
                self.texts.append(text)

    def _push(self, tag: str, attrs: list) -> None:
        if self.pending:
            self._end_text()
        given = {k: v or "" for k, v in attrs} if attrs else {}
        container = self.open[-1][2] if self.open else -1
        pos = -1
        if tag in _OUTLINED or "class" in given or "itemprop" in given:
            n = self.nodes
            pos = len(n["tag"]) - self.first_node
            cls = given.get("class")
            n["tag"].append(tag)
            n["cls"].append(None if cls is None else " ".join(cls.split()))
            for name in _ATTRS[1:]:
                n[name].append(given.get(name))
            n["pos"].append(pos)
            n["t0"].append(len(self.texts) - self.first_text)
            n["ctr"].append(container)
            n["stop"].append(None)
            n["t1"].append(None)
            n["own"].append(None)
            n["box"].append(self._box_of(container) if tag == "a" and "href" in given else None)
        self.open.append((tag, pos, pos if tag in _ENCLOSING else container))
        self.open_count[tag] += 1
        if tag in _SILENT:
            self.silent += 1

    def _box_of(self, container: int) -> int | None:
        if container < 0:
            return None
        boxes, at = self.nodes["box"], self.first_node + container
        if boxes[at] is None:
            boxes[at] = self.boxes
            self.boxes += 1
        return boxes[at]

    def _pop(self) -> str:
        tag, pos, _ = self.open.pop()
        self.open_count[tag] -= 1
        self.silent -= tag in _SILENT
        if pos >= 0:
            self.nodes["stop"][self.first_node + pos] = len(self.nodes["tag"]) - self.first_node
            self.nodes["t1"][self.first_node + pos] = len(self.texts) - self.first_text
        return tag


def _outline_batches(batches: Iterator[pa.RecordBatch], html: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = batch.column(html)
        kept = [name for name in batch.schema.names if name != html]
        start = 0
        while start < batch.num_rows:
            reader, errors = _PageReader(), []
            node_ends, text_ends, chars, stop = [0], [0], 0, start
            while stop < batch.num_rows and chars < _FLUSH_CHARS:
                page = pages[stop].as_py() or ""
                try:
                    reader.read(page)
                    errors.append(None)
                except Exception as failure:  # noqa: BLE001 - reported per page, counted by callers
                    reader.undo()
                    errors.append(f"{type(failure).__name__}: {failure}")
                node_ends.append(len(reader.nodes["tag"]))
                text_ends.append(len(reader.texts))
                chars += len(page)
                stop += 1
            part = batch.slice(start, stop - start)
            structs = pa.StructArray.from_arrays(
                [
                    pa.array(reader.nodes[f.name], pa.int32() if f.name in _NUMBERS else pa.string())
                    for f in NODE.fields
                ],
                names=NODE.names,
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(name) for name in kept]
                + [
                    pa.array(errors, pa.string()),
                    pa.ListArray.from_arrays(pa.array(text_ends, pa.int32()), pa.array(reader.texts, pa.string())),
                    pa.ListArray.from_arrays(pa.array(node_ends, pa.int32()), structs),
                ],
                names=[*kept, "error", "texts", "nodes"],
            )
            start = stop


def outline(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML column by ``error``, ``texts`` and ``nodes``; other columns pass through.

    Select only the columns wanted later before calling this: all of them travel
    through Python.
    """
    fields = [f for f in pages.schema.fields if f.name != html] + [
        T.StructField("error", T.StringType()),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("nodes", T.ArrayType(NODE)),
    ]
    return pages.mapInArrow(lambda it: _outline_batches(it, html), T.StructType(fields))


# --- reading outlines ----------------------------------------------------------


def first(nodes: Column, wanted) -> Column:
    """The first node for which ``wanted`` holds, NULL if there is none."""
    return F.get(F.filter(nodes, wanted), F.lit(0))


def inner_text(node: Column, sep: str = "", texts: Column | None = None) -> Column:
    """Text of an element: tight (``sep=''``) or spaced (``sep=' '``); NULL for no element."""
    texts = F.col("texts") if texts is None else texts
    return F.when(
        node.isNotNull(),
        F.array_join(F.slice(texts, node["t0"] + 1, node["t1"] - node["t0"]), sep),
    )


def has_class(node: Column, name: str) -> Column:
    """The class list holds exactly this name."""
    return F.coalesce(F.contains(F.concat(F.lit(" "), node["cls"], F.lit(" ")), F.lit(f" {name} ")), F.lit(False))


def class_like(node: Column, pattern: str) -> Column:
    """Some class matches the pattern; False where there is no class."""
    return F.coalesce(node["cls"].rlike(pattern), F.lit(False))


def inside(node: Column, outer: Column) -> Column:
    return (node["pos"] > outer["pos"]) & (node["pos"] < outer["stop"])
