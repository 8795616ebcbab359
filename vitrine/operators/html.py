"""Blocks of an HTML page, one row per matching element."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The parser travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have an end tag.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)


# Output of a batch of pages is passed on in parts of about this size.
_CHARS_PER_BATCH = 16 << 20


class _Blocks(HTMLParser):
    """Start and end offsets of the elements that match a tag and class."""

    def __init__(self, tag: str, css_class: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self._tag = tag.lower()
        self._class = css_class
        self._text = ""
        self._line_starts: list[int] = [0]
        self._open: list[tuple[str, list[int] | None]] = []
        self._names: Counter[str] = Counter()  # of the open elements
        self.spans: list[list[int]] = []

    def run(self, text: str) -> Iterator[str]:
        """Blocks one by one: nested ones together can be far larger than the page."""
        self._text = text
        at = text.find("\n")
        while at >= 0:
            self._line_starts.append(at + 1)
            at = text.find("\n", at + 1)
        self.feed(text)
        self.close()
        for start, end in self.spans:
            yield text[start : end if end >= 0 else len(text)]

    def _offset(self) -> int:
        line, column = self.getpos()
        return self._line_starts[line - 1] + column

    def _matches(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag != self._tag:
            return False
        if self._class is None:
            return True
        classes = (dict(attrs).get("class") or "").split()
        return self._class in classes or self._class == " ".join(classes)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        span = None
        if self._matches(tag, attrs):
            span = [self._offset(), -1]
            self.spans.append(span)
        if tag in _VOID:
            if span:
                span[1] = span[0] + len(self.get_starttag_text())
        else:
            self._open.append((tag, span))
            self._names[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._matches(tag, attrs):
            start = self._offset()
            self.spans.append([start, start + len(self.get_starttag_text())])

    def handle_endtag(self, tag: str) -> None:
        if not self._names[tag]:
            return
        start = self._offset()
        while self._open:
            name, span = self._open.pop()
            self._names[name] -= 1
            if span:
                # An element left open ends where the enclosing end tag begins.
                span[1] = self._text.find(">", start) + 1 if name == tag else start
            if name == tag:
                return


def html_blocks(
    df: DataFrame, tag: str, css_class: str | None = None, html_col: str = "html"
) -> DataFrame:
    """All ``tag`` elements of each page, nested ones too, in document order.

    ``css_class`` matches one class of the element or its whole class text. The page
    column is replaced by ``block_index`` and ``block`` (source text of the element);
    other columns stay. No shuffle: pages are parsed where they are read.
    """
    keep = [f for f in df.schema.fields if f.name != html_col]
    names = [f.name for f in keep]
    schema = T.StructType(
        [
            *keep,
            T.StructField("block_index", T.IntegerType()),
            T.StructField("block", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            numbers: list[int] = []
            texts: list[str] = []
            size = 0

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                columns = [batch.column(name).take(pa.array(rows, pa.int64())) for name in names]
                columns += [pa.array(numbers, pa.int32()), pa.array(texts, pa.string())]
                return pa.RecordBatch.from_arrays(columns, [*names, "block_index", "block"])

            for row, page in enumerate(batch.column(html_col).to_pylist()):
                if page is None:
                    continue
                for number, block in enumerate(_Blocks(tag, css_class).run(page)):
                    rows.append(row)
                    numbers.append(number)
                    texts.append(block)
                    size += len(block)
                    if size >= _CHARS_PER_BATCH:
                        yield flush()
                        rows, numbers, texts, size = [], [], [], 0
            if rows:
                yield flush()

    return df.mapInArrow(parse, schema)
