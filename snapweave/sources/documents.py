"""Tables inside documents: HTML tables as ragged rows, evacuee tables from HTML and from PDF matrices, HTTP bytes."""

from __future__ import annotations

import re
import time
import unicodedata
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Words of the evacuee tables.
NAME_HEADER, COUNT_HEADER, ADDRESS_HEADER, TOTAL_WORD = "避難所名", "避難者数", "住所", "合計"
FACILITY_MARKERS = ("○", "△", "×", "〇", "✕")
CITY_PREFIX = "八代市"


class _Tables(HTMLParser):
    """Tables of a page as lists of rows of cell texts; rows without text are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None

    def _end_cell(self):
        if self.cell is not None and self.row is not None:
            self.row.append(" ".join("".join(self.cell).split()))
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row and any(self.row) and self.tables:
            self.tables[-1].append(self.row)
        self.row = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._end_row()
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self._end_row()
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            self.cell = []
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def tables_of(page: str) -> list[list[list[str]]]:
    parser = _Tables()
    parser.feed(page or "")
    parser.close()
    parser._end_row()
    return parser.tables


def html_tables(pages: DataFrame, key: str, column: str) -> DataFrame:
    """key, table_idx, row_idx, cells of every table row of each page; Arrow batches, one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, t, r, cells) for k, page in zip(b.column("_key").to_pylist(), b.column("_page").to_pylist(), strict=True) for t, table in enumerate(tables_of(page)) for r, cells in enumerate(table)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], b.schema.field("_key").type), pa.array([x[1] for x in rows], pa.int32()), pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.string()))], names=[key, "table_idx", "row_idx", "cells"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("_key"), F.col(column).cast("string").alias("_page")).mapInArrow(run, f"`{key}` {kind}, table_idx int, row_idx int, cells array<string>")


@dataclass(frozen=True)
class EvacueeTable:
    """Records (name, address, count) and the published total of a source."""

    records: list[tuple[str, str, int]]
    total: int | None
    method: str


def _clean(value) -> str:
    return " ".join(unicodedata.normalize("NFKC", str(value or "")).split())


def _count(value: str) -> int | None:
    bare = _clean(value).replace(",", "")
    return int(bare) if re.fullmatch(r"[0-9]+", bare) else None


def evacuees_from_html(page: str) -> EvacueeTable:
    """The first table whose header names shelter and evacuees; a total is required and must agree.

    Rows without a whole number of people are left out; the total may stand in a row or in the page's text.
    """
    for table in tables_of(page):
        header = next((r for r in table if any(NAME_HEADER in _clean(c) for c in r) and any(COUNT_HEADER in _clean(c) for c in r)), None)
        if header is None:
            continue
        place = {w: next((i for i, c in enumerate(header) if w in _clean(c)), None) for w in (NAME_HEADER, COUNT_HEADER, ADDRESS_HEADER)}
        records, total = [], None
        for row in table[table.index(header) + 1 :]:
            cells = [_clean(c) for c in row]
            if any(c.replace(" ", "") == TOTAL_WORD for c in cells):
                total = next((n for c in reversed(cells) if (n := _count(c)) is not None), total)
            elif len(cells) > max(x for x in place.values() if x is not None) and cells[place[NAME_HEADER]]:
                n = _count(cells[place[COUNT_HEADER]])
                if n is not None:
                    records.append((cells[place[NAME_HEADER]], cells[place[ADDRESS_HEADER]] if place[ADDRESS_HEADER] is not None else "", n))
        if total is None:
            found = re.search(r"合\s*計\s*[:：]?\s*([0-9,]+)", _clean(re.sub(r"<[^>]*>", " ", page)))
            total = _count(found[1]) if found else None
        return _agreed(EvacueeTable(records, total, "html_table"))
    raise ValueError("no evacuee table")


def _agreed(table: EvacueeTable) -> EvacueeTable:
    calculated = sum(n for _, _, n in table.records)
    if table.total is None:
        raise ValueError("no published total")
    if calculated != table.total:
        raise ValueError(f"records sum to {calculated}, published {table.total}")
    return table


@dataclass(frozen=True)
class MatrixSchema:
    name: int
    address: int | None
    count: int
    method: str


def detect_schema(matrix: list[list[str]]) -> MatrixSchema:
    """Columns of a ruled table, from its first data row: the count stands before the first condition mark,
    else under its header, else where the known layouts have it; the address is there if its value says so.
    """
    rows = [[_clean(c) for c in r] for r in matrix]
    data = next((r for r in rows if r and r[0].isdigit()), None)
    if data is None or len(data) < 3:
        raise ValueError("no data row")
    heads: dict[int, str] = {}
    for r in rows[: rows.index(data)]:
        for i, c in enumerate(r):
            heads[i] = heads.get(i, "") + c.replace(" ", "")
    mark = next((i for i, c in enumerate(data) if c.replace(" ", "") in FACILITY_MARKERS), None)
    headed = next((i for i, h in sorted(heads.items()) if COUNT_HEADER in h), None)
    if mark is not None and mark >= 3:
        count, method = mark - 1, "marker_boundary"
    elif headed is not None and headed > 1 and headed < len(data) and re.fullmatch(r"[0-9,]+", data[headed]):
        count, method = headed, "header"
    else:
        count, method = (6 if len(data) >= 11 else 5), "layout"
    if count >= len(data) or count < 2 or not re.fullmatch(r"[0-9,]+", data[count]):
        raise ValueError("no count column")
    return MatrixSchema(1, 2 if data[2].startswith(CITY_PREFIX) else None, count, method)


def evacuees_from_matrix(tables: list[list[list[str]]]) -> EvacueeTable:
    """The table with most numbered rows; row numbers are taken once; the total is required and must agree."""
    numbered = lambda t: sum(bool(r) and _clean(r[0]).isdigit() for r in t)
    table = max(tables, key=numbered, default=[])
    schema = detect_schema(table)
    records, seen, total = [], set(), None
    for row in table:
        cells = [_clean(c) for c in row]
        if any(c.replace(" ", "").startswith(TOTAL_WORD) for c in cells):
            total = _count(cells[schema.count]) if schema.count < len(cells) else None
            total = total if total is not None else next((n for c in cells if (n := _count(c)) is not None), None)
        elif cells and cells[0].isdigit() and cells[0] not in seen and schema.count < len(cells):
            n = _count(cells[schema.count])
            if n is None:
                raise ValueError(f"no count in row {cells[0]}")
            seen.add(cells[0])
            records.append((cells[schema.name], cells[schema.address] if schema.address is not None else "", n))
    return _agreed(EvacueeTable(records, total, schema.method))


_LINE = re.compile(r"^\s*([0-9]+)\s+(.+?)\s+([0-9,]+)\s*$")


def evacuees_from_lines(lines: list[str]) -> EvacueeTable:
    """Text lines `number name count`; a row number counts once; the total line is required and must agree."""
    records, seen, total = [], set(), None
    for line in map(_clean, lines):
        if line.replace(" ", "").startswith(TOTAL_WORD):
            total = next((_count(w) for w in reversed(line.split()) if _count(w) is not None), None)
        elif (m := _LINE.match(line)) and m[1] not in seen:
            seen.add(m[1])
            records.append((m[2], "", _count(m[3])))
    return _agreed(EvacueeTable(records, total, "lines"))


_ADAPTERS = {"html": lambda v: evacuees_from_html(v), "matrix": evacuees_from_matrix, "lines": evacuees_from_lines}


def register_adapter(name: str, parse) -> None:
    """Put another parser in place of, or beside, the known ones."""
    _ADAPTERS[name] = parse


def parse_source(kind: str, value) -> EvacueeTable:
    return _ADAPTERS[kind](value)


def evacuee_records(pages: DataFrame, key: str, column: str) -> DataFrame:
    """Records of evacuee pages: key, shelter_name, address, evacuee_count, published_total, error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, page in zip(b.column("_key").to_pylist(), b.column("_page").to_pylist(), strict=True):
                try:
                    t = parse_source("html", page or "")
                    rows += [(k, n, a, c, t.total, None) for n, a, c in t.records]
                except ValueError as e:
                    rows.append((k, None, None, None, None, str(e)))
            types = [b.schema.field("_key").type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[key, "shelter_name", "address", "evacuee_count", "published_total", "error"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("_key"), F.col(column).cast("string").alias("_page")).mapInArrow(run, f"`{key}` {kind}, shelter_name string, address string, evacuee_count long, published_total long, error string")


def backoff(attempt: int, most: float = 15.0, factor: float = 2.0) -> float:
    return min(most, factor * attempt)


def fetch(url: str, timeout: float = 90.0, retries: int = 5, sleep=time.sleep) -> bytes:
    """Bytes of a URL, with retries after growing pauses; a last failure is raised."""
    for attempt in range(1, retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "snapweave"}), timeout=timeout) as r:
                return r.read()
        except OSError:
            if attempt == retries:
                raise
            sleep(backoff(attempt))
    raise ValueError("retries must be positive")


class _Url(InputPartition):
    def __init__(self, url: str):
        self.url = url


class HttpReader(DataSourceReader):
    def __init__(self, options):
        self.urls, self.timeout, self.retries = options["urls"].split(), float(options.get("timeout", 90)), int(options.get("retries", 5))

    def partitions(self):
        return [_Url(u) for u in self.urls]

    def read(self, partition):
        yield partition.url, fetch(partition.url, self.timeout, self.retries)


class HttpSource(DataSource):
    """`http_bytes`: one partition and row (url, content) for each of the option's URLs."""

    @classmethod
    def name(cls):
        return "http_bytes"

    def schema(self):
        return "url string, content binary"

    def reader(self, schema):
        return HttpReader(self.options)


def is_pdf(content) -> object:
    """Whether binary content begins like a PDF."""
    return F.hex(F.substring(content, 1, 4)) == "25504446"


def first_pdf(candidates, get=fetch, attempts: int = 12, pause: float = 45.0, sleep=time.sleep) -> tuple[str, bytes]:
    """The first of the ranked URLs whose content is a PDF; the round is repeated after a pause."""
    for attempt in range(attempts):
        for url in candidates:
            try:
                content = get(url)
            except OSError:
                continue
            if content[:4] == b"%PDF":
                return url, content
        if attempt + 1 < attempts:
            sleep(pause)
    raise ValueError("no candidate is a PDF")
