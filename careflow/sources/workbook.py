"""Workbook scan: ``.xlsx`` files to rows, one task per group of files.

Python only unzips and reads cells; which column is which field is settled once per
sheet, so rows leave the task already in one layout and everything after is columnar.
"""

from __future__ import annotations

import io
import math
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.functions.naming import clean_name, clean_names, locate, quoted
from careflow.operators.projection import FIELD_PREFIX, MISSING
from careflow.schemas import ROW_IDX, SOURCE_FILE
from careflow.shipping import ship
from careflow.sources.tables import literal_path

# One marker row per sheet (and per unreadable file) has this number instead of a row's.
MARKER = -1
BATCH_ROWS = 4096
# The limits of a sheet.
MAX_ROWS, MAX_COLUMNS = 1_048_576, 16_384
SCAN_SCHEMA = (
    f"{SOURCE_FILE} string, sheet string, {ROW_IDX} bigint, header array<string>, "
    f"cells array<string>, {MISSING} array<string>, error string"
)

# Cell text that means missing.
NA_TEXT = frozenset((
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
))
# Built-in number formats that show dates or times.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))


@dataclass(frozen=True)
class Layout:
    """Columns wanted from a sheet: fields found by keyword, then columns by name.

    ``fields`` maps a field to its lookup; ``columns`` are matched after cleaning;
    ``required`` names fields whose absence is reported in ``_missing``.
    """

    fields: Mapping[str, Sequence]
    columns: tuple[str, ...] = ()
    required: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [FIELD_PREFIX + f for f in self.fields] + list(self.columns)

    def positions(self, header: Sequence[str]) -> tuple[list[int | None], list[str]]:
        """For each wanted column its place in the header, and the required ones lacking."""
        cleaned = clean_names(header)
        found = {f: locate(cleaned, lookup) for f, lookup in self.fields.items()}
        at = {name: i for i, name in reversed(list(enumerate(cleaned)))}
        places = [at.get(found[f]) for f in self.fields]
        places += [at.get(clean_name(c)) for c in self.columns]
        return places, [f for f in self.required if found.get(f) is None]


def list_workbooks(spark: SparkSession, directory: str, pattern: str = "*.xlsx") -> DataFrame:
    """Files whose name matches the glob; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return files.select("path", "length", "modificationTime")


def scan_workbooks(
    spark: SparkSession,
    directory: str | Sequence[str],
    pattern: str = "*.xlsx",
    layouts: Mapping[str, Layout] | None = None,
) -> DataFrame:
    """All rows of the sheets in ``layouts`` (of every sheet, as it is, without layouts).

    A row has its cells in layout order.  Every sheet and every unreadable file gives a
    marker row.  ``directory`` may be a list of files instead.  ``_missing`` lists the sheets and required fields that the row's file
    lacks.  A bad file or sheet never fails the job: it is reported in ``error``.
    """
    ship(spark)
    wanted = None if layouts is None else dict(layouts)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _batches(_workbook_rows(path, content, wanted))

    places = directory if isinstance(directory, str) else [literal_path(f) for f in directory]
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(places)
    return files.select("path", "content").mapInPandas(read, SCAN_SCHEMA)


def widen(scan: DataFrame, layouts: Mapping[str, Layout]) -> DataFrame:
    """Cells as named text columns, those of all sheets side by side.

    Stored by sheet, a column that a sheet does not have takes no room, and readers get
    column pruning and pushed filters.
    """
    places: dict[str, dict[str, int]] = {}
    for sheet, layout in layouts.items():
        for i, name in enumerate(layout.names):
            places.setdefault(name, {})[sheet] = i

    def cell(where: Mapping[str, int]) -> Column:
        by_place: dict[int, list[str]] = {}
        for sheet, i in where.items():
            by_place.setdefault(i, []).append(sheet)
        return F.coalesce(*[
            F.when(F.col("sheet").isin(*sheets), F.get("cells", F.lit(i)))
            for i, sheets in by_place.items()
        ])

    return scan.select(
        SOURCE_FILE, "sheet", ROW_IDX, MISSING, "error",
        *[cell(where).alias(name) for name, where in places.items()],
    )


def sheet_table(wide: DataFrame, sheet: str, layout: Layout) -> DataFrame:
    """The rows of one sheet with the columns of its layout."""
    rows = wide.filter((F.col("sheet") == sheet) & (F.col(ROW_IDX) != MARKER))
    return rows.select(SOURCE_FILE, ROW_IDX, MISSING, *map(quoted, layout.names))


def any_sheet(scan: DataFrame, sheet: str, columns: Sequence[str]) -> DataFrame:
    """Columns of a sheet scanned without a layout, found by exact header text."""
    rows = scan.filter((F.col("sheet") == sheet) & (F.col(ROW_IDX) != MARKER))
    place = {c: F.array_position("header", F.lit(c)) for c in columns}
    return rows.select(
        SOURCE_FILE, ROW_IDX,
        *[F.when(p > 0, F.get("cells", p.cast("int") - 1)).alias(c) for c, p in place.items()],
    )


def _batches(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in SCAN_SCHEMA.split(", ")]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield pd.DataFrame(held, columns=names)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names)


def _workbook_rows(
    path: str, content: bytes, layouts: Mapping[str, Layout] | None
) -> Iterator[tuple]:
    try:
        book = _Workbook(content)
        sheets = [s for s in (book.sheets if layouts is None else layouts) if s in book.sheets]
    except Exception as problem:  # whatever is wrong with the file, the job goes on
        lacking = list(layouts or ())
        yield path, None, MARKER, None, None, lacking, f"{type(problem).__name__}: {problem}"
        return
    errors: dict[str, str] = {}
    for sheet in sheets:
        # Checked before the first row leaves, so that a sheet is all there or not at all.
        try:
            book.check(sheet)
        except Exception as problem:
            errors[sheet] = f"{type(problem).__name__}: {problem}"
    lacking = [s for s in layouts or () if s not in sheets or s in errors]
    for sheet in sheets:
        if sheet in errors:
            yield path, sheet, MARKER, None, None, lacking, errors[sheet]
            continue
        table = book.rows(sheet)
        header = next(table, [])
        layout = (layouts or {}).get(sheet)
        if layout is None:
            yield path, sheet, MARKER, header, None, lacking, None
            for i, cells in enumerate(table):
                yield path, sheet, i, header, cells, lacking, None
        else:
            places, absent = layout.positions(header)
            missing = lacking + absent
            yield path, sheet, MARKER, header, None, missing, None
            for i, cells in enumerate(table):
                kept = [None if p is None or p >= len(cells) else cells[p] for p in places]
                yield path, sheet, i, None, kept, missing, None
    if not sheets:
        yield path, None, MARKER, None, None, lacking, None


class _Workbook:
    """Sheets of one zipped workbook, read cell by cell as text."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        links = {
            e.get("Id"): e.get("Target") for e in self._elements("xl/_rels/workbook.xml.rels")
        }
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        self.sheets: dict[str, str] = {}
        for e in book.iter():
            if _tag(e) == "sheet":
                link = next(v for k, v in e.attrib.items() if k.endswith("}id"))
                target = links[link]
                self.sheets[e.get("name")] = (
                    target.lstrip("/") if target.startswith("/") else f"xl/{target}"
                )
        properties = next((e for e in book.iter() if _tag(e) == "workbookPr"), None)
        old_mac = properties is not None and properties.get("date1904") in ("1", "true")
        self.epoch = datetime(1904, 1, 1) if old_mac else datetime(1899, 12, 30)
        self.strings = [
            _shown(e) for e in self._elements("xl/sharedStrings.xml") if _tag(e) == "si"
        ]
        self.date_styles = self._date_styles()

    def _elements(self, part: str) -> Iterator[ElementTree.Element]:
        if part in self.zip.namelist():
            yield from ElementTree.fromstring(self.zip.read(part))

    def _date_styles(self) -> frozenset[int]:
        custom, styles = set(), []
        for block in self._elements("xl/styles.xml"):
            if _tag(block) == "numFmts":
                for e in block:
                    shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", ""))
                    if re.search("[ymdhs]", shown, re.IGNORECASE):
                        custom.add(int(e.get("numFmtId")))
            elif _tag(block) == "cellXfs":
                styles = [int(e.get("numFmtId", 0)) for e in block]
        return frozenset(i for i, f in enumerate(styles) if f in DATE_FORMATS or f in custom)

    def check(self, sheet: str) -> None:
        """Raise when a sheet's part is missing, damaged or not well-formed."""
        with self.zip.open(self.sheets[sheet]) as part:
            expat.ParserCreate().ParseFile(part)

    def rows(self, sheet: str) -> Iterator[list[str | None]]:
        """The header, then data rows; blank rows count only between filled ones."""
        header: list[str | None] | None = None
        expected = 0
        with self.zip.open(self.sheets[sheet]) as part:
            above: list[ElementTree.Element] = []
            for event, e in ElementTree.iterparse(part, events=("start", "end")):
                if event == "start":
                    above.append(e)
                    continue
                above.pop()
                if _tag(e) != "row":
                    continue
                number = _whole(e.get("r"), expected + 1)
                if not expected < number <= MAX_ROWS:
                    number = expected + 1
                cells = self._cells(e)
                # What has been read is released: a row hangs on the element above it.
                above[-1].clear()
                if all(c is None for c in cells):
                    continue
                if header is None:
                    header = [f"Unnamed: {i}" if c is None else c for i, c in enumerate(cells)]
                    yield header
                else:
                    for _ in range(expected, number - 1):
                        yield [None] * len(header)
                    yield cells
                expected = number

    def _cells(self, row: ElementTree.Element) -> list[str | None]:
        cells: list[str | None] = []
        for c in row:
            if _tag(c) != "c":
                continue
            place = _column_number(c.get("r") or "", len(cells))
            if place >= MAX_COLUMNS:
                continue
            cells.extend([None] * (place + 1 - len(cells)))
            cells[place] = self._value(c)
        return cells

    def _value(self, c: ElementTree.Element) -> str | None:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            text = "".join(_shown(part) for part in c if _tag(part) == "is")
        else:
            text = next((v.text for v in c if _tag(v) == "v"), None)
        if text is None or kind == "e":
            return None
        if kind == "s":
            place = _whole(text, -1)
            text = self.strings[place] if 0 <= place < len(self.strings) else ""
        elif kind == "b":
            text = "True" if text == "1" else "False"
        elif kind == "n":
            return self._number(text, _whole(c.get("s"), 0))
        return None if text in NA_TEXT else text

    def _number(self, text: str, style: int) -> str | None:
        try:
            value = float(text)
        except ValueError:
            return None
        if style in self.date_styles:
            try:
                return str(self.epoch + timedelta(seconds=round(value * 86400)))
            except (OverflowError, ValueError):
                return None
        if not math.isfinite(value):
            return None
        if value.is_integer() and abs(value) < 1e15:
            return str(int(value))
        return repr(value)


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _shown(e: ElementTree.Element) -> str:
    """Text of a string item: its own and that of its runs, without readings (phonetic runs)."""
    parts = [t for part in e for t in (part if _tag(part) == "r" else (part,)) if _tag(t) == "t"]
    return "".join(t.text or "" for t in parts)


def _whole(text: str | None, default: int) -> int:
    """Attributes of a damaged file must not stop a job."""
    try:
        return default if text is None else int(text)
    except ValueError:
        return default


def _column_number(reference: str, default: int) -> int:
    """Zero-based column of a cell reference such as ``AB7``."""
    number = 0
    for ch in reference[:4]:
        if not "A" <= ch.upper() <= "Z":
            break
        number = number * 26 + ord(ch.upper()) - 64
    return number - 1 if number else default
