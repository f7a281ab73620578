"""Excel workbooks (.xlsx) as rows of text, read inside tasks with the standard library.

Spark has no built-in Excel source. One workbook is one unit of work: its XML
is parsed as a stream, rows leave the task in batches.
"""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_CELL = re.compile(r"^([A-Z]+)([0-9]+)$")
_ADDRESS = re.compile(r"^(?:'?(?P<sheet>.*?)'?!)?(?P<col>[A-Za-z]+)?(?P<row>[0-9]+)?(?::(?P<col2>[A-Za-z]+)(?P<row2>[0-9]+))?$")
# built-in number formats that show a date or a time
_DATE_FORMATS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47])
_EPOCH = dt.datetime(1899, 12, 30)

# reader option names that mean the same
_ALIASES = {
    "useheader": "header",
    "header": "header",
    "inferschema": "inferSchema",
    "infer_schema": "inferSchema",
    "sheetname": "sheetName",
    "sheet_name": "sheetName",
}
_DEFAULTS = {"header": "true", "inferSchema": "false", "maxRowsInMemory": "1000", "excerptSize": "10"}


def excel_options(options: dict[str, str] | None) -> dict[str, str]:
    given = {_ALIASES.get(k.strip().lower(), k): v for k, v in (options or {}).items()}
    return {**_DEFAULTS, **given}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column(letters: str) -> int:
    n = 0
    for ch in letters.upper():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, el in ET.iterparse(f):
            if _local(el.tag) == "si":
                out.append("".join(t.text or "" for t in el.iter() if _local(t.tag) == "t"))
                el.clear()
    return out


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    custom = set()
    for el in root.iter():
        if _local(el.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", el.get("formatCode", ""))
            if re.search(r"[ymdhs]", code, re.I):
                custom.add(int(el.get("numFmtId")))
    styles = set()
    for xfs in (el for el in root.iter() if _local(el.tag) == "cellXfs"):
        for i, xf in enumerate(xfs):
            if int(xf.get("numFmtId", 0)) in _DATE_FORMATS | custom:
                styles.add(i)
    return styles


def _sheet_file(book: zipfile.ZipFile, wanted: str | None) -> str:
    root = ET.fromstring(book.read("xl/workbook.xml"))
    sheets = [(el.get("name"), el.get(_REL)) for el in root.iter() if _local(el.tag) == "sheet"]
    rels = {el.get("Id"): el.get("Target") for el in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for name, rid in sheets:
        if wanted is None or name == wanted:
            target = rels[rid]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"Unknown sheet {wanted}")


def _number(text: str, is_date: bool) -> str:
    value = float(text)
    if is_date:
        when = _EPOCH + dt.timedelta(seconds=round(value * 86400))
        return when.strftime("%Y-%m-%d" if value == int(value) else "%Y-%m-%d %H:%M:%S")
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)


def _value(cell: ET.Element, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
    raw = next((el.text for el in cell if _local(el.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind == "n":
        return _number(raw, int(cell.get("s", 0)) in dates)
    return raw


def sheet_rows(source, options: dict[str, str]) -> Iterator[list[str | None]]:
    """The rows of one sheet, as wide as their last cell; rows without any cell are left out."""
    address = _ADDRESS.match(options.get("dataAddress") or "A1")
    if address is None:
        raise ValueError(f"dataAddress not understood: {options['dataAddress']}")
    first_col = _column(address["col"] or "A")
    first_row = int(address["row"] or 1)
    last_col = _column(address["col2"]) if address["col2"] else None
    last_row = int(address["row2"]) if address["row2"] else None
    with zipfile.ZipFile(source) as book:
        shared, dates = _shared_strings(book), _date_styles(book)
        with book.open(_sheet_file(book, options.get("sheetName") or address["sheet"] or None)) as f:
            number = 0
            for _, el in ET.iterparse(f):
                if _local(el.tag) != "row":
                    continue
                number = int(el.get("r", number + 1))
                cells: dict[int, str | None] = {}
                position = -1
                for cell in el:
                    at = _CELL.match(cell.get("r", ""))
                    position = _column(at[1]) if at else position + 1
                    if position >= first_col and (last_col is None or position <= last_col):
                        cells[position - first_col] = _value(cell, shared, dates)
                el.clear()
                if number < first_row or (last_row is not None and number > last_row) or not cells:
                    continue
                yield [cells.get(i) for i in range(max(cells) + 1)]


def header_names(first: list[str | None], header: bool) -> list[str]:
    """Column names of a sheet: from its first row, blank ones and repeats made unique."""
    if not header:
        return [f"_c{i}" for i in range(len(first))]
    names: list[str] = []
    for i, name in enumerate(first):
        name = (name or "").strip() or f"_c{i}"
        names.append(name if name.lower() not in {n.lower() for n in names} else f"{name}{i}")
    return names
