"""Small trip files of every shape."""

from __future__ import annotations

import csv
import json
import os
import zipfile
from xml.sax.saxutils import escape

COLUMNS = (
    "transID payCardID payCardBank payCardName payCardSex payCardBirthDate corridorID corridorName "
    "direction tapInStops tapInStopsName tapInStopsLat tapInStopsLon stopStartSeq tapInTime "
    "tapOutStops tapOutStopsName tapOutStopsLat tapOutStopsLon stopEndSeq tapOutTime payAmount"
).split()


def trip(number: int, **changes) -> dict:
    row = {
        "transID": f"T{number}",
        "payCardID": 100 + number % 3,
        "payCardBank": "dki",
        "payCardName": "A, Person",
        "payCardSex": "F",
        "payCardBirthDate": 1990,
        "corridorID": "5",
        "corridorName": "A - B",
        "direction": 1,
        "tapInStops": "P1",
        "tapInStopsName": "One",
        "tapInStopsLat": -6.2,
        "tapInStopsLon": 106.8,
        "stopStartSeq": 1,
        "tapInTime": f"2023-04-{3 + number % 5:02d} 07:00:00",
        "tapOutStops": "P2",
        "tapOutStopsName": "Two",
        "tapOutStopsLat": -6.3,
        "tapOutStopsLon": 106.9,
        "stopEndSeq": 5,
        "tapOutTime": f"2023-04-{3 + number % 5:02d} 07:30:30",
        "payAmount": 3500.0,
    }
    return {**row, **changes}


def write_csv(path: str, rows: list[dict], columns=COLUMNS, headers=None) -> str:
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(headers or columns)
        writer.writerows([["" if r.get(c) is None else r[c] for c in columns] for r in rows])
    return path


def write_json_array(path: str, rows: list[dict]) -> str:
    with open(path, "w", encoding="utf-8") as out:
        json.dump(rows, out, indent=1)
    return path


def write_json_lines(path: str, rows: list[dict]) -> str:
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(json.dumps(row) + "\n" for row in rows)
    return path


def write_xlsx(path: str, rows: list[dict], columns=COLUMNS, headers=None) -> str:
    """A minimal workbook: shared texts for the header, inline texts and numbers in the cells."""
    headers = list(headers or columns)

    def cell(value):
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'

    head = "".join(f'<c t="s"><v>{n}</v></c>' for n in range(len(headers)))
    lines = "".join(f"<row>{''.join(cell(r.get(c)) for c in columns)}</row>" for r in rows)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    shared = "".join(f"<si><t>{escape(h)}</t></si>" for h in headers)
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
            '<sheet name="trips" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
            'Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{shared}</sst>')
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{main}"><sheetData><row>{head}</row>{lines}</sheetData></worksheet>',
        )
    return path


def new_folder(root: str, name: str) -> str:
    path = os.path.join(root, name)
    os.makedirs(path)
    return path
