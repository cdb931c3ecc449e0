import bz2
import io
import zipfile

import pytest

from conftest import values
from quayside.examples.structured import build_workbook
from quayside.sources.frames import Files
from quayside.sources.workbook import (
    NamedRange,
    SheetOption,
    WorkbookRanges,
    WorkbookUnion,
    cell_position,
    column_number,
)


def with_shared_strings(book: bytes, part: str, body: str, strings: list[str]) -> bytes:
    """The workbook with one part's rows replaced and a shared string table added."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            content = old.read(name)
            if name == part:
                content = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
            new.writestr(name, content)
        items = "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in strings)
        new.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return out.getvalue()


BODY = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row>'
    '<row r="3"><c r="A3"><v>0</v></c><c r="B3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c><c r="E3" t="s"><v>2</v></c></row>'
    '<row r="4"><c r="B4"><v>1.50</v></c><c r="C4" t="b"><v>1</v></c><c r="D4"><v>8</v></c><c r="E4" t="e"><v>#N/A</v></c></row>'
    '<row r="6"><c r="C6" t="str"><v>calc</v></c><c r="E6" t="inlineStr"><is><t>in</t></is></c></row>'
    '<row r="9"><c r="B9"><v>9</v></c></row>'
)
BOOK = with_shared_strings(build_workbook({"Sheet1": []}), "xl/worksheets/sheet1.xml", BODY, ["Amount", "Flag", "Note"])


def test_addresses():
    assert [column_number(c) for c in ("A", "Z", "AA", "AZ", "BA", "XFD")] == [1, 26, 27, 52, 53, 16384]
    assert cell_position("$b$12") == (12, 2)
    with pytest.raises(ValueError):
        cell_position("12B")


@pytest.mark.parametrize("packed", [False, True])
def test_ranges(spark, land, packed):
    name, content = ("a.xlsx.bz2", bz2.compress(BOOK)) if packed else ("a.xlsx", BOOK)
    folder = land({name: content, "~$a.xlsx": b"lock"})
    ranges = [
        NamedRange("open", "B3", True),
        NamedRange("closed", "B4", False, end="D6"),
        NamedRange("named", "B4", False, end="C4", sheet="Sheet1", header_columns=["x", "y"]),
        NamedRange("absent", "A1", True, sheet="Nope", required=False),
    ]
    frames = WorkbookRanges("s", ranges).read(spark, Files([folder]))
    by_type = {f.tokens["type"]: f for f in frames}
    assert by_type["open"].df.columns == ["Amount", "Flag", "Note", "meta_source_name"]
    assert values(by_type["open"].df) == [("1.50", "true", ""), ("9", None, None), (None, "calc", "in")]
    assert values(by_type["closed"].df) == [("1.50", "true", "8"), (None, "calc", None)]
    assert values(by_type["named"].df, "x", "y") == [("1.50", "true")]
    assert "absent" not in by_type or by_type["absent"].df.isEmpty()
    assert by_type["closed"].tokens == {
        "type": "closed", "sourceOffset": "B4:D6", "sheet": "Sheet1", "startCell": "B4", "endCell": "D6", "required": "true"
    }


def test_missing_required_sheet_is_an_error(spark, land):
    folder = land({"a.xlsx": BOOK})
    with pytest.raises(ValueError, match="Nope"):
        WorkbookRanges("s", [NamedRange("t", "A1", True, sheet="Nope")]).read(spark, Files([folder]))


def test_union_takes_the_first_matching_option(spark, land):
    def sheet(*rows):
        return [{f"A{n}": a, f"B{n}": b} for n, (a, b) in enumerate(rows, 1)]

    book = build_workbook(
        {
            "Jan 2024": sheet(("Id", "V #"), (1, "x")),
            "Feb 2024": sheet(("V #", "Id"), ("y", 2)),
            "Notes": sheet(("whatever", "z")),
            "Extra": sheet((3, "w")),
            "Mar 2024": [],
        }
    )
    options = [
        SheetOption(r"^(\w+) 2024$", "A1", True),
        SheetOption("2024", "A1", True, custom_name="never"),
        SheetOption("^Ex", "A1", False, custom_name="extra", columns=["Id", "V #"]),
    ]
    frame = WorkbookUnion("s", "Month", options).read(spark, Files([land({"a.xlsx": book})]))[0]
    assert values(frame.df, "id", "v_num", "month") == [("1", "x", "Jan"), ("2", "y", "Feb"), ("3", "w", "extra")]
    nothing = WorkbookUnion("s", "Month", [SheetOption("^Q", "A1", True)]).read(spark, Files([land({"a.xlsx": book})]))
    assert nothing[0].df.isEmpty()


def test_workbooks_of_other_layouts_give_other_frames(spark, land):
    def sheet(*rows):
        return [{f"A{n}": a, f"B{n}": b} for n, (a, b) in enumerate(rows, 1)]

    one = build_workbook({"Jan": sheet(("id", "v"), (1, "x")), "Feb": sheet(("v", "id"), ("y", 2)), "Mar": sheet(("other", "header"))})
    two = build_workbook({"Jan": sheet(("id", "w"), (3, "z"))})
    source = WorkbookUnion("s", "month", [SheetOption(".", "A1", True)])
    frames = source.read(spark, Files([land({"a.xlsx": one, "b.xlsx": two, "c.xlsx": one})]))
    got = {f.layout: values(f.df, "id", "month") for f in frames}
    assert got == {
        ("id", "meta_source_name", "month", "v"): [("1", "Jan"), ("1", "Jan"), ("2", "Feb"), ("2", "Feb")],
        ("id", "meta_source_name", "month", "w"): [("3", "Jan")],
    }
    mixed = build_workbook({"Jan": sheet(("id", "v"), (1, "x")), "Feb": sheet(("id", "w"), (1, "x"))})
    with pytest.raises(ValueError, match=r"mixed.xlsx differ in columns \['v', 'w'\]"):
        source.read(spark, Files([land({"mixed.xlsx": mixed}, root="other")]))


def test_a_large_workbook_is_read_in_bounded_memory():
    """200,000 rows of shared and inline texts: beyond the packed file and the strings, no more than some batches."""
    import tracemalloc

    import pandas as pd

    from quayside.sources import workbook

    count = 200_000
    body = "".join(f'<row r="{n}"><c r="A{n}" t="s"><v>{n % 20_000}</v></c><c r="B{n}"><v>{n}</v></c></row>' for n in range(1, count + 1))
    content = with_shared_strings(build_workbook({"Sheet1": []}), "xl/worksheets/sheet1.xml", body, [f"text number {n}" for n in range(20_000)])
    del body
    batch = pd.DataFrame({"meta_source_name": ["file:/a.xlsx"], "content": [content]})
    tracemalloc.start()
    try:
        rows, largest, last = 0, 0, None
        for part in workbook._unpack(iter([batch])):
            rows, largest, last = rows + len(part), max(largest, len(part)), part.iloc[-1]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == count and largest <= workbook.BATCH_ROWS
    assert list(last["cells"]) == [f"text number {count % 20_000}", str(count)]
    # all rows as texts would take over 60 MB
    assert peak < 12 << 20, peak
