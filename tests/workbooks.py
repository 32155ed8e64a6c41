"""Write tiny .xlsx files for tests (the engine itself writes no workbooks)."""

import zipfile
from xml.sax.saxutils import escape

CONTENT = "http://schemas.openxmlformats.org/package/2006/content-types"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


class Date(float):
    """A number shown as a date."""


def _letter(i):
    name = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        name = chr(65 + r) + name
    return name


def write_workbook(path, sheets, shared=True, damage=None):
    """``sheets``: {name: [header, row, ...]}; a row that is None is left out."""
    strings = []

    def cell(r, c, value):
        ref = f"{_letter(c)}{r}"
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, Date):
            return f'<c r="{ref}" s="1"><v>{float(value)!r}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value!r}</v></c>'
        if shared:
            strings.append(value)
            return f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'

    parts = {}
    for n, (name, rows) in enumerate(sheets.items(), 1):
        body = "".join(
            f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>"
            for r, row in enumerate(rows, 1) if row is not None
        )
        xml = f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'
        parts[f"xl/worksheets/sheet{n}.xml"] = xml[: len(xml) // 2] if name == damage else xml
    names = "".join(
        f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>'
        for n, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{n}" Type="{RELS}/worksheet" Target="worksheets/sheet{n}.xml"/>'
        for n in range(1, len(sheets) + 1)
    )
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>{names}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{PKG}">{links}</Relationships>'
    parts["xl/sharedStrings.xml"] = (
        f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>"
    )
    parts["xl/styles.xml"] = (
        f'<styleSheet xmlns="{MAIN}"><numFmts count="1">'
        '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
    )
    parts["[Content_Types].xml"] = f'<Types xmlns="{CONTENT}"/>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, xml in parts.items():
            z.writestr(name, xml)


def edit_part(path, name, change):
    """Rewrite one part of a workbook."""
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    parts[name] = change(parts[name])
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for n, xml in parts.items():
            z.writestr(n, xml)
