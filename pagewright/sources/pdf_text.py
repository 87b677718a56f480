"""Texts as PDF files: pages of lines in one font, with the character map that lets readers get the text back."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

SIZE, LEADING, MARGIN, WIDTH, HEIGHT = 10, 14, 40, 612, 792
#: Lines that one page holds.
LINES = (HEIGHT - 2 * MARGIN) // LEADING


def _flate(data: bytes, info: str = "") -> bytes:
    packed = zlib.compress(data)
    return f"<<{info}/Filter/FlateDecode/Length {len(packed)}>>\nstream\n".encode() + packed + b"\nendstream"


def _map(codes: dict[str, int]) -> bytes:
    """A character map from two-byte codes to their characters."""
    rows = [f"<{code:04x}><{c.encode('utf-16-be', 'surrogatepass').hex()}>" for c, code in codes.items()]
    parts = [rows[i : i + 100] for i in range(0, len(rows), 100)]
    body = "".join(f"{len(p)} beginbfchar\n" + "\n".join(p) + "\nendbfchar\n" for p in parts)
    return f"begincmap\n1 begincodespacerange\n<0000><ffff>\nendcodespacerange\n{body}endcmap\n".encode()


def text_pdf(pages: Sequence[Sequence[str]], packed: bool = False) -> bytes:
    """A file with these lines on its pages; with ``packed`` its objects are in object streams behind a cross-reference stream."""
    codes = {c: k + 1 for k, c in enumerate(sorted({c for lines in pages for line in lines for c in line}))}
    written = {ord(c): f"{code:04x}" for c, code in codes.items()}
    streams = {4: _flate(_map(codes))}
    plain = {
        1: "<</Type/Catalog/Pages 2 0 R>>", 2: f"<</Type/Pages/Count {len(pages)}/Kids[{' '.join(f'{5 + 2 * k} 0 R' for k in range(len(pages)))}]/MediaBox[0 0 {WIDTH} {HEIGHT}]/Resources<</Font<</F 3 0 R>>>>>>",
        3: "<</Type/Font/Subtype/Type0/BaseFont/F/Encoding/Identity-H/ToUnicode 4 0 R/DescendantFonts[<</Type/Font/Subtype/CIDFontType2/BaseFont/F/DW 500>>]>>",
    }
    for k, lines in enumerate(pages):
        shown = [f"<{line.translate(written)}> Tj T*" for line in lines]
        plain[5 + 2 * k] = f"<</Type/Page/Parent 2 0 R/Contents {6 + 2 * k} 0 R>>"
        streams[6 + 2 * k] = _flate("\n".join([f"BT /F {SIZE} Tf {LEADING} TL {MARGIN} {HEIGHT - MARGIN - SIZE} Td", *shown, "ET"]).encode())
    out, places = bytearray(b"%PDF-1.5\n"), {}
    last = 5 + 2 * len(pages)
    if packed:
        heads, body = [], ""
        for number, value in plain.items():
            heads.append(f"{number} {len(body)}")
            body += value + " "
        head = " ".join(heads) + " "
        streams[last] = _flate((head + body).encode(), f"/Type/ObjStm/N {len(plain)}/First {len(head)}")
    for number, value in sorted((streams if packed else streams | {k: v.encode() for k, v in plain.items()}).items()):
        places[number] = len(out)
        out += f"{number} 0 obj\n".encode() + value + b"\nendobj\n"
    start = len(out)
    if packed:
        inside = {number: k for k, number in enumerate(plain)}
        rows = [(0, 0, 0)] + [(2, last, inside[k]) if k in inside else (1, places[k], 0) for k in range(1, last + 1)] + [(1, start, 0)]
        table = b"".join(bytes([a]) + b.to_bytes(4, "big") + c.to_bytes(2, "big") for a, b, c in rows)
        out += f"{last + 1} 0 obj\n".encode() + _flate(table, f"/Type/XRef/W[1 4 2]/Size {last + 2}/Root 1 0 R") + b"\nendobj\n"
    else:
        out += f"xref\n0 {last}\n0000000000 65535 f \n".encode() + b"".join(f"{places[k]:010d} 00000 n \n".encode() for k in range(1, last)) + f"trailer\n<</Size {last}/Root 1 0 R>>\n".encode()
    return bytes(out + f"startxref\n{start}\n%%EOF\n".encode())
