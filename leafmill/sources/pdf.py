"""A small reader of PDF files in plain Python: document information, encryption, pages with their text layer, characters and images.

It reads uncompressed and Flate-compressed objects and streams, object streams, simple fonts and fonts with a ToUnicode map. It renders nothing,
repairs nothing and doesn't decrypt; where the optional PDF library is installed, `files.pdf_pages` prefers that.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from typing import Any


class PdfError(ValueError):
    pass


@dataclass(frozen=True)
class Ref:
    number: int


@dataclass
class Stream:
    info: dict
    raw: bytes

    def data(self) -> bytes:
        kind = self.info.get("Filter")
        names = kind if isinstance(kind, list) else [kind] if kind else []
        out = self.raw
        for n in names:
            if n != "/FlateDecode":
                raise PdfError(f"filter {n}")
            out = zlib.decompressobj().decompress(out)
        return out


_SPACE = b"\0\t\n\f\r "
_TOKEN = re.compile(rb"[\0\t\n\f\r ]*(?:%[^\r\n]*[\0\t\n\f\r ]*)*(<<|>>|\[|\]|\(|<|/[^\0\t\n\f\r ()<>\[\]{}/%]*|[^\0\t\n\f\r ()<>\[\]{}/%]+|[{}])")
_REF = re.compile(rb"[\0\t\n\f\r ]+(\d+)[\0\t\n\f\r ]+R(?![A-Za-z])")
_ESCAPES = {ord("n"): 10, ord("r"): 13, ord("t"): 9, ord("b"): 8, ord("f"): 12}


class Parser:
    """Objects and operators one after another; names come with their slash, strings as bytes, operators as str."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def next(self) -> Any:
        m = _TOKEN.match(self.data, self.at)
        if not m:
            raise EOFError
        token, self.at = m[1], m.end()
        if token == b"<<":
            return self._dict()
        if token == b"[":
            out = []
            while (x := self.next()) != "]":
                out.append(x)
            return out
        if token == b"(":
            return self._literal()
        if token == b"<":
            end = self.data.index(b">", self.at)
            digits, self.at = re.sub(rb"[^0-9A-Fa-f]", b"", self.data[self.at : end]), end + 1
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if token[:1] == b"/":
            return re.sub(r"#([0-9A-Fa-f]{2})", lambda h: chr(int(h[1], 16)), token.decode("latin-1"))
        if token[:1] in b"+-.0123456789":
            try:
                number = float(token) if b"." in token else int(token)
            except ValueError:
                return token.decode("latin-1")
            ref = _REF.match(self.data, self.at) if isinstance(number, int) and number >= 0 else None
            if ref:
                self.at = ref.end()
                return Ref(number)
            return number
        return {"true": True, "false": False, "null": None}.get(token.decode("latin-1"), token.decode("latin-1"))

    def _dict(self) -> dict:
        out: dict[str, Any] = {}
        while (key := self.next()) != ">>":
            value = self.next()
            if value == ">>":
                break
            out[str(key).lstrip("/")] = value
        return out

    def _literal(self) -> bytes:
        d, i, depth, out = self.data, self.at, 1, bytearray()
        while i < len(d):
            c = d[i]
            if c == 92:  # a backslash
                i += 1
                c = d[i] if i < len(d) else 0
                if 48 <= c < 56:
                    octal = re.compile(rb"[0-7]{1,3}").match(d, i)
                    out.append(int(octal[0], 8) & 255)
                    i = octal.end()
                    continue
                if c not in b"\r\n":
                    out.append(_ESCAPES.get(c, c))
                elif d[i : i + 2] == b"\r\n":
                    i += 1
            else:
                depth += (c == 40) - (c == 41)
                if not depth:
                    break
                out.append(c)
            i += 1
        self.at = i + 1
        return bytes(out)


def _text(raw: Any) -> str:
    """A text string of a document: UTF-16 with its mark, else one byte a character."""
    if not isinstance(raw, bytes):
        return ""
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


@dataclass
class Page:
    text: str
    width: float
    chars: list[tuple[float, float]] = field(default_factory=list)
    images: int = 0


class Pdf:
    def __init__(self, data: bytes) -> None:
        if data[:5] != b"%PDF-":
            raise PdfError("no PDF header")
        self.data = data
        self.objects: dict[int, Any] = {}
        self.trailer: dict[str, Any] = {}
        for m in re.finditer(rb"(?<![0-9])(\d+)[\0\t\n\f\r ]+\d+[\0\t\n\f\r ]+obj\b", data):
            try:
                self.objects[int(m[1])] = self._object(m.end())
            except (EOFError, ValueError, RecursionError):
                continue
        for m in re.finditer(rb"\btrailer\b", data):
            try:
                got = Parser(data, m.end()).next()
            except (EOFError, ValueError):
                continue
            if isinstance(got, dict):
                self.trailer |= got
        for o in list(self.objects.values()):
            if isinstance(o, Stream) and o.info.get("Type") == "/XRef":
                self.trailer = {**o.info, **self.trailer}
        self.encrypted = "Encrypt" in self.trailer
        if not self.encrypted:
            for o in list(self.objects.values()):
                if isinstance(o, Stream) and o.info.get("Type") == "/ObjStm":
                    self._unpack(o)

    def _object(self, at: int) -> Any:
        p = Parser(self.data, at)
        value = p.next()
        m = re.compile(rb"[\0\t\n\f\r ]*stream\r?\n").match(self.data, p.at)
        if not isinstance(value, dict) or not m:
            return value
        n = value.get("Length")
        end = m.end() + n if isinstance(n, int) and self.data[m.end() + n : m.end() + n + 12].lstrip(_SPACE).startswith(b"endstream") else self.data.find(b"endstream", m.end())
        return Stream(value, self.data[m.end() : end if end >= 0 else len(self.data)])

    def _unpack(self, o: Stream) -> None:
        try:
            body, first = o.data(), int(self.get(o.info["First"]))
            heads = [int(x) for x in body[:first].split()]
            for number, at in zip(heads[::2], heads[1::2], strict=False):
                self.objects.setdefault(number, Parser(body, first + at).next())
        except (EOFError, ValueError, KeyError, zlib.error):
            return

    def get(self, x: Any) -> Any:
        for _ in range(50):
            if not isinstance(x, Ref):
                return x
            x = self.objects.get(x.number)
        return None

    def info(self) -> dict[str, str]:
        got = self.get(self.trailer.get("Info"))
        return {k: _text(self.get(v)) for k, v in got.items()} if isinstance(got, dict) and not self.encrypted else {}

    def page_objects(self) -> list[dict]:
        """The pages in order, each with what it inherits."""
        root = self.get(self.trailer.get("Root"))
        if not isinstance(root, dict):
            root = next((o for o in self.objects.values() if isinstance(o, dict) and o.get("Type") == "/Catalog"), {})
        out: list[dict] = []
        todo: list[tuple[Any, dict]] = [(root.get("Pages"), {})]
        seen: set[int] = set()
        while todo:
            ref, above = todo.pop()
            if isinstance(ref, Ref):
                if ref.number in seen:
                    continue
                seen.add(ref.number)
            node = self.get(ref)
            if not isinstance(node, dict):
                continue
            node = {**{k: v for k, v in above.items() if k in ("MediaBox", "Resources")}, **node}
            kids = self.get(node.get("Kids"))
            if isinstance(kids, list):
                todo += [(k, node) for k in reversed(kids)]
            elif node.get("Type") in ("/Page", None):
                out.append(node)
        return out

    def pages(self) -> list[Page]:
        if self.encrypted:
            raise PdfError("encrypted")
        return [self._page(p) for p in self.page_objects()]

    def _page(self, page: dict) -> Page:
        box = [self.get(x) for x in self.get(page.get("MediaBox")) or (0, 0, 612, 792)]
        res = self.get(page.get("Resources")) or {}
        fonts = {k: self._font(self.get(f) or {}) for k, f in (self.get(res.get("Font")) or {}).items()}
        shown = (self.get(x) for x in (self.get(res.get("XObject")) or {}).values())
        images = sum(isinstance(x, Stream) and x.info.get("Subtype") == "/Image" for x in shown)
        content = self.get(page.get("Contents"))
        parts = [self.get(c) for c in content] if isinstance(content, list) else [content]
        body = b"\n".join(p.data() for p in parts if isinstance(p, Stream))
        runs = _runs(body, fonts)
        return Page(_lines(runs), float(box[2]) - float(box[0]), [(x + k * w, size) for x, _, size, text, w in runs for k in range(len(text))], images)

    def _font(self, f: dict) -> tuple[int, dict[int, str]]:
        """(bytes a character, what each code means) of a font."""
        wide = 2 if f.get("Subtype") == "/Type0" else 1
        to = self.get(f.get("ToUnicode"))
        codes: dict[int, str] = {}
        if isinstance(to, Stream):
            body = to.data()
            hexes = lambda part: [bytes.fromhex(h.decode()) for h in re.findall(rb"<([0-9A-Fa-f]+)>", part) if len(h) % 2 == 0]
            said = lambda b: b.decode("utf-16-be", "replace")
            for part in re.findall(rb"beginbfchar(.*?)endbfchar", body, re.S):
                got = hexes(part)
                codes |= {int.from_bytes(a): said(b) for a, b in zip(got[::2], got[1::2], strict=False)}
            for part in re.findall(rb"beginbfrange(.*?)endbfrange", body, re.S):
                for a, z, b in zip(*[iter(hexes(part))] * 3, strict=False):
                    codes |= {int.from_bytes(a) + k: said(b[:-2] + (int.from_bytes(b[-2:]) + k).to_bytes(2)) for k in range(min(1 << 16, int.from_bytes(z) - int.from_bytes(a) + 1))}
        return wide, codes


def _runs(body: bytes, fonts: dict[str, tuple[int, dict[int, str]]]) -> list[tuple[float, float, float, str, float]]:
    """(x, y, size, text, width of a character) of each string shown, in the order of showing; a character is taken as half as wide as high."""
    p, stack, out = Parser(body), [], []
    font, size, lead = (1, {}), 0.0, 0.0
    x = y = line_x = line_y = 0.0
    scale = 1.0

    def show(raw: bytes) -> None:
        nonlocal x
        wide, codes = font
        parts = [raw[i : i + wide] for i in range(0, len(raw), wide)]
        text = "".join(codes.get(int.from_bytes(c), c.decode("latin-1") if wide == 1 else "") for c in parts)
        w = 0.5 * size * scale
        if text:
            out.append((x, y, size * scale, text, w))
        x += w * len(text)

    while True:
        try:
            t = p.next()
        except (EOFError, ValueError, IndexError):
            return out
        if not isinstance(t, str) or t.startswith("/"):
            stack.append(t)
            continue
        a, n = stack, [v for v in stack if isinstance(v, int | float) and not isinstance(v, bool)]
        if t == "BT":
            x = y = line_x = line_y = 0.0
            scale = 1.0
        elif t == "Tf" and len(a) > 1:
            font, size = fonts.get(str(a[-2]).lstrip("/"), (1, {})), float(a[-1])
        elif t in ("Td", "TD") and len(n) > 1:
            line_x, line_y = line_x + n[-2] * scale, line_y + n[-1] * scale
            x, y = line_x, line_y
            lead = -n[-1] if t == "TD" else lead
        elif t == "Tm" and len(n) > 5:
            scale = abs(n[-3]) or abs(n[-4]) or 1.0
            x, y = line_x, line_y = float(n[-2]), float(n[-1])
        elif t == "TL" and n:
            lead = n[-1]
        elif t in ("T*", "'", '"'):
            line_y -= lead * scale
            x, y = line_x, line_y
        if t in ("Tj", "'", '"') and a and isinstance(a[-1], bytes):
            show(a[-1])
        elif t == "TJ" and a and isinstance(a[-1], list):
            for v in a[-1]:
                if isinstance(v, bytes):
                    show(v)
                elif isinstance(v, int | float):
                    x -= v / 1000 * size * scale
                    if v < -200 and out:  # a gap as wide as a blank
                        out[-1] = (*out[-1][:3], out[-1][3] + " ", out[-1][4])
        elif t == "BI":  # an inline image
            end = p.data.find(b"EI", p.at)
            p.at = end + 2 if end >= 0 else len(p.data)
        stack = []


def _lines(runs: list[tuple[float, float, float, str, float]]) -> str:
    """Runs of about one height make a line, from left to right; lines come from the top down."""
    rows: list[list[tuple]] = []
    for r in sorted(runs, key=lambda r: -r[1]):
        if rows and abs(rows[-1][0][1] - r[1]) <= max(1.0, 0.3 * r[2]):
            rows[-1].append(r)
        else:
            rows.append([r])
    out = []
    for row in rows:
        said, end = "", None
        for x, _, size, text, w in sorted(row, key=lambda r: r[0]):
            said += (" " if end is not None and x - end > 0.2 * size and said[-1:] != " " else "") + text
            end = x + w * len(text)
        out.append(said.rstrip())
    return "\n".join(out)
