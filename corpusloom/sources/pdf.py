"""Text of PDF files with the standard library alone: a reader for `extract.pdf_pages`.

Objects are found by their headers, whatever the cross-reference says, and in object
streams; content streams may be plain, Flate or ASCII-hex coded. Text comes from the
show operators, by the font's ToUnicode table where it has one, else as Latin-1; a new
line starts where the position moves down or to a new line. Encrypted files, and fonts
whose codes mean glyphs without a table, are beyond it: pass another reader for those.
"""

from __future__ import annotations

import re
import zlib

# Fixed values of the format.
_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b")
_STREAM = re.compile(rb"stream\r?\n")
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\]()]*|[-+]?[0-9]*\.?[0-9]+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _decoded(head: bytes, data: bytes) -> bytes:
    names = re.findall(rb"/(FlateDecode|ASCIIHexDecode)", head.split(b"/DecodeParms")[0])
    for name in names:
        data = zlib.decompressobj().decompress(data) if name == b"FlateDecode" else bytes.fromhex(re.sub(rb"[^0-9A-Fa-f]", b"", data.split(b">")[0]).decode())
    return data


def _objects(data: bytes) -> dict[int, tuple[bytes, bytes]]:
    """Per object number, what stands before its stream, and the stream."""
    out: dict[int, tuple[bytes, bytes]] = {}
    found = list(_OBJECT.finditer(data))
    at = 0
    for m in found:
        if m.start() < at:  # inside a stream
            continue
        end = data.find(b"endobj", m.end())
        stream = _STREAM.search(data, m.end(), end if end >= 0 else len(data))
        if stream:
            head = data[m.end() : stream.start()]
            size = re.search(rb"/Length\s+(\d+)(?!\s+\d+\s+R)", head)
            stop = stream.end() + int(size[1]) if size and data[stream.end() + int(size[1]) :].lstrip()[:9] == b"endstream" else data.find(b"endstream", stream.end())
            stop = len(data) if stop < 0 else stop
            body, at = data[stream.end() : stop], stop
            try:
                out[int(m[1])] = head, _decoded(head, body)
            except (zlib.error, ValueError):
                out[int(m[1])] = head, b""
        else:
            at = len(data) if end < 0 else end
            out[int(m[1])] = data[m.end() : at], b""
    for head, body in list(out.values()):
        if b"/ObjStm" in head and body:
            n, first = (int(re.search(rb"/" + k + rb"\s+(\d+)", head)[1]) for k in (b"N", b"First"))
            numbers = [int(x) for x in body[:first].split()][: 2 * n]
            places = numbers[1::2] + [len(body) - first]
            for number, a, b in zip(numbers[::2], places, places[1:]):
                out.setdefault(number, (body[first + a : first + b], b""))
    return out


def _to_unicode(table: bytes) -> dict[bytes, str]:
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    out: dict[bytes, str] = {}
    for part in re.findall(rb"beginbfchar(.*?)endbfchar", table, re.S):
        for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part):
            out[bytes.fromhex(a.decode())] = text(b)
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", table, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(<[0-9A-Fa-f]+>|\[[^\]]*\])", part):
            low, high, size = int(a, 16), int(b, 16), len(a) // 2
            if c.startswith(b"["):
                targets = [text(x) for x in re.findall(rb"<([0-9A-Fa-f]+)>", c)]
            else:
                start = text(c[1:-1])
                targets = [start[:-1] + chr(ord(start[-1]) + k) for k in range(min(high - low, 65535) + 1)] if start else []
            for k, t in enumerate(targets[: high - low + 1]):
                out[(low + k).to_bytes(size, "big")] = t
    return out


def _string(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1]).decode()
        return bytes.fromhex(digits + "0" * (len(digits) % 2))
    return re.sub(rb"\\([nrtbf()\\]|[0-7]{1,3}|\r?\n)", lambda m: _ESCAPES.get(m[1]) or (bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1].strip() == b"" else m[1]), token[1:-1])


def _shown(raw: bytes, font: dict[bytes, str] | None) -> str:
    if not font:
        return raw.decode("latin-1")
    size, out, i = max(map(len, font)), [], 0
    while i < len(raw):
        for k in range(size, 0, -1):
            if raw[i : i + k] in font:
                out.append(font[raw[i : i + k]])
                break
        else:
            k = size
        i += k
    return "".join(out)


def _page_text(content: bytes, fonts: dict[bytes, dict[bytes, str]]) -> str:
    out, stack, font = [], [], None

    def line() -> None:
        if out and not out[-1].endswith("\n"):
            out.append("\n")

    for m in _TOKEN.finditer(content):
        t = m[0]
        if t[:1] in b"(<[]/" or t[:1].isdigit() or t[:1] in b"+-.":
            stack.append(t)
            continue
        if t == b"Tf" and len(stack) > 1:
            font = fonts.get(stack[-2][1:])
        elif t in (b"Td", b"TD") and len(stack) > 1 and float(stack[-1]) or t in (b"T*", b"'", b'"', b"Tm", b"BT"):
            line()
        if t in (b"Tj", b"TJ", b"'", b'"'):
            start = len(stack) - 1 - stack[::-1].index(b"[") if t == b"TJ" and b"[" in stack else len(stack) - 1
            for x in stack[max(0, start) :]:
                if x[:1] in b"(<":
                    out.append(_shown(_string(x), font))
                elif t == b"TJ" and x[:1] in b"+-.0123456789" and float(x) < -200:  # a gap as wide as a space
                    out.append(" ")
        if t not in (b"true", b"false", b"null"):
            stack = []
    line()
    return "".join(out)


def pages(data: bytes) -> list[str]:
    """The texts of a file's pages in order; a page without text is ''."""
    objects = _objects(data)
    head = lambda n: objects.get(n, (b"", b""))[0]

    def value(of: bytes, key: bytes) -> bytes:
        """What follows a key: the object that is referred to, or the rest of the dictionary."""
        m = re.search(rb"/" + key + rb"(?![A-Za-z])\s*", of)
        if not m:
            return b""
        ref = _REF.match(of, m.end())
        return head(int(ref[1])) if ref else of[m.end() :]

    root = next((h for h, _ in objects.values() if re.search(rb"/Type\s*/Catalog\b", h)), b"")
    top = re.search(rb"/Pages\s+(\d+)\s+\d+\s+R", root)
    order, todo, seen = [], [(int(top[1]), b"")] if top else [], set()
    while todo:
        n, inherited = todo.pop()
        if n in seen:
            continue
        seen.add(n)
        own = head(n)
        if b"/Resources" in own:
            inherited = own
        kids = re.search(rb"/Kids\s*\[([^\]]*)\]", own)
        if kids:
            todo += [(int(k), inherited) for k in reversed(_REF.findall(kids[1]))]
        elif own:
            order.append((own, inherited))
    out = []
    for own, inherited in order:
        fonts = {}
        listed = value(value(inherited, b"Resources"), b"Font")
        for name, n in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", listed.split(b">>")[0]):
            table = re.search(rb"/ToUnicode\s+(\d+)\s+\d+\s+R", head(int(n)))
            if table:
                fonts[name] = _to_unicode(objects.get(int(table[1]), (b"", b""))[1])
        contents = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", own)
        streams = [objects.get(int(n), (b"", b""))[1] for n in _REF.findall(contents[1])] if contents else []
        out.append(_page_text(b"\n".join(streams), fonts))
    return out
