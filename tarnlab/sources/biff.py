"""Cells of workbooks in Excel's binary format (BIFF8 in a compound file), as published in MS-CFB and MS-XLS."""

from __future__ import annotations

import struct

MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"

# Sector marks, and the records that hold names, strings and cells.
END_OF_CHAIN = 0xFFFFFFFE
EOF, BOUNDSHEET, SST, CONTINUE, STRING = 0x000A, 0x0085, 0x00FC, 0x003C, 0x0207
LABEL_SST, LABEL, NUMBER, RK, MUL_RK, FORMULA = 0x00FD, 0x0204, 0x0203, 0x027E, 0x00BD, 0x0006


class Damaged(ValueError):
    """The file breaks off or points outside itself."""


class CompoundFile:
    """The streams of a compound file by name."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise Damaged("no compound file")
        self.data = data
        self.shift, self.mini_shift = struct.unpack_from("<HH", data, 30)
        n_fat, directory, self.cutoff, mini_fat, n_mini, difat, n_difat = self._header()
        places = list(struct.unpack_from("<109I", data, 76))
        per = (1 << self.shift) // 4
        for _ in range(n_difat):
            entries = struct.unpack(f"<{per}I", self._sector(difat))
            places += entries[:-1]
            difat = entries[-1]
        self.fat = [x for p in places[:n_fat] for x in struct.unpack(f"<{per}I", self._sector(p))]
        self.mini_fat = [x for s in self._chain(mini_fat, self.fat) for x in struct.unpack(f"<{per}I", self._sector(s))] if n_mini else []
        raw = self._read(directory)
        self.entries = {}
        for at in range(0, len(raw) - 127, 128):
            size = struct.unpack_from("<H", raw, at + 64)[0]
            if size >= 2:
                name = raw[at : at + size - 2].decode("utf-16-le", "replace")
                self.entries[name] = (raw[at + 66], *struct.unpack_from("<IQ", raw, at + 116))

    def _header(self) -> tuple[int, ...]:
        at = lambda i: struct.unpack_from("<I", self.data, i)[0]
        return tuple(at(i) for i in (44, 48, 56, 60, 64, 68, 72))

    def _sector(self, n: int) -> bytes:
        start = (n + 1) << self.shift
        part = self.data[start : start + (1 << self.shift)]
        if len(part) != 1 << self.shift:
            raise Damaged("a sector lies outside the file")
        return part

    def _chain(self, n: int, table: list[int]) -> list[int]:
        out: list[int] = []
        while n < END_OF_CHAIN:
            if n >= len(table) or len(out) > len(table):
                raise Damaged("a chain of sectors leads nowhere")
            out.append(n)
            n = table[n]
        return out

    def _read(self, start: int) -> bytes:
        return b"".join(self._sector(s) for s in self._chain(start, self.fat))

    def stream(self, name: str) -> bytes:
        _, start, size = self.entries[name]
        if size >= self.cutoff:
            return self._read(start)[:size]
        root = next(e for e in self.entries.values() if e[0] == 5)
        small, width = self._read(root[1]), 1 << self.mini_shift
        return b"".join(small[s * width : (s + 1) * width] for s in self._chain(start, self.mini_fat))[:size]


def _records(data: bytes, at: int = 0):
    """(kind, body, place after it) from a place on."""
    while at + 4 <= len(data):
        kind, size = struct.unpack_from("<HH", data, at)
        yield kind, data[at + 4 : at + 4 + size], at + 4 + size
        at += 4 + size


class _Parts:
    """A record's body with its continuations; characters that go over a boundary begin with their width anew."""

    def __init__(self, bodies: list[bytes]):
        self.bodies, self.part, self.at = bodies, 0, 0

    def take(self, n: int) -> bytes:
        out = b""
        while n:
            if self.part >= len(self.bodies):
                raise Damaged("the strings break off")
            piece = self.bodies[self.part][self.at : self.at + n]
            out, n, self.at = out + piece, n - len(piece), self.at + len(piece)
            if n:
                self.part, self.at = self.part + 1, 0
        return out

    def text(self, count: int, wide: int) -> str:
        out = ""
        while count:
            if self.part < len(self.bodies) and self.at == len(self.bodies[self.part]):
                self.part, self.at = self.part + 1, 0
                wide = self.take(1)[0] & 1
            left = len(self.bodies[self.part]) - self.at if self.part < len(self.bodies) else 0
            n = min(count, left >> wide)
            if not n:
                raise Damaged("a string breaks off")
            out += self.take(n << wide).decode("utf-16-le" if wide else "latin-1", "replace")
            count -= n
        return out


def _strings(bodies: list[bytes]) -> list[str]:
    parts, out = _Parts(bodies), []
    _, unique = struct.unpack("<II", parts.take(8))
    for _ in range(unique):
        count, flags = struct.unpack("<HB", parts.take(3))
        runs = struct.unpack("<H", parts.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", parts.take(4))[0] if flags & 4 else 0
        out.append(parts.text(count, flags & 1))
        parts.take(4 * runs + extra)
    return out


def number_text(v: float) -> str:
    return format(v, ".15g")


def _rk(raw: int) -> float:
    v = float(struct.unpack("<i", struct.pack("<I", raw))[0] >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return v / 100 if raw & 1 else v


def _cells(data: bytes, start: int, strings: list[str]):
    """(row, column, text) of a sheet, from 0."""
    asked = None  # the formula whose text follows
    for kind, body, _ in _records(data, start):
        if kind == EOF:
            return
        if kind == MUL_RK:
            row, first = struct.unpack_from("<HH", body)
            for i in range((len(body) - 6) // 6):
                yield row, first + i, number_text(_rk(struct.unpack_from("<I", body, 6 + 6 * i)[0]))
        elif kind == STRING and asked:
            count, wide = struct.unpack_from("<HB", body)
            yield *asked, body[3 : 3 + (count << (wide & 1))].decode("utf-16-le" if wide & 1 else "latin-1", "replace")
            asked = None
        elif kind in (LABEL_SST, LABEL, NUMBER, RK, FORMULA):
            row, column = struct.unpack_from("<HH", body)
            if kind == LABEL_SST:
                yield row, column, strings[struct.unpack_from("<I", body, 6)[0]]
            elif kind == LABEL:
                count, wide = struct.unpack_from("<HB", body, 6)
                yield row, column, body[9 : 9 + (count << (wide & 1))].decode("utf-16-le" if wide & 1 else "latin-1", "replace")
            elif kind == NUMBER:
                yield row, column, number_text(struct.unpack_from("<d", body, 6)[0])
            elif kind == RK:
                yield row, column, number_text(_rk(struct.unpack_from("<I", body, 6)[0]))
            elif body[12:14] == b"\xff\xff":
                asked = (row, column) if body[6] == 0 else None
                if body[6] == 1:
                    yield row, column, "TRUE" if body[8] else "FALSE"
            else:
                yield row, column, number_text(struct.unpack_from("<d", body, 6)[0])


def workbook_cells(content: bytes) -> list[tuple[str, int, int, str, int]]:
    """Cells of a binary workbook as text: sheet, r, c (from 1), v, sheet_no. Damaged where it can't be read."""
    try:
        book = CompoundFile(content)
        data = book.stream("Workbook" if "Workbook" in book.entries else "Book")
        sheets, strings, shared = [], [], None
        for kind, body, _ in _records(data):
            if kind == CONTINUE and shared is not None:
                shared.append(body)
                continue
            if shared is not None:
                strings, shared = _strings(shared), None
            if kind == SST:
                shared = [body]
            elif kind == BOUNDSHEET and body[5] == 0:
                count, wide = body[6], body[7] & 1
                sheets.append((body[8 : 8 + (count << wide)].decode("utf-16-le" if wide else "latin-1", "replace"), struct.unpack_from("<I", body)[0]))
            elif kind == EOF:
                break
        return [(name, r + 1, c + 1, v, k) for k, (name, start) in enumerate(sheets, 1) for r, c, v in _cells(data, start, strings) if v.strip()]
    except (struct.error, IndexError, KeyError, StopIteration) as e:
        raise Damaged(f"{type(e).__name__}: {e}") from None
