"""Secret scans through nested encodings.

A worklist holds layers of a text: the text itself, and whatever a piece of a layer decodes to. Each
layer is scanned by the same patterns, then its encoded pieces (URL escapes, Unicode escapes,
base64, base64 in URL form, both also wrapped over lines or part of a path, hex, and gzip or zlib
data inside these) are decoded and put on the list, until nothing new comes up. A layer whose content
(by a digest of 128 bits) has been seen with the same place is not put on the list again, which ends
cycles; each decoding is shorter than its source, so nesting ends by itself. Data that would grow
beyond `MOST_GROWTH` times their source, near the most that zlib can do, are left packed. A run of
base64 is decoded at most once for each of its four alignments, so the work is linear in its length.
Packed data are unpacked with all members as long as there is something packed inside, and of bytes
that are not text as a whole every readable run is a layer.
Every layer carries a map to the original text, so a finding in any layer names the span of original
code points that it was decoded from.

Cases: null and empty texts have no findings and the digest of the empty string; texts are scanned
whole; equal findings of several layers count once; repeated rows give repeated results; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import binascii
import hashlib
import re
import urllib.parse
import zlib
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import long_id

KINDS = ("assign", "access", "hex")
# Pattern, group whose length counts, least length.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# The same matches as HEX with its least length, found without stopping at every short run.
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
# What every match of ASSIGN has, for a quick look.
MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)")
# A run of base64 letters; after it come further lines if it is wrapped.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_-])")
NEXT_LINE = re.compile(r"\r?\n[\x20\t]*([A-Za-z0-9+/_-]+={0,2})(?=\s|[\"'<,;)\]}]|\Z)")
HEX_DATA = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){16,}(?![0-9A-Za-z])")
PRINTABLE = re.compile(r"[\t\n\r\x20-\x7e -\U0010ffff]*\Z")
# Runs that can hold a finding or an encoded one; all of these have 16 characters or more.
READABLE = re.compile(r"[\t\n\r\x20-\x7e\xa0-\ufffc\ufffe-\U0010ffff]{16,}")
MAGIC = {31: (b"\x1f\x8b",), 15: (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")}
PACKED = {magic for magics in MAGIC.values() for magic in magics}
MOST_GROWTH = 1000
# Bytes of readable runs, those of characters beyond ASCII included.
RUNS = re.compile(rb"[\t\n\r\x20-\x7e\x80-\xff]{16,}")
URL_DATA = re.compile(r"(?:x(?=%)|%[0-9A-Fa-f]{2})[A-Za-z0-9%_.~!*'()-]{16,}")

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "spans string, layers string")


def scan(text: str) -> list[tuple[str, int, int]]:
    """Findings of one layer: kind, start, end, by start and kind."""
    found = []
    low = text.lower()
    if any(mark in low for mark in MARKS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


class Layer:
    """A text with, for each of its characters, the original span that it comes from.

    Runs (start, original start, original end, step) cover the text: with step 1 characters follow
    the original one by one, with step 0 each of them stands for the whole span.
    """

    __slots__ = ("text", "runs", "starts", "path")

    def __init__(self, text, runs, path):
        self.text, self.runs, self.path = text, runs, path
        self.starts = [r[0] for r in runs]

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Original span of characters start .. end-1, at least one of them."""
        low, high = self._at(start)[0], self._at(end - 1)[1]
        first = bisect_right(self.starts, start)
        last = bisect_right(self.starts, end - 1)
        for run in self.runs[first:last]:
            low = min(low, run[1])
        return low, max(high, low)

    def _at(self, i: int) -> tuple[int, int]:
        start, low, high, step = self.runs[bisect_right(self.starts, i) - 1]
        return (low + i - start, low + i - start + 1) if step else (low, high)


def _members(data: bytes, wbits: int, most: int) -> bytes | None:
    """What all members of packed data hold, as far as they go; None if that is nothing or too much."""
    parts, length = [], 0
    while data.startswith(MAGIC[wbits]):
        unpack = zlib.decompressobj(wbits)
        try:
            parts.append(unpack.decompress(data, most - length + 1))
        except zlib.error:
            # The input again in small steps, for what comes before the damage.
            parts.append(_before_damage(data, wbits, most - length + 1))
            break
        length += len(parts[-1])
        if length > most:
            return None
        data = unpack.unused_data.lstrip(b"\0")
    return b"".join(parts) or None


def _before_damage(data: bytes, wbits: int, most: int) -> bytes:
    unpack, found = zlib.decompressobj(wbits), bytearray()
    try:
        for i in range(len(data)):
            found += unpack.decompress(data[i:i + 1], most)
            if len(found) >= most:
                break
    except zlib.error:
        pass
    return bytes(found)


def _texts(data: bytes, unpacked_only: bool = False) -> Iterator[str]:
    """The readable runs of bytes and of all that they unpack to, layer by layer."""
    most = MOST_GROWTH * len(data) + 1000
    if unpacked_only:
        data = _unpacked(data, most)
    while data:
        text = data.decode("utf-8", "replace")
        if "\ufffd" not in text and len(text) >= 4 and PRINTABLE.match(text):
            yield text
        else:
            yield from READABLE.findall(text)
        data = _unpacked(data, most)


def _unpacked(data: bytes, most: int) -> bytes | None:
    wbits = next((w for w, magic in MAGIC.items() if data.startswith(magic)), None)
    return wbits and _members(data, wbits, most)


def _from_base64(letters: str) -> bytes:
    """What base64 of either form stands for, as far as it goes."""
    letters = letters.rstrip("=").replace("-", "+").replace("_", "/")
    if len(letters) % 4 == 1:
        letters = letters[:-1]
    return binascii.a2b_base64(letters + "=" * (-len(letters) % 4)) if letters else b""


def _base64_pieces(text: str) -> Iterator[tuple[int, int, str, int]]:
    """Start, end and letters of what may be base64, and how many letters stand on the first line.

    That is every run, and again with the lines that follow it if it is wrapped.
    """
    done = 0
    for m in BASE64.finditer(text):
        start, end, run = m.start(), m.end(), m[0]
        yield start, end, run, len(run)
        if start < done or run.endswith("="):
            continue
        # Lines of one width follow, and a last one that is not longer.
        lines, ends, width, at = [run], [end], None, end
        while (line := NEXT_LINE.match(text, at)) and (width is None or len(line[1]) <= width):
            width = width or len(line[1])
            lines.append(line[1])
            at = line.end()
            ends.append(at)
            if len(line[1]) < width or line[1].endswith("="):
                break
        if len(lines) > 1:
            done = ends[-1]
            yield start, ends[-1], "".join(lines), len(run)
            if len(lines) > 2:  # the last line may be a word of what follows
                yield start, ends[-2], "".join(lines[:-1]), len(run)


def _held(start: int, end: int, letters: str, first_line: int
          ) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Texts that base64 holds, with the places in it (character, start in the layer) they begin at.

    After a slash something of its own may begin. What begins at places whose distance is a multiple
    of four decodes alike, so there is one decoding for each of the four, however many slashes there
    are, and a finding belongs to the last place before it.
    """
    for held in _texts(_from_base64(letters)):
        yield held, [(0, start)]
    begins: dict[int, list[int]] = {}
    slash = letters.find("/", 0, first_line)
    while slash >= 0:
        if len(letters) - slash > 16:
            begins.setdefault((slash + 1) % 4, []).append(slash + 1)
        slash = letters.find("/", slash + 1, first_line)
    for places in begins.values():
        data = _from_base64(letters[places[0]:])
        offsets = [(p - places[0]) // 4 * 3 for p in places]
        for run in RUNS.finditer(data):
            # Bytes of a character that is cut by the edge are left out.
            parts, at = [], run.start()
            cuts = offsets[bisect_right(offsets, at):bisect_left(offsets, run.end())]
            marks, length = [], 0
            for stop in (*cuts, run.end()):
                own = places[bisect_right(offsets, at) - 1]
                part = data[at:stop].decode("utf-8", "ignore")
                marks.append((length, start + own))
                parts.append(part)
                length += len(part)
                at = stop
            whole = "".join(parts)
            if length >= 16:
                yield whole, marks
        upto = 0
        for place, offset in zip(places, offsets):
            packed = offset >= upto and data[offset:offset + 2] in PACKED
            if packed:
                for held in _texts(data[offset:], unpacked_only=True):
                    upto = len(data)
                    yield held, [(0, start + place)]


def _inner(layer: Layer) -> Iterator[Layer]:
    """Layers that stand in pieces of this one."""
    text = layer.text
    for start, end, letters, first_line in _base64_pieces(text):
        for held, marks in _held(start, end, letters, first_line):
            yield Layer(held, [(at, *layer.span(own, end), 0) for at, own in marks],
                        f"{layer.path}>base64")
    for m in HEX_DATA.finditer(text):
        for held in _texts(bytes.fromhex(m[0])):
            yield Layer(held, [(0, *layer.span(*m.span()), 0)], f"{layer.path}>hex")
    if "%" in text:
        for m in URL_DATA.finditer(text):
            data = urllib.parse.unquote_to_bytes(m[0])
            if data[:2] in PACKED:
                for held in _texts(data, unpacked_only=True):
                    yield Layer(held, [(0, *layer.span(*m.span()), 0)], f"{layer.path}>url")


def _escape(piece: str) -> str:
    try:
        digits = piece.strip("\\ux{}&#;")
        return chr(int(digits, 16 if piece[1] in "ux" or piece[2] == "x" else 10))
    except (ValueError, OverflowError):
        return piece


def _substituted(layer: Layer, name: str) -> Layer | None:
    """The whole layer with its escapes resolved, so that what surrounds them stays around."""
    text, parts, runs, at, length = layer.text, [], [], 0, 0
    pattern = URL if name == "url" else ESCAPES

    def copy(upto):
        nonlocal length
        # Runs of the layer that lie within text[at:upto], moved to their new place.
        i = at
        while i < upto:
            k = bisect_right(layer.starts, i) - 1
            start, low, high, step = layer.runs[k]
            stop = min(upto, layer.starts[k + 1] if k + 1 < len(layer.starts) else upto)
            runs.append((length, low + i - start if step else low, high, step))
            length += stop - i
            i = stop
        parts.append(text[at:upto])

    changed = False
    for m in pattern.finditer(text):
        if name == "url":
            # Bytes that are no UTF-8 stand for themselves and leave the others readable.
            new = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "replace")
        else:
            new = _escape(m[0])
            if new == m[0] or "\ud800" <= new <= "\udfff":
                continue
        changed = True
        copy(m.start())
        runs.append((length, *layer.span(m.start(), m.end()), 0))
        parts.append(new)
        length += len(new)
        at = m.end()
    if not changed:
        return None
    copy(len(text))
    return Layer("".join(parts), runs, f"{layer.path}>{name}")


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def findings(text: str) -> tuple[list, list]:
    """Findings of the text itself, and of all layers as (kind, start, end, path)."""
    first = Layer(text, [(0, 0, len(text), 1)], "text")
    base = scan(text)
    every = {(k, a, b): "text" for k, a, b in base}
    waiting, seen = deque([first]), {(_digest(text), 0, len(text))}
    while waiting:
        layer = waiting.popleft()
        if layer is not first:
            for kind, a, b in scan(layer.text):
                every.setdefault((kind, *layer.span(a, b)), layer.path)
        inner = list(_inner(layer))
        if "%" in layer.text:
            inner.append(_substituted(layer, "url"))
        if "\\" in layer.text or "&#" in layer.text:
            inner.append(_substituted(layer, "escape"))
        for new in inner:
            if new is None or not new.text:
                continue
            key = (_digest(new.text), *new.span(0, len(new.text)))
            if key not in seen:
                seen.add(key)
                waiting.append(new)
    order = sorted(every, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))
    return base, [(*f, every[f]) for f in order]


def _joined(found: list) -> str:
    return ",".join(f"{f[0]}:{f[1]}:{f[2]}" for f in found)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column(1):
            base, every = findings(value.as_py() or "")
            kinds = [f[0] for f in base]
            rows.append((
                *(kinds.count(k) for k in KINDS),
                hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every),
                ",".join(f"{k}:{a}:{b}:{path}" for k, a, b, path in every if path != "text")))
        columns = list(zip(*rows)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(columns[i], pa.int64()) for i in range(3)),
             *(pa.array(columns[i], pa.string()) for i in range(3, 6))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "layers"])


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the text's own findings, and spans of all."""
    return docs.select(long_id(), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan_batches, SCHEMA)
