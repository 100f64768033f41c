"""Finds secrets in texts and in what is encoded inside them.

A text is the first layer of a worklist. Each layer is scanned; what it holds in
URL escapes, Unicode escapes, base64 or compressed bytes becomes further layers,
until none is new. A layer keeps, for each of its characters, the range of the
original text it came from, so that every finding has a span in the original.
A layer whose content was seen at the same span is not opened again.

Bytes need not be clean text: all ASCII in them is scanned, since no secret, encoded or
not, holds anything else.
Decompressed bytes are scanned in overlapping windows of bounded size, all members and
however many, each with what is encoded in it.

Two guards make every text end. Layers with escapes decoded in place may hold
``MAX_LAYER_CHARS`` characters and four times the length of what they were found in (a
chain of escapes is decoded a link at a time), and decompressed bytes ``MAX_INFLATED``.
What would go beyond is reported as a span of the kind ``unopened``.

Defined results: a null or empty text has no span; text is scanned whole, however
long; rows that repeat give equal results; an empty table gives an empty table;
extra columns are ignored, or passed through by ``redacted``.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "unopened")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

URL_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
#: Letters of both alphabets, 16 at least; then lines of nothing but letters, up to the
#: padding or the end of the string that holds them.
BREAK = r"(?:\r?\n|(?:\\r)?\\n)[ \t]*"
BASE64 = re.compile(
    rf"""[A-Za-z0-9+/_-]{{16,}}(?:{BREAK}[A-Za-z0-9+/_-]+(?=={{0,2}}[ \t]*(?:[\r\n"'`<),;\]}}]|\\[nr]|\Z)))*={{0,2}}"""
)
LINE, LINE_BREAK = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(BREAK)
STANDARD = str.maketrans("-_", "+/")
#: No secret, and nothing that encodes one, is shorter or has other bytes in it.
ASCII = re.compile(rb"[\t\n\r\x20-\x7e]{14,}")
#: ASCII in 32-bit and 16-bit units, of either byte order.
WIDE = tuple((re.compile(rb"(?:[\t\n\r\x20-\x7e]" + rb"\0" * n + rb"){4,}"), n + 1) for n in (3, 1))
#: Where compressed bytes may begin.
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\0|x[\x01\x5e\x9c\xda]")
MAX_LAYER_CHARS = 1 << 24
MAX_INFLATED = 1 << 36
#: Decompressed bytes that are scanned together, and those that the next ones repeat.
WINDOW, OVERLAP = 1 << 22, 1 << 16
BLOCK = 1 << 16


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end): leftmost matches per kind; those that are too short drop out."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


@dataclass
class Layer:
    """Decoded text; piece k begins at ``at[k]`` and stands for one range of the original.

    ``step`` 1: the piece's characters stand for the original's, one for one; 0: the
    whole piece stands for the whole range.
    """

    text: str
    at: list[int]
    pieces: list[tuple[int, int, int]]  # start, end, step

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._place(start)[0], self._place(end - 1)[1]

    def _place(self, i: int) -> tuple[int, int]:
        k = bisect_left(self.at, i + 1) - 1
        start, end, step = self.pieces[k]
        return (start + i - self.at[k], start + i - self.at[k] + 1) if step else (start, end)

    def sub(self, start: int, end: int) -> list[tuple[int, tuple[int, int, int]]]:
        """The pieces of a part of this layer, placed from 0."""
        if start == end:
            return []
        first = bisect_left(self.at, start + 1) - 1
        last = bisect_left(self.at, end) - 1
        out = []
        for k in range(first, last + 1):
            a, b, step = self.pieces[k]
            cut = max(0, start - self.at[k])
            out.append((max(0, self.at[k] - start), (a + cut, b, step) if step else (a, b, 0)))
        return out


def whole(text: str) -> Layer:
    return Layer(text, [0], [(0, len(text), 1)])


def replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match decoded in place; None if nothing changes.

    ``decode`` gives (text, start, end) parts of a match, with offsets in the layer.
    """
    parts, at, pieces, size, done = [], [], [], 0, 0

    def keep(start: int, end: int) -> None:
        nonlocal size
        for offset, piece in layer.sub(start, end):
            at.append(size + offset)
            pieces.append(piece)
        parts.append(layer.text[start:end])
        size += end - start

    for m in pattern.finditer(layer.text):
        got = decode(m)
        if not got:
            continue
        keep(done, m.start())
        for text, start, end in got:
            if text:
                at.append(size)
                pieces.append((*layer.span(start, end), 0))
                parts.append(text)
                size += len(text)
        done = m.end()
    if not done:
        return None
    keep(done, len(layer.text))
    return Layer("".join(parts), at, pieces)


def url_parts(m: re.Match) -> list[tuple[str, int, int]]:
    """One part per character of the escaped UTF-8, or per byte that is not UTF-8."""
    text = lenient(bytes.fromhex(m.group().replace("%", "")))
    ends = (m.start() + 3 * byte_ends(text)).tolist()
    return list(zip(shown(text), [m.start(), *ends], ends))


def unicode_parts(m: re.Match) -> list[tuple[str, int, int]]:
    """One part per character; a surrogate pair is one character, a lone surrogate ends it."""
    parts: list[tuple[str, int, int]] = []
    for e in ONE_ESCAPE.finditer(m.group()):
        four, two, dec, hexa = e.groups()
        code = int(dec) if dec else int(four or two or hexa, 16)
        start, end = m.start() + e.start(), m.start() + e.end()
        if 0xDC00 <= code < 0xE000 and parts and 0xD800 <= ord(parts[-1][0]) < 0xDC00:
            high, start, _ = parts.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00
        if code > 0x10FFFF:
            code = 0xFFFD
        parts.append((chr(code), start, end))
    return [(c if not 0xD800 <= ord(c) < 0xE000 else "�", a, b) for c, a, b in parts]


class Feed:
    """Blocks of bytes, taken one by one; what is put back comes first."""

    def __init__(self, blocks: Iterable[bytes]) -> None:
        self.blocks, self.held, self.taken, self.cut = iter(blocks), b"", 0, False

    def take(self) -> bytes:
        out, self.held = self.held or next(self.blocks, b""), b""
        self.taken += len(out)
        return out

    def put_back(self, data: bytes) -> None:
        self.held = data + self.held
        self.taken -= len(data)


def opener_of(head: bytes):
    """What decompresses the gzip, zlib, bzip2 or xz bytes that begin so; None if they are none."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if head[:6] == b"\xfd7zXZ\0" else None


def pulled(opener, block: bytes) -> Iterator[bytes]:
    """What a decompressor makes of one more block, in pieces of bounded size."""
    limit, more = 1 << 20, True
    while more and not opener.eof:
        out = opener.decompress(block, limit)
        if hasattr(opener, "needs_input"):
            block, more = b"", not opener.needs_input
        else:
            block = opener.unconsumed_tail
            more = bool(block) or len(out) == limit
        if out:
            yield out


def inflated(feed: Feed) -> Iterator[bytes]:
    """Decompressed bytes of all members that follow each other, as far as they can be read.

    ``feed.cut`` tells that the last one goes on behind the feed's end.
    """
    while True:
        head = feed.take()
        while len(head) < 6 and (more := feed.take()):
            head += more
        if feed.taken > len(head):  # members may have zeros between them
            while head and not (head := head.lstrip(b"\0")):
                head = feed.take()
        feed.put_back(head)
        opener = opener_of(head)
        if opener is None:
            return
        try:
            while not opener.eof:
                block = feed.take()
                if not block:
                    feed.cut = True
                    return
                yield from pulled(opener, block)
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return
        feed.put_back(opener.unused_data)


def blocks_of(data: bytes, start: int) -> Iterator[bytes]:
    for k in range(start, len(data), BLOCK):
        yield data[k : k + BLOCK]


def skipped(blocks: Iterable[bytes], n: int) -> Iterator[bytes]:
    """The blocks without their first n bytes."""
    for block in blocks:
        if n < len(block):
            yield block[n:]
        n = max(0, n - len(block))


def windows(blocks: Iterable[bytes]) -> Iterator[tuple[int, bytes, bool]]:
    """(place, bytes, whether others follow): the blocks in overlapping windows."""
    held, at = bytearray(), 0
    for block in blocks:
        held += block
        while len(held) > WINDOW:
            yield at, bytes(held[:WINDOW]), True
            del held[: WINDOW - OVERLAP]
            at += WINDOW - OVERLAP
    yield at, bytes(held), False


@dataclass
class Room:
    """What is left of the guards, and the windows that were scanned."""

    chars: int
    inflated: int
    seen: set = field(default_factory=set)

    def metered(self, blocks: Iterable[bytes]) -> Iterator[bytes]:
        """The blocks; raises OverflowError where they are too many."""
        for block in blocks:
            self.inflated -= len(block)
            if self.inflated < 0:
                raise OverflowError
            yield block


def readable(data: bytes) -> str | None:
    """The bytes as text, if they are UTF-8 without control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else None


def lenient(data: bytes) -> str:
    """The bytes as text; each byte that is not UTF-8 is a lone surrogate."""
    return data.decode("utf-8", "surrogateescape")


def texts_of(data: bytes) -> Iterator[tuple[int, str]]:
    """(place, text): all of the bytes if they are clean text, else what is ASCII in them."""
    text = readable(data)
    if text is not None:
        yield 0, text
    else:
        for m in ASCII.finditer(data):
            yield m.start(), m.group().decode()


def shown(text: str) -> str:
    """``lenient`` text with a replacement character for each lone surrogate."""
    return re.sub("[\udc80-\udcff]", "\ufffd", text)


def byte_ends(text: str) -> np.ndarray:
    """Where each character's bytes end in what ``lenient`` was given."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    return np.cumsum(np.where((codes >= 0xDC80) & (codes <= 0xDCFF), 1, sizes))


def narrowed(data: bytes) -> bytes:
    """The bytes with each run of wide ASCII characters as plain ones."""
    for pattern, width in WIDE:
        data = pattern.sub(lambda m, width=width: m.group()[::width], data)
    return data


class Letters:
    """Base64 letters on some lines of a layer, with the padding after them."""

    def __init__(self, layer: Layer, lines: list[tuple[int, int]], stop: int) -> None:
        self.layer, self.stop = layer, stop
        self.starts = [a for a, _ in lines]
        self.at = [0, *accumulate(b - a for a, b in lines)][:-1]
        self.text = "".join(layer.text[a:b] for a, b in lines)

    def _place(self, i: int) -> int:
        k = bisect_left(self.at, i + 1) - 1
        return self.starts[k] + i - self.at[k]

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.layer.span(self._place(start), self._place(end - 1) + 1)

    def rest(self, start: int) -> tuple[int, int]:
        """From a letter to the end of the padding."""
        return self.layer.span(self._place(start), self.stop)


class Base64Text(Layer):
    """Decoded text; a character stands for the four-letter groups that it came from.

    ``skip`` letters come before the first group, and ``first`` bytes before the text.
    Places are found when asked for.
    """

    def __init__(self, letters: Letters, skip: int, first: int, text: str) -> None:
        self.letters, self.skip, self.first, self.text = letters, skip, first, text
        self.ends = None if text.isascii() else byte_ends(text)

    def _place(self, i: int) -> tuple[int, int]:
        a, b = i, i + 1
        if self.ends is not None:
            a, b = int(self.ends[i - 1]) if i else 0, int(self.ends[i])
        start, end = (a + self.first) // 3 * 4, -(-(b + self.first) // 3) * 4
        return self.letters.span(self.skip + start, min(len(self.letters.text), self.skip + end))

    def sub(self, start: int, end: int) -> list[tuple[int, tuple[int, int, int]]]:
        step = 1 + (end - start >> 20)  # a piece for each character would take too much room
        return [(i - start, (*self.span(i, min(i + step, end)), 0)) for i in range(start, end, step)]


def letter_blocks(layer: Layer):
    """Lists of letters to decode: lines that were wrapped as one, then each on its own.

    The lines of a wrapped block are of one width; the last may be shorter, and the
    first longer or, if two others follow, shorter, since it shares its line.
    """
    for m in BASE64.finditer(layer.text):
        lines, at = [], m.start()
        while line := LINE.match(layer.text, at, m.end()):
            lines.append(line.span())
            gap = LINE_BREAK.match(layer.text, line.end(), m.end())
            at = gap.end() if gap else m.end()
        widths, i = [b - a for a, b in lines], 0
        while i < len(lines):
            j = i + 1
            armour = layer.text.endswith("-----", *lines[i])  # the line before a PEM block
            if not armour and j < len(lines) and (
                widths[j] <= widths[i] or (j + 1 < len(lines) and widths[j + 1] <= widths[j])
            ):
                j += 1
                while j < len(lines) and widths[j] <= widths[j - 1] == widths[i + 1]:
                    j += 1
            block = lines[i:j]
            stop = m.end() if j == len(lines) else block[-1][1]
            tries = [Letters(layer, block, stop)]
            if len(block) > 1:
                tries += [Letters(layer, [x], x[1]) for x in block if x[1] - x[0] >= 16]
            yield tries
            i = j


def base64_layers(holder: Layer, room: Room):
    """(layer or None, span) of the text or compressed text in each base64 run.

    A run that is not text as a whole may begin with letters of something else, so that
    all four alignments are decoded. None: what it holds has no room.
    """
    for tries in letter_blocks(holder):
        for letters in tries:
            whole_text = False
            for skip in range(4):
                run = letters.text[skip:]
                run = run[: len(run) - (len(run) % 4 == 1)]
                if not run:
                    break
                data = base64.b64decode(run.translate(STANDARD) + "=" * (-len(run) % 4))
                for at, text in texts_of(data):
                    whole_text = skip == 0 and len(text.encode()) == len(data)
                    room.chars += 4 * len(text)
                    layer = Base64Text(letters, skip, at, text)
                    yield layer, layer.span(0, len(text))
                if whole_text:
                    break
                yield from byte_layers(data, lambda at: letters.rest(skip + at // 3 * 4), room)
            if whole_text:
                break


def byte_layers(
    data: bytes,
    span_from: Callable[[int], tuple[int, int]],
    room: Room,
    source: Callable[[], Iterator[bytes]] | None = None,
    at: int = 0,
):
    """(layer or None, span) of wide text and compressed text in bytes.

    ``source`` opens the stream in which ``data`` is the window at ``at``, if others
    follow: compressed bytes that go on behind the window are read from there.
    """

    def plain(data: bytes, span: tuple[int, int]):
        for _, text in texts_of(data):
            room.chars += 4 * len(text)
            yield Layer(text, [0], [(*span, 0)]), span

    thin = narrowed(data)
    if thin != data:
        yield from plain(thin, span_from(0))
    done = 0
    for start in sorted({0, *(m.start() for m in MAGIC.finditer(data))}):
        if start < done or (source and start and start >= len(data) - OVERLAP):
            continue  # read already, or in the next window too
        span = span_from(start)

        def here(start=start) -> Feed:
            return Feed(blocks_of(data, start))

        def further(start=start) -> Feed:
            return Feed(skipped(source(), at + start))

        try:
            for opened in (here, further) if source else (here,):
                feed = opened()
                for place, window, more in windows(room.metered(inflated(feed))):
                    done = max(done, start + feed.taken) if window and opened is here else done
                    key = (hashlib.sha1(window).digest(), span)
                    if not window or key in room.seen:
                        continue
                    room.seen.add(key)
                    yield from plain(window, span)
                    again = (lambda opened=opened: inflated(opened())) if more else None
                    yield from byte_layers(window, lambda _, span=span: span, room, again, place)
                if not feed.cut:
                    break
        except OverflowError:
            yield None, span


def changed_span(layer: Layer) -> tuple[int, int]:
    """From the first to the last place where an in-place layer was decoded."""
    decoded = [(a, b) for a, b, step in layer.pieces if not step]
    return min(a for a, _ in decoded), max(b for _, b in decoded)


def layers_in(layer: Layer, room: Room):
    """(layer or None, span) of all that is encoded in one layer."""
    escapes = (("%", URL_ESCAPES, url_parts), ("\\", UNICODE_ESCAPES, unicode_parts))
    for mark, pattern, decode in (*escapes, ("&#", UNICODE_ESCAPES, unicode_parts)):
        if mark in layer.text and (child := replaced(layer, pattern, decode)):
            fits = len(child.text) <= room.chars
            if fits:
                room.chars -= len(child.text)
            yield child if fits else None, changed_span(child)
    yield from base64_layers(layer, room)


def spans_of(text: str, max_chars: int | None = None) -> tuple[list, list]:
    """(base, all): the text's own spans, and these with the mapped ones of all layers.

    ``max_chars`` bounds layers and decompressed bytes further, beside four times the text.
    """

    def ordered(spans):
        return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    base = scan(text)
    found = set(base)
    own = 4 * len(text)
    room = Room(MAX_LAYER_CHARS + own, MAX_INFLATED)
    if max_chars is not None:
        room = Room(max_chars + own, max_chars + own)
    # One layer of each depth is held at a time.
    work, seen = [layers_in(whole(text), room)] if text else [], set()
    while work:
        child, span = next(work[-1], (None, None))
        if span is None:
            work.pop()
        elif child is None:
            found.add(("unopened", *span))
        elif child.text:
            key = (hashlib.sha1(child.text.encode("utf-8", "replace")).digest(), span)
            if key not in seen:
                seen.add(key)
                found.update((kind, *child.span(a, b)) for kind, a, b in scan(child.text))
                work.append(layers_in(child, room))
    return ordered(base), ordered(found)


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<kind:string,start:long,end:long>>"


def secret_spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, base, spans): the text's own spans and all spans, as arrays of structs."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def find(batches):
        for batch in batches:
            got = [spans_of(t.as_py() or "") for t in batch.column(1)]
            both = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[k]] for x in got], SPANS)
                for k in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *both], ["id", "base", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(
        find, f"id {id_type}, base {SPANS_DDL}, spans {SPANS_DDL}"
    )


MASK = "[SECRET]"


def redact(text: str) -> str:
    """The text with each run of overlapping spans replaced by ``MASK``."""
    _, spans = spans_of(text)
    parts, done = [], 0
    for _, a, b in spans:
        if a >= done:
            parts += [text[done:a], MASK]
        done = max(done, b)
    return "".join([*parts, text[done:]]) if parts else text


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with all spans masked in the text, and its length column brought up to date."""

    @F.pandas_udf("string")
    def mask(texts):
        return texts.map(redact, na_action="ignore")

    rows = docs.select(F.struct("*").alias("row"), mask(F.col(text)).alias("masked"))
    changed = ~F.col("masked").eqNullSafe(F.col(f"row.{text}"))
    return rows.select(
        *(
            F.col("masked").alias(c)
            if c == text
            else F.when(changed, F.length("masked").cast(docs.schema[c].dataType))
            .otherwise(F.col(f"row.`{c}`"))
            .alias(c)
            if c == length
            else F.col(f"row.`{c}`")
            for c in docs.columns
        )
    )
