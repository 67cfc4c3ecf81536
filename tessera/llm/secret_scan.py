"""Secret scans: base patterns on the text and on every layer encoded in it.

A worklist holds layers: the text itself, then whatever unwraps from it.  URL
and Unicode escapes are decoded over the whole layer; base64 runs, joined over
line breaks, are decoded at all four alignments (a line that is text as a whole
stands for itself; else a match is told as the longest stretch of text around it
that starts and ends with the run, a line or one of ``+/-_``), and gzip, zlib, bzip2, xz or zstd streams (all members) anywhere in
the bytes of a decoded layer are inflated.  Bytes that are not UTF-8 stay in the
layer as lone surrogates, so one of them costs no other match.  Each new layer is scanned and unwrapped again until nothing new
appears.  A set of layers already seen, each with the interval it stands for,
ends cycles (a layer that decodes to itself or to an ancestor).  Each layer carries, per character, the code point
interval of the original text it came from, so every span found inside maps
back to the outermost text.  Spans of the text itself are never removed.

Defined cases: a null text counts as empty; no match gives the SHA-256 of the
empty string and an empty ``spans``; texts are scanned whole; a decoded stream
beyond ``MAX_INFLATED`` bytes is counted by ``n_bombs`` and scanned in slices of
``_SLICE`` bytes that overlap by ``_OVERLAP``, so its size costs no memory; only
the kinds inside a stream matter, and each needs a short stretch of it (spaces
around an ``=`` apart, which are collapsed).  A further compressed stream that
outlasts its slice, plain or below base64 and escapes, is read by inflating the
outer one again up to it, so it is followed to its end at any depth.  Repeated
rows are scanned each; further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import bz2
import codecs
import functools
import hashlib
import itertools
import lzma
import re
import zlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_rows, text_or_empty

KINDS = ("assign", "access", "hex")
MAX_INFLATED = 8 << 20
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# runs are maximal, so a minimum length inside the pattern equals a filter after it
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|(?:%u[0-9A-Fa-f]{4})+|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs, joined over line breaks; in a run of one line at least 16 characters.
_JOINED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+"
                     r"|[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++)={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_DELIMITER = re.compile(r"[+/_-]")
_HEX4 = re.compile(r"[0-9A-Fa-f]{4}")
_HEX2 = re.compile(r"[0-9A-Fa-f]{2}")
#: The two bytes that may begin a zlib stream without a preset dictionary.
_ZLIB = {bytes((c, f)) for c in range(0x08, 0x80, 0x10) for f in range(256) if not f & 32 and (c * 256 + f) % 31 == 0}
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|" + b"|".join(map(re.escape, sorted(_ZLIB))),
                    re.DOTALL)
#: An assignment long enough, in a stream whose spaces are collapsed.
_ASSIGNED = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20?[:=]\x20?["']?[A-Za-z0-9+/_.=-]{6}""")
_SPACES = re.compile(rb"\x20{2,}")
_FOREIGN = re.compile(rb"[^A-Za-z0-9+/_\- \t\r\n]")
_URLSAFE = bytes.maketrans(b"-_", b"+/")
_ZSTD = type(zstandard.ZstdDecompressor().decompressobj())
#: Characters that text does not hold: control characters, and bytes that are not UTF-8.
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\udc80-\udcff]")
_POINTS = {0xDC00 + i: i for i in range(128, 256)}
_IN, _OUT, _SLICE, _OVERLAP = 1 << 16, 1 << 20, 4 << 20, 1 << 19


def scan(text: str) -> list[tuple[str, int, int]]:
    """Base matches (kind, start, end) of one layer, leftmost and
    non-overlapping per kind; too short ones are dropped after matching."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _percent(run: str) -> str:
    return _text(bytes.fromhex(run.replace("%", "")))


def _text(raw: bytes) -> str:
    """Bytes as text; one that is not UTF-8 becomes a lone surrogate, which no pattern matches."""
    return raw.decode("utf-8", "surrogateescape")


def _escape(run: str) -> str | None:
    try:
        if run.startswith(("\\u", "%u")):
            units = b"".join(int(x, 16).to_bytes(2, "big") for x in _HEX4.findall(run.replace("%u", "\\u")))
            return units.decode("utf-16-be", "replace")
        if run.startswith("\\U"):
            return chr(int(run[2:], 16)).encode().decode()
        if run.startswith("\\x"):
            return _text(bytes(int(x, 16) for x in _HEX2.findall(run)))
        return chr(int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])).encode().decode()
    except (UnicodeError, ValueError, OverflowError):
        return None


def _widths(text: str) -> np.ndarray:
    """The byte at which every character of a text starts, and the end."""
    point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    size = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
    size[(point >= 0xDC80) & (point <= 0xDCFF)] = 1
    return np.concatenate([[0], np.cumsum(size)])


class _Layer:
    """A text and, per character, the interval it stands for (``starts`` None:
    the character itself) in the original, or in what ``parent`` places there.
    ``sure``: no part of it was decoded from a guessed start.  ``rest``: where
    the text is a slice, the bytes from a character on, to the end of the stream."""

    def __init__(self, text, starts=None, ends=None, parent=None, sure=True, rest=None):
        self.text, self.starts, self.ends, self.parent, self.sure = text, starts, ends, parent, sure
        self.rest = rest

    def _inner(self, s: int, e: int) -> tuple[int, int]:
        if self.starts is None:
            return s, e
        return int(self.starts[s:e].min()), int(self.ends[s:e].max())

    def span(self, s: int, e: int) -> tuple[int, int]:
        """The original interval that a match here is told as."""
        inner = self._inner(s, e)
        return self.parent.span(*inner) if self.parent else inner

    def exact(self, s: int, e: int) -> tuple[int, int]:
        """The original interval of just these characters."""
        inner = self._inner(s, e)
        return self.parent.exact(*inner) if self.parent else inner

    def unescaped(self, pattern: re.Pattern, decode) -> "_Layer | None":
        """This layer with every decodable run replaced, or None."""
        parts, lo, hi, at, changed = [], [], [], 0, False

        def copy(s, e):
            parts.append(self.text[s:e])
            lo.append(np.arange(s, e))
            hi.append(np.arange(s, e) + 1)

        for m in pattern.finditer(self.text):
            out = decode(m[0])
            if out is None:
                continue
            changed = True
            copy(at, m.start())
            parts.append(out)
            # an equal share of the run per character; one escape is one character in most runs
            edge = m.start() + (np.arange(len(out) + 1) * (m.end() - m.start())) // max(1, len(out))
            lo.append(edge[:-1])
            hi.append(edge[1:])
            at = m.end()
        if not changed:
            return None
        copy(at, len(self.text))
        text = "".join(parts)
        place, hi = np.concatenate(lo), np.concatenate(hi)
        rest = self.rest and (lambda c: _unescaped(self.rest(int(place[c])), pattern, decode))
        if isinstance(self.parent, _Fixed):
            return _Layer(text, None, None, self.parent, self.sure, rest)
        lo = place
        if self.starts is not None:
            lo, hi = self.starts[place], self.ends[np.maximum(hi - 1, 0)]
        return _Layer(text, lo, hi, self.parent, self.sure, rest)

    def streams(self, memo: dict, above: tuple):
        """(interval, kinds, bombs) of every compressed stream among the bytes this layer stands for."""
        raw = self.text.encode("utf-8", "surrogateescape")
        rest = self.rest and (lambda b: self.rest(len(raw[:b].decode("utf-8", "surrogateescape"))))
        for s, e, kinds, bombs in _streams(raw, memo, above, rest):
            at = np.searchsorted(_widths(self.text), [s, e])
            yield self.span(int(at[0]), max(int(at[0]) + 1, int(at[1]))), kinds, bombs
        if any("\x80" <= c <= "\xff" for c in set(self.text)):  # code points that stand for bytes
            code = self.text.translate(_POINTS).encode("latin-1", "replace")
            rest = self.rest and (lambda b: _as_codes(self.rest(b)))
            for s, e, kinds, bombs in _streams(code, memo, above, rest):
                yield self.span(s, e), kinds, bombs


class _Fixed:
    """Parent of a layer that stands for one interval as a whole."""

    def __init__(self, exact: tuple[int, int], span: tuple[int, int]):
        self._exact, self._span = exact, span

    def exact(self, s: int, e: int) -> tuple[int, int]:
        return self._exact

    def span(self, s: int, e: int) -> tuple[int, int]:
        return self._span


class _Run:
    """A base64 run, its lines joined: ``body`` without the breaks."""

    def __init__(self, m: re.Match):
        self.start, self.end = m.span()
        lines = list(_LINE.finditer(m[0]))
        self.body = "".join(x[0] for x in lines)
        self.at = [self.start + x.start() for x in lines]  # each line's place, and where it starts in the body
        self.line = [0, *itertools.accumulate(len(x[0]) for x in lines)]

    def place(self, c: int) -> int:
        """Where character ``c`` of the body stands."""
        i = bisect.bisect_right(self.line, c, 0, len(self.at)) - 1
        return self.at[i] + c - self.line[i]

    @functools.cached_property
    def cuts(self) -> np.ndarray:
        """Places in the body after a delimiter or a line break."""
        return np.array(sorted({m.end() for m in _DELIMITER.finditer(self.body)} | set(self.line[1:-1])), np.int64)

    @functools.cached_property
    def stops(self) -> np.ndarray:
        """Places in the body before a delimiter or a line break."""
        return np.array(sorted({m.start() for m in _DELIMITER.finditer(self.body)} | set(self.line[1:-1])), np.int64)


class _Decoded:
    """A run of ``layer`` decoded from character ``offset`` on."""

    def __init__(self, layer: _Layer, run: _Run, offset: int):
        self.layer, self.run, self.offset = layer, run, offset
        self.raw = _base64_bytes(run.body[offset:])
        self.text = _text(self.raw)
        # a run that stands at the end of a slice goes on after it
        tail = len(layer.text) - run.end
        goes_on = layer.rest is not None and tail < 256 and not layer.text[run.end:].strip()
        self.rest = self._rest if goes_on else None

    def _rest(self, byte: int):
        """The bytes from ``byte`` on, to the end of the run in the whole stream."""
        at = self.run.place(self.offset + byte // 3 * 4)
        return _skip(_unbase64(self.layer.rest(at)), byte % 3)

    def as_layer(self) -> _Layer:
        rest = self.rest and (lambda c: self.rest(int(self.widths[c])))
        return _Layer(self.text, None, None, self, False, rest)

    @functools.cached_property
    def widths(self) -> np.ndarray:
        return _widths(self.text)

    @functools.cached_property
    def odd(self) -> np.ndarray:
        """Bytes that are no text: not UTF-8, or control characters."""
        return self.widths[[m.start() for m in _ODD.finditer(self.text)]]

    def place(self, s: int, e: int) -> tuple[int, int]:
        """The interval of the run's characters that hold bytes ``s`` to ``e``."""
        last = min(self.offset + (8 * e - 1) // 6, len(self.run.body) - 1)
        return (self.run.place(self.offset + 8 * s // 6),
                self.run.end if e == len(self.raw) else self.run.place(last) + 1)

    def exact(self, s: int, e: int) -> tuple[int, int]:
        return self.layer.exact(*self.place(int(self.widths[s]), int(self.widths[e])))

    def span(self, s: int, e: int) -> tuple[int, int]:
        """The longest stretch of text around a match that starts and ends with
        the run, a line or a delimiter; odd bytes that no such place parts from
        the match belong to it."""
        s, e = int(self.widths[s]), int(self.widths[e])
        run, o, odd = self.run, self.offset, self.odd
        i, j = np.searchsorted(odd, [s, e])
        low, high = (int(odd[i - 1]) + 1 if i else 0), (int(odd[j]) if j < len(odd) else len(self.raw))
        start, end = o, len(run.body)
        if low:
            cut = run.cuts[(run.cuts >= o) & ((run.cuts - o) % 4 == 0)]
            byte = (cut - o) // 4 * 3
            cut = cut[(byte >= low) & (byte <= s)]
            start = int(cut[0]) if len(cut) else o
        if high < len(self.raw):
            stop = run.stops[run.stops > o]
            byte = (stop - o) * 3 // 4
            stop = stop[(byte <= high) & (byte >= e)]
            end = int(stop[-1]) if len(stop) else end
        return self.layer.span(run.place(start), run.end if end == len(run.body) else run.place(end - 1) + 1)


def _skip(chunks, n: int):
    """The stream without its first ``n`` bytes."""
    for c in chunks:
        if n < len(c):
            yield c[n:] if n else c
        n = max(0, n - len(c))


def _unbase64(chunks):
    """Base64 characters as bytes, up to the first that is neither one nor white space."""
    held = b""
    for c in chunks:
        c = bytes(c)
        end = _FOREIGN.search(c)
        held += b"".join((c[:end.start()] if end else c).split())
        whole = len(held) - len(held) % 4
        if whole:
            yield base64.b64decode(held[:whole].translate(_URLSAFE))
            held = held[whole:]
        if end:
            break
    if len(held) > 1:
        yield base64.b64decode(held.translate(_URLSAFE) + b"=" * (4 - len(held)))


def _unescaped(chunks, pattern: re.Pattern, decode):
    """The stream with every decodable run replaced; an escape, at most ten
    characters, is never parted."""
    utf8, held = codecs.getincrementaldecoder("utf-8")("surrogateescape"), ""
    for c in itertools.chain(chunks, (None,)):
        text = held + (utf8.decode(b"", True) if c is None else utf8.decode(bytes(c)))
        cut = len(text)
        if c is not None:
            cut = min((i for m in "%\\&" if (i := text.find(m, max(0, cut - 16))) >= 0), default=cut)
        held, done = text[cut:], []
        at = 0
        for m in pattern.finditer(text[:cut]):
            if (out := decode(m[0])) is not None:
                done += (text[at:m.start()], out)
                at = m.end()
        yield "".join((*done, text[at:cut])).encode("utf-8", "surrogateescape")


def _as_codes(chunks):
    """UTF-8 whose code points stand for bytes, as those bytes."""
    utf8 = codecs.getincrementaldecoder("utf-8")("surrogateescape")
    for c in chunks:
        yield utf8.decode(bytes(c)).translate(_POINTS).encode("latin-1", "replace")


def _pieces(raw: bytes, at: int):
    view = memoryview(raw)
    for s in range(at, len(raw), _IN):
        yield view[s:s + _IN]


class _Members:
    """The members or frames at the start of a stream, one after the other, as
    chunks of output; ``end`` is then the place after the last one that gave
    any, and ``cut`` whether the input ended inside one."""

    def __init__(self, chunks):
        self.chunks, self.end, self.cut = iter(chunks), 0, False
        self._held = memoryview(b"")

    def _take(self, n: int) -> memoryview:
        """Input at hand, ``n`` bytes or more unless the stream ends."""
        while len(self._held) < n and (c := next(self.chunks, None)) is not None:
            self._held = memoryview(bytes(self._held) + bytes(c) if len(self._held) else c)
        return self._held

    def __iter__(self):
        at = 0
        try:
            while (d := _decoder(bytes(self._take(6)[:6]))) is not None:
                # a zstd object takes no limit of output: its input is kept short
                step, most = (_IN, (_OUT,)) if not isinstance(d, _ZSTD) else (256, ())
                data = b""
                while not d.eof:
                    if not data and getattr(d, "needs_input", True):
                        data = self._take(1)[:step]
                        self._held = self._held[len(data):]
                        at += len(data)
                        if not data:  # a cut stream: what it held so far counts
                            self.end, self.cut = at, True
                            if hasattr(d, "flush") and (out := d.flush()):
                                yield out
                            return
                    out = d.decompress(data, *most)
                    data = getattr(d, "unconsumed_tail", b"")
                    if out:
                        self.end = max(self.end, at - len(data))
                        yield out
                at -= len(d.unused_data)
                self._held = memoryview(bytes(d.unused_data) + bytes(self._held))
                self.end = at
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
            return


def _decoder(head: bytes):
    if head[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if head[:2] in _ZLIB:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _streams(raw: bytes, memo: dict, above: tuple, rest=None):
    """(start, end, kinds of secrets inside, bombs) of every compressed stream
    in ``raw``.  With ``rest``, ``raw`` is a slice: a stream that outlasts it is
    read on, and the last bytes are left to the next slice, which repeats them."""
    key = hashlib.sha256(raw).digest() if rest is None and _MAGIC.search(raw) else None
    found, at = memo.get(key), 0
    if found is None:
        found, until = [], len(raw) - (_OVERLAP // 16 if rest else 0)
        while (m := _MAGIC.search(raw, at)) is not None and m.start() < until:
            start, made, outlasts = m.start(), [], False
            if rest:
                probe = _Members(_pieces(raw, start))
                for _ in probe:
                    pass
                outlasts = probe.cut

            def source():
                members = _Members(rest(start) if outlasts else _pieces(raw, start))
                made or made.append(members)  # the first one is read to its end
                return members

            kinds, bombs = _inside(source, memo, above)
            end = min(len(raw), start + made[0].end)
            if kinds or bombs:
                found.append((start, end, kinds, bombs))
                at = max(end, start + 1)
            else:
                at = start + 1
        if key and None not in memo:
            memo[key] = found
    return found


def _inside(source, memo: dict, above: tuple) -> tuple[frozenset, int]:
    """The kinds of secrets in a stream, at any depth, and the bombs in it.
    ``source()`` gives its chunks, from the start at each call."""
    kinds, bombs, kept, total, base, open_end = set(), 0, bytearray(), 0, 0, b""

    def look(part: bytes, rest=None):
        nonlocal bombs
        if not part:
            return
        key = hashlib.sha256(part).digest()
        if key in above:  # a stream that holds itself adds nothing
            memo[None] = True  # what is found below is not the whole of each stream: no longer kept
            return
        known, read_on = memo.get(("slice", key)), []
        if known is None:
            chain, mine, n = (*above, key), set(), 0
            follow = rest and (lambda b: read_on.append(b) or rest(b))
            inner, n = _find(_text(part), memo, chain, follow)[1:]
            mine.update(k for k, _, _ in inner)
            for _, _, k, deeper in _streams(part, memo, chain, follow):
                mine.update(k)
                n += deeper
            known = mine, n
            if rest and not read_on and None not in memo:  # equal slices of a bomb are scanned once
                memo["slice", key] = known
        kinds.update(known[0])
        bombs += known[1]

    for out in source():
        total += len(out)
        kept += out
        if total > MAX_INFLATED:
            open_end = _SPACES.sub(b" ", open_end + (out if open_end else bytes(kept)))
            low = open_end.lower() if "assign" not in kinds else b""
            if any(w.encode() in low for w in _WORDS) and _ASSIGNED.search(low):
                kinds.add("assign")
            open_end = open_end[-64:]
            while len(kept) >= _SLICE:
                part = bytes(kept[:_SLICE])
                look(part, functools.partial(lambda at, b: _skip(source(), at + b), base))
                del kept[:_SLICE - _OVERLAP]
                base += _SLICE - _OVERLAP
    look(bytes(kept))
    return frozenset(kinds), bombs + (total > MAX_INFLATED)


def _base64_bytes(body: str) -> bytes:
    body = body[:len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], set[tuple[str, int, int]], int]:
    """(base matches of the text, all spans over all layers, bombs met)."""
    return _find(text, {}, ())


def _find(text: str, memo: dict, above: tuple, rest=None):
    base = scan(text)
    spans = set(base)
    onward = rest and (lambda c: rest(len(text[:c].encode("utf-8", "surrogateescape"))))
    work, seen, bombs = [_Layer(text, rest=onward)], set(), 0

    def push(layer):
        if layer is None or not layer.text:
            return False
        # an equal text from another run has spans of its own
        key = (layer.text, *layer.exact(0, len(layer.text)), layer.sure)
        if key in seen:
            return False
        seen.add(key)
        work.append(layer)
        return True

    def add(interval, kinds, n):
        nonlocal bombs
        spans.update((k, *interval) for k in kinds)
        bombs += n

    first, whole, guessed = True, {}, []
    while work:
        layer = work.pop()
        for k, s, e in () if first else scan(layer.text):
            if not layer.sure:
                guessed.append((k, layer, s, e))
                continue
            spans.add((k, *layer.span(s, e)))
            if isinstance(layer.parent, _Fixed):
                whole.setdefault(k, set()).add(layer.span(s, e))
        first = False
        for marks, pattern, decode in ((("%",), _PERCENT, _percent), (("\\", "%u", "&#"), _ESCAPE, _escape)):
            if any(m in layer.text for m in marks) and push(inner := layer.unescaped(pattern, decode)):
                for found in inner.streams(memo, above):
                    add(*found)
        for m in _JOINED.finditer(layer.text):
            run = _Run(m)
            if len(run.body) < 16:
                continue
            clean = False
            for p in _BASE64.finditer(layer.text, m.start(), m.end()):
                body = p[0].rstrip("=")
                out = _text(_base64_bytes(body)) if len(body) % 4 != 1 else ""
                if out and not _ODD.search(out):  # a line that is text as a whole
                    push(_Layer(out, None, None, _Fixed(layer.exact(*p.span()), layer.span(*p.span())), layer.sure))
                    clean = clean or len(body) == len(run.body) and layer.rest is None
            for offset in range(4):
                inner = _Decoded(layer, run, offset)
                for s, e, kinds, n in _streams(inner.raw, memo, above, inner.rest):
                    add(layer.span(*inner.place(s, e)), kinds, n)
                if offset or not clean:
                    push(inner.as_layer())
    known = {k: sorted(v) for k, v in whole.items()}
    reach = {k: list(itertools.accumulate((e for _, e in v), max)) for k, v in known.items()}
    for k, layer, s, e in guessed:
        lo, hi = layer.exact(s, e)
        i = bisect.bisect_right(known.get(k, []), (lo, len(text) + 1))
        if not i or reach[k][i - 1] < hi:  # else a line that is text as a whole has it
            spans.add((k, *layer.span(s, e)))
    return base, spans, bombs


def _order(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_bombs."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_bombs")}
            for text in b["_text"]:
                base, spans, bombs = find_spans(text)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                out["base_sha256"].append(hashlib.sha256(_joined(_order(base)).encode()).hexdigest())
                out["spans"].append(_joined(_order(spans)))
                out["n_bombs"].append(bombs)
            yield {"doc_id": b["doc_id"], **out}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                               "base_sha256 string, spans string, n_bombs long")


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every found interval replaced by ``mark``; overlapping
    intervals are joined first."""
    parts, at = [], 0
    for s, e in sorted({(s, e) for _, s, e in find_spans(text)[1]}):
        if e <= at:
            continue
        if s >= at:
            parts += [text[at:s], mark]
        at = e
    return "".join(parts) + text[at:] if parts else text


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with their secrets replaced; columns stay, ``n_chars`` (where
    present) follows the new text; a null text stays null."""
    names = docs.columns

    def run(batches):
        for b in batches:
            text = [None if t is None else redact(t) for t in b["text"]]
            out = {**b, "text": text}
            if "n_chars" in b:
                out["n_chars"] = [n if t == old else len(t) for n, t, old in zip(b["n_chars"], text, b["text"])]
            yield out

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs, run, types).select(*names)
