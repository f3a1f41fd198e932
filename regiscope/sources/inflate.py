"""A deflate stream that can be entered in many places: an index of checkpoints, made in one pass, and readers that start at one.

A checkpoint is the border of two blocks of the stream: where it lies (byte and bit), how many bytes came out before it, and
the last 32 KB of those, which the blocks after it refer to. It takes the C library's inflate, which Python's zlib module is
linked to but does not show these calls of.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

# Fixed values of the C library's interface.
NO_FLUSH, BLOCK, OK, STREAM_END, BUF_ERROR = 0, 5, 0, 1, -5
WINDOW = 1 << 15
READ, OUT = 1 << 20, 1 << 20


class _Stream(ctypes.Structure):
    _fields_ = [("next_in", ctypes.c_void_p), ("avail_in", ctypes.c_uint), ("total_in", ctypes.c_ulong), ("next_out", ctypes.c_void_p), ("avail_out", ctypes.c_uint), ("total_out", ctypes.c_ulong),
                ("msg", ctypes.c_char_p), ("state", ctypes.c_void_p), ("zalloc", ctypes.c_void_p), ("zfree", ctypes.c_void_p), ("opaque", ctypes.c_void_p), ("data_type", ctypes.c_int), ("adler", ctypes.c_ulong), ("reserved", ctypes.c_ulong)]


@functools.cache
def _library():
    for name in (getattr(zlib, "__file__", None), ctypes.util.find_library("z")):
        if name:
            found = ctypes.CDLL(name)
            if hasattr(found, "inflatePrime"):
                found.zlibVersion.restype = ctypes.c_char_p
                return found
    raise RuntimeError("the C library of zlib isn't here")


class Checkpoint(NamedTuple):
    """at: first whole byte of the compressed data; bits: so many of the byte before it come first; out: bytes that came out before; window: the last of them."""

    at: int
    bits: int
    out: int
    window: bytes


class Inflater:
    """Inflates raw deflate data from a checkpoint. read(n) gives the next bytes from the checkpoint's `at` on; `before` is the byte before that."""

    def __init__(self, read: Callable[[int], bytes], start: Checkpoint = Checkpoint(0, 0, 0, b""), before: int = 0):
        self.read, self.base, self.done, self._in = read, start.at, False, b""
        self.stream, self.lib, self.space = _Stream(), _library(), ctypes.create_string_buffer(OUT)
        if self.lib.inflateInit2_(ctypes.byref(self.stream), -15, self.lib.zlibVersion(), ctypes.sizeof(self.stream)) != OK:
            raise zlib.error("inflate can't start")
        if start.bits:
            self.lib.inflatePrime(ctypes.byref(self.stream), start.bits, before >> (8 - start.bits))
        if start.window:
            self.lib.inflateSetDictionary(ctypes.byref(self.stream), start.window, len(start.window))

    def step(self, flush: int = NO_FLUSH) -> bytes:
        """The next bytes; with BLOCK no further than the end of a block. Nothing only at the end of the stream, or of a block."""
        s = self.stream
        while not self.done:
            if not s.avail_in:
                self._in = self.read(READ)
                s.next_in, s.avail_in = ctypes.cast(ctypes.c_char_p(self._in), ctypes.c_void_p), len(self._in)
            s.next_out, s.avail_out = ctypes.addressof(self.space), OUT
            got = self.lib.inflate(ctypes.byref(s), flush)
            if got not in (OK, STREAM_END, BUF_ERROR):
                raise zlib.error(f"damaged data: {(s.msg or b'').decode() or got}")
            self.done = got == STREAM_END
            made = OUT - s.avail_out
            if made or (flush == BLOCK and s.data_type & 128):
                return ctypes.string_at(self.space, made)
            if not self.done and not s.avail_in and not self._in:
                raise EOFError("the compressed data ends too early")
        return b""

    def at_border(self) -> tuple[int, int] | None:
        """(byte, bits) if a block that isn't the last has just ended."""
        s = self.stream
        return (self.base + s.total_in, s.data_type & 7) if s.data_type & 128 and not s.data_type & 64 and not self.done else None

    def close(self) -> None:
        self.lib.inflateEnd(ctypes.byref(self.stream))

    def __iter__(self) -> Iterator[bytes]:
        while piece := self.step():
            yield piece


def checkpoints(read: Callable[[int], bytes], span: int, seen: Callable[[bytes], object]) -> Iterator[Checkpoint]:
    """Checkpoints at least `span` bytes of output apart, the first at the start. `seen` is given all that comes out, in order, each piece before a checkpoint behind it."""
    start = Checkpoint(0, 0, 0, b"")
    yield start
    inflater, out, last, window = Inflater(read), 0, 0, b""
    try:
        while not inflater.done:
            piece = inflater.step(BLOCK)
            seen(piece)
            out += len(piece)
            window = piece[-WINDOW:] if len(piece) >= WINDOW else (window + piece)[-WINDOW:]
            if out - last >= span and (border := inflater.at_border()):
                yield Checkpoint(*border, out, window)
                last = out
    finally:
        inflater.close()
