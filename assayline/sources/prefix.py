"""The first line of a file, by reading a prefix of it."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping
from urllib.parse import quote, unquote, urlsplit

CHUNK = 1 << 14
BOM = "\ufeff"
#: Endings under which a file is packed; only the first can be read here.
PACKED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")


def opened(path: str):
    """A file handle for a path or URI, through the file systems pyarrow has."""
    parts = urlsplit(path) if "://" in path or path.startswith("file:") else None
    if parts is None or parts.scheme == "file":
        local = path if parts is None else path.removeprefix("file:")
        return open("/" + local.lstrip("/") if parts else local, "rb")
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(quote(unquote(path), safe=":/@?=&"))
    return store.open_input_stream(name)


def first_line(path: str, options: Mapping[str, str], handle: Callable = opened) -> tuple[str | None, bool]:
    """(first line that is not blank, whether the file could be read here).

    Reads CHUNK bytes at a time, until a line with something in it has ended or the
    file has. A byte order mark is taken off.
    """
    low = path.lower()
    gzip = low.endswith(".gz")
    if not gzip and low.endswith(PACKED):
        return None, False
    encoding = options.get("encoding", options.get("charset", "UTF-8"))
    try:
        ends = [e.encode(encoding) for e in ([options["lineSep"]] if "lineSep" in options else ["\n", "\r"])]
        if len("\n".encode(encoding)) > 1:  # a byte of one letter may look like a line's end
            return None, False
        unpack = zlib.decompressobj(31) if gzip else None
        with handle(path) as f:
            buffer = b""
            while True:
                more = f.read(CHUNK)
                buffer += unpack.decompress(more) if unpack and more else more
                line = _complete(buffer, ends, not more)
                if line is not None or not more:
                    text = line.decode(encoding, "replace").lstrip(BOM) if line is not None else None
                    return text or None, True
    except (OSError, ValueError, LookupError, ImportError, zlib.error):
        return None, False


def _complete(buffer: bytes, ends: list[bytes], at_end: bool) -> bytes | None:
    """First line of the buffer that is not blank, if it has ended."""
    for end in ends[1:]:
        buffer = buffer.replace(end, ends[0])
    lines = buffer.split(ends[0])
    for line in lines if at_end else lines[:-1]:
        if line.strip(b" \t\r\n").removeprefix(b"\xef\xbb\xbf").strip():
            return line
    return None
