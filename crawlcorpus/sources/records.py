"""The archive byte format: records out of a stream, and back."""

import io
import zlib
from collections import deque

import zstandard

from .files import located

#: What reading raises where an archive itself is at fault. Anything else, such as a failure
#: of the network, is for a retry of the task to cure.
FORMAT_ERRORS = (ValueError, EOFError, zlib.error, zstandard.ZstdError)

_HTTP_RECORDS = ("response", "request", "revisit")


class GzipMembers(io.RawIOBase):
    """Concatenated gzip members as one stream.

    What precedes damage is delivered before the damage is raised, so that every whole
    record of a cut-off archive is read. ``starts`` tells where members begin, in what they
    inflate to and in the file, from the last one asked about on.
    """

    def __init__(self, stream, offset: int = 0):
        self.stream, self.inflate, self.rest = stream, None, b""
        self.offset, self.out = offset, 0  # of the next compressed byte in the file; inflated so far
        self.starts: deque[tuple[int, int]] = deque()

    def readable(self):
        return True

    def readinto(self, buffer):
        while True:
            if self.inflate is None:
                self.rest = self.rest or self.stream.read(1 << 16)
                if not self.rest:
                    return 0
                self.inflate = zlib.decompressobj(31)
                self.starts.append((self.out, self.offset))
            data = self.rest or self.stream.read(1 << 16)
            out = self.inflate.decompress(data, len(buffer))
            if not (data or out or self.inflate.eof):
                raise EOFError("compressed stream is cut off")
            self.rest = self.inflate.unconsumed_tail
            if self.inflate.eof:
                # zero padding between members is allowed
                self.rest, self.inflate = self.inflate.unused_data.lstrip(b"\0"), None
            self.offset += len(data) - len(self.rest)
            self.out += len(out)
            if out:
                buffer[:len(out)] = out
                return len(out)

    def start_of(self, at: int) -> tuple[int, int]:
        """The last member that begins at or before a place of the inflated stream. Places
        must ascend from one question to the next."""
        while len(self.starts) > 1 and self.starts[1][0] <= at:
            self.starts.popleft()
        return self.starts[0] if self.starts else (0, 0)


class _Plain(io.RawIOBase):
    """A stream as it is, from an offset of the file on."""

    def __init__(self, stream, offset: int = 0):
        self.stream, self.offset = stream, offset

    def readable(self):
        return True

    def readinto(self, buffer):
        data = self.stream.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def start_of(self, at: int) -> tuple[int, int]:
        return at, self.offset + at


def open_archive(path: str, offset: int = 0) -> io.BufferedIOBase:
    """A decompressed stream, by suffix, from any file system Arrow knows; from a member on,
    where ``offset`` is given."""
    filesystem, local = located(path)
    if offset:
        stream = filesystem.open_input_file(local)
        stream.seek(offset)
    else:
        stream = filesystem.open_input_stream(local, compression=None)
    if path.endswith(".gz"):
        return io.BufferedReader(GzipMembers(stream, offset), 1 << 16)
    if path.endswith(".zst"):
        inflate = zstandard.ZstdDecompressor(max_window_size=2**31)
        return io.BufferedReader(inflate.stream_reader(stream, read_across_frames=True),
                                 1 << 16)
    return io.BufferedReader(_Plain(stream, offset), 1 << 16)


def next_record(path: str, after: int) -> int | None:
    """Where the first record behind a place of a file begins, found by what a record or a
    gzip member begins with; None if there is none, or if the codec has no such places."""
    gzipped = path.endswith(".gz")
    if path.endswith(".zst"):
        return None
    mark = b"\x1f\x8b\x08" if gzipped else b"\r\n\r\nWARC/1."
    filesystem, local = located(path)
    with filesystem.open_input_file(local) as file:
        size, at, tail = file.size(), after + 1, b""
        while at < size:
            file.seek(at)
            data = tail + file.read(1 << 20)
            first = at - len(tail)
            found = data.find(mark)
            while found >= 0:
                place = first + found
                if not gzipped:
                    return place + 4
                file.seek(place)
                try:
                    if zlib.decompressobj(31).decompress(file.read(1 << 12), 5) == b"WARC/":
                        return place
                except zlib.error:
                    pass
                found = data.find(mark, found + 1)
            at, tail = first + len(data), data[-(len(mark) - 1):]
    return None


def _text(line: bytes) -> str:
    try:
        return line.decode("utf-8")
    except UnicodeDecodeError:
        return line.decode("latin-1")


def _read_headers(stream) -> tuple[dict, bytes]:
    """Headers up to the blank line, names in lower case, and the bytes they came in.

    Of a header that is repeated the first value counts; the bytes keep all.
    """
    headers, raw, name = {}, [], None
    for line in iter(stream.readline, b""):
        raw.append(line)
        content = _text(line.rstrip(b"\r\n"))
        if not content:
            return headers, b"".join(raw)
        if content[0] in " \t":
            if name:
                headers[name] += " " + content.strip()
        elif ":" in content:
            name, value = content.split(":", 1)
            name = name.strip().lower()
            if name in headers:
                name = None
            else:
                headers[name] = value.strip()
    return headers, b"".join(raw)


def _holds_http(headers: dict) -> bool:
    return (headers.get("warc-type") in _HTTP_RECORDS
            and headers.get("content-type", "").startswith("application/http"))


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def _http_body(headers: dict, body: bytes) -> bytes | None:
    """The body without transfer and content coding; as it is when those are false, that is, when
    it does not begin like it; None when it does, but cannot be undone."""
    try:
        if headers.get("transfer-encoding", "").lower() == "chunked":
            body = _dechunked(body)
    except ValueError:
        pass
    coding = headers.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip") and body[:2] == b"\x1f\x8b":
        try:
            return zlib.decompressobj(31).decompress(body)
        except zlib.error:
            return None
    try:
        if coding == "deflate":
            return zlib.decompressobj(15 if body[:1] == b"\x78" else -15).decompress(body)
    except zlib.error:
        pass
    return body


class Position:
    """Where a reader is in the inflated stream: at the beginning of the record it reads."""

    at = 0


def _skipped(stream, length: int) -> int:
    left = length
    while left:
        data = stream.read(min(left, 1 << 20))
        if not data:
            break
        left -= len(data)
    return length - left


def read_records(stream, *, wanted=None, content: bool = True, raw: bool = True,
                 http_headers: bool = True, position: Position | None = None):
    """Yield ``(headers, http_headers, content, raw)`` until the stream ends.

    Records whose headers are not ``wanted`` yield None. What is not asked for is None, and is
    neither decoded nor, without any of it, kept in memory. Raises ``ValueError`` where it is not an
    archive, ``EOFError`` where it is cut off.
    """
    position = position or Position()
    end = 0
    while True:
        position.at = end
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            end += len(line)
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers, head = _read_headers(stream)
        size = headers.get("content-length", "")
        if not size.isdigit():
            raise ValueError(f"no usable Content-Length: {size!r}")
        size = int(size)
        end += len(line) + len(head) + size
        own = wanted is None or wanted(headers)
        holds_http = own and _holds_http(headers) and (content or http_headers)
        block = stream.read(size) if own and (content or raw or holds_http) else None
        read = _skipped(stream, size) if block is None else len(block)
        if read < size:
            raise EOFError(f"record cut off after {read} of {size} bytes")
        if not own:
            yield None
            continue
        http, body = None, block if content else None
        if holds_http:
            inner = io.BytesIO(block)
            status = _text(inner.readline().strip())
            http, _ = _read_headers(inner)
            body = _http_body(http, inner.read()) if content else None
            http[":status"] = status
        yield headers, http, body, line + head + block + b"\r\n\r\n" if raw else None


def _header_lines(headers) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in headers if not k.startswith(":"))


def write_record(headers: dict, http: dict | None, content: bytes) -> bytes:
    """A record from its parts, with the length its content has now."""
    block = content or b""
    if _holds_http(headers):
        http = http or {}
        kept = [(k, v) for k, v in http.items()
                if k not in ("transfer-encoding", "content-encoding", "content-length")]
        kept.append(("content-length", str(len(block))))
        status = http.get(":status", "HTTP/1.1 200 OK").encode()
        block = status + b"\r\n" + _header_lines(kept) + b"\r\n" + block
    kept = [(k, v) for k, v in headers.items() if k != "content-length"]
    kept.append(("content-length", str(len(block))))
    return b"WARC/1.0\r\n" + _header_lines(kept) + b"\r\n" + block + b"\r\n\r\n"
