"""Archives made by the tests."""

import gzip

import zstandard

from crawlcorpus.sources.records import write_record


def record(kind, number, content=b"", http=True, **headers):
    """One record; a keyword such as ``Content_Type`` sets a header, None removes one."""
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{number}>",
        "WARC-Target-URI": f"http://example.org/{number}", "WARC-Date": "2021-01-15T00:00:00Z",
        "WARC-Identified-Payload-Type": "text/html",
        "Content-Type": "application/http; msgtype=response" if http else "text/plain",
    }
    for name, value in headers.items():
        fields[name.replace("_", "-")] = value
    block = content
    if http:
        block = b"HTTP/1.1 200 OK\r\nServer: test\r\n\r\n" + content
    lines = [f"{k}: {v}\r\n" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}\r\n")
    return b"WARC/1.0\r\n" + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def write(path, records, cut=0):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.name.endswith(".gz"):
        data = b"".join(gzip.compress(r) for r in records)
    elif path.name.endswith(".zst"):
        data = zstandard.ZstdCompressor().compress(b"".join(records))
    else:
        data = b"".join(records)
    path.write_bytes(data[:len(data) - cut] if cut else data)
    return str(path)


PAGE = b"<html><body><h1>Head</h1><p>Some <b>bold</b> text</p></body></html>"


def ordinary():
    return [
        record("warcinfo", "w", b"info", http=False),
        record("request", "q", b"", Content_Type="application/http; msgtype=request"),
        record("response", "r", PAGE),
        record("metadata", "m", b"meta", http=False),
        record("conversion", "c", b"plain text", http=False,
               WARC_Identified_Payload_Type=None, WARC_Refers_To="<urn:uuid:r>"),
    ]


__all__ = ["record", "write", "ordinary", "PAGE", "write_record"]
