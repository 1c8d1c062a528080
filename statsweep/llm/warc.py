"""WARC derivative builder: a metadata and a plain-text conversion record for every response record.

Both refer to the response (``WARC-Refers-To``, its URI and date); the metadata record is concurrent to the conversion
and holds the response's HTTP status, headers and digests as ``application/warc-fields``. Record ids are UUIDs derived
from the response's id, so a task that runs again after a lost executor makes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:derivative")
UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head|template|noscript)(?=[\s/>]).*?(?:</\1\s*>|\Z)", re.S | re.I)
BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|blockquote|pre|hr|dt|dd|title)(?=[\s/>])[^>]*>", re.I)
TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
BLANKS, LINES = re.compile(r"[ \t\r\f\v\xa0]+"), re.compile(r" ?\n[ \n]*")
MAX_INFLATED = 64 << 20  # bytes; a payload that decodes to more gets its metadata record only
CHUNK = re.compile(rb"[ \t]*([0-9a-fA-F]+)[ \t]*(?:;[^\r\n]*)?\r?\n")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC headers write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; without a header block all of it is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines if ":" in x)], payload


def unchunk(payload: bytes) -> bytes:
    """The data of a chunked payload, a last part that is cut short included; one that isn't chunks throughout, because
    it was unchunked before, stays as it is."""
    out, at = [], 0
    while at < len(payload):
        m = CHUNK.match(payload, at)
        if not m:
            return payload
        size = int(m[1], 16)
        end = m.end() + size
        out.append(payload[m.end():end])
        if not size:
            break
        if end < len(payload) and payload[end:end + 1] not in (b"\r", b"\n"):
            return payload
        at = end + (2 if payload[end:end + 2] == b"\r\n" else 1)
    return b"".join(out)


def inflate(payload: bytes, wbits: int, limit: int = MAX_INFLATED) -> bytes | None:
    """Decompressed data, all members, as far as it goes; null if it isn't such data or is more than ``limit`` bytes.
    No more than that is ever held, however small the payload is."""
    out, size = [], 0
    while payload:
        d = zlib.decompressobj(wbits)
        try:
            part = d.decompress(payload, limit - size + 1)
            size += len(part)
            if size > limit:
                return None
            out.append(part + d.flush())
        except zlib.error:
            return b"".join(out) if out else None  # what follows the last whole member is no part of it
        payload = d.unused_data
    return b"".join(out)


def undo_codings(headers: list[tuple[str, str]], payload: bytes) -> bytes | None:
    """The payload without its transfer and content codings, the last applied first; null if one can't be undone.
    A payload without gzip's first bytes was decoded before, as some archives store it."""
    named = lambda name: [c.strip().lower() for k, v in headers if k.lower() == name for c in v.split(",")]
    data: bytes | None = payload
    for coding in reversed(named("content-encoding") + named("transfer-encoding")):
        if not data or coding in ("", "identity"):
            continue
        if coding == "chunked":
            data = unchunk(data)
        elif coding in ("gzip", "x-gzip"):
            data = inflate(data, 31) if data[:2] == b"\x1f\x8b" else data
        elif coding == "deflate":
            zlibbed = inflate(data, 15)
            data = zlibbed if zlibbed is not None else inflate(data, -15)
        else:
            return None
    return data


def plain_text(payload: bytes, content_type: str) -> str:
    """Text of a payload: markup off for HTML, as it is for other text. Bytes that don't decode become U+FFFD."""
    m = CHARSET.search(content_type)
    try:
        text = payload.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        text = payload.decode("utf-8", "replace")
    if "html" in content_type.lower():
        text = unescape(TAG.sub("", BREAK.sub("\n", UNSEEN.sub("", text.replace("\n", " ")))))
    return LINES.sub("\n", BLANKS.sub(" ", text)).strip()


def record(kind: str, record_id: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Bytes of a WARC/1.1 record."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def derive(record_id: str, uri: str, date: str, block: bytes) -> list[dict]:
    """The metadata record and, for a text payload whose codings can be undone, the conversion record of one response.
    Source digests and lengths are those of the payload as it is stored."""
    status, headers, payload = split_http(block)
    content_type = next((v for k, v in headers if k.lower() == "content-type"), "application/octet-stream" if status else "text/html")
    seed = record_id.strip("<>")
    new_id = lambda kind: f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {seed}')}>"
    one_line = lambda v: " ".join(v.split())
    refers = [("WARC-Target-URI", one_line(uri)), ("WARC-Date", date), ("WARC-Refers-To", record_id), ("WARC-Refers-To-Target-URI", one_line(uri)), ("WARC-Refers-To-Date", date)]
    source_digest = digest(payload)
    out = []
    is_text = "html" in content_type.lower() or content_type.lower().startswith("text/")
    plain = undo_codings(headers, payload) if is_text else None
    is_text = plain is not None
    if is_text:
        text = plain_text(plain, content_type).encode()
        fields = [*refers, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Block-Digest", digest(text)), ("WARC-Payload-Digest", digest(text))]
        out.append({"record_type": "conversion", "record_id": new_id("conversion"), "block": text, "fields": fields})
    lines = [("source-status", status), *(("source-header", f"{k}: {v}") for k, v in headers), ("source-payload-digest", source_digest),
             ("source-block-digest", digest(block)), ("source-length", str(len(payload)))]
    if is_text:
        lines += [("conversion", out[0]["record_id"]), ("conversion-digest", digest(out[0]["block"])), ("conversion-length", str(len(out[0]["block"])))]
    body = "".join(f"{k}: {one_line(v)}\r\n" for k, v in lines).encode()
    fields = [*refers, *([("WARC-Concurrent-To", out[0]["record_id"])] if is_text else []), ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", digest(body))]
    out.append({"record_type": "metadata", "record_id": new_id("metadata"), "block": body, "fields": fields})
    for r in out:
        r["record"] = record(r["record_type"], r["record_id"], r["fields"], r["block"])
        r["digest"], r["source_digest"] = digest(r["block"]), source_digest
    return out


COLUMNS = ("record_type", "record_id", "refers_to", "target_uri", "content_length", "block_digest", "source_payload_digest", "record_sha256")


def build_derivatives(responses: DataFrame, content: bool = True) -> DataFrame:
    """Derived records of ``responses(record_id, target_uri, date, block, ...)``; ``block`` (binary) is the HTTP response.

    Returns ``record_type`` (conversion or metadata), ``record_id``, ``refers_to``, ``target_uri``, ``content_length``,
    ``block_digest``, ``source_payload_digest``, ``record_sha256`` and, with ``content``, ``record`` (the WARC record's
    bytes). A null block is an empty one, a null URI or date an empty field. Rows without a record id can't be referred
    to and give no records. Repeated rows give equal records, once each; payloads that aren't text, whose encoding can't
    be undone (all but chunked, gzip and deflate) or that inflate to more than ``MAX_INFLATED`` bytes give metadata only.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for rid, uri, date, block in zip(*(batch.slice(at, 500).column(i).to_pylist() for i in range(4))):
                    for r in derive(rid, uri or "", date or "", block or b""):
                        rows.append((r["record_type"], r["record_id"], rid, uri or "", len(r["block"]), r["digest"], r["source_digest"],
                                     hashlib.sha256(r["record"]).hexdigest(), *[r["record"]] * content))
                cols = list(zip(*rows)) or [()] * (8 + content)
                kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 3 + [pa.binary()] * content
                yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(cols, kinds)], names=[*COLUMNS, *["record"] * content])

    schema = "record_type string, record_id string, refers_to string, target_uri string, content_length bigint, block_digest string, source_payload_digest string, record_sha256 string"
    src = responses.select("record_id", "target_uri", F.col("date").cast("string"), F.col("block").cast("binary")).where("record_id IS NOT NULL")
    return src.mapInArrow(run, schema + ", record binary" * content)
