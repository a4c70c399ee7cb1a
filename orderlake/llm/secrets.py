"""Secret scans with structural confirmation.

Three base patterns give candidates by shape (assignments, access key ids, hex strings).
The structural scan adds secrets that prove their structure: base64 or hex runs are
decoded and must parse as a private key (DER with consistent nested lengths, or the
OpenSSH container with its length-prefixed fields), and signed tokens must carry a JSON
header that names an algorithm.

Defined results: null text is empty (no spans); positions are code points, end exclusive;
repeated rows are scanned alike; an empty table gives an empty result; extra columns do
not matter. Every text is scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ["assign", "access", "hex", "pem", "der", "ssh", "jwt"]
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}")


def _from_base64(text: str, url: bool = False) -> bytes | None:
    try:
        padded = text.rstrip("=") + "=" * (-len(text.rstrip("=")) % 4)
        return (base64.urlsafe_b64decode if url else base64.b64decode)(padded)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the DER elements that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_der_private_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 or SEC1: one SEQUENCE that starts with a small version INTEGER and
    goes on with the fields of one of the three, every nested length consistent."""
    top = _elements(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    fields = _elements(top[0][1])
    if not fields or fields[0][0] != 0x02 or fields[0][1] not in (b"\x00", b"\x01", b"\x02"):
        return False
    tags = [t for t, _ in fields[1:]]
    if len(tags) >= 8 and all(t == 0x02 for t in tags[:8]):  # modulus, exponents, primes
        return True
    if tags[:2] == [0x30, 0x04]:  # algorithm, wrapped key
        kind = _elements(fields[1][1])
        return bool(kind) and kind[0][0] == 0x06
    return tags[:1] == [0x04] and len(fields[1][1]) >= 16 and set(tags[1:]) <= {0xA0, 0xA1}


def is_ssh_private_key(data: bytes) -> bool:
    """The OpenSSH container: magic, then length-prefixed cipher, kdf, options, keys."""
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    while at + 4 <= len(data) and fields < 3:
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        at, fields = at + 4 + size, fields + 1
    return fields == 3 and at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 16


def is_signed_token(header: str, payload: str) -> bool:
    for part, needs in ((header, "alg"), (payload, None)):
        raw = _from_base64(part, url=True)
        try:
            value = json.loads(raw) if raw else None
        except (ValueError, UnicodeDecodeError, RecursionError):
            return False
        if not isinstance(value, dict) or (needs and not isinstance(value.get(needs), str)):
            return False
    return True


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh" if is_ssh_private_key(data) else "der" if is_der_private_key(data) else None


def base_spans(text: str, runs: bool) -> list[tuple[int, int, str]]:
    low = text.lower()
    out = []
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if runs:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
        out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str, runs: bool) -> list[tuple[int, int, str]]:
    out, covered = [], []
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            if _key_kind(_from_base64("".join(m[2].split()))):
                out.append((m.start(), m.end(), "pem"))
                covered.append((m.start(), m.end()))
    if not runs:
        return out
    free = lambda m: not any(a < m.end() and m.start() < b for a, b in covered)
    if "eyJ" in text:
        out += [(m.start(), m.end(), "jwt") for m in _JWT.finditer(text) if is_signed_token(m[1], m[2])]
    for pattern, decode in ((_BASE64, _from_base64), (_LONG_HEX, bytes.fromhex)):
        for m in pattern.finditer(text):
            kind = _key_kind(decode(m[0])) if free(m) else None
            if kind:
                out.append((m.start(), m.end(), kind))
                covered.append((m.start(), m.end()))
    return out


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) as (start, end, kind), by start, then kind as listed."""
    # every run-shaped secret is 20 or more characters without white space
    runs = len(text) >= 20 and max(map(len, text.split()), default=0) >= 20
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text, runs), key=order)
    return base, sorted(base + confirmed_spans(text, runs), key=order)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_confirmed, base_sha256, spans."""
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, spans = scan(text.as_py() or "")
                count = [sum(s[2] == k for s in base) for k in BASE] if base else [0, 0, 0]
                rows.append((*count, len(spans) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(),
                             joined(spans)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string")
