"""Secret scans with structural confirmation.

Patterns of the base find assignments, access keys and hex strings. The method adds keys and signed tokens that are confirmed by their structure:
candidates in base64 or hex are decoded and reported only if the bytes parse.

* `jwt`: three or five base64url segments; the header is a JSON object that names a known algorithm, the claims are a JSON object, the signature
  has the algorithm's length (for encrypted tokens the vector and the tag have usual lengths).
* `key`: private keys in DER (PKCS#1, PKCS#8, SEC1, DSA, encrypted PKCS#8), whose nested lengths fill each other exactly, or in the OpenSSH format,
  whose counted strings do; as base64 (either alphabet, wrapped lines too) or hex. Public keys and certificates aren't secrets and aren't reported.
* Either of them encoded once more, as in base64 of a PEM file: decoded candidates are searched again, `depth` times at most.

A candidate starts where a run of its alphabet starts. Headers and counts say how long a key has to be, so no more than that is decoded; a file in base64 takes the
line or all wrapped lines, and what stands in lines that were tried as one file isn't tried as another.

Defined cases: a null or empty text has no spans; equal rows give equal spans, a null key too; spans of a kind don't overlap, those of different kinds may, and are
sorted by start, then by the order of KINDS; a very long text is scanned whole; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import text as X

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "key")

_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Last letters of the words that name a secret.
_LAST = X.byte_class(lambda b: b in b"dDtTnNyY")
_HEX = X.byte_class(lambda b: b in b"0123456789abcdef")
_ANY_HEX = X.byte_class(lambda b: b in b"0123456789abcdefABCDEF")
_B64 = X.byte_class(lambda b: chr(b) in "+/-_" or chr(b).isascii() and chr(b).isalnum())

_TOKEN_START, _KEY_START = re.compile(rb"(?<![A-Za-z0-9_-])eyJ"), re.compile(rb"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3Bl|LS0t|ZXlK)")
_HEX_RUN = re.compile(rb"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_JWT = re.compile(rb"eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,4}")
_LINE = re.compile(rb"[A-Za-z0-9+/_-]+")
_PADDING = re.compile(rb"={0,2}")
#: Between lines of wrapped base64: line ends, or their escapes in JSON and source code.
_WRAP = re.compile(rb"(?:\r?\n|(?:\\r)?\\n)[\x20\x09]*")

#: How an OpenSSH key begins, how it does in base64, a PEM file and a token's header in base64, and these and a DER sequence in hex.
_MAGIC, _OPENSSH, _NESTED = b"openssh-key-v1\0", b"b3BlbnNzaC1rZXktdj", (b"LS0tLS1CRUdJTi", b"ZXlK")
_HEX_OPENINGS = re.compile(rb"30|6f70656e7373682d6b65792d76|2d2d2d2d2d424547494e|65794a", re.I)
#: Bytes of a signature by algorithm; (least, most).
_SIGNATURES = {"HS256": (32, 32), "HS384": (48, 48), "HS512": (64, 64), "ES256": (64, 64), "ES256K": (64, 64), "ES384": (96, 96), "ES512": (132, 132), "EdDSA": (64, 114)} | {
    f"{a}{n}": (128, 2048) for a in ("RS", "PS") for n in (256, 384, 512)
}
#: Object identifiers of password-based encryption (PKCS#5, PKCS#12), of Edwards and Montgomery curves, and of RSA.
_PBE, _CURVES, _RSA = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01")), bytes.fromhex("2b65"), bytes.fromhex("2a864886f70d010101")
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def length(blob: bytes, at: int) -> tuple[int, int] | None:
    """Start of the content and its end for the DER element at `at`, or None."""
    if at + 2 > len(blob):
        return None
    n, to = blob[at + 1], at + 2
    if n >= 0x80:
        k = n - 0x80
        if not 1 <= k <= 4 or to + k > len(blob) or blob[to] == 0:
            return None
        n, to = int.from_bytes(blob[to : to + k], "big"), to + k
        if n < 0x80 or k > 1 and n < 1 << (8 * (k - 1)):
            return None  # DER takes the shortest form
    return to, to + n


def children(blob: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end of content) of the elements that fill [at, end) exactly."""
    out = []
    while at < end:
        own = length(blob, at)
        if not own or own[1] > end:
            return None
        out.append((blob[at], *own))
        at = own[1]
    return out


def sequence(blob: bytes, at: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """The elements of a sequence that fills [at, end)."""
    end = len(blob) if end is None else end
    own = length(blob, at) if at < end and blob[at] == _SEQUENCE else None
    return children(blob, *own) if own and own[1] == end else None


def private_key(blob: bytes) -> str | None:
    """The format of a DER private key that fills the bytes, else None."""
    parts = sequence(blob)
    if not parts:
        return None
    tags = [p[0] for p in parts]
    values = [blob[a:b] for _, a, b in parts]
    if tags == [_INTEGER] * 9 and values[0] == b"\0" and len(values[1]) >= 32:
        return "pkcs1"
    if tags == [_INTEGER] * 6 and values[0] == b"\0" and len(values[1]) > len(values[2]) >= 16:
        return "dsa"
    if tags[:2] == [_INTEGER, _OCTETS] and values[0] == b"\x01" and 16 <= len(values[1]) <= 80 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "sec1"
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and values[0] in (b"\0", b"\x01") and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
        named = children(blob, *parts[1][1:])
        if not named or named[0][0] != _OID:
            return None
        oid, inner = blob[named[0][1] : named[0][2]], values[2]
        if oid == _RSA:
            return "pkcs8" if private_key(inner) == "pkcs1" else None
        if oid.startswith(_CURVES):
            own = children(inner, 0, len(inner))
            return "pkcs8" if own and [t for t, _, _ in own] == [_OCTETS] and own[0][2] - own[0][1] in (32, 56, 57) else None
        return "pkcs8" if inner and children(inner, 0, len(inner)) else None
    if tags == [_SEQUENCE, _OCTETS]:
        named = children(blob, *parts[0][1:])
        if named and named[0][0] == _OID and blob[named[0][1] : named[0][2]].startswith(_PBE) and len(values[1]) >= 16:
            return "encrypted-pkcs8"
    return None


def openssh(blob: bytes) -> tuple[int, bool] | None:
    """Bytes that an OpenSSH key at the start takes, as far as its counts can be read, and whether that is all; None if it is none."""
    at, strings, left = len(_MAGIC), 0, 4
    if not _MAGIC.startswith(blob[:at]):
        return None
    while left:
        if at + 8 > len(blob):
            return at + max(8, 4 * left), False
        if strings == 3:  # cipher, derivation and its options; then the number of keys, at least one
            left = int.from_bytes(blob[at : at + 4], "big") + 1
            if left < 2:
                return None
            at += 4
        at, strings, left = at + 4 + int.from_bytes(blob[at : at + 4], "big"), strings + 1, left - 1
    return at, True


def unbase64(data: bytes) -> bytes | None:
    """Bytes of base64 in either alphabet, without padding."""
    if len(data) % 4 == 1:
        return None
    try:
        return base64.b64decode(data.translate(bytes.maketrans(b"-_", b"+/")) + b"=" * (-len(data) % 4), validate=True)
    except binascii.Error:
        return None


def _object(segment: bytes) -> dict | None:
    try:
        value = json.loads(unbase64(segment) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_token(data: bytes) -> tuple[int, str] | None:
    """Length and format of the token at the start of the bytes, which are segments joined by dots."""
    parts = data.split(b".")
    header = _object(parts[0])
    if not header or not isinstance(header.get("alg"), str):
        return None
    if len(parts) == 5 and isinstance(header.get("enc"), str):
        _, _, iv, body, tag = (unbase64(p) for p in parts)
        return (len(data), "jwe") if iv and len(iv) in (12, 16) and body and tag and 16 <= len(tag) <= 32 else None
    least, most = _SIGNATURES.get(header["alg"], (1, 0))
    signature = unbase64(parts[2]) if _object(parts[1]) is not None else None
    if signature is None or not least <= len(signature) <= most:
        return None
    return len(b".".join(parts[:3])), f"jwt-{header['alg']}"


def gather(data: bytes, at: int, end: int, need: int | None = None) -> tuple[bytes, int]:
    """Base64 characters from `at`, over wrapped lines, and where they and their padding end; with `need`, up to the line that completes so many."""
    lines, n, to = [], 0, at
    while m := _LINE.match(data, at, end):
        lines.append(m[0])
        n, to = n + len(m[0]), m.end()
        wrap = _WRAP.match(data, to, end) if need is None or n < need else None
        if not wrap:
            break
        at = wrap.end()
    return b"".join(lines), _PADDING.match(data, to, end).end()


def blocks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int]]:
    """What a file in base64 from `at` may be, with its end: the line alone, the wrapped lines, or these without the last, which may be prose."""
    yield gather(data, at, end, 1)
    body, to = gather(data, at, end)
    yield body, to
    last = re.search(rb"[A-Za-z0-9+/_-]*={0,2}\Z", data[at:to])
    wrap = re.search(rb"(?:\r?\n|(?:\\r)?\\n)[\x20\x09]*\Z", data[at : at + last.start()])
    if wrap:
        yield body[: len(body) - len(last[0].rstrip(b"="))], at + wrap.start()


def base64_key(data: bytes, at: int, end: int) -> tuple[int, str] | None:
    """End and format of a key in base64 that starts at `at`."""
    if data.startswith(_OPENSSH, at, end):
        known, whole, body = 24, False, b""
        while not whole or len(body) < -(-known * 4 // 3):
            need = -(-known * 4 // 3)
            if need > end - at:
                return None
            body, to = gather(data, at, end, need)
            own = openssh(unbase64(body[: len(body) // 4 * 4]) or b"") if len(body) >= need else None
            if not own:
                return None
            known, whole = own
        return (to, "openssh") if len(body) == -(-known * 4 // 3) else None
    opening, _ = gather(data, at, min(end, at + 64), 16)
    head = unbase64(opening[:16]) if len(opening) >= 16 else None
    own = length(head, 0) if head and head[0] == _SEQUENCE else None
    if not own or head[own[0]] not in (_INTEGER, _SEQUENCE):
        return None
    need = -(-own[1] * 4 // 3)
    if need > end - at:
        return None
    body, to = gather(data, at, end, need)
    found = private_key(unbase64(body) or b"") if len(body) == need else None
    return (to, found) if found else None


def confirm(blob: bytes, depth: int) -> str | None:
    """The format of the key or token that decoded bytes are, or that a file in them holds."""
    if found := private_key(blob):
        return found
    if openssh(blob) == (len(blob), True):
        return "openssh"
    return next((detail for _, _, _, detail in structural(blob, 0, len(blob), depth - 1)), None) if depth else None


def structural(data: bytes, lo: int, end: int, depth: int = 2) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, format) of confirmed tokens and keys in data[lo:end]; those of a kind don't overlap."""
    done = lo
    for m in _TOKEN_START.finditer(data, lo, end):
        got = _JWT.match(data, m.start(), end) if m.start() >= done else None
        if got and (found := signed_token(got[0])):
            done = m.start() + found[0]
            yield "jwt", m.start(), done, found[1]
    done = tried = lo
    for m in _KEY_START.finditer(data, lo, end):
        at = m.start()
        if at < done:
            continue
        if found := base64_key(data, at, end):
            done = found[0]
            yield "key", at, *found
        elif depth and at >= tried and data.startswith(_NESTED, at, end):
            tried = at
            for body, to in blocks(data, at, end):
                tried = max(tried, to)
                if detail := confirm(unbase64(body) or b"", depth):
                    done = to
                    yield "jwt" if "jw" in detail else "key", at, to, f"base64:{detail}"
                    break
    for m in _HEX_RUN.finditer(data, lo, end):
        if _HEX_OPENINGS.match(m[0]) and (detail := confirm(bytes.fromhex(m[0].decode()), depth)):
            yield "jwt" if "jw" in detail else "key", *m.span(), f"hex:{detail}"


def places(raw: bytes, what: bytes) -> np.ndarray:
    return np.array([m.start() for m in re.finditer(re.escape(what), raw)], np.int64)


def suspects(texts: X.Texts, raw: bytes) -> tuple[set[int], set[int]]:
    """Texts that may hold an assignment, and those that may hold a key or token, by tests of the whole chunk at once."""
    data = texts.data
    own = lambda at: set((np.searchsorted(texts.bounds, at, "right") - 1).tolist())
    written = np.maximum.accumulate(np.where(data == 0x20, -1, np.arange(len(data))))  # the last byte up to here that is no space
    back = written[np.maximum(np.flatnonzero((data == 0x3A) | (data == 0x3D)) - 1, 0)]
    back = back[back >= 0]
    back -= (data[back] == 0x22) | (data[back] == 0x27)
    back = back[back >= 0]
    assigns = own(back[_LAST[data[back]]])
    upper = np.flatnonzero(data[:-1] == 0x4D) if len(data) else np.zeros(0, np.int64)
    upper = upper[(data[upper + 1] >= 0x41) & (data[upper + 1] <= 0x50)]
    lo, hi = X.runs(_ANY_HEX[data], texts.bounds)
    found = own(upper) | own(lo[hi - lo >= 48])
    for what in (b"eyJ", _OPENSSH[:4], *_NESTED):
        found |= own(places(raw, what))
    return assigns, found


def scan_group(texts: X.Texts, depth: int = 2) -> dict[int, list[tuple[int, int, str, str]]]:
    """Text -> spans (start, end, kind, format) in bytes of the text."""
    raw, out = texts.data.tobytes(), {}
    add = lambda row, a, b, kind, detail="": out.setdefault(row, []).append((a - int(texts.bounds[row]), b - int(texts.bounds[row]), kind, detail))
    assigns, found = suspects(texts, raw)
    for row in assigns:
        for m in _ASSIGN.finditer(raw, int(texts.bounds[row]), int(texts.bounds[row + 1])):
            if len(m[1]) >= 12:
                add(row, *m.span(), "assign")
    end = 0
    for at in places(raw, b"AKIA").tolist():
        row = int(np.searchsorted(texts.bounds, at, "right")) - 1
        m = _ACCESS.match(raw, at, int(texts.bounds[row + 1])) if at >= end else None
        if m:
            end = m.end()
            if end - at >= 18:
                add(row, at, end, "access")
    lo, hi = X.runs(_HEX[texts.data], texts.bounds)
    wide = hi - lo >= 16
    for a, b in zip(lo[wide].tolist(), hi[wide].tolist(), strict=True):
        add(int(np.searchsorted(texts.bounds, a, "right")) - 1, a, b, "hex")
    for row in found:
        lo, hi = int(texts.bounds[row]), int(texts.bounds[row + 1])
        own = raw[lo:hi]
        for kind, a, b, detail in structural(own, 0, len(own), depth):
            add(row, a + lo, b + lo, kind, detail)
    return out


def code_points(texts: X.Texts, spans: dict[int, list[tuple[int, int, str, str]]]) -> list[list[dict]]:
    """Each text's spans in code points, sorted; hits of one kind keep the first of those that overlap."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)]) if spans else None
    for row, found in spans.items():
        base, reach = int(texts.bounds[row]), {}
        for a, b, kind, detail in sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), -s[1])):
            if a >= reach.get(kind, 0):
                reach[kind] = b
                first, start, end = (int(points[x]) for x in (base, base + a, base + b))
                out[row].append({"kind": kind, "start": start - first, "end": end - first, "format": detail})
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 2) -> DataFrame:
    """key, spans array<struct<kind,start,end,format>>: code points, end exclusive; format is empty for the kinds of BASE."""
    span = "struct<kind:string,start:bigint,end:bigint,format:string>"
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(f"spans array<{span}>")])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("format", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(1)):
                spans = pa.array(code_points(group, scan_group(group, depth)), kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.first, len(group)), spans], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
