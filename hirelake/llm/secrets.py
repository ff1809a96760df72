"""Secret scans: patterns, then structural confirmation of encoded keys and tokens.

Base spans are what three patterns find. Beyond them, base64 and hex candidates are decoded
and reported only if what comes out is a key: a DER private key whose nested lengths fit
exactly, an OpenSSH private key whose length fields fit, or a signed token whose header is a
JSON object with an algorithm. Each text is scanned on its own, in time linear in it.

Defined cases: a null text is empty; repeated rows each give their result; spans of one kind
do not overlap, spans of different kinds may; an empty table gives an empty result. The added
column takes the place of an input column of its name.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import packed, unpacked

#: Fixed order of kinds; the base ones come first.
KINDS = ("assign", "access", "hex", "private_key", "openssh_key", "signed_token")
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A line break inside base64, real or escaped, with the white space that indents the next line.
WRAP = re.compile(r"(?:\r?\n|\\r\\n|\\n)[ \t]*")
BASE64 = re.compile(
    r"(?:(?<=\\n)|(?<![A-Za-z0-9+/_-])(?<!\\(?=[nr])))[A-Za-z0-9+/_-]{16,}+"
    rf"(?:{WRAP.pattern}[A-Za-z0-9+/_-]++)*+={{0,2}}"
)
#: How a DER sequence and an OpenSSH key begin in base64.
HEADS = ("M", "b3BlbnNzaC1rZXkt")
LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}(?![0-9A-Fa-f])")
PEM = re.compile(r"-----BEGIN ([A-Z ]{0,20})PRIVATE KEY-----((?:(?!-----).)++)-----END \1PRIVATE KEY-----", re.S)
PEM_HEADER = re.compile(r"\s*[A-Za-z][A-Za-z0-9-]*:")
DEK = re.compile(r"DEK-Info:[ \t]*[A-Za-z0-9-]+,[0-9A-Fa-f]{16,}")
#: Password-based encryption of PKCS#5 and PKCS#12.
PBE = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
OPENSSH = b"openssh-key-v1\0"


def unbase64(text: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill [start, end) exactly, else None."""
    out = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        start = at + size
    return out


def is_private_key(data: bytes) -> bool:
    """RSA (nine integers), DSA (six, the first zero), PKCS#8 (version, algorithm, octets; or a password-based
    algorithm and octets, where encrypted) or EC (version 1, octets)."""
    whole = der_items(data, 0, len(data))
    if not whole or len(whole) != 1 or whole[0][0] != 0x30:
        return False
    items = der_items(data, whole[0][1], whole[0][2])
    if not items or len(items) < 2:
        return False
    tags = [t for t, _, _ in items]
    if tags == [0x30, 0x04]:
        inner = der_items(data, items[0][1], items[0][2])
        return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1] : inner[0][2]].startswith(PBE)
    if tags[0] != 0x02:
        return False
    if tags == [0x02] * 6:
        return data[items[0][1] : items[0][2]] == b"\0" and items[1][2] - items[1][1] >= 64
    if len(items) >= 9 and set(tags[:9]) == {0x02}:
        return True
    if tags[:3] == [0x02, 0x30, 0x04]:
        inner = der_items(data, items[1][1], items[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return tags[1] == 0x04 and data[items[0][1] : items[0][2]] == b"\x01" and all(t in (0xA0, 0xA1) for t in tags[2:])


def openssh_size(data: bytes) -> int | None:
    """Bytes of the key at the start of `data`: cipher, function and its options, a number of keys,
    public parts and a private part."""
    if not data.startswith(OPENSSH):
        return None
    at, fields = len(OPENSSH), 0

    def field(at: int) -> int:
        size = int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else len(data)
        return at + 4 + size

    for _ in range(3):
        at = field(at)
    if at + 4 > len(data) or not 1 <= int.from_bytes(data[at : at + 4], "big") <= 64:
        return None
    fields = int.from_bytes(data[at : at + 4], "big") + 1
    at += 4
    for _ in range(fields):
        at = field(at)
    return at if at <= len(data) else None


def is_openssh_key(data: bytes) -> bool:
    return openssh_size(data) == len(data)


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with `head`, by its length field."""
    if len(head) < 6 or head[0] != 0x30:
        return None
    n = head[1] & 0x7F
    if head[1] < 0x80:
        return 2 + head[1]
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if 1 <= n <= 4 else None


def encoded_keys(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of base64 keys, on one line or wrapped over lines. A key begins with a
    line, has the size its own length fields give, and ends with a line."""
    for m in BASE64.finditer(text):
        plain = m[0].rstrip("=")
        if len(plain) < 40:
            continue
        starts, parts, at = [], [], 0
        for gap in WRAP.finditer(plain):
            starts.append(at)
            parts.append(plain[at : gap.start()])
            at = gap.end()
        starts.append(at)
        parts.append(plain[at:])
        whole, offsets, total = "".join(parts), [], 0
        for part in parts:
            offsets.append(total)
            total += len(part)
        ends = {o + len(p): s + len(p) for o, s, p in zip(offsets, starts, parts)}
        done = 0
        for begin, offset in zip(starts, offsets):
            if offset < done or not whole.startswith(HEADS, offset):
                continue
            if whole[offset] == "M":
                size = der_size(unbase64(whole[offset : offset + 12]) or b"")
            else:
                rest = whole[offset:]
                size = openssh_size(unbase64(rest[: len(rest) // 4 * 4]) or b"") or openssh_size(unbase64(rest) or b"")
            stop = offset + -(-size * 4 // 3) if size else 0
            if stop in ends and (kind := confirmed(unbase64(whole[offset:stop]))):
                done, end = stop, m.start() + ends[stop]
                if stop == len(whole):
                    end += min(len(m[0]) - len(plain), -len(whole[offset:stop]) % 4)
                yield m.start() + begin, kind, end


def pem_key(body: str) -> int | None:
    """The kind of what stands between the lines of a PEM block, with or without header lines."""
    found = WRAP.sub("\n", body).strip()
    headers, rest = "", found
    if PEM_HEADER.match(found):
        headers, _, rest = found.partition("\n\n")
    data = unbase64(re.sub(r"\s", "", rest))
    if "ENCRYPTED" in headers and DEK.search(headers):
        return 3 if data and len(data) % 8 == 0 else None
    return confirmed(data)


def is_signed_token(text: str) -> bool:
    head, body, _ = text.split(".")
    for part, name in ((head, "alg"), (body, None)):
        raw = unbase64(part)
        try:
            value = json.loads(raw) if raw else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(value, dict) or (name and not isinstance(value.get(name), str)):
            return False
    return True


def confirmed(data: bytes | None) -> int | None:
    if data and is_private_key(data):
        return 3
    return 4 if data and is_openssh_key(data) else None


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    taken = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            if kind := pem_key(m[2]):
                found.append((m.start(), kind, m.end()))
                taken.append(m.span())
    found += [k for k in encoded_keys(text) if not any(s <= k[0] < e for s, e in taken)]
    for m in LONG_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := confirmed(bytes.fromhex(m[0]))):
            found.append((m.start(), kind, m.end()))
    if "ey" in text and "." in text:
        found += [(m.start(), 5, m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    return sorted(found)


def _scanner(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for texts in batches:
        rows = ([{"kind": k, "start": s, "end": e} for s, k, e in scan(t or "")] for t in texts.to_pylist())
        yield pa.array(rows, kind)


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds `spans` (array<struct<kind, start, end>>, by start and kind; kind is a place in
    KINDS) to the columns `carry`, all of them unless named."""
    carry = docs.columns if carry is None else carry
    udf = F.arrow_udf(_scanner, "array<struct<kind:int,start:int,end:int>>")
    return unpacked(packed(docs, carry, _text=F.col(text)).select("_in", udf("_text").alias("spans")), carry, "spans")
