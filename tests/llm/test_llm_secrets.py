"""Encoded keys after an equals sign, wrapped, escaped, under headers, encrypted, and of DSA."""

import base64

import pytest
from test_llm_operators import der

from hirelake.llm import secrets


def number(n):
    return der(2, b"\x01" * n)


def field(b):
    return len(b).to_bytes(4, "big") + b


RSA = der(0x30, der(2, b"\0"), *(number(n) for n in (64, 3, 64, 32, 32, 32, 32, 32)))
DSA = der(0x30, der(2, b"\0"), *(number(n) for n in (128, 20, 128, 128, 20)))
PBES2 = der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d")
ENCRYPTED = der(0x30, der(0x30, PBES2, der(0x30, der(4, b"salt" * 4))), der(4, b"\x5a" * 160))
DIGEST = der(0x30, der(0x30, der(6, b"\x60\x86\x48\x01\x65\x03\x04\x02\x01"), der(5)), der(4, b"\x5a" * 32))
SSH = secrets.OPENSSH + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 90)


def b64(data):
    return base64.b64encode(data).decode()


def wrapped(data, by="\n", width=64):
    return by.join(b64(data)[i : i + width] for i in range(0, len(b64(data)), width))


def pem(name, body, by="\n"):
    return f"-----BEGIN {name}PRIVATE KEY-----{by}{body}{by}-----END {name}PRIVATE KEY-----"


HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
KEYS = [
    (3, "PRIVATE=", b64(RSA)), (4, "SSH_KEY=", b64(SSH)), (3, "?key=", b64(RSA).rstrip("=")), (3, "see ", b64(DSA)),
    (3, "see ", b64(ENCRYPTED)), (3, "see\n", wrapped(RSA)), (4, "k=", wrapped(SSH, "\r\n  ", 76)), (3, '"k": "', wrapped(RSA, "\\n")),
    (3, "anextremelylongwordbefore\n", wrapped(RSA)), (3, "", pem("RSA ", HEADERS + wrapped(b"\x5a" * 304))),
    (3, "", pem("RSA ", "Comment: mine\n\n" + wrapped(RSA))), (3, "", pem("", wrapped(RSA, "\\n"), "\\n")),
    (3, "", pem("DSA ", wrapped(DSA))), (3, "", pem("ENCRYPTED ", wrapped(ENCRYPTED))), (4, "x\\n", wrapped(SSH, "\\n")),
]


@pytest.mark.parametrize("place", range(len(KEYS)))
@pytest.mark.parametrize("after", ["", " there", "\nwords that follow"])
def test_planted_keys(place, after):
    kind, before, key = KEYS[place]
    found = [s for s in secrets.scan(before + key + after) if s[1] > 2]
    assert found == [(len(before), kind, len(before) + len(key))]


@pytest.mark.parametrize("text", [
    f"k={b64(DIGEST)}", f"k={b64(RSA + bytes(1))}", f"k={b64(RSA[:-1])}", pem("RSA ", HEADERS + wrapped(b"x" * 303)), f"k={b64(SSH + b'x')}",
    pem("RSA ", "words only"), "M" * 5000, ("M" * 64 + "\n") * 500, "-----BEGIN PRIVATE KEY-----" * 500,
])
def test_what_is_no_key(text):
    assert not [s for s in secrets.scan(text) if s[1] > 2]
