"""Secret scans with structural confirmation.

Three patterns find named assignments, access key ids and long hex runs. Beyond them, whatever
could be base64 or hex is decoded, and reported only if the bytes really are a key: DER whose
nested lengths fill the value exactly and whose elements are those of a private key (PKCS#1,
PKCS#8 plain or encrypted, SEC1), the OpenSSH private key container with its inner lengths, or a
signed token whose header and claims are JSON and which carries a signature. Public keys, digests,
pictures and random strings have other structures and are left alone. A value wrapped over several
lines is followed as far as its own outer length says, which must be the end of a line.

Defined results: a null text is empty and has no secrets; a block in armour may be of any length, its
end being the next mark; a wrapped key inside a reported block is not reported again; rows are handled
one by one, so repeated rows give repeated results; an empty table gives an empty result; the work is
linear in the text, but for keys that a text claims to hold inside one another; other columns,
whatever their names, are left alone.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Base patterns first, then what is confirmed by its structure.
KINDS = ("assign", "access", "hex", "jwt", "key")
BASE = KINDS[:3]

ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
ARMOUR = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]{1,12} ){0,3})PRIVATE KEY-----")

#: Lines of base64 or hex, the first of which may begin a key: DER's tag or OpenSSH's name, in either coding.
#: Line breaks may be written as escapes.
PIECE = r"[A-Za-z0-9+/_-]++"
BREAK = r"[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+"
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])(?=M|30|b3BlbnNz|6[fF]70656[eE])({PIECE}(?:{BREAK}{PIECE})++)")
LINE = re.compile(rf"(?:{BREAK})?({PIECE})")
OPENSSH = b"openssh-key-v1\0"
#: How many bytes take how many characters.
HEX_UNIT, BASE64_UNIT = (1, 2), (3, 4)

INTEGER, BIT_STRING, OCTETS, OBJECT_ID, SEQUENCE, CONTEXT_0, CONTEXT_1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1


def decode(text: str) -> bytes | None:
    """The bytes of hex or of base64 in either alphabet; None if it is neither."""
    try:
        if len(text) % 2 == 0 and re.fullmatch("[0-9a-fA-F]+", text):
            return bytes.fromhex(text)
        text = text.rstrip("=").replace("-", "+").replace("_", "/")
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER elements that fill ``data`` exactly, as (tag, content); None if they don't."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            size, at = int.from_bytes(data[at : at + more], "big"), at + more
            if size < 0x80:  # DER takes the shortest form
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_private_key(data: bytes | None) -> bool:
    """Whether the bytes are one private key and nothing else."""
    if not data:
        return False
    if data.startswith(OPENSSH):
        return _openssh_size(lambda at, size: data[at : at + size]) == len(data)
    outer = elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = elements(outer[0][1]) or []
    tags = [tag for tag, _ in inner]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS#8: version, algorithm, key
        return len(inner[0][1]) == 1 and _is_algorithm(inner[1][1]) and len(inner[2][1]) >= 16
    if tags == [SEQUENCE, OCTETS]:  # PKCS#8 under a password
        return _is_algorithm(inner[0][1]) and len(inner[1][1]) >= 16
    if tags[:9] == [INTEGER] * 9:  # PKCS#1: version, modulus, exponents, primes, coefficient
        return inner[0][1] in (b"\0", b"\1") and len(inner[1][1]) >= 32
    if tags[:2] == [INTEGER, OCTETS]:  # SEC1: version 1, key, then curve and public point
        return inner[0][1] == b"\1" and 16 <= len(inner[1][1]) <= 80 and set(tags[2:]) <= {CONTEXT_0, CONTEXT_1}
    return False


def _is_algorithm(data: bytes) -> bool:
    parts = elements(data)
    return bool(parts) and parts[0][0] == OBJECT_ID and len(parts[0][1]) >= 3


def _openssh_size(read: Callable[[int, int], bytes]) -> int | None:
    """Bytes of an OpenSSH key: cipher, key derivation and its options, number of keys, public keys, private
    part, each with its length. ``read(at, size)`` gives its bytes, fewer at the end."""

    def number(at: int) -> int:
        four = read(at, 4)
        if len(four) < 4:
            raise ValueError
        return int.from_bytes(four, "big")

    try:
        at = len(OPENSSH)
        for _ in range(3):
            at += 4 + number(at)
        keys = number(at)
        if not 1 <= keys <= 16:
            return None
        at += 4
        for _ in range(keys + 1):
            at += 4 + number(at)
        return at
    except ValueError:
        return None


def _der_size(head: bytes) -> int | None:
    """Bytes of the DER sequence that begins so."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    more = head[1] & 0x7F
    return 2 + more + int.from_bytes(head[2 : 2 + more], "big") if 1 <= more <= 4 else None


def _coded(text: str, unit: tuple[int, int]) -> bytes:
    """The bytes of whole or last units; nothing if they are none."""
    try:
        if unit == HEX_UNIT:
            return bytes.fromhex(text)
        return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)
    except (ValueError, binascii.Error):
        return b""


def wrapped_keys(text: str) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of private keys in base64 or hex that go over several lines."""
    for run in WRAPPED.finditer(text):
        lines = [m.span(1) for m in LINE.finditer(text, run.start(), run.end())]
        joined = "".join([text[s:e] for s, e in lines])
        ends, starts = [], []  # places in the joined text
        for s, e in lines:
            starts.append(ends[-1] if ends else 0)
            ends.append(starts[-1] + e - s)
        done = 0
        for (start, _), at in zip(lines, starts):
            if at < done:
                continue
            for unit in (HEX_UNIT, BASE64_UNIT):

                def read(first: int, size: int) -> bytes:
                    few, chars = unit
                    low, high = first // few, -(-(first + size) // few)
                    return _coded(joined[at + low * chars : at + high * chars], unit)[first - low * few :][:size]

                head = read(0, len(OPENSSH))
                size = _openssh_size(read) if head == OPENSSH else _der_size(head)
                if size is None:
                    continue
                stop = at + -(-size * unit[1] // unit[0])
                last = bisect_left(ends, stop)
                if last == len(ends) or ends[last] != stop or ends[last] - at == lines[last][1] - start:
                    continue  # not at the end of a line, or of a single one
                if is_private_key(_coded(joined[at:stop], unit)):
                    end = lines[last][1]
                    padding = -(stop - at) % 4 if unit == BASE64_UNIT else 0
                    yield start, end + (padding if text.startswith("=" * padding, end) else 0)
                    done = stop
                    break


def armoured(text: str) -> Iterator[tuple[int, int, str]]:
    """``(start, end, body)`` of every block: a BEGIN mark whose next mark is the END of the same label."""
    begin = None
    for mark in ARMOUR.finditer(text):
        if mark[1] == "END" and begin is not None and begin[2] == mark[2]:
            yield begin.start(), mark.end(), text[begin.end() : mark.start()]
        begin = mark if mark[1] == "BEGIN" else None


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    try:
        head, body = (json.loads(decode(part) or b"") for part in (header, claims))
    except ValueError:  # also of a wrong encoding
        return False
    except RecursionError:
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return head["alg"].lower() != "none" and len(decode(signature) or b"") >= 16


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of every secret, by start, then kind; end exclusive."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found += [(m.start(), m.end(), "jwt") for m in TOKEN.finditer(text) if is_signed_token(*m.groups())]
    found += [(m.start(), m.end(), "key") for m in ENCODED.finditer(text) if is_private_key(decode(m[0]))]
    blocks = []
    for start, end, inner in armoured(text):
        # an encrypted block may have header lines with a colon
        body = "".join(line.strip() for line in inner.replace("\\n", "\n").split("\n") if ":" not in line)
        data = decode(body) if body else None
        if is_private_key(data) or (data and "ENCRYPTED" in inner and len(data) >= 64):
            blocks.append((start, end))
    ends = [end for _, end in blocks]
    for start, end in wrapped_keys(text):
        block = bisect_left(ends, end)
        if block == len(blocks) or start < blocks[block][0]:
            found.append((start, end, "key"))
    found += [(start, end, "key") for start, end in blocks]
    order = {kind: n for n, kind in enumerate(KINDS)}
    return sorted(set(found), key=lambda s: (s[0], order[s[2]], s[1]))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: positions in code points of all secrets of each document's text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for s, e, k in find_secrets(text or "")] for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {dict(docs.dtypes)['doc_id']}, spans {SPANS}")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a checksum of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = listed(F.filter("spans", lambda s: s["kind"].isin(*BASE)))
    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(base, 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("jwt"),
        count("key"),
    )
