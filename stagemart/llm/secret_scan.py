"""Secret scans: patterns, and candidates that are reported only once their structure is confirmed."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.shipping import session_of
from stagemart.llm.words import Block, blocks, cut

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
_ASSIGN = re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_SHORTEST_HEX = 24
_SHORTEST_ACCESS = 20
_SHORTEST_VALUE = 6

#: Shorter runs hold no key or token header.
SHORTEST_RUN = 32
_RUN = re.compile(rb"[A-Za-z0-9+/_-]{32,}={0,2}")
_ANY_HEX = re.compile(rb"[0-9a-fA-F]+")
_PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)-----END \1-----")
_JWT = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_SSH_MAGIC = b"openssh-key-v1\0"


def _table(letters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(letters, np.uint8)] = True
    return table


_LOWER_HEX = _table(b"0123456789abcdef")
_CODED = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _with_run(block: Block, table: np.ndarray, length: int) -> np.ndarray:
    """Which texts of the block have ``length`` bytes of the table in a row; runs end where texts do."""
    starts, ends, _ = cut(block, table)
    found = np.zeros(block.rows, bool)
    found[np.searchsorted(block.offsets, starts[ends - starts >= length], "right") - 1] = True
    return found


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The elements of DER ``data`` when their lengths are definite, minimal and fill it exactly, else None."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
            if size < 0x80 or size >> (8 * (width - 1)) == 0:
                return None
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


def _is_private_der(data: bytes) -> bool:
    """An RSA, EC or wrapped (also encrypted) private key, nested lengths and all."""
    outer = _elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = _elements(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    whole = [int.from_bytes(value, "big") for tag, value in inner if tag == 2]
    if tags[:9] == [2] * 9 and whole[0] in (0, 1):  # version, modulus, exponents, primes
        return whole[1] > 1 and whole[4] * whole[5] == whole[1] if whole[0] == 0 else True
    if tags[:3] == [2, 0x30, 4] and whole[0] in (0, 1):  # version, algorithm, key
        algorithm = _elements(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 6
    if tags[:2] == [2, 4] and whole[0] == 1 and len(inner[1][1]) in range(20, 67):  # version, scalar, curve
        return set(tags[2:]) <= {0xA0, 0xA1}
    if tags == [0x30, 4]:  # encryption algorithm, encrypted key
        algorithm = _elements(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == 6 and len(inner[1][1]) % 8 == 0 and len(inner[1][1]) >= 16
    return False


def _is_private_ssh(data: bytes) -> bool:
    """An OpenSSH private key: magic, then length-prefixed fields of which each fits the rest."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for _ in range(3):  # cipher, key derivation, its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    keys = int.from_bytes(data[at : at + 4], "big")
    if not 1 <= keys <= 16:
        return False
    at += 4
    for _ in range(keys + 1):  # public keys, then the private section
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at == len(data)


def _decoded(run: bytes) -> bytes | None:
    body = run.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _kind_of_key(data: bytes | None) -> str | None:
    if not data:
        return None
    if data[0] == 0x30 and _is_private_der(data):
        return "der"
    return "ssh" if _is_private_ssh(data) else None


def _is_token(header: bytes, payload: bytes) -> bool:
    """A signed token: a JSON header that names an algorithm, and a JSON payload."""
    for part, needs in ((header, "alg"), (payload, None)):
        data = _decoded(part)
        if not data or data[:1] != b"{":
            return False
        try:
            held = json.loads(data)
        except (ValueError, RecursionError):
            return False
        if not isinstance(held, dict) or needs and not isinstance(held.get(needs), str):
            return False
    return True


def base_spans(text: bytes, hex_run: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the patterns, each leftmost and without overlap in its kind; short ones dropped after matching."""
    found = []
    if b"=" in text or b":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _SHORTEST_VALUE]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _SHORTEST_ACCESS]
    if hex_run:
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= _SHORTEST_HEX]
    return found


def confirmed_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of candidates whose decoded structure is that of a private key or a signed token."""
    found = []
    if b"PRIVATE KEY-----" in text:
        for match in _PEM.finditer(text):
            if _kind_of_key(_decoded(b"".join(match[2].split()))):
                found.append((match.start(), 3, match.end()))
    for match in _RUN.finditer(text):
        run = match[0]
        kind = None
        if run[:1] == b"M" or run.startswith(b"b3BlbnNzaC1rZXktdjE"):  # 0x30 and the magic in base64
            kind = _kind_of_key(_decoded(run))
        elif run[:2] == b"30" and len(run) % 2 == 0 and _ANY_HEX.fullmatch(run):
            kind = _kind_of_key(bytes.fromhex(run.decode()))
        if kind:
            found.append((match.start(), KINDS.index(kind), match.end()))
    if b"eyJ" in text or b"ewog" in text or b"eyAi" in text:
        found += [(m.start(), 6, m.end()) for m in _JWT.finditer(text) if _is_token(m[1], m[2])]
    return found


def _points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points instead of bytes, in order of start, kind and end."""
    if spans and not text.isascii():
        before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        spans = [(int(before[start]), kind, int(before[end])) for start, kind, end in spans]
    return sorted(spans)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SCANNED = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"


def _scanned(column: pa.Array) -> pa.Array:
    counts: list[list[int]] = [[], [], [], []]
    digests, listed = [], []
    nothing = hashlib.sha256(b"").hexdigest()
    for block in blocks(column):
        hexes, coded = _with_run(block, _LOWER_HEX, _SHORTEST_HEX), _with_run(block, _CODED, SHORTEST_RUN)
        data = block.data.tobytes()
        for row in range(block.rows):
            text = data[block.offsets[row] : block.offsets[row + 1]]
            base = _points(text, base_spans(text, bool(hexes[row])))
            more = confirmed_spans(text) if coded[row] or b"eyJ" in text or b"PRIVATE KEY" in text else []
            for kind in range(3):
                counts[kind].append(sum(span[1] == kind for span in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest() if base else nothing)
            every = sorted(base + _points(text, more)) if more else base
            counts[3].append(len(every))
            listed.append(_joined(every))
    arrays = [pa.array(each, pa.int64()) for each in counts[:3]] + [pa.array(digests, pa.string()), pa.array(listed, pa.string()), pa.array(counts[3], pa.int64())]
    return pa.StructArray.from_arrays(arrays, ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"])


def scan_secrets(documents: DataFrame, text_column: str = "text", output: str = "secrets") -> DataFrame:
    """``documents`` with a struct column ``output``, see :func:`secrets_of`.

    Whole texts are read, however long; an empty table gives an empty one. A column named ``output`` raises ValueError; other columns pass through.
    """
    if output in documents.columns:
        raise ValueError(f"there is a column {output} already")
    session_of(documents)
    return documents.withColumn(output, secrets_of(F.col(text_column)))


def secrets_of(text: Column) -> Column:
    """A struct for each whole text: counts and digest of the pattern spans, and all spans.

    ``spans`` lists ``kind:start:end`` by start, then kind in the order of ``KINDS``, then end, in
    code points with the end exclusive. The kinds ``assign``, ``access`` and ``hex`` are patterns;
    ``pem``, ``der`` and ``ssh`` are private keys whose encoding parses with all nested lengths,
    and ``jwt`` signed tokens whose header and payload decode. Null is an empty text, without spans.
    A span is the whole match, with the name before a value. Repeated rows get the same answer each.
    """
    return F.arrow_udf(_scanned, _SCANNED)(text.cast("binary"))
