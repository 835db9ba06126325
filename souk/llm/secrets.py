"""Secret scans: patterns find candidates, their structure confirms them.

Three patterns (assignments, access keys, long hex) are reported as they are. Runs of base64,
base64url and hex are further decoded and reported only if what they decode to has the inner
structure of a key or token: nested DER lengths and the parts of a private key, the length-prefixed
fields of an SSH key, or a token whose header is a JSON object that names its algorithm (signed: three
parts; sealed: five). A key is sought wherever no letter or digit stands before its first characters,
and ends where its own lengths say, whatever follows.

Signatures and other numbers in DER are no keys. A public key in DER is reported as a kind of its own and
not masked; public SSH keys, which name their owner, are reported with the private ones and masked.

Defined results: a null text counts as empty and has no spans; spans are code points, end exclusive;
equal rows are scanned alike; an empty table gives an empty result.
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

from souk.llm.common import corpus, strings

# The base patterns and their shortest lengths, in the order of their kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "ssh", "jwt", "pub")
DER, SSH, TOKEN, PUBLIC = range(3, 7)

SIGNED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{8,})(?![A-Za-z0-9_-])")
SEALED = re.compile(
    r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.[A-Za-z0-9_-]*\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*\.[A-Za-z0-9_-]{8,}(?![A-Za-z0-9_-])"
)
TWO_MORE = re.compile(r"\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?![A-Za-z0-9_-])")
# How a DER sequence, a length-prefixed field and an OpenSSH key file begin in base64.
KEY_START = re.compile(r"(?<![A-Za-z0-9])(?:M[A-P]|AAAA|b3BlbnNzaC1rZXktdjEA)")
# bodies may be broken into lines, as in key files
BODIES = tuple(
    (re.compile(rf"[A-Za-z0-9{more}]{{32,}}(?:\r?\n[A-Za-z0-9{more}]{{16,}})*(?:\r?\n[A-Za-z0-9{more}]+)?"), more == "_-")
    for more in ("+/", "_-")
)
MIN_KEY = 24
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}")
MAX_KEYS = 64  # in one OpenSSH file
# How an encoded JSON object can begin (a quote, a space or a line end after the brace).
JSON_STARTS = ("eyJ", "eyA", "ewo", "ewk", "ew0")
SSH_KINDS = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-")
SSH_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"ecdsa-sha2-": 3}
SSH_MAGIC = b"openssh-key-v1\0"


def _decoded64(run: str, urlsafe: bool = False) -> bytes | None:
    body = re.sub(r"\s", "", run).rstrip("=")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), altchars=b"-_" if urlsafe else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, start and end of each value; None unless the lengths fill the span exactly."""
    fields = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end:
                return None
            size, start = int.from_bytes(data[start : start + n], "big"), start + n
        if start + size > end:
            return None
        fields.append((tag, start, start + size))
        start += size
    return fields


def der_kind(data: bytes) -> int | None:
    """DER for a private key, PUBLIC for a public one: a SEQUENCE that ends with the data and nests exactly."""
    outer = _der_fields(data, 0, len(data)) if data[:1] == b"\x30" and len(data) >= 16 else None
    if not outer or len(outer) != 1:
        return None
    inner = _der_fields(data, *outer[0][1:])
    if not inner or len(inner) < 2:
        return None
    tags = [tag for tag, _, _ in inner]
    nested = [_der_fields(data, start, end) for tag, start, end in inner if tag == 0x30]
    if any(fields is None for fields in nested):
        return None
    if tags[0] == 0x02:
        if inner[0][2] - inner[0][1] != 1 or data[inner[0][1]] > 2:
            return None  # not a version: a signature, the modulus of a public key
        # version and numbers; version, octets, curve; version, algorithm, octets
        numbers = len(tags) >= 4 and tags.count(0x02) == len(tags)
        algorithm = tags[1:3] == [0x30, 0x04] and nested[0] and nested[0][0][0] == 0x06
        return DER if numbers or tags[1] == 0x04 or algorithm else None
    # algorithm, bits
    return PUBLIC if tags == [0x30, 0x03] and nested[0] and nested[0][0][0] == 0x06 else None


def _field_ends(data: bytes, at: int, count: int) -> list[int] | None:
    """Where each of ``count`` length-prefixed fields ends; None if they are not all there."""
    ends = []
    for _ in range(count):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return None
        ends.append(at)
    return ends


def _public_ssh(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first of which names a key type."""
    at, fields = 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or size > 1 << 16:
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and fields[0].startswith(SSH_KINDS)


def openssh_size(data: bytes) -> int:
    """Size of the OpenSSH key file that begins the data, 0 unless all its fields are those of one.

    Names of cipher and derivation, the options, the number of keys, that many public keys, the private part.
    """
    head = _field_ends(data, len(SSH_MAGIC), 3) if data.startswith(SSH_MAGIC) else None
    if not head:
        return 0
    names = data[len(SSH_MAGIC) + 4 : head[0]], data[head[0] + 4 : head[1]]
    if not all(name and name.isascii() and name.decode().isprintable() for name in names):
        return 0
    keys = int.from_bytes(data[head[2] : head[2] + 4], "big")
    first = head[2] + 4
    ends = _field_ends(data, first, keys + 1) if 1 <= keys <= MAX_KEYS else None
    if not ends or ends[-1] - ends[-2] < 4 + 16:  # a private part has two check numbers and a key
        return 0
    starts = [first, *ends[:-2]]
    return ends[-1] if all(_public_ssh(data[a + 4 : b]) for a, b in zip(starts, ends)) else 0


def _body_end(body: str, n: int) -> int | None:
    """Where the first ``n`` bytes of a body end, None if it has fewer."""
    chars, at = -(-4 * n // 3), 0
    for line in body.splitlines(keepends=True):
        size = len(line.rstrip("\r\n"))
        if chars <= size:
            return at + chars
        chars, at = chars - size, at + len(line)
    return None


def _decoded_body(body: str, urlsafe: bool) -> bytes:
    """What a body decodes to; a last single character is no byte."""
    chars = re.sub(r"\s", "", body)
    return _decoded64(chars[: len(chars) - (len(chars) % 4 == 1)], urlsafe) or b""


def _der_size(head: bytes) -> int:
    """Size of the SEQUENCE that begins here by its own length, 0 if there is none."""
    if head[:1] != b"\x30" or len(head) < 6:
        return 0
    if head[1] < 0x80:
        return 2 + head[1]
    n = head[1] & 0x7F
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if 1 <= n <= 4 else 0


def _ssh_end(body: str, data: bytes) -> int | None:
    """Where an SSH key at the start of a body ends."""
    if data.startswith(SSH_MAGIC):
        size = openssh_size(data)
        return _body_end(body, size) if size else None
    fields, at, ends = 0, 0, []
    kind = next((k for k in SSH_KINDS if data[4:].startswith(k)), None)
    while kind and at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or size > 1 << 16 or (fields >= 2 and data[at + 4 : at + 4 + size].startswith(SSH_KINDS)):
            break
        at, fields = at + 4 + size, fields + 1
        if fields >= 2:
            ends.append(at)
    if ends and ends[-1] == len(data):
        return len(body)
    # then what follows is not part of the key: it ends with a line, or after its kind's fields
    for end in map(lambda n: _body_end(body, n), reversed(ends)):
        if end is not None and body[end : end + 1] in ("", "\r", "\n"):
            return end
    return _body_end(body, ends[SSH_FIELDS[kind] - 2]) if kind and len(ends) > SSH_FIELDS[kind] - 2 else None


def _key_at(text: str, start: int) -> tuple[int, int] | None:
    """(kind number, end) of the key in base64 that begins here."""
    for pattern, urlsafe in BODIES:
        first = pattern.match(text, start, start + 40)
        head = _decoded_body(first[0], urlsafe) if first else b""
        kind, end = None, None
        if size := _der_size(head):
            # a body of that many bytes, with its line ends, and no more
            body = pattern.match(text, start, start + size * 3 // 2 + 40) if MIN_KEY <= size <= len(text) else None
            end = _body_end(body[0], size) if body else None
            if end is not None:
                kind = der_kind(_decoded_body(body[0][:end], urlsafe)[:size])
        elif head.startswith(SSH_MAGIC) or head[4:].startswith(SSH_KINDS):
            kind, body = SSH, pattern.match(text, start)
            end = _ssh_end(body[0], _decoded_body(body[0], urlsafe))
        if kind is not None and end is not None:
            end += start
            padded = end
            while padded < end + 2 and text[padded : padded + 1] == "=":
                padded += 1
            return kind, padded
    return None


def _json_object(part: str) -> dict | None:
    try:
        found = json.loads(_decoded64(part, urlsafe=True) or b"null")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str) -> bool:
    """The header is a JSON object naming an algorithm, the payload a JSON object."""
    first = _json_object(header)
    return first is not None and isinstance(first.get("alg"), str) and _json_object(payload) is not None


def is_sealed_token(header: str) -> bool:
    """The header is a JSON object naming the algorithms of the key and of the content."""
    first = _json_object(header)
    return first is not None and isinstance(first.get("alg"), str) and isinstance(first.get("enc"), str)


def _hex_key(run: str) -> tuple[int, int] | None:
    """(kind number, length in characters) of the key that begins a run of hex digits."""
    data = bytes.fromhex(run[: len(run) // 2 * 2])
    if MIN_KEY <= (size := _der_size(data)) <= len(data) and (kind := der_kind(data[:size])):
        return kind, 2 * size
    if size := openssh_size(data):
        return SSH, 2 * size
    return (SSH, 2 * len(data)) if _public_ssh(data) else None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base patterns."""
    spans = []
    folded = text.lower()
    if any(hint in folded for hint in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of candidates confirmed by their structure."""
    spans = []
    at = 0
    while m := KEY_START.search(text, at):
        at = m.start() + 1
        if found := _key_at(text, m.start()):
            kind, at = found
            spans.append((m.start(), kind, at))
    for m in HEX_RUN.finditer(text):
        if found := _hex_key(m[0]):
            spans.append((m.start(), found[0], m.start() + found[1]))
    if any(start in text for start in JSON_STARTS):
        for m in SIGNED.finditer(text):
            if is_signed_token(m[1], m[2]):
                more = TWO_MORE.match(text, m.end())  # five parts are one token
                spans.append((m.start(), TOKEN, more.end() if more else m.end()))
        spans += [(m.start(), TOKEN, m.end()) for m in SEALED.finditer(text) if is_sealed_token(m[1])]
    return sorted(set(spans))


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, mask: str = "[SECRET]") -> str:
    """The text with every (merged) span replaced, but for public keys."""
    out, at = [], 0
    for start, kind, end in sorted(base_spans(text) + confirmed_spans(text)):
        if kind == PUBLIC:
            continue
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


SCAN_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans = ([], [], []), [], []
        for text in strings(batch):
            base = base_spans(text)
            kinds = [kind for _, kind, _ in base]
            for k in range(3):
                counts[k].append(kinds.count(k))
            digests.append(hashlib.sha256(spelled(base).encode()).hexdigest())
            spans.append(spelled(sorted(base + confirmed_spans(text))))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Spans and counts per document; one pass over the texts, nothing is shuffled."""
    return corpus(docs).mapInArrow(_scan, SCAN_SCHEMA)


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [x if x is None else redacted(x) for x in batch.column(at).to_pylist()]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with every reported span masked; null texts stay null."""
    return docs.mapInArrow(_redact, docs.schema)
