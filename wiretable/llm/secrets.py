"""Secret scans with structural confirmation.

Three plain patterns give the base spans.  Beyond them, every run of base64 or
hex characters of a fitting length is a candidate that is reported only if its
decoded bytes have the structure of a secret:

* ``der``: nested DER lengths that add up exactly, in the shape of a private or
  public key (PKCS#1, PKCS#8, SEC1, SPKI), from base64 or hex, at any place of a
  run and over line ends (at least eight characters a line), as its outer length
  tells where it ends;
* ``pem``: the same inside BEGIN/END lines, the body joined over its lines, or
  any body under a private-key label whose decoded bytes are a key; header lines
  are left out, and a legacy encrypted key (Proc-Type, DEK-Info) needs a known
  cipher, an initial value of its size and whole cipher blocks;
* ``openssh``: the openssh-key-v1 container or an SSH public-key blob with
  length-prefixed fields that add up, the container also over line ends;
* ``jwt``: three parts, of which the first two decode to JSON objects, the
  header with a string ``alg``, the signature of the length the algorithm has.

Line ends are real or written as backslash-n and backslash-r (JSON, .env files).

A candidate that only looks the part is not reported by the method (it stays a
base span if it is one).  Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; repeated rows are scanned
one by one; an empty table gives an empty result; other columns are ignored, or
returned inside ``row`` with ``carry``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from wiretable.llm import tokens as T
from wiretable.llm.frames import keyed

#: Kinds in the order of ties.
KINDS = ("assign", "access", "hex", "der", "pem", "openssh", "jwt")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_CANDIDATE = re.compile(r"(?:[0-9a-fA-F]{2}){24,}")
HEX_RUN = re.compile(r"[0-9a-fA-F]{48,}")
#: Places where a key may begin inside a run: a DER sequence, the OpenSSH container, an SSH public-key blob.
START = re.compile(r"(?=M[A-P][A-Za-z0-9+/_-]{2}|b3BlbnNzaC1rZXktdjEA|AAAA[BCE][23][NV][zj][aZ])")
HEX_START = re.compile(r"(?=30(?:8[1-4]|[2-7][0-9a-fA-F]))")
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
LINE_END = re.compile(r"[ \t]*(?:\r\n?|\n|(?:\\+[rn])+)[ \t]*")
PEM_LINE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,40})-----")
ESCAPED_BLANK = re.compile(r"\\+[nrt]")
ENCRYPTED = re.compile(r"\s*Proc-Type:\s*4\s*,\s*ENCRYPTED\s+DEK-Info:\s*([A-Z0-9-]+)\s*,\s*([0-9A-Fa-f]+)\s+")
HEADERS = re.compile(r"(?:\s*[A-Za-z][A-Za-z0-9-]*:[^\n]*\n)+")
JWT = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")

#: What a text needs for a pattern to match at all; run over whole Arrow columns (RE2).
NEEDS_ASSIGN = r"(?i)password|passwd|secret|token|api_?key"
NEEDS_HEX = r"[0-9a-f]{24}"
NEEDS_RUN = r"[A-Za-z0-9+/_-]{32}|M[A-P][A-Za-z0-9+/_-]{6}"
NEEDS_JWT = r"[A-Za-z0-9_-]{10}\.[A-Za-z0-9_-]{2,}\."

#: Signature bytes by algorithm (fixed values of RFC 7518); None: any length of an RSA key.
SIGNATURES = {"none": {0}, "HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES384": {96}, "ES512": {132},
              "EdDSA": {64, 114}, "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None}
#: Fields of a public-key blob by its first one.
SSH_KINDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"ecdsa-sha2-nistp256": 3, b"ecdsa-sha2-nistp384": 3,
             b"ecdsa-sha2-nistp521": 3}
OPENSSH = b"openssh-key-v1\0"
#: Block bytes of the ciphers of legacy encrypted PEM.
BLOCKS = {"DES-CBC": 8, "DES-EDE3-CBC": 8, "BF-CBC": 8, "CAST5-CBC": 8, "IDEA-CBC": 8, "RC2-CBC": 8, "SEED-CBC": 16,
          **{f"{name}-{bits}-CBC": 16 for name in ("AES", "CAMELLIA", "ARIA") for bits in (128, 192, 256)}}
#: Characters that hold a key's first fields, and the least of a key (as of a run).
HEAD, LEAST = 44, 32


def unbase64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der(body: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the element at a place, if its length fits."""
    if at + 2 > end:
        return None
    tag, size = body[at], body[at + 1]
    at += 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or body[at] == 0:
            return None
        size = int.from_bytes(body[at:at + n], "big")
        if size < 0x80:
            return None  # DER wants the short form
        at += n
    return (tag, at, at + size) if at + size <= end else None


def elements(body: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range exactly."""
    out = []
    while at < end:
        element = der(body, at, end)
        if element is None:
            return None
        out.append(element)
        at = element[2]
    return out


def is_der_key(body: bytes) -> bool:
    """Whether the bytes are one key: a sequence in a known shape whose nested lengths add up."""
    top = der(body, 0, len(body))
    if top is None or top[0] != 0x30 or top[2] != len(body):
        return False
    parts = elements(body, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]

    def identifier(p) -> bool:
        inner = elements(body, p[1], p[2]) if p[0] == 0x30 else None
        return bool(inner) and inner[0][0] == 0x06 and inner[0][2] > inner[0][1]

    version = body[parts[0][1]:parts[0][2]] if tags[0] == 0x02 else None
    if tags[0] == 0x02 and len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):
        return version in (b"\0", b"\1")  # PKCS#1 private key
    if tags[:3] == [0x02, 0x30, 0x04] and all(t & 0xE0 == 0xA0 or t & 0xC0 == 0x80 for t in tags[3:]):
        return version in (b"\0", b"\1") and identifier(parts[1])  # PKCS#8
    if tags[:2] == [0x02, 0x04] and len(tags) <= 4 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return version == b"\1" and parts[1][2] - parts[1][1] in (28, 32, 48, 66)  # SEC1
    if tags == [0x30, 0x03]:
        return identifier(parts[0]) and parts[1][2] - parts[1][1] > 1 and body[parts[1][1]] == 0  # SPKI
    if tags == [0x30, 0x04]:
        return identifier(parts[0]) and parts[1][2] > parts[1][1]  # encrypted PKCS#8
    return False


def fields(body: bytes, at: int) -> list[bytes] | None:
    """Length-prefixed fields that fill the rest exactly."""
    out = []
    while at < len(body):
        if at + 4 > len(body):
            return None
        size = int.from_bytes(body[at:at + 4], "big")
        at += 4 + size
        if at > len(body):
            return None
        out.append(body[at - size:at])
    return out


def is_openssh(body: bytes) -> bool:
    """An openssh-key-v1 container, or an SSH public-key blob."""
    if body.startswith(OPENSSH):
        at, seen = len(OPENSSH), 0
        while seen < 3:  # cipher, key derivation, its options
            size = int.from_bytes(body[at:at + 4], "big")
            at += 4 + size
            seen += 1
            if at + 4 > len(body):
                return False
        keys = int.from_bytes(body[at:at + 4], "big")
        rest = fields(body, at + 4)
        return rest is not None and keys >= 1 and len(rest) == keys + 1
    parts = fields(body, 0)
    return bool(parts) and len(parts) >= 2 and parts[0] in SSH_KINDS and all(parts)


def is_signed(body: bytes) -> bool:
    """Whether the bytes are a certificate or a like signed structure, whose inner public key is no find of its own."""
    top = der(body, 0, len(body))
    parts = elements(body, top[1], top[2]) if top and top[0] == 0x30 and top[2] == len(body) else None
    return [p[0] for p in parts or ()] == [0x30, 0x30, 0x03]


def der_size(head: bytes) -> int:
    """Bytes of the DER sequence that begins here, by its outer length; 0 if its first element is no key's."""
    if len(head) < 8 or head[0] != 0x30:
        return 0
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    if n > 4:
        return 0
    at = 2 + n
    size = int.from_bytes(head[2:at], "big") if n else head[1]
    return at + size if head[at] == 0x30 or head[at:at + 3] in (b"\x02\x01\0", b"\x02\x01\x01") else 0


def ssh_size(body: bytes) -> tuple[int, bool]:
    """Bytes of the OpenSSH container or public-key blob that begins here, as far as they can be told, and whether
    these are all; 0 if none begins."""
    if body.startswith(OPENSSH):
        at, left, counted = len(OPENSSH), 3, False  # cipher, key derivation, its options, then the counted keys
        if int.from_bytes(body[at:at + 4], "big") > 64:
            return 0, True
    else:
        at, counted = 0, True
        left = SSH_KINDS.get(body[4:4 + int.from_bytes(body[:4], "big")], 0)
        if not left:
            return 0, True
    while left or not counted:
        if at + 4 > len(body):
            return at + 4, False
        size = int.from_bytes(body[at:at + 4], "big")
        at += 4
        if left:
            at, left = at + size, left - 1
        else:
            left, counted = size + 1, True
    return at, True


def joined(text: str, at: int, most: int) -> tuple[str, int]:
    """Up to ``most`` base64 characters from a place on, line ends left out, and the place behind them."""
    parts: list[str] = []
    end = at
    while run := RUN.match(text, at, at + most):
        parts.append(run[0])
        most -= len(run[0])
        end = run.end()
        line_end = LINE_END.match(text, end) if most else None
        if line_end is None:
            break
        at = line_end.end()
    return "".join(parts), end


def key_at(text: str, start: int) -> tuple[int, bytes, int] | None:
    """Kind, bytes and end of what begins at a place with a key's first fields and is there as a whole."""
    chars = joined(text, start, HEAD)[0]
    kind = 3 if text[start] == "M" else 5
    while True:
        body = unbase64(chars[:len(chars) // 4 * 4]) or b""
        size, whole = (der_size(body), True) if kind == 3 else ssh_size(body)
        need = -(-size * 4 // 3)
        if need < LEAST or need > len(text) - start:
            return None
        if whole:
            break
        more = joined(text, start, max(need + 4, 2 * len(chars)))[0]
        if len(more) <= len(chars):
            return None
        chars = more
    chars, end = joined(text, start, need)
    found = unbase64(chars) if len(chars) == need else None
    if found is None:
        return None
    for _ in range(-need % 4):
        end += text.startswith("=", end)
    return kind, found, end


def keys_inside(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Keys that begin anywhere in a run and may go on over line ends; none inside ``taken`` (in order)."""
    out: list[tuple[int, int, int]] = []
    at = skip = 0
    while m := START.search(text, at):
        start = m.start()
        at = start + 1
        while skip < len(taken) and taken[skip][1] <= start:
            skip += 1
        if skip < len(taken) and taken[skip][0] <= start:
            at = taken[skip][1]
        elif found := key_at(text, start):
            kind, body, end = found
            if is_der_key(body) if kind == 3 else is_openssh(body):
                out.append((start, kind, end))
                at = end
            elif kind == 3 and is_signed(body):
                at = end
    return out


def hex_keys(run: str) -> list[tuple[int, int]]:
    """Start and end of the DER keys anywhere in a run of hex digits."""
    out: list[tuple[int, int]] = []
    at = 0
    while m := HEX_START.search(run, at):
        start = m.start()
        at = start + 1
        end = start + 2 * der_size(bytes.fromhex(run[start:start + HEAD]) if len(run) - start >= HEAD else b"")
        if LEAST * 3 // 2 <= end - start <= len(run) - start:
            body = bytes.fromhex(run[start:end])
            if is_der_key(body):
                out.append((start, end))
                at = end
            elif is_signed(body):
                at = end
    return out


def is_pem_key(label: str, body: str) -> bool:
    """Whether the text between BEGIN and END lines is a key."""
    body = ESCAPED_BLANK.sub("\n", body).replace("\\/", "/").replace("\\u003d", "=")
    encrypted = ENCRYPTED.match(body)
    headers = encrypted or HEADERS.match(body)
    found = unbase64("".join(body[headers.end() if headers else 0:].split()))
    if not found:
        return False
    if encrypted:
        block = BLOCKS.get(encrypted[1])
        return (label.endswith("PRIVATE KEY") and block is not None and len(encrypted[2]) == 2 * block
                and len(found) >= 32 and len(found) % block == 0)
    return is_der_key(found) or is_openssh(found)


def is_token(header: str, claims: str, signature: str) -> bool:
    """A signed token: JSON objects in front, a signature of the right length behind."""
    try:
        head, body = (json.loads(unbase64(x) or b"x") for x in (header, claims))
    except (ValueError, RecursionError):
        return False
    sign = unbase64(signature) if signature else b""
    if not isinstance(head, dict) or not isinstance(body, dict) or sign is None:
        return False
    algorithm = head.get("alg")
    if not isinstance(algorithm, str) or algorithm not in SIGNATURES:
        return False
    sizes = SIGNATURES[algorithm]
    return len(sign) in sizes if sizes is not None else len(sign) >= 128 and len(sign) % 64 == 0


def base_spans(text: str, assign: bool = True, longhex: bool = True) -> list[tuple[int, int, int]]:
    out = []
    if assign:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if longhex:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return out


def structural_spans(text: str, run: bool = True, token: bool = True) -> list[tuple[int, int, int]]:
    out = []
    if token:
        out += [(m.start(), 6, m.end()) for m in JWT.finditer(text) if is_token(*m.groups())]
    taken: list[tuple[int, int]] = []
    if "-----BEGIN " in text:
        begin = None
        for m in PEM_LINE.finditer(text):
            if m[1] == "END" and begin and begin[2] == m[2] and is_pem_key(m[2], text[begin.end():m.start()]):
                out.append((begin.start(), 4, m.end()))
                taken.append((begin.start(), m.end()))
            begin = m if m[1] == "BEGIN" else None
    if run:
        found = []
        for m in CANDIDATE.finditer(text):
            body = unbase64(m[0])
            if body and is_openssh(body):
                found.append((m.start(), 5, m.end()))
            elif body and body[0] == 0x30 and is_der_key(body):
                found.append((m.start(), 3, m.end()))
        out += found
        out += keys_inside(text, sorted(taken + [(a, b) for a, _, b in found]))
        for m in HEX_CANDIDATE.finditer(text):
            body = bytes.fromhex(m[0])
            if is_openssh(body):
                out.append((m.start(), 5, m.end()))
        for m in HEX_RUN.finditer(text):
            out += [(m.start() + a, 3, m.start() + b) for a, b in hex_keys(m[0])]
    return out


def scan_text(text: str | None) -> list[tuple[int, int, int]]:
    """All spans (start, kind number, end) of one text in order."""
    return sorted(set(base_spans(text) + structural_spans(text))) if text else []


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str | None = None,
         carry: bool = False) -> DataFrame:
    """doc_id and spans (kind, start, end), in order of start, then kind, of every row.

    With ``mask`` also clean_text, where each stretch of overlapping spans is
    replaced by the mask.
    """
    rows = keyed(documents, id_col, text_col, carry)
    kept = [n for n in rows.columns if n != "text"]
    span = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType([rows.schema[n] for n in kept] + [StructField("spans", ArrayType(span))]
                        + [StructField("clean_text", StringType())] * (mask is not None))

    def run(batches):
        for batch in T.chunks(batches):
            texts = T.whole(batch)
            # Which patterns can match at all is found over the whole column; only those texts become Python strings.
            needs = [pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False)
                     for p in (NEEDS_ASSIGN, NEEDS_HEX, NEEDS_RUN, NEEDS_JWT)]
            needs += [pc.match_substring(texts, p).to_numpy(zero_copy_only=False) for p in ("AKIA", "-----BEGIN ")]
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            clean = texts.to_pylist() if mask is not None else None
            for d in (needs[0] | needs[1] | needs[2] | needs[3] | needs[4] | needs[5]).nonzero()[0].tolist():
                text = texts[d].as_py()
                found = base_spans(text, needs[0][d], needs[1][d]) + structural_spans(text, needs[2][d], needs[3][d])
                found = sorted(set(found))
                spans[d] = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found]
                if clean is not None and found:
                    parts, at = [], 0
                    for a, _, b in found:
                        if a >= at:
                            parts += [text[at:a], mask]
                        at = max(at, b)
                    clean[d] = "".join([*parts, text[at:]])
            out = [T.column(batch, n) for n in kept] + [pa.array(spans, SPANS)]
            if clean is not None:
                out.append(pa.array(clean, pa.string()))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)
