import base64
import json
import os
import struct

import plain
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.secrets import KINDS, is_der_key, is_token, scan, scan_text


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else (lambda x: bytes([0x80 | len(x)]) + x)(n.to_bytes((n.bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def integer(n):
    return tlv(2, n.to_bytes((n.bit_length() + 8) // 8, "big"))


RSA = tlv(0x30, integer(0) + b"".join(integer(int.from_bytes(os.urandom(60), "big") | 1) for _ in range(8)))
PKCS8 = tlv(0x30, integer(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + tlv(5, b"")) + tlv(4, RSA))
SEC1 = tlv(0x30, integer(1) + tlv(4, os.urandom(32)))


def ssh(*fields):
    return b"".join(struct.pack(">I", len(x)) + x for x in fields)


def b64(body):
    return base64.b64encode(body).decode()


def url64(body):
    return base64.urlsafe_b64encode(body).decode().rstrip("=")


def jwt(header, claims, signature):
    return ".".join([url64(json.dumps(header).encode()), url64(json.dumps(claims).encode()), url64(signature)])


def kinds(text):
    return {KINDS[k] for _, k, _ in scan_text(text)}


def test_structures_are_confirmed():
    for body in (RSA, PKCS8, SEC1):
        assert is_der_key(body) and not is_der_key(body[:-1]) and not is_der_key(body + b"\0")
        assert "der" in kinds(f"key {b64(body)} end") and "der" in kinds(f"key {body.hex()} end")
        assert "der" not in kinds(f"key {b64(body[:-4])} end")
    assert "openssh" in kinds("ssh-ed25519 " + b64(ssh(b"ssh-ed25519", os.urandom(32))) + " me")
    container = b"openssh-key-v1\0" + ssh(b"none", b"none", b"") + struct.pack(">I", 1) + ssh(b"pub", b"private part")
    assert "openssh" in kinds(b64(container))
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(b64(PKCS8)[i:i + 64] for i in range(0, len(b64(PKCS8)), 64)) + "\n-----END PRIVATE KEY-----"
    assert "pem" in kinds(f"é\n{pem}\n") and "pem" not in kinds(pem.replace("MII", "AAA", 1))


def test_tokens_need_a_header_and_a_fitting_signature():
    good = jwt({"alg": "HS256"}, {"sub": 1}, os.urandom(32))
    assert kinds(f"bearer {good}.") == {"jwt"} or kinds(f"bearer {good} x") == {"jwt"}
    assert "jwt" not in kinds(jwt({"alg": "HS256"}, {"sub": 1}, os.urandom(31)))
    assert "jwt" not in kinds(jwt({"typ": "x" * 12}, {"sub": 1}, os.urandom(32)))
    assert not is_token("first.second", "x", "y") and "jwt" not in kinds("some.sentence.with dots.and.more")


def found(text):
    return [(KINDS[k], text[a:b]) for a, k, b in scan_text(text) if KINDS[k] in ("der", "pem", "openssh")]


def wrapped(body, width=64, end="\n"):
    return end.join(b64(body)[i:i + width] for i in range(0, len(b64(body)), width))


def test_keys_on_one_line_with_written_line_ends():
    for label, body in (("PRIVATE KEY", PKCS8), ("RSA PRIVATE KEY", RSA), ("EC PRIVATE KEY", SEC1)):
        for end in ("\\n", "\\r\\n", "\\\\n"):
            pem = f"-----BEGIN {label}-----{end}{wrapped(body, end=end)}{end}-----END {label}-----"
            text = json.dumps({"type": "service_account"})[:-1] + f', "private_key": "{pem}{end}"}}'
            assert found(text) == [("pem", pem)]
            assert found(text.replace(b64(body)[:4], "AAAA", 1)) == []


def test_legacy_encrypted_pem():
    def pem(cipher, value, body):
        return (f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: {cipher},{value}\n\n"
                f"{wrapped(body)}\n-----END RSA PRIVATE KEY-----")

    secret = b"\x01" + os.urandom(607)
    for text in (pem("AES-128-CBC", "0F" * 16, secret), pem("DES-EDE3-CBC", "0F" * 8, secret)):
        assert found(f"x {text} y") == [("pem", text)]
        assert found(text.replace("\n", "\\n")) == [("pem", text.replace("\n", "\\n"))]
    assert found(pem("AES-128-CBC", "0F" * 8, secret)) == []  # initial value of another size
    assert found(pem("AES-128-CBC", "0F" * 16, secret[:-1])) == []  # no whole blocks
    assert found(pem("NONE-CBC", "0F" * 16, secret)) == []
    plain_key = f"-----BEGIN RSA PRIVATE KEY-----\nComment: mine\n\n{wrapped(RSA)}\n-----END RSA PRIVATE KEY-----"
    assert found(plain_key) == [("pem", plain_key)]


def test_keys_inside_a_run_and_over_line_ends():
    container = b"openssh-key-v1\0" + ssh(b"none", b"none", b"") + struct.pack(">I", 1) + ssh(b"pub" * 9, b"private part" * 9)
    blob = ssh(b"ssh-ed25519", os.urandom(32))
    for body, kind in ((RSA, "der"), (PKCS8, "der"), (SEC1, "der"), (container, "openssh"), (blob, "openssh")):
        for before in ("/", "-", "_", "key_", "n", "abc/", "\\n"):
            assert found(f"{before}{b64(body)} x") == [(kind, b64(body))], before
        for key in (wrapped(body), wrapped(body, 76, "\r\n"), wrapped(body, 20, "\\n"), wrapped(body, 64, "\n    ")):
            assert found(f"the key\n{key}\nand prose") == [(kind, key)]
        assert found(b64(body[:-4])) == [] and found(wrapped(body[:-4])) == []
    for body in (RSA, PKCS8, SEC1):
        assert found(f"abc{body.hex()} x") == [("der", body.hex())]
    spki = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x86\x48")) + tlv(3, b"\0" + os.urandom(64)))
    assert found("k" + b64(spki)) == [("der", b64(spki))]
    for pad in range(3):  # a certificate is no find, wherever its public key lies
        signed = tlv(0x30, tlv(0x30, tlv(4, bytes(pad)) + spki) + tlv(0x30, tlv(6, b"\x2a\x86\x48")) + tlv(3, b"\0" * 9))
        assert found(b64(signed)) == [] and found(wrapped(signed)) == [] and found(signed.hex()) == []


def test_masked_service_account(spark):
    pem = f"-----BEGIN PRIVATE KEY-----\\n{wrapped(PKCS8, end=chr(92) + 'n')}\\n-----END PRIVATE KEY-----"
    rows = [(1, f'{{"private_key": "{pem}"}}'), (2, "MIN " + wrapped(SEC1, 20))]
    got = {r.doc_id: r.clean_text for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), mask="[m]").collect()}
    assert got == {1: '{"private_key": "[m]"}', 2: "MIN [m]"}


def test_random_text_is_left_alone():
    assert not kinds(b64(os.urandom(200))) - {"hex", "assign"}
    assert scan_text(None) == [] and scan_text("") == []


def test_odd_rows(spark, odd, odd_rows, empty):
    got = sorted((r.doc_id, len(r.spans)) for r in scan(odd).collect())
    assert got == sorted((i, len(scan_text(t))) for i, t in odd_rows)
    assert scan(empty).count() == 0
    masked = scan(spark.createDataFrame([(1, "é token=abcdef1 rest", "x")], "doc_id long, text string, clean_text string"),
                  mask="[m]", carry=True).first()
    assert masked.clean_text == "é [m] rest" and masked.row.clean_text == "x"


def test_query(spark, sf_rows):
    got = {r.doc_id: tuple(r)[1:5] for r in registry.op1_secrets(spark, SF001).collect()}
    assert got == {i: plain.secrets(t) for i, t in sf_rows}
