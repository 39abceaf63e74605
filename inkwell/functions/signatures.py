"""HMAC-SHA256 as native expressions (RFC 2104), no UDF.

HMAC(k, m) = H((k' xor opad) || H((k' xor ipad) || m)), where k' is the key
zero-padded to the 64-byte block (hashed first when longer).  The two padded
keys depend only on the secret, so they are computed once on the driver and
enter the plan as binary literals; the per-row work is two ``sha2`` calls.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def key_pads(secret: str) -> tuple[str, str]:
    """Hex of (k' xor 0x36..., k' xor 0x5c...)."""
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    ipad = bytes(b ^ 0x36 for b in key).hex()
    opad = bytes(b ^ 0x5C for b in key).hex()
    return ipad, opad


def hmac_sha256_hex(payload: Column, secret: str) -> Column:
    """Hex digest of HMAC-SHA256(payload as UTF-8 bytes, secret)."""
    ipad, opad = key_pads(secret)
    data = payload if payload is not None else F.lit("")
    inner = F.unhex(F.sha2(F.concat(F.unhex(F.lit(ipad)), F.encode(data, "UTF-8")), 256))
    return F.sha2(F.concat(F.unhex(F.lit(opad)), inner), 256)


def hmac_sha256_base64(payload: Column, secret: str) -> Column:
    """Base64 digest of HMAC-SHA256(payload, secret)."""
    return F.base64(F.unhex(hmac_sha256_hex(payload, secret)))


def signature_ok(payload: Column, signature: Column, secret: str | None,
                 encoding: str = "base64", accept_when_unset: bool = False) -> Column:
    """F3/F4 predicate.  An empty or unset secret rejects everything unless
    ``accept_when_unset`` (the hex-signed feed historically accepted all)."""
    if not secret:
        return F.lit(bool(accept_when_unset))
    digest = hmac_sha256_base64(payload, secret) if encoding == "base64" else \
        hmac_sha256_hex(payload, secret)
    return signature.isNotNull() & (digest == signature)
