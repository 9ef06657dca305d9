"""Secrets in texts: pattern matches, and encoded secrets confirmed by structure.

Three patterns report what they match (``assign``, ``access``, ``hex``).
Everything else is a candidate that must decode and parse before it is
reported, so that random text of the same shape is not:

* ``jwt``: dot-joined base64url parts; the header must be a JSON object that
  names its algorithm, the payload a JSON object, and the signature must be as
  long as that algorithm makes it (five parts: an encrypted token).
* ``pem``: an armoured private key whose body decodes to one of the structures
  below, with nothing left over.
* ``key``: a run of base64 (also wrapped over lines) or hex outside such an
  armour that decodes to one of them, or to an armoured key itself.

Structures: DER private keys (RSA, DSA, elliptic curve, PKCS 8, encrypted
PKCS 8), all nested lengths minimal and filling their parents exactly, an RSA
modulus equal to the product of its primes; the OpenSSH private key format,
its length-prefixed fields filling it; OpenPGP secret-key packets.

Every text is read whole and once: markers and runs are found by one scan
each, and a key's own length says how much of a run is decoded. No structure
here is longer than ``MAX_KEY`` bytes, which bounds the work of an attempt.

Defined cases: a null or empty text has no spans; every row gives one row,
repeated rows too; a null id stays null. Offsets are code points, ends
exclusive, of whole matches. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three patterns, and the least size of what they report.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "jwt", "pem", "key")
MAX_KEY = 1 << 16

#: Access keys, hex and encoded secrets stand in runs of these characters.
RUN = re.compile(r"(?<![A-Za-z0-9+/=_.-])[A-Za-z0-9+/=_.-]{20,}")
DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]++")
MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{1,60})-----")
#: How base64 of the structures begins: a DER sequence, the OpenSSH format, an armour.
BEGIN64 = re.compile(r"(?<![A-Za-z0-9])(?:M[A-P]|b3BlbnNzaC1r|LS0tLS1CRUdJTi)")
BEGIN16 = re.compile(r"(?<![A-Za-z0-9])30(?=[0-9a-fA-F]{46})")
DIGITS16 = re.compile(r"[0-9a-fA-F]+")
LINE64 = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
LINE_BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
FIELD = re.compile(r"^[A-Za-z-]+:.*$", re.MULTILINE)
#: A wrapped run goes on only after a line of so many characters.
WRAPPED = 40


# --- decoding ------------------------------------------------------------------

def decode64(s: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not."""
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except ValueError:
        return None


def field(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, begin, end of the content) of the DER element at ``at``, if its
    length is minimally written and does not go beyond ``end``."""
    if at + 2 > end or data[at] & 31 == 31:
        return None
    size, body = data[at + 1], at + 2
    if size >= 128:
        n = size & 127
        if not 1 <= n <= 4 or body + n > end:
            return None
        size = int.from_bytes(data[body:body + n], "big")
        if size < 128 or size >> 8 * (n - 1) == 0:
            return None
        body += n
    return (data[at], body, body + size) if body + size <= end else None


def fields(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly."""
    out = []
    while at < end:
        f = field(data, at, end)
        if f is None or len(out) == 16:
            return None
        out.append(f)
        at = f[2]
    return out


# DER tags, and object identifiers of key algorithms.
INT, BITS, OCTETS, OID, SEQ, CTX0, CTX1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1
RSA_OID = bytes.fromhex("2a864886f70d010101")
DSA_OID = bytes.fromhex("2a8648ce380401")
EC_OID = bytes.fromhex("2a8648ce3d0201")
RAW_OIDS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56,
            bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
PBE_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def der_key(data: bytes, at: int, end: int) -> str | None:
    """What private key the DER sequence content ``at`` to ``end`` is."""
    parts = fields(data, at, end)
    if not parts:
        return None
    tags = [t for t, _, _ in parts]
    value = lambda i: data[parts[i][1]:parts[i][2]]
    number = lambda i: int.from_bytes(value(i), "big", signed=True)
    if tags[:9] == [INT] * 9 and number(0) in (0, 1) and len(tags) == 9 + (number(0) == 1):
        if number(1) > 0 and (number(0) == 1 or number(1) == number(4) * number(5)):
            return f"RSA {number(1).bit_length()}"
        return None
    if tags == [INT] * 6 and number(0) == 0 and number(1) > number(2) > 1 and 0 < number(5) < number(2):
        return f"DSA {number(1).bit_length()}"
    if tags[:2] == [INT, OCTETS] and number(0) == 1 and tags[2:] in ([], [CTX0], [CTX1], [CTX0, CTX1]) \
            and 14 <= len(value(1)) <= 72:
        for t, b, e in parts[2:]:
            inner = fields(data, b, e)
            if not inner or len(inner) != 1 or inner[0][0] not in ((OID, SEQ) if t == CTX0 else (BITS,)):
                return None
        return f"EC {8 * len(value(1))}"
    if tags[:3] == [INT, SEQ, OCTETS] and number(0) in (0, 1) and set(tags[3:]) <= {CTX0, 0x81}:
        algorithm = fields(data, parts[1][1], parts[1][2])
        if not algorithm or algorithm[0][0] != OID:
            return None
        name, (_, b, e) = data[algorithm[0][1]:algorithm[0][2]], parts[2]
        inner = field(data, b, e)
        if inner is None or inner[2] != e:
            return None
        if name in (RSA_OID, EC_OID):
            return inner[0] == SEQ and der_key(data, inner[1], inner[2]) or None
        if name in RAW_OIDS:
            return "Edwards" if inner[0] == OCTETS and inner[2] - inner[1] == RAW_OIDS[name] else None
        return "DSA" if name == DSA_OID and inner[0] == INT else None
    if tags == [SEQ, OCTETS] and len(value(1)) >= 16:
        algorithm = fields(data, parts[0][1], parts[0][2])
        if algorithm and algorithm[0][0] == OID and \
                data[algorithm[0][1]:algorithm[0][2]].startswith(PBE_OIDS):
            return "encrypted PKCS 8"
    return None


OPENSSH = b"openssh-key-v1\0"


def openssh_key(data: bytes) -> tuple[str, int] | None:
    """(what, bytes) of an OpenSSH private key at the beginning of ``data``."""
    at = len(OPENSSH)

    def text():
        nonlocal at
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            raise ValueError
        at += 4 + size
        return data[at - size:at]

    try:
        cipher, kdf, _ = text(), text(), text()
        keys = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if not 1 <= keys <= 16 or (cipher == b"none") != (kdf == b"none"):
            return None
        public = [text() for _ in range(keys)]
        secret = text()
    except ValueError:
        return None
    size = int.from_bytes(public[0][:4], "big")
    kind = public[0][4:4 + size]
    if not 4 <= size == len(kind) or not re.fullmatch(rb"[a-z0-9@.-]+", kind):
        return None
    if cipher == b"none" and (len(secret) < 8 or secret[:4] != secret[4:8]):
        return None  # the check numbers of an unencrypted key are equal
    return f"OpenSSH {kind.decode()}", at


def pgp_key(data: bytes) -> str | None:
    """Whether ``data`` is OpenPGP packets, filled exactly, the first a secret key."""
    at, first = 0, None
    while at < len(data):
        head = data[at]
        if not head & 128 or at + 2 > len(data):
            return None
        if head & 64:
            tag, a = head & 63, data[at + 1]
            if a < 192:
                size, at = a, at + 2
            elif a < 224 and at + 3 <= len(data):
                size, at = ((a - 192) << 8) + data[at + 2] + 192, at + 3
            elif a == 255:
                size, at = int.from_bytes(data[at + 2:at + 6], "big"), at + 6
            else:
                return None
        else:
            tag, n = head >> 2 & 15, 1 << (head & 3)
            if n == 8:
                return None
            size, at = int.from_bytes(data[at + 1:at + 1 + n], "big"), at + 1 + n
        if first is None:
            first = (tag, data[at:at + 1])
        at += size
    return "OpenPGP" if at == len(data) and first and first[0] == 5 and first[1] in (b"\3", b"\4", b"\5", b"\6") \
        else None


def whole_key(data: bytes) -> str | None:
    """What private key ``data`` is, nothing left over."""
    if data.startswith(OPENSSH):
        found = openssh_key(data)
        return found[0] if found and found[1] == len(data) else None
    f = field(data, 0, len(data))
    return der_key(data, f[1], f[2]) if f and f[0] == SEQ and f[2] == len(data) else None


# --- candidates ------------------------------------------------------------------

# Bytes of a signature by algorithm (None: at least 128).
SIGNATURE = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,),
             "ES512": (132,), "EdDSA": (64, 114), "RS256": None, "RS384": None, "RS512": None, "PS256": None,
             "PS384": None, "PS512": None}


def json_object(part: str) -> dict | None:
    data = decode64(part) if part else None
    if not data or data[:1] != b"{":
        return None
    try:
        out = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return out if isinstance(out, dict) else None


def tokens(run: str) -> list[tuple[int, int, str]]:
    """Signed or encrypted tokens in one run."""
    out = []
    for m in DOTTED.finditer(run):
        parts, at, ends = m[0].split("."), m.start(), []
        for p in parts:
            ends.append((at, at + len(p)))
            at += len(p) + 1
        i = 0
        while i + 2 < len(parts):
            part, step = parts[i], 1
            # base64 of an opening brace: e, then one of the last sixteen digits
            if len(part) >= 12 and part[0] == "e" and part[1] in "wxyz0123456789-_":
                head = json_object(part)
                alg = head.get("alg") if head else None
                if isinstance(alg, str) and "enc" in head:
                    if i + 4 < len(parts) and all(decode64(p) for p in parts[i + 2:i + 5]):
                        step, what = 5, f"encrypted {alg}"
                elif isinstance(alg, str) and alg.lower() != "none" and json_object(parts[i + 1]) is not None:
                    sizes, n = SIGNATURE.get(alg, ()), len(decode64(parts[i + 2]) or b"")
                    if n in sizes if sizes else n >= (128 if sizes is None else 1):
                        step, what = 3, alg
                if step > 1:
                    out.append((ends[i][0], ends[i + step - 1][1], what))
            i += step
    return out


def armours(text: str) -> list[tuple[int, int, str]]:
    """Armoured private keys. A begin mark belongs to the next mark if that is its end."""
    out, last = [], None
    for m in MARK.finditer(text):
        if m[1] == "END" and last is not None and last[2] == m[2] and "PRIVATE KEY" in m[2]:
            body = text[last.end():m.start()].replace("\\r", "").replace("\\n", "\n").replace("\r", "")
            named = [x.lower() for x in FIELD.findall(body)]
            body = FIELD.sub("", body)
            if m[2].startswith("PGP"):
                body = re.sub(r"\n=[A-Za-z0-9+/]{4}\s*$", "\n", body)  # the checksum line
            data = decode64("".join(body.split())) if len(body) < 2 * MAX_KEY else None
            if data:
                if any("encrypted" in x for x in named) and any(x.startswith("dek-info:") for x in named):
                    what = "encrypted" if len(data) % 8 == 0 else None
                else:
                    what = pgp_key(data) if m[2].startswith("PGP") else whole_key(data)
                if what:
                    out.append((last.start(), m.end(), what))
        last = m if m[1] == "BEGIN" else None
    return out


def base64_key(text: str, at: int) -> tuple[int, str] | None:
    """(end, what) of the key whose base64 begins at ``at``. The structure's
    own length says how many characters belong to it."""
    digits, ends, need, last = [], [], None, at
    held = 0
    while True:
        m = LINE64.match(text, last, last + 2 * MAX_KEY)
        if not m:
            break
        line = m[0].rstrip("=")[:2 * MAX_KEY - held]
        digits.append(line)
        ends.append((held, last, m.end()))
        held += len(line)
        if need is None and held >= 16:
            head = decode64("".join(digits)[:16])
            if head and head[0] == SEQ and 1 <= head[1] <= 0x84 and head[1] != 0x80:
                n = head[1] & 127 if head[1] > 128 else 0
                size = int.from_bytes(head[2:2 + n], "big") + 2 + n if n else 2 + head[1]
                # then comes the version, or the algorithm of an encrypted key
                if size > MAX_KEY or head[2 + n] not in (INT, SEQ):
                    return None
                need = -(-size * 4 // 3)
            elif head and (head.startswith(OPENSSH[:12]) or head.startswith(b"-----BEGIN ")):
                need = 2 * MAX_KEY
            else:
                return None
        if need is not None and held >= need or held >= 2 * MAX_KEY or len(line) < WRAPPED or "=" in m[0]:
            break
        broken = LINE_BREAK.match(text, m.end())
        if not broken:
            break
        last = broken.end()
    if need is None or not ends:
        return None
    all_digits = "".join(digits)
    wrapped = need == 2 * MAX_KEY
    if not wrapped and held < need:
        return None
    use = all_digits if wrapped else all_digits[:need]
    data = decode64(use[:len(use) - (len(use) % 4 == 1)])
    if not data:
        return None
    used = len(use)
    if data.startswith(OPENSSH):
        found = openssh_key(data)
        if not found:
            return None
        used, what = -(-found[1] * 4 // 3), found[0]
    elif data.startswith(b"-----BEGIN "):
        inner = armours(data.decode("latin-1"))
        if not inner:
            return None
        used, what = -(-inner[-1][1] * 4 // 3), inner[0][2]
    else:
        f = field(data, 0, len(data))
        what = der_key(data, f[1], f[2]) if f and f[0] == SEQ else None
    if not what:
        return None
    before, begin, line_end = next(x for x in reversed(ends) if x[0] < used)
    end = begin + used - before
    if text[end:line_end].strip("=") == "":
        end = line_end  # the padding
    return end, what


def hex_key(run: str, at: int) -> tuple[int, str] | None:
    """(end, what) of the key whose hex digits begin at ``at`` of a run."""
    m = DIGITS16.match(run, at, at + 2 * MAX_KEY)
    data = bytes.fromhex(run[at:m.end() - (m.end() - at) % 2])
    f = field(data, 0, len(data))
    what = der_key(data, f[1], f[2]) if f and f[2] <= MAX_KEY else None
    return (at + 2 * f[2], what) if what else None


def spans(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """(kind, start, end, what) by start, then kind."""
    if not text:
        return []
    out = [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    armoured = armours(text) if "-----BEGIN " in text else []
    out += [("pem", *x) for x in armoured]
    free, begins = 0, [b for b, _, _ in armoured]  # where the last confirmed key ended
    for r in RUN.finditer(text):
        run, at = r[0], r.start()
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            out += [(kind, at + m.start(), at + m.end(), None) for m in pattern.finditer(run)
                    if m.end() - m.start() >= LEAST[kind]]
        if len(run) < WRAPPED:
            continue
        out += [("jwt", at + b, at + e, what) for b, e, what in tokens(run)]
        for begin, parse in ((BEGIN64, base64_key), (BEGIN16, hex_key)):
            for m in begin.finditer(run):
                start = at + m.start()
                i = bisect_right(begins, start) - 1
                if start < free or i >= 0 and start < armoured[i][1]:
                    continue
                found = parse(text, start) if parse is base64_key else parse(run, m.start())
                if found:
                    end = found[0] if parse is base64_key else at + found[0]
                    out.append(("key", start, end, found[1]))
                    free = max(free, end)
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], rank[s[0]], s[2]))


SPANS = "array<struct<kind: string, start: long, end: long, what: string>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every row. One pass over the texts, no shuffle."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("what", pa.string())]))

    def run(batches):
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "what"), s)) for s in spans(t)]
                     for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "found"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, found {SPANS}")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the patterns, the digest of their spans, and all spans."""
    found = find_secrets(docs)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    listed = lambda c: F.array_join(F.transform(
        c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*LEAST))
    confirmed = F.filter("found", lambda s: ~s["kind"].isin(*LEAST))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in LEAST],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
        F.transform(confirmed, lambda s: s["what"]).alias("confirmed"))
