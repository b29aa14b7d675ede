"""Secret scan: fixed patterns, and encoded candidates reported only after their structure is confirmed.

Base kinds are found by pattern alone. Runs of base64 and hex digits are decoded at every alignment, so that a path
or word that stands before a blob doesn't shift it, also where they are wrapped into lines. They are reported
where the bytes parse as a private key (nested DER lengths, all nested fields of an OpenSSH key) or hold a base kind;
dotted parts are reported when one of them decodes to a signed token's header and the next to its claims. Every search
is one pass over the text, in time linear in its length. One pass over the whole texts, no shuffle; a task holds one
Arrow batch.

Defined cases: a null or empty text has no spans; a very long text is searched whole; spans are in code points, end
exclusive, and spans of different kinds may overlap; of spans that start together the kind listed first comes first;
repeated rows are scanned each for itself; an empty table gives no rows; further columns are not carried by `scan`
and kept as they are by `redact`.
"""

from __future__ import annotations

import base64
import bisect
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import map_batches

# The contract's patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE = ("assign", "access", "hex")
#: All kinds, in the order in which spans that start together are listed.
KINDS = (*BASE, "pem", "token", "key64", "keyhex", "hidden64", "hiddenhex")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
#: Candidates from the shortest secret on that can be confirmed: 14 bytes, an assign of five letters, a sign and eight.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}+={0,2}")
ANY_HEX = re.compile(r"[0-9a-fA-F]{28,}+")
#: Lines of one blob: at least 40 digits in each but the last.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{40,}+\r?\n[ \t]*+)+[A-Za-z0-9+/]++={0,2}")
WRAPPED_HEX = re.compile(r"(?<![0-9a-fA-F])(?:[0-9a-fA-F]{40,}+\r?\n[ \t]*+)+[0-9a-fA-F]++")
ASSIGN_BYTES, ACCESS_BYTES = re.compile(ASSIGN.pattern.encode(), re.I), re.compile(ACCESS.pattern.encode())
DECODER = json.JSONDecoder()
OPENSSH = b"openssh-key-v1\0"
#: What may stand around a base kind in the text that hides it.
READABLE = re.compile(rb"[\x09\x0a\x0d\x20-\x7e]+")
CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
#: A key's DER value, from its first byte on: its length in one byte or up to four.
SEQUENCE = re.compile(rb"\x30(?:[\x16-\x7f]|\x81[\x80-\xff]|\x82..|\x83...|\x84....)", re.S)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end), unordered."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def unbase64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the DER values that fill `data` exactly; None if the lengths don't nest."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or at + wide > len(data):
                return None
            size, at = int.from_bytes(data[at : at + wide], "big"), at + wide
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def strings(data: bytes, at: int, n: int) -> tuple[list[bytes], int] | None:
    """n length-prefixed strings from `at` on, and where they end."""
    found = []
    for _ in range(n):
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or end > len(data):
            return None
        found.append(data[at + 4 : end])
        at = end
    return found, at


def openssh_end(data: bytes, start: int = 0) -> int:
    """Where an OpenSSH key that starts at `start` ends, or 0: cipher, key derivation, public keys, private part."""
    if not data.startswith(OPENSSH, start) or not (head := strings(data, start + len(OPENSSH), 3)):
        return 0
    (cipher, kdf, options), at = head
    count = int.from_bytes(data[at : at + 4], "big")
    if not 1 <= count <= len(data) // 8 or (cipher == b"none") != (kdf == b"none") or not cipher.isascii():
        return 0
    if not (rest := strings(data, at + 4, count + 1)):
        return 0
    (*public, private), end = rest
    if any(not (kind := strings(key, 0, 1)) or not kind[0][0] or not kind[0][0].isascii() for key in public):
        return 0
    if cipher == b"none":  # two equal check numbers, then the first key's kind again
        kind = strings(private, 8, 1)
        return end if private[:4] == private[4:8] and kind and kind[0][0] == strings(public[0], 0, 1)[0][0] else 0
    return end if len(private) >= 16 and (kdf != b"bcrypt" or strings(options, 0, 1)) else 0


def is_private_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or OpenSSH, judged by the nested lengths and leading fields."""
    if data.startswith(OPENSSH):
        return openssh_end(data) == len(data)
    if data[:1] != b"\x30" or len(data) < 24:
        return False
    outer = der_items(data)
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if len(inner) >= 9 and inner[0] == (2, b"\0"):
        return all(tag == 2 for tag in tags[:9])
    if tags[:3] == [2, 0x30, 4] and inner[0][1] in (b"\0", b"\1"):
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 6
    if tags[:2] == [2, 4] and inner[0][1] == b"\1":
        return len(inner[1][1]) in (20, 24, 28, 32, 48, 66)
    if tags == [0x30, 4]:
        algorithm = der_items(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == 6
    return False


def key_spans(data: bytes) -> list[tuple[int, int]]:
    """Where private keys stand in decoded bytes; keys don't overlap."""
    found, at = [], 0
    for m in SEQUENCE.finditer(data):
        start, wide = m.start(), max(0, len(m[0]) - 2)
        size = int.from_bytes(data[start + 2 : start + 2 + wide], "big") if wide else data[start + 1]
        end = start + 2 + wide + size
        # the first value inside a key is a small number, or the sequence of an algorithm
        inside = data[start + 2 + wide : start + 4 + wide]
        if start >= at and end <= len(data) and (inside == b"\x02\x01" or inside[:1] == b"\x30") and is_private_key(data[start:end]):
            found.append((start, end))
            at = end
    at = data.find(OPENSSH)
    while at >= 0:
        if end := openssh_end(data, at):
            found.append((at, end))
        at = data.find(OPENSSH, max(end, at + 1))
    return found


def is_text(data: bytes) -> bool:
    if CONTROL.search(data):
        return False
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def hidden_spans(data: bytes) -> list[tuple[int, int]]:
    """Where text in decoded bytes stands that holds a base kind (no hex) or a key's armour: all of it, or a stretch."""
    hits = [m.span() for m in ASSIGN_BYTES.finditer(data) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    hits += [m.span() for m in ACCESS_BYTES.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    if b"PRIVATE KEY-----" in data:
        hits += [(start, end) for start, _, end in armoured(data.decode("latin-1"))]
    if not hits:
        return []
    if is_text(data):
        return [(0, len(data))]
    hits.sort()
    found, k = [], 0
    for m in READABLE.finditer(data):
        while k < len(hits) and hits[k][1] <= m.start():
            k += 1
        if k < len(hits) and hits[k][0] < m.end():
            found.append(m.span())
    return found


def decoded_spans(digits: str, width: int, decode) -> list[tuple[int, int, bool]]:
    """(start, end, whether a key) in digits, `width` of which make a group of whole bytes, at every alignment."""
    found: list[tuple[int, int, bool]] = []
    size = {2: 1, 4: 3}[width]
    for shift in range(width):
        body = digits[shift:]
        data = decode(body[: len(body) - len(body) % 2] if width == 2 else body[:-1] if len(body) % 4 == 1 else body)
        if not data:
            continue
        for key, spans in ((True, key_spans(data)), (False, hidden_spans(data))):
            for a, b in spans:
                start, end = shift + a * width // size, min(len(digits), shift + -(-b * width // size))
                k = bisect.bisect_left(found, (end,))  # found is in order and without overlaps
                if k == 0 or found[k - 1][1] <= start:
                    found.insert(k, (start, end, key))
    return found


def object_at(part: str, shift: int) -> tuple[int, dict] | None:
    """The first JSON object that fills what follows it of a token's part, decoded from `shift` on, and where it starts."""
    raw = unbase64(part[shift:] if (len(part) - shift) % 4 != 1 else "")
    data = raw.decode("latin-1") if raw else ""
    end, at = len(data.rstrip()), data.find("{")
    while at >= 0:
        if at % 3 == 0 or not data[:at].strip():
            try:
                value, stop = DECODER.raw_decode(data, at)
                if stop == end:
                    return shift + at // 3 * 4, value
            except ValueError:
                pass
            except RecursionError:
                return None
        at = data.find("{", at + 1)
    return None


def token_spans(text: str) -> list[tuple[int, int]]:
    """Signed tokens: a header with an algorithm, claims and a signature between dots, whatever stands before them."""
    found = []
    for m in DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        k = 0
        while k + 2 < len(parts):
            end = at + sum(map(len, parts[k : k + 3])) + 2
            start = None
            if len(parts[k]) >= 8 and len(parts[k + 1]) >= 3 and (claims := object_at(parts[k + 1], 0)) and claims[0] == 0:
                heads = [head for shift in range(4) if (head := object_at(parts[k], shift))]
                start = min((place for place, value in heads if isinstance(value.get("alg"), str)), default=None)
            if start is not None:
                found.append((at + start, end))
            step = 3 if start is not None else 1
            at += sum(map(len, parts[k : k + step])) + step
            k += step
    return found


def armoured(text: str) -> list[tuple[int, str, int]]:
    """(start, body, end) from each END of a key's armour back to the last BEGIN of its label."""
    found, opened = [], {}
    for m in MARKER.finditer(text):
        if m[1] == "BEGIN":
            opened[m[2]] = m
        elif (first := opened.pop(m[2], None)) is not None:
            found.append((first.start(), text[first.end() : m.start()], m.end()))
    return found


def is_armoured_key(body: str) -> bool:
    """A key in base64; of an encrypted one in the old form its fields and whole cipher blocks."""
    lines = body.replace("\\r", "").replace("\\n", "\n").split("\n")
    data = unbase64("".join("".join(line.split()) for line in lines if ":" not in line))
    if not data:
        return False
    fields = dict(line.split(":", 1) for line in lines if ":" in line)
    if "ENCRYPTED" in fields.get("Proc-Type", ""):
        return "DEK-Info" in fields and len(data) >= 16 and len(data) % 8 == 0
    return is_private_key(data)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    spans, pems = [], []
    if "PRIVATE KEY-----" in text:
        for start, body, end in armoured(text):
            if is_armoured_key(body):
                pems.append((start, end))
                spans.append((start, 3, end))
    if "ey" in text or "ew" in text:
        spans += [(a, 4, b) for a, b in token_spans(text)]
    firsts = [a for a, _ in pems]
    for number, patterns, width, decode in ((5, (WRAPPED, BASE64), 4, unbase64), (6, (WRAPPED_HEX, ANY_HEX), 2, bytes.fromhex)):
        joined: list[tuple[int, int]] = []  # lines that were confirmed together, in order
        for wrapped, pattern in zip((True, False), patterns, strict=True):
            starts = [a for a, _ in joined]
            for m in pattern.finditer(text):
                if any((k := bisect.bisect_right(of, m.start())) and m.start() < spans_of[k - 1][1] for of, spans_of in ((firsts, pems), (starts, joined))):
                    continue
                raw = m[0]
                places = [k for k, c in enumerate(raw) if not c.isspace()] if wrapped else range(len(raw))
                digits = ("".join(raw.split()) if wrapped else raw).rstrip("=")
                for a, b, key in decoded_spans(digits, width, decode):
                    if wrapped and not key and (a, b) != (0, len(digits)):
                        continue  # the lines may be strangers to each other
                    start, end = places[a], places[b - 1] + 1
                    if not raw[end:].strip("="):
                        end = len(raw)
                    spans.append((m.start() + start, number if key else number + 2, m.start() + end))
                    if wrapped:
                        joined.append((m.start() + start, m.start() + end))
    return spans


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all spans of each document as an array of (kind, start, end), by start, then kind."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(base_spans(t) + confirmed_spans(t)) if t else [] for t in batch.column(1).to_pylist()]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in found]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], names=["doc_id", "spans"])

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest(scanned: DataFrame) -> DataFrame:
    """The counts and span lists of `scan` in the columns of the contract."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select("doc_id", *map(count, BASE), F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of its texts replaced by `mark` (overlapping spans by one), n_chars counted anew."""
    names = docs.columns
    at, size = names.index(text), names.index(n_chars)

    def clean(value: str | None) -> str | None:
        spans = sorted(base_spans(value) + confirmed_spans(value)) if value else []
        if not spans:
            return value
        parts, end = [], 0
        for start, _, stop in spans:
            if start >= end:
                parts += [value[end:start], mark]
            end = max(end, stop)
        return "".join([*parts, value[end:]])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        kept = [clean(t) for t in texts]
        columns = list(batch.columns)
        counts = [len(k) if k != t else n for k, t, n in zip(kept, texts, columns[size].to_pylist(), strict=True)]
        columns[at], columns[size] = pa.array(kept, pa.string()), pa.array(counts, columns[size].type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(docs, work, docs.schema)
