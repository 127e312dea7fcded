"""Personal data (operator 7): patterns propose spans, checksums confirm them, context scores them.

Base kinds, leftmost and non-overlapping within a kind: ``email``, ``ip`` (parts at most 255),
``card`` (13 to 19 digits that pass Luhn) and ``phone`` (9 to 15 digits after ``+``). Further kinds
are confirmed by more than their pattern: ``iban`` by its length and the mod-97 check, ``ssn`` and
``local_phone`` by context words near them. A span's score starts at its kind's prior and
rises for each context word of its kind within 40 characters; base spans are always kept, the
further kinds only at ``MIN_SCORE`` or more and where no earlier span of any kind lies.

Every pattern is searched in time linear in the text: e-mails are found from their ``@``, runs
of digits only from their start. A null text is an empty one. Repeated rows give repeated results;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from ._base import map_batches

SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_iban long, "
          "n_ssn long, n_local_phone long, top_score double, base_sha256 string, spans string")

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "local_phone")
MIN_SCORE = 0.6
CONTEXT_CHARS = 40

# A kind's prior score and the context words that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.4}
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "credit", "visa", "mastercard", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono", "telephone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono", "telephone"),
}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without blanks has a valid length and check digits."""
    if not 15 <= len(iban) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str):
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if m:
            at = end = m.end()
            yield start, end


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    at = 0
    while (at := text.find("+", at)) >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()
        at = m.end() if m else at + 1


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    words = {w.lower() for w in _WORD.findall(near)}
    return min(1.0, PRIOR[kind] + 0.3 * sum(w in words for w in CONTEXT[kind]))


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) of a text, by kind as listed, then start."""
    text = text or ""
    found: list[tuple[str, int, int, float]] = []
    digits = _DIGIT.search(text) is not None
    if "@" in text:
        found += [("email", a, b, _score(text, "email", a, b)) for a, b in _emails(text)]
    if digits:
        for kind, search in (("ip", _ips), ("card", _cards), ("phone", _phones)):
            found += [(kind, a, b, _score(text, kind, a, b)) for a, b in search(text)]
        taken = bytearray(len(text))
        for _, a, b, _ in found:
            taken[a:b] = b"\1" * (b - a)
        for kind, spans in (("iban", _ibans(text)), ("ssn", (m.span() for m in _SSN.finditer(text))),
                            ("local_phone", (m.span() for m in _LOCAL_PHONE.finditer(text)))):
            for a, b in spans:
                score = _score(text, kind, a, b)
                if score >= MIN_SCORE and 1 not in taken[a:b]:
                    taken[a:b] = b"\1" * (b - a)
                    found.append((kind, a, b, score))
    return found


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data of every whole text: (doc_id, spans array)."""
    def run(ids: list, texts: list) -> dict[str, list]:
        spans = [[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in find_spans(t)]
                 for t in texts]
        return {"doc_id": ids, "spans": spans}

    return map_batches(docs, ["doc_id", "text"],
                       "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>", run)


def mask(text: str | None, token: str = "<{}>") -> str | None:
    """The text with each span replaced by its kind; of overlapping spans the first stays."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b, _ in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], token.format(kind.upper())]
            at = b
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the personal data of each text masked."""
    return map_batches(docs, ["doc_id", "text"], "doc_id long, text string",
                       lambda ids, texts: {"doc_id": ids, "text": [mask(t) for t in texts]})


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts by kind and digests of the spans of every text."""
    def run(ids: list, texts: list) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids} | {f"n_{k}": [] for k in BASE_KINDS + MORE_KINDS}
        out |= {"top_score": [], "base_sha256": [], "spans": []}
        for text in texts:
            spans = find_spans(text)
            kinds = [s[0] for s in spans]
            for k in BASE_KINDS + MORE_KINDS:
                out[f"n_{k}"].append(kinds.count(k))
            named = [f"{k}:{a}:{b}" for k, a, b, _ in spans]
            base = ",".join(x for x, k in zip(named, kinds, strict=True) if k in BASE_KINDS)
            out["top_score"].append(max((s[3] for s in spans), default=0.0))
            out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            out["spans"].append(",".join(named))
        return out

    return map_batches(docs, ["doc_id", "text"], SCHEMA, run)
