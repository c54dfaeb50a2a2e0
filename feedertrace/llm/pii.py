"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes and identifier cues. At each anchor a
deterministic parser expands to the boundaries of the identifier and validates it. A parser looks at the text around
its anchor only and never twice at the same stretch, so the time is linear in the text, however long its words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
#: In the order that breaks ties between spans of one start.
KINDS = (*BASE_KINDS, "iban", "account", "ssn", "secret", "url")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"

#: Words before an identifier, by the parser that reads what follows.
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "secret": ("password", "passwd", "api_key", "apikey", "secret", "token"),
}

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").match
_DIGITS = re.compile(r"[0-9]+").match
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_IBAN = re.compile(r"[\s:#=.-]{1,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])").match
_ACCOUNT = re.compile(r"(?: ?(?:no|nr|number|num))?[\s:#=.]{1,8}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.I).match
_SSN = re.compile(r"[\s:#=.]{1,8}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])").match
_SECRET = re.compile(r"[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_/+.-]{12,})").match
_AUTHORITY = re.compile(r"[^\s/?#@:]+(?::[^\s/?#@]*)?@[A-Za-z0-9.-]+").match


def luhn(digits: str) -> bool:
    """Whether the check digit of ``digits`` holds."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    """Whether the remainder modulo 97 holds."""
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


@lru_cache(maxsize=1)
def automaton():
    """All anchors; a value is (kind of anchor, its length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    found.add_word("://", ("://", 3))
    for kind, words in CUES.items():
        for word in words:
            for form in {word, word.title(), word.capitalize(), word.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _cued(text: str, kind: str, end: int) -> tuple[int, int] | None:
    """The identifier that follows a cue ending at ``end``."""
    m = {"iban": _IBAN, "account": _ACCOUNT, "ssn": _SSN, "secret": _SECRET}[kind](text, end)
    if not m:
        return None
    value = m[1]
    if kind == "iban" and not iban_valid(value):
        return None
    if kind == "ssn" and (value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[7:] == "0000"):
        return None
    if kind == "secret" and not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return None
    return m.span(1)


def find_spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all identifiers, by start and then by kind; ends are exclusive, in code points."""
    found: list[tuple[int, str, int]] = []
    if not text:
        return found
    email_to = ip_to = card_to = 0
    for last, (anchor, width) in automaton().iter(text):
        if anchor == "digit":
            if last >= ip_to:
                if m := _IP(text, last):
                    ip_to = m.end()
                    if all(len(x) <= 3 and int(x or "0") <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
                        found.append((last, "ip", ip_to))
                else:
                    ip_to = _DIGITS(text, last).end()
            if last >= card_to:
                if m := _CARD(text, last):
                    card_to = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        found.append((last, "card", card_to))
                else:
                    card_to = last + 1
        elif anchor == "@":
            at = last
            while at > email_to and text[at - 1] in _LOCAL:
                at -= 1
            if at < last and (m := _DOMAIN(text, last + 1)):
                email_to = m.end()
                found.append((at, "email", email_to))
        elif anchor == "+":
            if (m := _PHONE(text, last)) and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((last, "phone", m.end()))
        elif anchor == "://":
            at = last - 2
            while at and last - at < 24 and text[at - 1] in _SCHEME:
                at -= 1
            if at < last - 2 and (m := _AUTHORITY(text, last + 1)):
                found.append((at, "url", m.end()))
        else:
            before = last - width
            if (before < 0 or not text[before].isalnum()) and (span := _cued(text, anchor, last + 1)):
                found.append((span[0], anchor, span[1]))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(found), key=lambda x: (x[0], order[x[1]], x[2]))


def _said(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            spans = find_spans(text)
            base = [x for x in spans if x[1] in BASE_KINDS]
            counts = [sum(x[1] == k for x in base) for k in BASE_KINDS]
            rows.append((doc_id, *counts, hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans), len(spans)))
        yield pd.DataFrame(rows, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"]).astype({"doc_id": "Int64"})


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read), with what its whole text holds.

    A null text is empty, and an empty text has no spans: counts 0, empty ``spans``, the digest of an empty string.
    Repeated rows and rows with a null doc_id each give a row. An empty table gives an empty one.
    """
    return docs.select("doc_id", "text").mapInPandas(_rows, SCHEMA)


def redact(text: str | None, mask: str = "[{}]") -> str | None:
    """``text`` with each identifier replaced by its kind; where spans overlap, one mask (the first's) covers them all."""
    if text is None:
        return None
    out, to = [], 0
    for start, kind, end in find_spans(text):
        if start >= to:
            out += [text[to:start], mask.format(kind)]
        to = max(to, end)
    return "".join([*out, text[to:]])


def _redacted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(text=[redact(x) for x in batch["text"]])


def redact_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, identifiers in ``text`` masked; nulls stay null."""
    return docs.mapInPandas(_redacted, docs.schema)
