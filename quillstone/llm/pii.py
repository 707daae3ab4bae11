"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, digits, "://" and cue words such as IBAN.
From each anchor a deterministic local parser expands to the borders of an e-mail address, network address, card
number, telephone number, URL with user data or account number, and validates it (octets, Luhn, digit counts, mod 97).
Parsers of one kind never look again at characters that a match of that kind has used, so each text takes linear time.

An octet may have any number of leading zeros. A scheme has any length and begins with its run's first letter; cues are
met in any case of their letters.

Offsets are code points, end exclusive. A null text counts as empty and has no spans. Texts of any length are scanned
whole; repeated rows give repeated results. Nothing is shuffled, so no key can be hot. Extra columns pass through; one
named like an added column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, with_columns

#: Kinds in their order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = 4

# Fixed forms of the base kinds, as what may stand right of an anchor.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

SCHEME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
NOT_FIRST = "0123456789+.-"
USER_URL = re.compile(r"://[^\s/?#@<>\"']+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
CUES = ("iban", "ssn", "account", "acct", "passport")
AFTER_CUE = re.compile(r"\s{0,3}(?:number|no|nr)?[\s:#.=]{1,4}", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")
NUMBER = re.compile(r"[A-Z]{0,3}[0-9][0-9 -]{4,20}[0-9](?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class AnchorScanner:
    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for key in ("@", "+", "://", *"0123456789"):
            self.automaton.add_word(key, (key, len(key)))
        for cue in CUES:
            for form in map("".join, product(*((c, c.upper()) for c in cue))):  # in any case of their letters
                self.automaton.add_word(form, ("cue", len(form)))
        self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of all spans, sorted."""
        out: list[tuple[int, int, int]] = []
        mail_at = quad_at = card_at = phone_at = url_at = account_at = seen_at = scheme_at = 0
        for last, (key, width) in self.automaton.iter(text):
            at = last - width + 1
            if key == "@":
                if at >= mail_at:
                    from_ = max(mail_at, seen_at)
                    local = text[from_:at]
                    start = from_ + len(local.rstrip(LOCAL))
                    m = DOMAIN.match(text, at + 1)
                    if start < at and m:
                        out.append((start, 0, m.end()))
                        mail_at = m.end()
                seen_at = at + 1
            elif key == "+":
                if at >= phone_at and (m := PHONE.match(text, at)):
                    phone_at = m.end()
                    if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                        out.append((at, 3, m.end()))
            elif key == "://":
                if at >= url_at and (m := USER_URL.match(text, at)):
                    head = text[max(url_at, scheme_at) : at]
                    scheme = head[len(head.rstrip(SCHEME)) :].lstrip(NOT_FIRST)
                    if scheme:
                        out.append((at - len(scheme), 4, m.end()))
                        url_at = m.end()
                scheme_at = at + 3
            elif key == "cue":
                if at >= account_at and not (at and text[at - 1].isalnum()):
                    self._account(text, at, last + 1, out)
                    account_at = out[-1][2] if out and out[-1][1] == 5 else account_at
            else:
                if at >= quad_at:
                    m = QUAD.match(text, at)
                    if m:
                        quad_at = m.end()
                        if all(len(x) < 4 and int(x or "0") <= 255 for x in (x.lstrip("0") for x in m.group().split("."))):
                            out.append((at, 1, m.end()))
                    else:  # no other start in this run of digits can do better
                        quad_at = DIGITS.match(text, at).end()
                if at >= card_at:
                    m = CARD.match(text, at)
                    card_at = m.end() if m else at + 1
                    if m:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 12 <= len(digits) <= 19 and luhn(digits):
                            out.append((at, 2, m.end()))
        return sorted(out)

    @staticmethod
    def _account(text: str, at: int, end: int, out: list[tuple[int, int, int]]) -> None:
        gap = AFTER_CUE.match(text, end)
        if not gap:
            return
        cue, start = text[at:end].lower(), gap.end()
        if m := IBAN.match(text, start):
            found = next((m.group()[:n] for n in range(len(m.group()), 14, -1) if m.group()[n - 1] != " " and iban_ok(m.group()[:n])), None)
            if found:
                out.append((start, 5, start + len(found)))
        elif cue == "ssn":
            if m := SSN.match(text, start):
                out.append((start, 5, m.end()))
        elif cue != "iban" and (m := NUMBER.match(text, start)) and 6 <= sum(c.isdigit() for c in m.group()) <= 17:
            out.append((start, 5, m.end()))


_SCANNER: list[AnchorScanner] = []


def scanner() -> AnchorScanner:
    if not _SCANNER:
        _SCANNER.append(AnchorScanner())
    return _SCANNER[0]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds spans, an array of structs (start, kind, end) sorted by start; kind counts from 0 in KINDS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner().scan
        for batch in slices(batches, text):
            found = [[{"start": a, "kind": k, "end": e} for a, k, e in find(x or "")] for x in batch.column(text).to_pylist()]
            yield with_columns(batch, ["spans"], [pa.array(found, _ARROW_SPANS)])

    return df.mapInArrow(run, T.StructType([f for f in df.schema.fields if f.name.lower() != "spans"] + [T.StructField("spans", SPANS)]))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each span replaced by its kind in brackets; of overlapping spans the first stands for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner().scan
        for batch in slices(batches, text):
            out = []
            for x in batch.column(text).to_pylist():
                parts, at = [], 0
                for a, k, e in find(x or ""):
                    if a >= at:
                        parts += [x[at:a], f"[{KINDS[k].upper()}]"]
                    at = max(at, e)
                out.append(x if not parts else "".join([*parts, x[at:]]))
            columns = [pa.array(out, pa.string()) if n == text else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)
