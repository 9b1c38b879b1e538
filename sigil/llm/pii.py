"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, schemes
and identifier cues. At each anchor a deterministic parser grows the span to its borders
and validates it. Per kind, spans are leftmost and do not overlap.

Base kinds: email, ip, card (14 to 19 digits that pass Luhn), phone (10 to 15 digits).
Added kinds: email_intl (letters beyond ASCII), login (user information in a URL), iban
(mod 97), account (a number after an account cue).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sigil.llm.common import slices, small_batches, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_intl", "login", "iban", "account")
RANK = {kind: i for i, kind in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOMAIN_INTL = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s@/]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Runs of white space are taken whole (possessive), so that a long one is read once.
_ACCOUNT = re.compile(r"(?:\s*+(?:no|nr|number|id)\b\.?)?+\s*+(?:[:#=]\s*+)?+([0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.I)

#: Anchor texts and the parser each one starts.
ANCHORS = (
    {"@": "at", "+": "plus", "://": "scheme"}
    | dict.fromkeys("0123456789", "digit")
    | dict.fromkeys(("IBAN", "iban", "Iban"), "iban")
    | dict.fromkeys(("account", "Account", "ACCOUNT", "acct", "Acct", "Konto", "konto", "cuenta", "Cuenta", "compte", "Compte"), "account")
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Finder:
    """Compiled anchors; spans(text) gives (start, end, kind) sorted by start, then kind."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for word, parser in ANCHORS.items():
            self.automaton.add_word(word, (parser, len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        found: list[tuple[int, int, str]] = []
        free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may begin
        run = 0  # digits before this are part of a run that failed as an address
        for last, (parser, length) in self.automaton.iter(text):
            if parser == "digit":
                if last >= free["card"]:
                    if m := _CARD.match(text, last):
                        free["card"] = m.end()
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            found.append((last, m.end(), "card"))
                    else:
                        free["card"] = last + 1
                if last >= run:
                    if m := _IP.match(text, last):
                        run = m.end()
                        parts = [p.lstrip("0") for p in m[0].split(".")]
                        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                            found.append((last, run, "ip"))
                    else:
                        run = _DIGITS.match(text, last).end()
            elif parser == "plus":
                if last >= free["phone"] and (m := _PHONE.match(text, last)):
                    free["phone"] = m.end()
                    if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                        found.append((last, m.end(), "phone"))
            elif parser == "at":
                self._email(text, last, free, found)
            elif parser == "scheme":
                if m := _LOGIN.match(text, last + 1):
                    start = last + 1 - length
                    while start > free["login"] and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                        start -= 1
                    if start < last + 1 - length and start >= free["login"]:
                        free["login"] = m.end()
                        found.append((start, m.end(), "login"))
            elif parser == "iban":
                at = last + 1
                while at < len(text) and text[at] in " :#=":
                    at += 1
                if at >= free["iban"] and (m := _IBAN.match(text, at)) and _iban_ok(m[0]):
                    free["iban"] = m.end()
                    found.append((at, m.end(), "iban"))
            elif (m := _ACCOUNT.match(text, last + 1)) and m.start(1) >= free["account"]:
                free["account"] = m.end(1)
                found.append((m.start(1), m.end(1), "account"))
        return sorted(found, key=lambda s: (s[0], RANK[s[2]]))

    @staticmethod
    def _email(text: str, at: int, free: dict[str, int], found: list[tuple[int, int, str]]) -> None:
        start = at
        while start > free["email"] and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free["email"] = m.end()
            found.append((start, m.end(), "email"))
        wide = at
        while wide > free["email_intl"] and (text[wide - 1] in _LOCAL or text[wide - 1].isalnum()):
            wide -= 1
        if wide == at:
            return
        n = _DOMAIN_INTL.match(text, at + 1)
        if n and not (m and wide == start and n.end() <= m.end()) and not text[wide : n.end()].isascii():
            free["email_intl"] = n.end()
            found.append((wide, n.end(), "email_intl"))


def joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Offsets are code points of the whole text, ends exclusive. Null and empty texts have no
    spans. Null ids and repeated rows are kept as they are; an empty table gives an empty
    table. Other input columns are ignored, whatever their names.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in slices(batches):
            counts: dict[str, list[int]] = {k: [] for k in BASE}
            digests, spans = [], []
            for text in texts_of(batch.column("text")):
                all_spans = finder.spans(text)
                base = [s for s in all_spans if s[2] in BASE]
                for k in BASE:
                    counts[k].append(sum(s[2] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(all_spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
            )

    small_batches(docs)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(scan, f"doc_id {dict(rows.dtypes)['doc_id']}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: str, mask: str = "<{}>") -> str:
    """text with every span of a spans string replaced by its kind; of overlapping spans the first counts."""
    out, at = [], 0
    for item in filter(None, spans.split(",")):
        kind, start, end = item.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], mask.format(kind)]
            at = int(end)
    return "".join([*out, text[at:]])
