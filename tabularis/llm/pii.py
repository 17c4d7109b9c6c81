"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one scan of a text: at-signs, plus signs, digits, URL schemes, identifier cues and
the fixed starts of tokens. Local parsers expand an anchor to the boundaries of the address or number and validate
it (domain labels, byte ranges, digit counts, Luhn, IBAN check digits). A digit is an anchor of addresses of four parts and of
card numbers where a run of digits starts; what a parser has read, valid or not, is not read by it again, so that the
matches of a kind are the leftmost ones that do not overlap.

Kinds: email, ip, card, phone (the base kinds) and, added by the cues, url, iban, account, secret. Spans are
code points, end exclusive; kinds may overlap each other, spans of one kind do not.

Cases: null and empty texts have no spans; long runs of address characters cost linear time, because an
at-sign expands left no further than the at-sign or match before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import doc_texts, lean, public_id

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "secret")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"://[^\s<>\"'`{}|\\^]+")
IBAN = re.compile(r"[\s:#=]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
ACCOUNT = re.compile(r"(?:\s*(?:no|nr|num|number|id))?[\s.:#=]{1,4}([A-Za-z]{0,3}[0-9](?:[ -]?[0-9]){5,17})(?![0-9A-Za-z])")
SECRET = re.compile(r"(?:\s{0,2}[:=]\s{0,2}|\s{1,2}is\s{1,2}(?=[^\s]*[0-9]))[\"']?([A-Za-z0-9+/_=.-]{8,})")
#: Starts of tokens that need no cue, and what follows them.
TOKENS = {
    "AKIA": re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])"),
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"[A-Za-z0-9]{20,}(?![A-Za-z0-9])")),
    **dict.fromkeys(("sk_live_", "sk_test_", "rk_live_"), re.compile(r"[A-Za-z0-9]{16,}(?![A-Za-z0-9])")),
    **dict.fromkeys(("xoxb-", "xoxp-"), re.compile(r"[A-Za-z0-9-]{10,}")),
    "eyJ": re.compile(r"[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
    "Bearer ": re.compile(r" *[A-Za-z0-9_.~+/-]{16,}=*"),
    "-----BEGIN ": re.compile(r"[A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----)?"),
}
SCHEMES = ("http", "https", "ftp", "ftps")
#: Cues, matched without regard to case where they are lower-case here.
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta", "passport", "customer", "ssn")
SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte(part: str) -> bool:
    """Whether a part of an address is at most 255 (leading zeros count for nothing)."""
    return len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255


def _automaton():
    a = ahocorasick.Automaton()
    for cue in (*ACCOUNT_CUES, *SECRET_CUES, "iban"):
        kind = "iban" if cue == "iban" else "secret" if cue in SECRET_CUES else "account"
        for form in (cue, cue.capitalize(), cue.upper()):
            a.add_word(form, (kind, len(form)))
    for mark in ("@", "+", "://", *TOKENS):
        a.add_word(mark, (mark, len(mark)))
    for digit in "0123456789":
        a.add_word(digit, ("digit", 1))
    a.make_automaton()
    return a


_AUTOMATA: list = []


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind as in KINDS, then by start."""
    if not _AUTOMATA:
        _AUTOMATA.append(_automaton())
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # where the last span of a kind ended

    def add(kind: str, start: int, end: int) -> None:
        if start >= free[kind]:
            found[kind].append((start, end))
            free[kind] = end

    read = {"ip": 0, "card": 0, "phone": 0}  # where the parser of a kind has come to
    for end, (what, size) in _AUTOMATA[0].iter(text):
        at = end + 1
        if what == "@":
            start = end
            while start > free["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < end and (m := DOMAIN.match(text, at)):
                add("email", start, m.end())
        elif what == "digit":
            if end and "0" <= text[end - 1] <= "9":
                continue  # within a run that its first digit has expanded
            if end >= read["ip"] and (m := IP.match(text, end)):
                read["ip"] = m.end()
                if all(_byte(p) for p in m.group().split(".")):
                    found["ip"].append(m.span())
            if end >= read["card"] and (m := CARD.match(text, end)):
                read["card"] = m.end()
                if 13 <= m.end() - end and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                    found["card"].append(m.span())
        elif what == "+":
            if end >= read["phone"] and (m := PHONE.match(text, end)):
                read["phone"] = m.end()
                if 9 <= len(_digits(m.group())) <= 15:
                    found["phone"].append(m.span())
        elif what == "://":
            start = end - 2
            while start > free["url"] and text[start - 1].isascii() and text[start - 1].isalpha() and end - start < 8:
                start -= 1
            if text[start : end - 2].lower() in SCHEMES and (m := URL.match(text, end - 2)):
                stop = m.end()
                while text[stop - 1] in ".,;:!?)]":
                    stop -= 1
                if stop > at:
                    add("url", start, stop)
        elif what == "iban":
            if m := IBAN.match(text, at):
                stop = m.end(1)
                while stop > m.start(1) + 14 and not iban_ok(text[m.start(1) : stop]):
                    stop -= 1
                if iban_ok(text[m.start(1) : stop]):
                    add("iban", m.start(1), stop)
        elif what == "account":
            if not text[max(0, at - size - 1) : at - size].isalnum() and (m := ACCOUNT.match(text, at)):
                add("account", *m.span(1))
        elif what == "secret":
            if m := SECRET.match(text, at):
                add("secret", *m.span(1))
        elif not text[max(0, at - size - 1) : at - size].isalnum() and (m := TOKENS[what].match(text, at)):
            add("secret", at - size, m.end())
    return [(k, *s) for k in KINDS for s in found[k]]


SPANS = "array<struct<kind: string, start: int, end: int>>"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for b in batches:
        rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(t.as_py())] for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.list_(span))], names=["id", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every whole text."""
    return doc_texts(docs).mapInArrow(lean(_run), f"id long, spans {SPANS}").select(public_id().alias("doc_id"), "spans")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
