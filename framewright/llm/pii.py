"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, URL schemes and identifier cues. A local parser for
each kind expands an anchor to a span and validates it. The four base kinds give exactly the leftmost non-overlapping
matches of their patterns: every match holds an anchor (its at-sign, plus sign or first digit), and a parser never
looks at what an earlier match of its kind has taken. Further kinds: ``secret`` (access keys; values after password,
passwd, token, secret, api or access key and an equals sign or colon), ``iban`` (mod 97), ``ssn`` (after a cue) and
``login`` (user:password in a URL). Cues count in lower case, in capitals and with capital initials. A value after a cue
counts if it has 8 characters or more up to the next blank or quote and a digit among them: words alone are prose too
often to be called secrets, so a password of letters only, or of words in quotes, isn't found.

Null and empty texts have no spans. Positions are code points, the end exclusive. One pass, no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "iban", "ssn", "login")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACCESS = re.compile(r"A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])")
_ASSIGN = re.compile(r"['\"]?[\x20\t]{0,3}[=:][\x20\t]{0,3}['\"]?")
_VALUE = re.compile(r"[^\s'\"]*+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{1,4}){3,8}(?![0-9A-Za-z])")
_SSN = re.compile(r"[^0-9\n]{0,20}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_LOGIN = re.compile(r"://([^\s/@:]++:[^\s/@]++)@")

_DIGITS = frozenset("0123456789")
_CUES = {
    "secret": ("password", "passwd", "token", "secret", "api_key", "apikey", "access_key"),
    "ssn": ("ssn", "social security"),
    "iban": ("iban",),
}
_automaton = None


def _anchors():
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for c in "0123456789":
            a.add_word(c, ("digit", 1))
        a.add_word("@", ("email", 1))
        a.add_word("+", ("phone", 1))
        a.add_word("://", ("login", 3))
        for key in ("AKIA", "ASIA"):
            a.add_word(key, ("access", 4))
        for kind, cues in _CUES.items():
            for cue in cues:
                for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                    a.add_word(form, (kind, len(form)))
        a.make_automaton()
        _automaton = a
    return _automaton


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return not (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    taken = dict.fromkeys(KINDS, 0)
    # The last run without a delimiter that was read for a secret: its end, and its last digit; no run is read twice.
    run_end = run_digit = -1
    for last, (anchor, width) in _anchors().iter(text):
        at, after = last - width + 1, last + 1
        if anchor == "digit":
            # At a run's first digit only: from within a run both patterns match no more than from its start.
            if at >= taken["card"] and (m := _CARD.match(text, at)):
                taken["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
            if at >= taken["ip"] and (at == taken["ip"] or text[at - 1] not in _DIGITS) and (m := _IP.match(text, at)):
                taken["ip"] = m.end()
                if all(map(_octet, m[0].split("."))):
                    found["ip"].append(m.span())
        elif anchor == "email":
            start = at
            while start > taken["email"] and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at and (m := _DOMAIN.match(text, after)):
                taken["email"] = m.end()
                found["email"].append((start, m.end()))
        elif anchor == "phone":
            if at >= taken["phone"] and (m := _PHONE.match(text, at)):
                taken["phone"] = m.end()
                if 9 <= sum(c in _DIGITS for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        else:
            kind, span = {"access": "secret"}.get(anchor, anchor), None
            if anchor == "access":
                span = (m := _ACCESS.match(text, at)) and m.span()
            elif anchor == "secret":
                if m := _ASSIGN.match(text, after):
                    start = m.end()
                    if start >= run_end:
                        run_end = _VALUE.match(text, start).end()
                        run_digit = max(text.rfind(c, start, run_end) for c in _DIGITS)
                    span = run_end - start >= 8 and run_digit >= start and (start, run_end)
            elif anchor == "ssn":
                span = (m := _SSN.match(text, after)) and m.span(1)
            elif anchor == "iban":
                skip = re.compile(r"[\s:=#]{0,4}").match(text, after).end()
                span = (m := _IBAN.match(text, skip)) and _mod97(m[0]) and m.span()
            elif anchor == "login":
                span = (m := _LOGIN.match(text, at)) and m.span(1)
            if span and span[0] >= taken[kind]:
                taken[kind] = span[1]
                found[kind].append(span)
    return [(k, *span) for k in KINDS for span in found[k]]


def redact(text: str) -> str:
    """Every span, overlapping ones together, becomes [KIND] of the first of them."""
    out, at = [], 0
    for kind, start, end in sorted(find_spans(text), key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += (text[at:start], f"[{kind.upper()}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def _said(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            rows = [find_spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in r if s[0] in BASE] for r in rows]
            counts = [pa.array([sum(s[0] == k for s in r) for r in base], pa.int64()) for k in BASE]
            sha = pa.array([hashlib.sha256(_said(r).encode()).hexdigest() for r in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, sha, pa.array(map(_said, rows), pa.string())], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return common.text_rows(df, id_col, text_col).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_column(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with every span of text_col replaced; a null text stays null, all other columns stay as they are."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([t if t is None else redact(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at).name, texts)

    return df.mapInArrow(common.tidy(run), df.schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(common.documents(spark, sf_dir))
