"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, digits, plus signs, URL
schemes and identifier cues.  A deterministic local parser expands each anchor to the left and
right and validates the result; nothing else of the text is looked at.  Every parser consumes
its candidate, valid or not, so matches of one kind never overlap.

Base kinds: email, ip (parts up to 255), card (13-19 digits, Luhn), phone (9-15 digits).
Added by the method: url (after a scheme), account (IBAN with its check digits, or a number
after an account cue) and secret (the value assigned to a password, token or key cue).

Cases: null and empty texts have no spans; positions are code points, end exclusive; other
columns are ignored (reports) or passed through (redaction).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumshift.llm.rows import per_text, rewrite_text

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_RUN = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`|\\^{}\[\]]*[^\s<>\"'`|\\^{}\[\].,;:!?)]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"[^\w\n]{0,4}(?:(?i:no|nr|number|num)\b)?[^\w\n]{0,4}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])")
_AFTER_IBAN = re.compile(r"[^\w\n]{0,4}")
_ASSIGNED = re.compile(r"[\"']?[ \t]*[=:][ \t]*[\"']?([^\s\"',;]{6,})")
_ACCOUNT_CUES, _SECRET_CUES = ("account", "acct", "konto"), ("password", "passwd", "token", "secret", "api_key", "apikey")


def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    for key, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        a.add_word(key, kind)
    for cues, kind in ((("iban",), "iban"), (_ACCOUNT_CUES, "account"), (_SECRET_CUES, "secret")):
        for c in cues:
            for form in (c, c.upper(), c.capitalize()):
                a.add_word(form, kind)
    a.make_automaton()
    return a


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


class Finder:
    """Spans of one text: ``find`` returns {kind: [(start, end)]}, each list in order."""

    def __init__(self):
        self.anchors = _automaton()

    def find(self, text: str) -> dict[str, list[tuple[int, int]]]:
        out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        if not text:
            return out
        done = dict.fromkeys(("email", "ip", "card", "url", "account", "secret"), 0)
        for end, kind in self.anchors.iter(text):
            at = end + 1
            if kind == "digit":
                if end >= done["card"]:
                    done["card"] = self._card(text, end, out["card"])
                if end >= done["ip"]:
                    done["ip"] = self._ip(text, end, out["ip"])
            elif kind == "at":
                done["email"] = self._email(text, end, done["email"], out["email"])
            elif kind == "plus":
                m = _PHONE.match(text, end)
                if m and 9 <= len(_digits(m[0])) <= 15:
                    out["phone"].append(m.span())
            elif kind == "scheme":
                done["url"] = self._url(text, end - 2, done["url"], out["url"])
            elif at > done["secret" if kind == "secret" else "account"]:
                if kind == "secret":
                    m = _ASSIGNED.match(text, at)
                    span = m and m.span(1)
                else:
                    skip = _AFTER_IBAN.match(text, at).end()
                    m = _IBAN.match(text, skip) if kind == "iban" else None
                    span = m and _iban(m[0]) and m.span()
                    if kind == "account" and (m := _NUMBER.match(text, at)):
                        span = m.span(1)
                if span:
                    name = "secret" if kind == "secret" else "account"
                    out[name].append(span)
                    done[name] = span[1]
        return out

    @staticmethod
    def _card(text: str, at: int, spans: list) -> int:
        m = _DIGITS.match(text, at)
        if not m:
            return at + 1
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(m.span())
        return m.end()

    @staticmethod
    def _ip(text: str, at: int, spans: list) -> int:
        m = _DOTTED.match(text, at)
        parts = [x.span() for x in _RUN.finditer(text, at, m.end())]
        for i in range(0, len(parts) - 3, 4):
            if all(_small(text[a:b]) for a, b in parts[i:i + 4]):
                spans.append((parts[i][0], parts[i + 3][1]))
        return m.end()

    @staticmethod
    def _email(text: str, at: int, low: int, spans: list) -> int:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if not m:
            return low
        spans.append((start, m.end()))
        return m.end()

    @staticmethod
    def _url(text: str, at: int, low: int, spans: list) -> int:
        start = at
        while start > low and text[start - 1] in _SCHEME:
            start -= 1
        while start < at and not text[start].isalpha():
            start += 1
        m = _URL.match(text, at + 3) if start < at else None
        if not m:
            return low
        spans.append((start, m.end()))
        return m.end()


def _small(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end; by kind, then start) of every document."""
    def make():
        finder = Finder()

        def one(text: str) -> tuple:
            found = finder.find(text)
            return ([{"kind": k, "start": a, "end": b} for k in KINDS for a, b in found[k]],)
        return one

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    return per_text(docs, id_col, text_col, [
        ("spans", pa.list_(span), T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType())])))], make)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; where spans overlap, the
    whole overlap is replaced once, named after its first span."""
    def make():
        finder = Finder()

        def one(text: str | None) -> str | None:
            if not text:
                return text
            found = finder.find(text)
            spans = sorted((a, -b, k) for k, xs in found.items() for a, b in xs)
            if not spans:
                return text
            out, done = [], 0
            for a, b, k in spans:
                if a >= done:
                    out += [text[done:a], f"<{k.upper()}>"]
                done = max(done, -b)
            return "".join(out) + text[done:]
        return one

    return rewrite_text(docs, text_col, make)
