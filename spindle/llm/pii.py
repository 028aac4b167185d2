"""Personal data in texts: expressions propose spans, validators confirm them, context scores them.

Four kinds have a fixed base definition: ``email``, ``ip`` (parts at most 255), ``card`` (a
chain of digits with single spaces or hyphens, 16 to 19 digits, Luhn) and ``phone`` (``+``
and 8 to 15 digits), leftmost and non-overlapping per kind, without retries. Every base
span is kept. The method adds:

* ``card``, ``phone``: a part of a chain that failed as a whole, cut at its separators, as
  when a phone number and a card number stand side by side. Card parts need Luhn; those of
  13 to 15 digits also a context word. Numbers without ``+`` need a context word.
* ``ip``: version 6 addresses that the standard library parses.
* ``iban``: registered country, its length, mod-97.
* ``ssn``: assigned ranges and a context word.
* ``secret``: access keys of a fixed form; values assigned to a password or token name.

Each proposal has a prior by kind. A validator rejects it or raises its score, words
within ``CONTEXT_CHARS`` characters raise it (``card``, ``phone``) or lower it (``example``,
``version``); added spans need ``MIN_SCORE`` and must not overlap spans already taken, base
ones first, then the kinds in their order.

Every pattern is linear in the text: mail addresses are grown from their ``@``, digit runs
are taken possessively. A map over whole texts, without a shuffle: a hot source or a long
text moves nothing, and a lost task is just run again.

Defined cases: a null or empty text has no spans; equal rows have equal spans, each of its
own; offsets count code points, the end is exclusive; an empty table gives an empty result;
a column of the input named like an output is replaced.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import with_python_columns

#: Kinds in the order of their spans; the first four have base definitions.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE_KINDS = KINDS[:4]
CONTEXT_CHARS = 40
MIN_SCORE = 0.5

#: Prior of a proposal, and what a passed validator or a context word adds to it.
PRIOR = {"email": 0.6, "ip": 0.5, "card": 0.3, "phone": 0.4, "iban": 0.3, "ssn": 0.3, "secret": 0.4}
VALID, NEAR, AGAINST = 0.3, 0.25, -0.25
#: Base kinds whose definition holds a validator.
VALIDATED = ("ip", "card")

#: Words that speak for a kind, and words that speak against any.
CONTEXT = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|credit|debit|visa|mastercard|amex|tarjeta|carte|karte|payment",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|sms|whatsapp|telefon|teléfono|téléphone|handy",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|taxpayer|tax id",
    "secret": "password|passwd|pwd|token|secret|key|credential|login",
}
CONTEXT = {k: re.compile(rf"(?<!\w)(?:{v})(?!\w)", re.I) for k, v in CONTEXT.items()}
AGAINST_WORDS = re.compile(r"(?<![\w.@])(?:example|sample|dummy|version|isbn|order|invoice|page)(?!\.?\w)", re.I)

#: Lengths of account numbers by country.
IBAN_LENGTH = {"AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
               "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
               "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
               "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
               "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
               "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
               "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
               "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20}

AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
NATIONAL = re.compile(r"(?<![\w+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
V6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
SSN = re.compile(r"(?<![\w-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![\w-])")
ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
#: Names whose assigned value is a secret.
SECRET_NAMES = ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key", "apikey")
ASSIGN = re.compile("[:=]")
VALUE = re.compile(r"[ \t]*+[\"']?([A-Za-z0-9+/_.~-]{8,}+)")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    twice = [int(c) for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[::-2]) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number's check digits hold (letters count from 10)."""
    number = "".join(str(int(c, 36)) for c in iban[4:] + iban[:4])
    return int(number) % 97 == 1


def only_digits(s: str) -> str:
    return "".join(DIGITS.findall(s))


# --- base spans -----------------------------------------------------------------
def emails(text: str) -> Iterator[tuple[int, int]]:
    taken = 0
    at = text.find("@")
    while at >= 0:
        if m := AT_DOMAIN.match(text, at):
            start = at
            while start > taken and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                taken = m.end()
                yield start, taken
        at = text.find("@", at + 1)


def quads(text: str) -> Iterator[tuple[int, int]]:
    for m in QUAD.finditer(text):
        # a part over 255 has more than three digits but for leading zeros
        if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split("."))):
            yield m.span()


# --- spans the method adds ------------------------------------------------------
def card_parts(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Spans of a failed chain's consecutive digit groups that are cards, with their digits:
    a group alone, or groups of four with a shorter last one, or 4-6-5."""
    groups = [m.span() for m in DIGITS.finditer(text, start, end)]
    k = 0
    while k < len(groups):
        for n in (1, 4, 5, 3):
            part = groups[k:k + n]
            if len(part) < n:
                continue
            sizes = [b - a for a, b in part]
            shaped = n == 1 or sizes[:-1] == [4] * (n - 1) and sizes[-1] <= 4 or sizes == [4, 6, 5]
            if shaped and 13 <= sum(sizes) <= 19 and luhn(only_digits(text[part[0][0]:part[-1][1]])):
                yield part[0][0], part[-1][1], sum(sizes)
                k += n - 1
                break
        k += 1


def phone_part(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest head of a failed ``+`` match that ends with a digit group and has 8 to 15 digits."""
    n, best = 0, None
    for m in DIGITS.finditer(text, start, end):
        n += m.end() - m.start()
        if n > 15:
            break
        if n >= 8:
            best = start, m.end()
    return best


def v6(s: str) -> bool:
    if sum(map(bool, s.split(":"))) < 3 or not DIGITS.search(s):
        return False
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return True


def iban_end(text: str, start: int) -> int | None:
    """Where the account number that starts here ends, by its country's length; None if it fails."""
    left = IBAN_LENGTH.get(text[start:start + 2])
    if left is None:
        return None
    at, number = start, []
    while left:
        c = text[at:at + 1]
        if c == " " and text[at - 1] != " ":
            at += 1
            continue
        if not ("0" <= c <= "9" or "A" <= c <= "Z"):
            return None
        number.append(c)
        at, left = at + 1, left - 1
    follows = text[at:at + 1]
    return at if not follows.isalnum() and mod97("".join(number)) else None


def assigned_values(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what stands after the name of a secret and a colon or equals sign."""
    for m in ASSIGN.finditer(text):
        head = text[max(0, m.start() - 32):m.start()].rstrip(" \t\"'").lower()
        if head.endswith(SECRET_NAMES) and (v := VALUE.match(text, m.end())):
            yield v.span(1)


class Finder:
    """Spans ``(kind number, start, end, score, base)`` of one text at a time, by kind, then start."""

    def score(self, text: str, kind: str, start: int, end: int, valid: bool) -> float:
        near = text[max(0, start - CONTEXT_CHARS):start] + "\n" + text[end:end + CONTEXT_CHARS]
        s = PRIOR[kind] + (VALID if valid else 0.0)
        if CONTEXT[kind].search(near):
            s += NEAR
        if AGAINST_WORDS.search(near):
            s += AGAINST
        return round(min(max(s, 0.0), 1.0), 3)

    def find(self, text: str) -> list[tuple[int, int, int, float]]:
        base: list[tuple[str, int, int]] = []
        proposed: list[tuple[str, int, int, bool]] = []
        if "@" in text:
            base += [("email", a, b) for a, b in emails(text)]
        digits = DIGITS.search(text) is not None
        if digits:
            base += [("ip", a, b) for a, b in quads(text)]
            for m in CHAIN.finditer(text):
                if m.end() - m.start() < 13:
                    continue
                number = only_digits(m[0])
                if 16 <= len(number) <= 19 and luhn(number):
                    base.append(("card", *m.span()))
                elif len(number) >= 13:
                    proposed += [("card", a, b, n >= 16) for a, b, n in card_parts(text, *m.span())]
            if "+" in text:
                for m in PLUS.finditer(text):
                    n = len(only_digits(m[0]))
                    if 8 <= n <= 15:
                        base.append(("phone", *m.span()))
                    elif n > 15 and (part := phone_part(text, *m.span())):
                        proposed.append(("phone", *part, True))
            proposed += [("phone", *m.span(), False) for m in NATIONAL.finditer(text)]
            if "::" in text or text.count(":") >= 7:
                proposed += [("ip", *m.span(), True) for m in V6.finditer(text) if v6(m[0])]
            for m in IBAN_HEAD.finditer(text):
                if end := iban_end(text, m.start()):
                    proposed.append(("iban", m.start(), end, True))
            for m in SSN.finditer(text):
                area, group, serial = map(int, m.groups())
                if area not in (0, 666) and area < 900 and group and serial:
                    proposed.append(("ssn", *m.span(), False))
            proposed += [("secret", *m.span(), True) for m in ACCESS_KEY.finditer(text)]
            for a, b in assigned_values(text):
                value = text[a:b]
                if DIGITS.search(value):
                    proposed.append(("secret", a, b, len(value) >= 12 and any(map(str.isalpha, value))))
        if not base and not proposed:
            return []
        taken: list[tuple[int, int]] = []      # base spans of two kinds may overlap: joined
        for a, b in sorted((a, b) for _, a, b in base):
            if taken and a < taken[-1][1]:
                taken[-1] = taken[-1][0], max(taken[-1][1], b)
            else:
                taken.append((a, b))
        order = KINDS.index
        out = [(order(k), a, b, max(MIN_SCORE, self.score(text, k, a, b, k in VALIDATED)), True) for k, a, b in base]
        for kind, a, b, valid in sorted(proposed, key=lambda p: (order(p[0]), *p[1:])):
            k = bisect_left(taken, (a, b))
            if (k and taken[k - 1][1] > a) or (k < len(taken) and taken[k][0] < b):
                continue
            if (s := self.score(text, kind, a, b, valid)) >= MIN_SCORE:
                insort(taken, (a, b))
                out.append((order(kind), a, b, s, False))
        return sorted(out)


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``pii``: spans by kind, then start; ``base`` marks
    those of the base definition."""
    def make():
        find = Finder().find
        names = ("kind", "start", "end", "score", "base")
        return lambda texts: [[[dict(zip(names, (KINDS[k], *rest))) for k, *rest in find(t)] for t in texts]]

    return with_python_columns(docs, text_col, {"pii": SPANS}, make)


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``redacted``: the text with ``[KIND]`` in place of
    each span (overlapping spans: the first one's kind)."""
    def redact(find, text):
        parts, at = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b, _, _ in find(text)):
            if a >= at:
                parts += [text[at:a], f"[{KINDS[k].upper()}]"]
            at = max(at, b)
        return "".join([*parts, text[at:]])

    def make():
        find = Finder().find
        return lambda texts: [[redact(find, t) for t in texts]]

    return with_python_columns(docs, text_col, {"redacted": "string"}, make)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def n_base(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
