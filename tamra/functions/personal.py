"""Patterns and validity rules for personal data."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kind, pattern. The order is the order of redaction. ``\b`` means a border of ASCII
# letters, digits and ``_``, also inside Thai text, which is written without blanks.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "URL": r"https?://[^\s<>\"']+",
    "SECRET": r"\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}\b|\bsk-[A-Za-z0-9\-]{20,}|\bxox[abp]-[A-Za-z0-9\-]{10,}"
              r"|(?i:token|secret|password|api[_\-]?key) ?[:=] ?\"?[A-Za-z0-9_\-]{8,}",
    "IP": r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
    "THAI_ID": r"\b\d-\d{4}-\d{5}-\d{2}-\d\b|\b\d{13}\b",
    "CARD": r"\b\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}\b|\b\d{4}[ \-]\d{6}[ \-]\d{5}\b|\b\d{13,19}\b",
    "PHONE": r"\+66[ \-]?\d{1,2}[ \-]?\d{3,4}[ \-]?\d{4}\b|\b0\d{1,2}[ \-]?\d{3,4}[ \-]?\d{4}\b|\+1 \(\d{3}\) \d{3}-\d{4}\b",
    "NAME": r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\. ?|(?:นางสาว|นาย|นาง|คุณ) ?)\p{L}[\p{L}\p{M}]+(?: (?:\p{Lu}|[ก-๏])[\p{L}\p{M}]+)?",
}
KINDS = tuple(PATTERNS)
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"
# What every match of a kind begins with, in Java's notation. It is looked at first, so
# that a place where no value can begin is left after one cheap test.
BEGINS = {
    "SECRET": r"(?=[AaTtSsPpgx][KkHhOoEeAaPp])(?=AKIA|gh[pousr]_|sk-|xox|(?i:token|secret|password|api))",
    "IP": "(?=[0-9๐-๙])", "THAI_ID": "(?=[0-9๐-๙])", "CARD": "(?=[0-9๐-๙])", "PHONE": "(?=[+0๐])", "NAME": "(?=[MDPนค])",
}


def _for_spark(kind: str) -> str:
    """The pattern in Java's notation: borders that Thai letters don't hide, and Thai digits.

    A border ahead of a value looks behind only and one after it ahead only, since the value's own
    end is a word character by its pattern. An address starts where no character of its local part stands before (or where the last
    match ended), so a long run of letters is scanned once.
    """
    pattern = PATTERNS[kind]
    if kind == "EMAIL":
        return r"(?:\G|(?<![A-Za-z0-9._%+\-]))" + pattern
    pattern = pattern.replace(r"\b0", r"\b[0๐]").replace("66", "[6๖]{2}")
    pattern = re.sub(r"\\b(?=\||$)", lambda _: r"(?![A-Za-z0-9_๐-๙])", pattern)
    pattern = pattern.replace(r"\b", r"(?<![A-Za-z0-9_๐-๙])").replace(r"\d", "[0-9๐-๙]")
    return f"{BEGINS[kind]}(?:{pattern})" if kind in BEGINS else pattern


SPARK_PATTERNS = {kind: _for_spark(kind) for kind in KINDS}

# One of the words that a text must hold for a kind to occur in it. The other kinds have no such
# word, and their patterns are as cheap as a search for a digit.
NEEDED_WORDS = {
    "EMAIL": ("@",), "URL": ("://",), "NAME": ("Mr", "Ms", "Dr", "Prof", "นาย", "นาง", "คุณ"),
}


def holds_word(kind: str, text: Column) -> Column:
    """Whether the text holds a word that every value of the kind needs; true for a kind without such words."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in NEEDED_WORDS[kind]]) if kind in NEEDED_WORDS else F.lit(True)


def plain_digits(value: Column) -> Column:
    """Thai digits as 0-9, so one number has one form."""
    return F.translate(value, THAI_DIGITS, "0123456789")


def digits(value: Column) -> Column:
    return F.regexp_replace(plain_digits(value), r"\D+", "")


def thai_id_ok(value: Column) -> Column:
    """Thirteen digits, the last being ``(11 - sum(d_i * (14 - i)) mod 11) mod 10``."""
    d = digits(value)
    total = F.lit(0)
    for i in range(1, 13):
        total = total + F.substring(d, i, 1).cast("int") * (14 - i)
    return (F.length(d) == 13) & ((F.lit(11) - total % 11) % 10 == F.substring(d, 13, 1).cast("int"))


def card_ok(value: Column) -> Column:
    d = digits(value)
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def ip_ok(value: Column) -> Column:
    return F.forall(F.split(plain_digits(value), r"\."), lambda part: part.cast("int") <= 255)


def secret_ok(value: Column) -> Column:
    """At least eight different characters: a low-entropy filler is no key."""
    return F.size(F.array_distinct(F.split(value, ""))) >= 8


RULES = {"THAI_ID": thai_id_ok, "CARD": card_ok, "IP": ip_ok, "SECRET": secret_ok}


def valid(kind: str, value: Column) -> Column:
    rule = RULES.get(kind)
    return F.lit(True) if rule is None else F.coalesce(rule(value), F.lit(False))


@dataclass(frozen=True)
class Redaction:
    """What a found value becomes: ``<KIND>``, or a salted hash that stays joinable."""

    mode: str = "redact"
    salt: str = ""

    def mark(self, kind: str, value: Column) -> Column:
        if self.mode == "redact":
            return F.lit(f"<{kind}>")
        if self.mode == "hash":
            return F.concat(F.lit(f"<{kind}:"), F.substring(F.sha2(F.concat(F.lit(self.salt), plain_digits(value)), 256), 1, 16), F.lit(">"))
        raise ValueError(f"unknown mode {self.mode!r}")
