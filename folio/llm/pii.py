"""Personal data with offset-preserving deobfuscation.

Two passes over each whole text:

1. the base detectors run on the text as it is (e-mail, IP, card, phone);
2. transducers write a normalised text together with the source span of every piece:
   homoglyphs and full-width or other decimal digits become ASCII (one character each), zero-width
   characters vanish, spelled digits become digits, and disguises of ``@`` and ``.``
   (``[at]``, ``(dot)``, `` dot ``, `` at `` before a host) become those characters.  The same
   detectors run on the normalised text and decide what counts (address shape, IP parts, Luhn, phone
   length); their spans are mapped back to source characters.  Spelled digits are rewritten in two ways,
   long runs only and also short ones next to digits, dots or each other, so that a number word in
   front of a number hides nothing; of spans that meet the longer one counts.

A bare `` at `` needs a disguised dot in the host (``john at example [dot] com``) or, where its dots are real, a
local part that is no plain word (``john.doe at example.com``): ``look at example.com`` is no address.

A span of the second pass is added when it covers at least one transduced piece and meets no
base span of its kind.  Base spans always stay.  A text without any transduced
piece skips the second pass, since its normalised text is the text itself.

Spans count code points, the end is exclusive.  All detectors take time in proportion to the
text: their patterns start only at the first character of a run and give nothing back.

Defined results: a null or empty text has no spans; repeated rows are scanned each; other
columns are passed through, and columns that carry a result name are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Every ``@`` whose left run of local characters and right side make an address; searching from
    the ``@`` gives the leftmost matches without trying each start of a long run."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        else:
            free = max(free, start if start == at else at)
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[Span]:
    small = lambda p: len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(small, m.group().split(".")))]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]


def detect(text: str) -> dict[str, list[Span]]:
    """Base spans by kind."""
    digits = _DIGIT.search(text) is not None
    return {"email": emails(text) if "@" in text else [], "ip": ips(text) if digits else [],
            "card": cards(text) if digits else [], "phone": phones(text) if digits and "+" in text else []}


#: Letters of other scripts that look like a Latin letter, by that letter.
HOMOGLYPHS = {
    "a": "аαɑ", "c": "сϲ", "d": "ԁ", "e": "еє", "h": "һ", "i": "іιı",
    "j": "ј", "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "νѵ", "w": "ԝѡ", "x": "хχ",
    "y": "уγ", "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ",
    "I": "ІΙ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "Υ", "Z": "Ζ",
    "@": "＠﹫", ".": "．。․", "-": "‐‑‒–−－", "+": "＋",
    " ": "   ",
}
#: Spelled digits in the four languages of the tables.
SPELLED = {
    "0": ("zero", "oh", "null", "cero", "zéro"), "1": ("one", "eins", "un", "uno"), "2": ("two", "zwei", "zwo", "deux", "dos"),
    "3": ("three", "drei", "trois", "tres"), "4": ("four", "vier", "quatre", "cuatro"), "5": ("five", "fünf", "cinq", "cinco"),
    "6": ("six", "sechs", "seis"), "7": ("seven", "sieben", "sept", "siete"), "8": ("eight", "acht", "huit", "ocho"),
    "9": ("nine", "neun", "neuf", "nueve"),
}
INVISIBLE = "​‌‍⁠﻿­"
#: Runs of so many spelled digits are rewritten wherever they are, shorter ones next to digits or dots.
LEAST_SPELLED = 4

_FOLD = {ord(x): to for to, xs in HOMOGLYPHS.items() for x in xs} | {0xFF10 + d: str(d) for d in range(10)} \
    | {0xFF21 + i: chr(65 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)} \
    | {start + d: str(d) for start in (0x660, 0x6F0, 0x966) for d in range(10)}
_DIGIT_OF = {w: d for d, ws in SPELLED.items() for w in ws}
_WORD = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_SPELLED = re.compile(rf"\b(?:{_WORD})\b(?:[\x20,-]{{1,2}}(?:(?:{_WORD})|[0-9])\b)*+", re.I)
_SPELLED_PART = re.compile(rf"{_WORD}|[0-9]", re.I)
_DOT_WORD = "(?:dot|punto|punkt|point)"
_OPEN, _CLOSE = r"[\x20]{0,2}[\[({<][\x20]?", r"[\x20]?[\])}>][\x20]{0,2}"
_BRACKETED = re.compile(rf"{_OPEN}(?:(at|arroba)|({_DOT_WORD})){_CLOSE}", re.I)
_DISGUISED = rf"(?:\x20{{1,2}}{_DOT_WORD}\x20{{1,2}}|{_OPEN}{_DOT_WORD}{_CLOSE})"
_LABEL = r"[A-Za-z0-9-]++"
_BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9_%+-])\x20{{1,2}}{_DOT_WORD}\x20{{1,2}}(?=[A-Za-z0-9_%+-])", re.I)
_BARE_AT = re.compile(rf"(?<=[A-Za-z0-9])\x20{{1,2}}(?:at|arroba)\x20{{1,2}}(?=({_LABEL}(?:(?:\.|{_DISGUISED}){_LABEL})+))", re.I)
_DOT_BEFORE = re.compile(rf"{_DISGUISED}[A-Za-z0-9_%+-]+\Z", re.I)
_HAS_DISGUISED = re.compile(_DISGUISED, re.I)
#: What joins digits of one identifier, on both sides of a short run of spelled ones.
_JOINT = rf"(?:{_DISGUISED}|[\x20().,-]{{1,3}})"
_NUMBER_AFTER = re.compile(rf"{_JOINT}(?:[0-9]|(?:{_WORD})\b)", re.I)
_NUMBER_BEFORE = re.compile(rf"(?:[0-9+]|\b(?:{_WORD})){_JOINT}\Z|[+(]\Z", re.I)
#: A joint and a spelled digit have no more characters.
_REACH = 20
_ODD = re.compile("[" + re.escape("".join(map(chr, _FOLD)) + INVISIBLE) + "]")
_HINT = re.compile(rf"[\[({{<]\x20?(?:at|arroba|{_DOT_WORD})\x20?[\])}}>]|\x20{_DOT_WORD}\x20|\x20(?:at|arroba)\x20{{1,2}}{_LABEL}\.[A-Za-z0-9]", re.I)


class Tape:
    """A text under transduction: pieces (start in the text, start and end in the source, transduced)."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.source, self.touched = [0], [(0, len(text))], [False]

    def source_span(self, start: int, end: int) -> Span:
        return self._place(start, False), self._place(end - 1, True)

    def _place(self, at: int, last: bool) -> int:
        k = bisect_right(self.starts, at) - 1
        if self.touched[k]:
            return self.source[k][last]
        return self.source[k][0] + at - self.starts[k] + last

    def covers_touched(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start) - 1
        while k < len(self.starts) and self.starts[k] < end:
            if self.touched[k]:
                return True
            k += 1
        return False

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the given non-overlapping spans of the current text; source spans follow."""
        if not edits:
            return
        text, starts, source, touched, out, n, at = self.text, [], [], [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal n
            k = bisect_right(self.starts, a) - 1
            while a < b:
                end = min(b, self.starts[k + 1] if k + 1 < len(self.starts) else len(text))
                if end > a:
                    s = self.source[k] if self.touched[k] else (
                        self.source[k][0] + a - self.starts[k], self.source[k][0] + end - self.starts[k])
                    starts.append(n)
                    source.append(s)
                    touched.append(self.touched[k])
                    out.append(text[a:end])
                    n += end - a
                a, k = end, k + 1

        for a, b, to in edits:
            copy(at, a)
            if to:
                s = (self.source_span(a, b))
                starts.append(n)
                source.append(s)
                touched.append(True)
                out.append(to)
                n += len(to)
            at = b
        copy(at, len(text))
        self.text = "".join(out)
        self.starts, self.source, self.touched = starts or [0], source or [(0, 0)], touched or [False]


def fold_characters(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), _FOLD.get(ord(m.group()), "")) for m in _ODD.finditer(tape.text)])


def spelled_digits(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Edits of long runs, and of these and of short runs that other digits or dots stand next to."""
    long, every = [], []
    for m in _SPELLED.finditer(text):
        a, b = m.span()
        parts = _SPELLED_PART.findall(m.group())
        edit = (a, b, "".join(_DIGIT_OF.get(p.lower(), p) for p in parts))
        if len(parts) >= LEAST_SPELLED:
            long.append(edit)
            every.append(edit)
        elif _NUMBER_AFTER.match(text, b, b + _REACH) or _NUMBER_BEFORE.search(text[max(0, a - _REACH):a]):
            every.append(edit)
    return long, every


def address_disguises(tape: Tape) -> None:
    text, edits = tape.text, []
    for m in _BARE_AT.finditer(text):
        if _HAS_DISGUISED.search(m.group(1)) or (m.group(1)[-1].isalpha() and named(text, m.start())):
            edits.append((m.start(), m.end(), "@"))
    edits += [(m.start(), m.end(), ".") for m in _BARE_DOT.finditer(text)]
    edits += [(m.start(), m.end(), "@" if m.group(1) else ".") for m in _BRACKETED.finditer(text)]
    free, apart = 0, []
    for e in sorted(edits):
        if e[0] >= free:
            apart.append(e)
            free = e[1]
    tape.rewrite(apart)


def named(text: str, end: int) -> bool:
    """The local part that ends here is no plain word: digits, a dot or the like are in it, or a disguised dot."""
    start = end
    while start and text[start - 1] in _LOCAL_CHARS:  # runs before different ends do not overlap: linear in the text
        start -= 1
    local = text[start:end]
    return any(map(str.isalpha, local)) and (any(c in "0123456789._%+" for c in local)
                                             or _DOT_BEFORE.search(text[max(0, start - _REACH):end]) is not None)


def normalised(text: str, odd: bool) -> list[Tape]:
    """The text with its disguises undone; twice if short runs of spelled digits make a difference."""
    folded = Tape(text)
    if odd:
        fold_characters(folded)
    long, every = spelled_digits(folded.text)
    out = []
    for edits in (long, every) if len(every) > len(long) else (long,):
        tape = Tape(folded.text)
        tape.starts, tape.source, tape.touched = folded.starts, folded.source, folded.touched
        tape.rewrite(edits)
        address_disguises(tape)
        out.append(tape)
    return out


def scan(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans by kind."""
    if not text:
        return {k: [] for k in KINDS}, {k: [] for k in KINDS}
    base = detect(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    odd = not text.isascii() and _ODD.search(text) is not None
    if not odd and not _HINT.search(text) and not _SPELLED.search(text):
        return base, added
    for tape in normalised(text, odd):
        if tape.text == text:
            continue
        for kind, spans in detect(tape.text).items():
            known = base[kind]
            starts = [s for s, _ in known]
            for a, b in spans:
                if tape.covers_touched(a, b):
                    s, e = tape.source_span(a, b)
                    k = bisect_right(starts, s)
                    if (k == 0 or known[k - 1][1] <= s) and (k == len(known) or known[k][0] >= e):
                        added[kind].append((s, e))
    return base, {kind: longest(spans) for kind, spans in added.items()}


def longest(spans: list[Span]) -> list[Span]:
    """Of spans that meet the longer one."""
    out: list[Span] = []
    for s, e in sorted(set(spans)):
        if not out or out[-1][1] <= s:
            out.append((s, e))
        elif e - s > out[-1][1] - out[-1][0]:
            out[-1] = (s, e)
    return out


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``base_spans`` and ``spans`` (base and added), both as
    ``kind:start:end`` joined by commas, by kind and start."""
    ship(docs.sparkSession)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base_spans string, spans string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            rows = []
            for t in texts.tolist():
                base, added = scan(t)
                own = joined(base)
                every = joined({k: base[k] + added[k] for k in KINDS}) if any(added.values()) else own
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(own.encode()).hexdigest(), own, every))
            yield pd.DataFrame(rows, columns=RESULT)

    others = [c for c in docs.columns if c not in RESULT]
    return (docs.withColumn("__pii", run(F.col(text)))
            .select(*[F.col(f"`{c}`") for c in others], *[F.col(f"__pii.{c}").alias(c) for c in RESULT]))


RESULT = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base_spans", "spans"]
