"""Personal data in texts, plain and in disguise, with places in the source.

Plain finds are the leftmost matches, without overlap within a kind, of a pattern for each kind, less those that fail its
check. Then transducers rewrite a text: look-alike letters and other scripts' digits to ASCII, hidden signs to nothing,
entities of HTML to their signs, spelled digits to digits, ``at`` and ``dot`` in disguise to their signs, in English, German, Spanish and
French. Each keeps for every character the source
characters it stands for. The same patterns search the rewritten text, and a match that holds something rewritten and
does not lie within a plain find of its kind is mapped back and added; a longer one stands beside the plain find. They search
once more with spelled digits joined over commas and blanks, and once more over line ends; what is found before stays. Texts
without a sign of disguise skip this.

Rewriting is careful: between words the German, Spanish and French words for ``at`` need a whole domain after them, and ``at`` and ``chez``,
which mean other things, a spelled dot in it; a spelled digit by itself, without another one or a plain digit beside it, stays; a word counts as look-alikes only if all its letters become ASCII; ``at`` without brackets needs a
spelled ``dot`` in the domain after it, or before a literal domain a local part that looks like one (john.smith, j_doe, jo42)
or a word such as ``mail`` or ``contact`` before it. Patterns start only where a match could, so long runs of digits or letters cost no more
than others. Null text: empty. Offsets are code points, ends exclusive. Every row is searched by itself; doc_id, other
columns and repeated rows play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.text import column, slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield "email", begin, done
        at = text.find("@", max(at + 1, done))


def plain_spans(text: str) -> list[Span]:
    """By kind in the order of KINDS, then by start."""
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# fixed values: letters that look like ASCII ones, and what they look like
_ALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝвкмнтАВЕЅІЈКМНОРСТУХЗҮԌ" + "αονιρτυκχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "ɑɡıℓⅼⅰⅴⅹⅽⅾⅿ",
        "aeopcyxijshdqwbkmhtABESIJKMHOPCTYX3YG" + "aoviptukxABEZHIKMNOPTYX" + "agillivxcdm",
    )
)
# fixed values: signs that are not shown, and signs that stand for a dot, an at, a plus or a hyphen
_HIDDEN = "­​‌‍⁠﻿"
_SIGNS = {"․": ".", "。": ".", "．": ".", "﹒": ".", "＠": "@", "﹫": "@", "﹢": "+", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-"}
# fixed values: the digits from 0 to 9 by language, words for a plus, and words for an at and a dot in addresses
_DIGIT_WORDS = {
    "en": ("zero oh", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    "de": ("null", "eins", "zwei zwo", "drei", "vier", "fünf fuenf", "sechs", "sieben", "acht", "neun"),
    "es": ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
    "fr": ("zéro zero", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
}
_PLUS_WORDS = ("plus", "más", "mas")
# by language: words that say at, those of them that also mean something else, and the word for a dot. English has rules of its own.
_AT_WORDS = {"de": ("ät", "at", "klammeraffe"), "es": ("arroba",), "fr": ("arobase", "arrobase", "chez")}
_UNSURE = ("at", "chez")
_DOT_WORDS = {"de": "punkt", "es": "punto", "fr": "point"}
# fixed values: names of signs in HTML
_ENTITIES = {"commat": "@", "period": ".", "plus": "+", "hyphen": "-"}

_SPELLED = {word: str(digit) for words in _DIGIT_WORDS.values() for digit, some in enumerate(words) for word in some.split()}


def _alike(char: str) -> str | None:
    """The ASCII sign a character stands for; None: no such."""
    if char in _ALIKE:
        return _ALIKE[char]
    if char in _SIGNS:
        return _SIGNS[char]
    if "！" <= char <= "～":  # full-width forms follow ASCII's order
        return chr(ord(char) - 0xFEE0)
    if "\U0001d400" <= char <= "\U0001d7ff":  # mathematical letters and digits
        plain = unicodedata.normalize("NFKC", char)
        return plain if plain.isascii() and len(plain) == 1 else None
    digit = unicodedata.decimal(char, None)
    return None if digit is None else str(digit)


class Mapped:
    """A text with, for each character, where its source begins and ends and whether it was rewritten."""

    def __init__(self, text: str, starts=None, ends=None, changed=None):
        n = len(text)
        self.text = text
        self.starts = list(range(n)) if starts is None else starts
        self.ends = list(range(1, n + 1)) if ends is None else ends
        self.changed = bytearray(n) if changed is None else changed

    def rewritten(self, pattern: re.Pattern, to: Callable[[re.Match], list[tuple[int, int, str]] | None]) -> Mapped:
        """Replace in each match the parts (from, to, sign) that ``to`` gives."""
        text, starts, ends, changed, at = [], [], [], bytearray(), 0
        for m in pattern.finditer(self.text):
            for a, b, sign in to(m) or ():
                text += self.text[at:a], sign
                starts += self.starts[at:a]
                ends += self.ends[at:a]
                changed += self.changed[at:a]
                if not sign and changed:
                    changed[-1] = 1
                for _ in sign:
                    starts.append(self.starts[a])
                    ends.append(self.ends[b - 1])
                    changed.append(1)
                at = b
        if not at:
            return self
        return Mapped("".join([*text, self.text[at:]]), starts + self.starts[at:], ends + self.ends[at:], changed + self.changed[at:])


_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"[^\x00-\x7f]")
_HIDE = re.compile(f"[{_HIDDEN}]")
_LETTER = "A-Za-zÀ-ÿ"
_CAPITALS = str.maketrans("äáéü", "ÄÁÉÜ")


def _tried(words) -> str:
    """An alternation of words, apart by first letter so that most fail at once; letters beyond ASCII in either case."""
    forms = {form for w in words for form in ({w} if w.isascii() else {w, w.translate(_CAPITALS)})}
    heads = sorted({w[0] for w in forms})
    return "(?:" + "|".join(h + "(?:" + "|".join(sorted((re.escape(w[1:]) for w in forms if w[0] == h), key=len, reverse=True)) + ")" for h in heads) + ")"


_DOT_ANY = _tried(["dot", *_DOT_WORDS.values()])
# what may stand between the digits of a find, spelled or not
_GAP = rf"(?:[ \t\r\n,.()\[\]{{}}<>+-]|{_DOT_ANY})++"

_NUMBER = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_PLUS = re.compile(rf"(?<![{_LETTER}])(?:{'|'.join(_PLUS_WORDS)})[ -]+(?=[0-9]|{_NUMBER}(?![{_LETTER}]))", re.I)
_NUMBERS = re.compile(rf"(?<![{_LETTER}]){_NUMBER}(?:[ -]{_NUMBER})*+(?![{_LETTER}])", re.I)
_BEFORE = re.compile(rf"(?:[0-9]|(?<![{_LETTER}]){_NUMBER}){_GAP}\Z", re.I)
_AFTER = re.compile(rf"{_GAP}(?:[0-9]|{_NUMBER}(?![{_LETTER}]))", re.I)
_ENTITY = re.compile(rf"&(?:#0*+([0-9]{{2,3}})|#x0*+([0-9a-f]{{2}})|({'|'.join(_ENTITIES)}));", re.I)
# what parts spelled digits: commas and blanks, then line ends as well
_JOINED = tuple(re.compile(rf"(?<=[0-9])[{signs}]++(?=[0-9])") for signs in (r" \t,-", r" \t,\r\n-"))
_ONE = re.compile(_NUMBER, re.I)
_NUMBERS_IN = re.compile(rf"{_NUMBER}[ -]{_NUMBER}", re.I)
_AT_MARKED = re.compile(rf"[ \t]*+[\[({{<][ \t]*+(?:at|@|{'|'.join(w for words in _AT_WORDS.values() for w in words)})[ \t]*+[\])}}>][ \t]*+", re.I)
_DOT_MARKED = re.compile(rf"[ \t]*+[\[({{<][ \t]*+(?:dot|{'|'.join(_DOT_WORDS.values())}|\.)[ \t]*+[\])}}>][ \t]*+", re.I)
_DOT_DIGITS = re.compile(rf"(?<=[0-9])[ \t]++(?:{'|'.join(_DOT_WORDS.values())})[ \t]++(?=[0-9])", re.I)
_DOT_PLAIN = re.compile(r"(?<=[A-Za-z0-9])[ \t]++dot[ \t]++(?=[A-Za-z0-9])", re.I)
_AT_PLAIN = re.compile(r"(?<=[A-Za-z0-9])[ \t]++at[ \t]++(?!(?:the|an?|this|that|which|each|every|its?|his|her|our|their)\b)(?=([A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++))", re.I)
# fixed values: what speaks for an address before `` at `` and a literal domain, and words that are no local part
_LIKE_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z][A-Za-z0-9%-]*(?:[._+][A-Za-z0-9._%+-]*|[0-9][A-Za-z0-9%-]*)\Z")
_CUED_LOCAL = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:e-?)?mails?|mailto|contact|write|reach|address|send)(?:[ \t]+(?:me|us|him|her|them|to|is|address|or))*[ \t]*[:=]?[ \t]*(?<![A-Za-z0-9])"
    r"(?!(?:me|us|him|her|them|you|it|this|that|one|is|to|in|out|up|here|there|now|back|look|address|support(?:ed)?|sent|found|available)[ \t]*\Z)[A-Za-z0-9._%+-]+\Z",
    re.I,
)


def _phrase(language: str) -> re.Pattern:
    """What follows the first word of an address that is spelled out: dots of the local part, at, and a domain."""
    at, dot = "|".join(_AT_WORDS[language]), _DOT_WORDS[language]
    gap, label = r"[ \t]++", "[A-Za-z0-9-]++"
    between = rf"(?:{gap}{dot}{gap}|\.)"
    return re.compile(rf"(?<=[A-Za-z0-9])(?:{gap}{dot}{gap}{label})*{gap}({at}){gap}({label}(?:{between}{label})*{between}[A-Za-z]{{2,}}+)(?![A-Za-z0-9-])", re.I)


_PHRASES = {language: _phrase(language) for language in _AT_WORDS}
_SPOKEN = {language: re.compile(rf"[ \t]++(?:({'|'.join(_AT_WORDS[language])})|{_DOT_WORDS[language]})[ \t]++", re.I) for language in _AT_WORDS}
_TOP = re.compile(r"\.[A-Za-z]{2,}-?\Z")
_AT_SPACED = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]++@[ \t]*+|@[ \t]++)(?=[A-Za-z0-9])")


def deobfuscated(text: str) -> Mapped:
    out = Mapped(text)

    def all_alike(m: re.Match):
        word = [c if c.isascii() else _ALIKE.get(c) or _alike(c) for c in m[0]]
        if not m[0].isascii() and None not in word:
            return [(m.start() + i, m.start() + i + 1, w) for i, (c, w) in enumerate(zip(m[0], word)) if c != w]

    def sign(m: re.Match):
        return None if m[0].isalpha() or (to := _alike(m[0])) is None else [(m.start(), m.end(), to)]

    def const(to: str):
        return lambda m: [(m.start(), m.end(), to)]

    if not text.isascii():
        out = out.rewritten(_HIDE, const("")).rewritten(_WORD, all_alike).rewritten(_SIGN, sign)

    def entity(m: re.Match):
        number = int(m[1]) if m[1] else int(m[2], 16) if m[2] else ord(_ENTITIES[m[3].lower()])
        sign = chr(number)
        return [(m.start(), m.end(), sign)] if sign.isascii() and (sign.isalnum() or sign in "@._+-") else None

    def spoken(language: str):
        def to(m: re.Match):  # a word that means something else as well needs a dot that is spelled
            if m[1].lower() in _UNSURE and not re.search(rf"[ \t]{_DOT_WORDS[language]}[ \t]", m[2], re.I):
                return None
            return [(x.start(), x.end(), "@" if x[1] else ".") for x in _SPOKEN[language].finditer(m.string, m.start(), m.end())]

        return to

    def numbers(m: re.Match):
        parts, at = [], m.start()
        if not (_NUMBERS_IN.search(m[0]) or _AFTER.match(m.string, m.end()) or _BEFORE.search(m.string[max(0, at - 40) : at])):
            return None  # one by itself
        for one in _ONE.finditer(m[0]):  # the gap before a further word goes with it
            parts.append((at, m.start() + one.end(), _SPELLED[one[0].lower()]))
            at = m.start() + one.end()
        return parts

    def plain_at(m: re.Match):  # its domain must have a dot that was spelled, or its local part must look like one
        domain = range(m.start(1), m.end(1))
        if not any(out.changed[k] and out.text[k] == "." for k in domain):
            before = out.text[max(0, m.start() - 200) : m.start()]
            if not _TOP.search(m[1]) or not (_LIKE_LOCAL.search(before) or _CUED_LOCAL.search(before)):
                return None
        return [(m.start(), m.end(), "@")]

    out = out.rewritten(_ENTITY, entity)
    out = out.rewritten(_PLUS, const("+")).rewritten(_NUMBERS, numbers)
    out = out.rewritten(_DOT_MARKED, const(".")).rewritten(_DOT_DIGITS, const("."))
    out = out.rewritten(_AT_MARKED, const("@"))
    for language, pattern in _PHRASES.items():
        out = out.rewritten(pattern, spoken(language))
    out = out.rewritten(_DOT_PLAIN, const("."))
    out = out.rewritten(_AT_PLAIN, plain_at)
    return out.rewritten(_AT_SPACED, const("@"))


def joined(text: Mapped, pattern: re.Pattern) -> Mapped:
    """What parts digits becomes one blank where a digit beside it was rewritten; so numbers stay apart from each other."""

    def blank(m: re.Match):
        beside = text.changed[m.start() - 1] or text.changed[m.end()]
        return [(m.start(), m.end(), " ")] if beside and m[0] not in (" ", "-") else None

    return text.rewritten(pattern, blank)


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """Finds in the rewritten text that hold something rewritten and do not lie within a plain find of their kind."""
    to = deobfuscated(text)
    if 1 not in to.changed:
        return []
    out: list[Span] = []
    for form in dict.fromkeys([to, *(joined(to, pattern) for pattern in _JOINED)]):
        taken = {kind: sorted((a, b) for k, a, b in plain + out if k == kind) for kind in KINDS}
        reach = {kind: list(accumulate((b for _, b in taken[kind]), max)) for kind in KINDS}  # the last end so far
        for kind, a, b in plain_spans(form.text):
            if 1 in form.changed[a:b]:
                start, end = form.starts[a], form.ends[b - 1]
                before = bisect_right(taken[kind], start, key=lambda x: x[0])
                if not before or reach[kind][before - 1] < end:
                    out.append((kind, start, end))
    return out


def all_spans(text: str, suspect: bool = True) -> tuple[list[Span], list[Span]]:
    """Plain finds, and all finds, by kind and start."""
    plain = plain_spans(text)
    added = disguised_spans(text, plain) if suspect else []
    every = sorted(plain + added, key=lambda s: (KINDS.index(s[0]), *s[1:])) if added else plain
    return plain, every


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every found part replaced by the name of its kind; overlapping parts become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += text[at:a], f"<{kind.upper()}>"
        at = max(at, b)
    return "".join([*out, text[at:]])


_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_FOREIGN = np.zeros(256, bool)
_FOREIGN[0xC4:] = True  # leads of what is beyond Latin-1


# A text up to Latin-1 can hold a find in disguise only if one of these matches its lower-case bytes: each is what a transducer
# needs, less conditions. A spelled digit alone makes no find; it takes another one, or a plain digit, beyond a gap.
_AT_ANY = _tried(["at", *(w for words in _AT_WORDS.values() for w in words)])
_SURE_AT = _tried([w for words in _AT_WORDS.values() for w in words if w not in _UNSURE])
_DIGIT_ANY = _tried(_SPELLED)
_HINTS = tuple(
    re.compile(pattern.encode())
    for pattern in (
        rf"(?<![a-z])(?:{_DIGIT_ANY}{_GAP}|{_tried(_PLUS_WORDS)}[ -]+)(?:[0-9]|{_DIGIT_ANY})",
        rf"[0-9]{_GAP}{_DIGIT_ANY}",
        rf"[\[({{<][ \t]*+(?:{_AT_ANY}|{_DOT_ANY}|[@.])[ \t]*+[\])}}>]",
        rf"[ \t](?:dot[ \t]|{_SURE_AT}[ \t]|(?:at|chez)[ \t]++[a-z0-9-]++(?:\.|[ \t]++{_DOT_ANY}[ \t])|@|{_DOT_ANY}[ \t]++[0-9])",
        rf"@[ \t]|&(?:#|{_tried(_ENTITIES)};)|{chr(0xAD)}",
    )
)


def _suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts that may hold plain finds, and texts with a sign of disguise."""
    sums = np.cumsum(np.stack([np.r_[0, _DIGIT[data] | (data == 64)], np.r_[0, _FOREIGN[data]]]), axis=1)
    plain, suspect = np.diff(sums[:, offsets]) > 0
    whole = data.tobytes().lower()
    for i in np.flatnonzero(~suspect).tolist():  # each by itself: no pattern sees a neighbour's letters
        text = whole[offsets[i] : offsets[i + 1]]
        suspect[i] = any(hint.search(text) for hint in _HINTS)
    return plain, suspect


_OUT_FIELDS = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
_OUT = pa.schema(_OUT_FIELDS)
_DDL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _found(texts: pa.Array) -> Iterator[tuple[str, list[Span], list[Span]] | None]:
    """Of each text: itself, plain and all finds; None where there can be no find."""
    data, offsets = text_bytes(texts)
    plain_here, suspect = _suspects(data, offsets)
    for i in range(len(texts)):
        if plain_here[i] or suspect[i]:
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            yield text, *all_spans(text, bool(suspect[i]))
        else:
            yield None


def _find(batches):
    nothing = {"n_email": 0, "n_ip": 0, "n_card": 0, "n_phone": 0, "base_sha256": hashlib.sha256(b"").hexdigest(), "spans": "", "n_added": 0}
    for batch in slices(batches):
        rows = []
        for id_, found in zip(column(batch, "doc_id").to_pylist(), _found(column(batch, "text"))):
            row = {"doc_id": id_, **nothing}
            if found:
                _, plain, every = found
                for kind, _, _ in plain:
                    row[f"n_{kind}"] += 1
                row |= {"base_sha256": hashlib.sha256(_listed(plain).encode()).hexdigest(), "spans": _listed(every), "n_added": len(every) - len(plain)}
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=_OUT)


def _redact(batches):
    for batch in slices(batches):
        texts = column(batch, "text")
        new = {i: redacted(found[0], found[2]) for i, found in enumerate(_found(texts)) if found and found[2]}
        if new:
            texts = pa.array([new.get(i, t) for i, t in enumerate(texts.to_pylist())], pa.string())
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", texts)
        yield batch


def find_private(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (plain finds), base_sha256 (of the plain finds' list), spans (all
    finds as kind:start:end, comma-joined), n_added (finds in disguise).
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find, _DDL)


def without_private(docs: DataFrame) -> DataFrame:
    """The rows with every find in ``text`` replaced by the name of its kind."""
    return docs.mapInArrow(_redact, docs.schema)
