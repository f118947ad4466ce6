"""Surrogates for personal data: keyed, type-consistent and collision-free.

Entities are found by pattern (emails, phone numbers, payment cards, IP addresses,
IBANs, social security numbers, secrets, and names after a form of address); a capitalised
word that is part of a name so found is a mention of that person everywhere in its text.
Each gets a surrogate of its own type and format: letters stay letters of their script
and case, digits stay digits, separators stay, a card number or IBAN stays valid if it was
(check digits stay as far off as they were), an octet stays below 256, an IPv6 address
keeps its first group, a name keeps its gender and script.  A secret of hexadecimal digits
with a letter stays one, and no other secret becomes one.

The surrogate is a keyed permutation of the entity's format class - a Feistel
network over the class's numbers with cycle walking, conjugated with a step of one,
which has no fixed point.  So one entity has one surrogate in every document
(coreference, needing no table), two entities of a class never share one
(distinctness), and none keeps its own value.  Names are rendered as syllables, one
rendering for each number.  ``collisions`` checks it on a whole corpus, and ``again``
names entities that share a surrogate with another, for ``pseudonymise`` to give them one
by another key.

Scale: documents are only scanned; nothing is looked up or joined.  The collision
check shuffles distinct entities, summed map-side, and stores them.  Clashing entities go
to all tasks, so more than ``MOST_AGAIN`` of them are an error; by construction there are none.

Defined results: digits of every script count as digits: an entity is found, named and
permuted by their values, and its surrogate has the script that each digit had.  An
octet's leading zeros are no part of it, nor are an IBAN's spaces or the spelling of an
IPv6 address, which is written in eight groups.  A name's ``'s`` is no part of it.  Very long
values are permuted in pieces.  An empty table gives an empty one.  A null text stays null, a text without
entities is unchanged;
overlapping matches go to the earliest, then longest, then the first type listed;
repeated documents get equal texts.  Other columns pass through as they are; columns
that share the name of a result column of ``annotate`` give way to it.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import lean, stored

# ---- fixed values: forms of address by gender, and alphabets --------------------------------------------------------
FEMALE = "Mrs Ms Mme Mlle Frau Sra Srta Signora Госпожа Г-жа Κυρία"
MALE = "Mr Herr Sr Signor Господин Г-н Κύριος"
NEUTRAL = "Dr Prof Mx"
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")
#: Of a script: consonants, vowels, endings of female, male and other names.
SYLLABLES = {"latin": ("bdfghjklmnprstvz", "aeiou", {"f": "a", "m": "o", "n": "e"}),
             "cyrillic": ("бвгджзклмнпрстфх", "аеиоу", {"f": "а", "m": "о", "n": "е"}),
             "greek": ("βγδζθκλμνξπρστφχ", "αειου", {"f": "α", "m": "ο", "n": "ε"})}
# ---------------------------------------------------------------------------------------------------------------------

#: Entities that may get a surrogate by another key; they go to all tasks.
MOST_AGAIN = 10_000
#: Characters that are permuted as one number.
_PIECE = 48
_CLASS = {ch: a for a in ALPHABETS for ch in a}
_TITLE = {t: g for g, names in (("f", FEMALE), ("m", MALE), ("n", NEUTRAL)) for t in names.split()}
_NAME = r"[^\W\d_][^\W\d_'’-]*(?:[-'’][^\W\d_]+)*"

#: Types in order of preference; the group ``v`` is what gets replaced.
PATTERNS = {
    "email": r"(?<![\w.+%-])(?P<v>[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)",
    "secret": (r"(?i:\b(?:pass(?:word|wd)?|token|secret|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?(?P<v>[A-Za-z0-9_+/=-]{8,}))"
               r"|\b(?:AKIA|ASIA)(?P<v2>[A-Z0-9]{16})\b|\bgh[pousr]_(?P<v3>[A-Za-z0-9]{30,})|\b(?P<v4>[0-9a-fA-F]{32,})\b"),
    "iban": r"\b(?P<v>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)\b",
    "ip": r"(?<![\d.])(?P<v>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\d|\.\d)",
    "ipv6": (r"(?<![\w:.])(?P<v>[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
             r"|(?=[A-Fa-f]*\d)[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:])"),
    "card": r"(?<!\d)(?P<v>\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{1,7}|\d{4}([ -])\d{6}\3\d{5})(?!\d)",
    "ssn": r"(?<![\d-])(?P<v>\d{3}-\d{2}-\d{4})(?![\d-])",
    "phone": (r"(?<![\w+])(?P<v>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
              r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"),
    "name": (r"\b(?P<title>" + "|".join(sorted(map(re.escape, _TITLE), key=len, reverse=True))
             + rf")\b\.?[ \u00a0](?P<v>(?=[A-ZÀ-ÞΑ-ΩА-Я]){_NAME}(?: (?=[A-ZÀ-ÞΑ-ΩА-Я]){_NAME}){{0,2}})"),
}
_COMPILED = {kind: re.compile(p) for kind, p in PATTERNS.items()}
_DIGITS = re.compile(r"\d[\d .()-]{5}")
_SECRET = re.compile(r"(?i:pass|token|secret|key)|AKIA|ASIA|gh[pousr]_|[0-9a-fA-F]{32}")
_TITLED = re.compile(r"\b(?:" + "|".join(map(re.escape, _TITLE)) + r")\b")
#: A text that fails its type's test has no entity of it.
_MAY: dict[str, Callable[[str, bool], bool]] = {
    "email": lambda text, digits: "@" in text, "secret": lambda text, digits: bool(_SECRET.search(text)),
    "iban": lambda text, digits: bool(re.search(r"[A-Z]{2}\d\d", text)), "ipv6": lambda text, digits: "::" in text or text.count(":") > 6,
    "name": lambda text, digits: bool(_TITLED.search(text)),
    # every other type has a digit and five of digits and separators after it, but for octets of an address
    "ip": lambda text, digits: digits, "card": lambda text, digits: digits, "ssn": lambda text, digits: digits,
    "phone": lambda text, digits: digits or "+" in text,
}
_WORD = re.compile(r"(?<!\w)" + _NAME + r"(?!\w)")
_OWNED = ("'s", "’s")

#: A digit of another script than ASCII.
_OTHER_DIGIT = re.compile(r"[^\D0-9]")

_ENTITY = T.StructType([T.StructField("kind", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])


def _plain(text: str) -> str:
    """The text with each digit as the ASCII digit of its value, at the same place."""
    return text if text.isascii() else _OTHER_DIGIT.sub(lambda m: str(int(m[0])), text)


def _in_script(ch: str, like: str) -> str:
    """A digit in the script of the digit ``like``: the digits of a script lie in a row."""
    return chr(ord(like) - int(like) + int(ch)) if ch in ALPHABETS[0] and like.isdecimal() else ch


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, gender)`` of the entities of a text, in order and disjoint."""
    text = _plain(text)
    digits = bool(_DIGITS.search(text))
    found = []
    for rank, (kind, pattern) in enumerate(_COMPILED.items()):
        if not _MAY[kind](text, digits):
            continue
        for m in pattern.finditer(text):
            group = next((g for g in ("v", "v2", "v3", "v4") if m.groupdict().get(g) is not None))
            if kind == "ipv6" and _number_v6(m[group]) is None:
                continue
            end = m.end(group) - (2 if kind == "name" and m[group].endswith(_OWNED) else 0)
            found.append((m.start(group), -end, rank, kind, _TITLE[m["title"]] if kind == "name" else ""))
    named = _disjoint(found)
    parts: dict[str, str] = {}
    # names of several words first: they tell given names from family names
    for start, end, kind, gender in sorted((e for e in named if e[2] == "name"), key=lambda e: " " not in text[e[0]:e[1]]):
        for word, g in _name_parts(text[start:end], gender):
            parts.setdefault(word.lower(), g)
    if not parts:
        return named
    named = [(start, end, kind, "=" + parts[text[start:end].lower()] if kind == "name" and " " not in text[start:end] else gender)
             for start, end, kind, gender in named]
    taken = [(start, -end, -1, kind, gender) for start, end, kind, gender in named]  # before every mention
    return _disjoint(taken + list(_mentions(text, parts)))


def _disjoint(found: list[tuple[int, int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Of overlapping finds ``(start, -end, rank, kind, gender)``: those that have a place already, then the first in order."""
    out, at = [], 0
    held = sorted((f[0], -f[1]) for f in found if f[2] < 0)
    k = 0
    for start, end, rank, kind, gender in sorted(found):
        while k < len(held) and held[k][1] <= start:
            k += 1
        if start >= at and (rank < 0 or k == len(held) or held[k][0] >= -end):
            out.append((start, -end, kind, gender))
            at = -end
    return out


def _mentions(text: str, parts: dict[str, str]) -> Iterator[tuple[int, int, int, str, str]]:
    """Capitalised words that are a part of a name of the text; ``parts`` has their genders,
    marked by ``=`` as the word's own, not that of a form of address."""
    for m in _WORD.finditer(text):
        word = m[0][:-2] if m[0].endswith(_OWNED) and m[0].lower() not in parts else m[0]
        if word[0].isupper() and len(word) > 1 and word.lower() in parts:
            yield m.start(), -(m.start() + len(word)), len(PATTERNS), "name", "=" + parts[word.lower()]


def permuted(x: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``range(size)`` without a fixed point (for ``size`` of 2 or more)."""
    if size < 2:
        return x
    half = (size - 1).bit_length() + 1 >> 1
    low = (1 << half) - 1
    mac = hmac.new(key, f"{tweak}|{size}".encode(), hashlib.sha256)

    def rounds(v: int, order: range) -> int:
        left, right = v >> half, v & low
        for r in order:
            h = mac.copy()
            h.update(r.to_bytes(1, "big") + (right if order.step > 0 else left).to_bytes(half // 8 + 1, "big"))
            f = int.from_bytes(hashlib.shake_128(h.digest()).digest(half // 8 + 8), "big") & low
            left, right = (right, left ^ f) if order.step > 0 else (right ^ f, left)
        return left << half | right

    def walk(v: int, order: range) -> int:
        v = rounds(v, order)
        while v >= size:
            v = rounds(v, order)
        return v

    return walk((walk(x, range(8)) + 1) % size, range(7, -1, -1))


def _pieces(text: str) -> list[str]:
    """A long text is permuted piece by piece, so numbers stay small."""
    return [text[k:k + _PIECE] for k in range(0, max(len(text), 1), _PIECE)]


def _by_class(text: str, key: bytes, tweak: str) -> str:
    """Permute a text within its format: each character keeps its alphabet, others stay."""
    if len(text) > _PIECE:
        return "".join(_by_class(piece, key, f"{tweak}|{k}") for k, piece in enumerate(_pieces(text)))
    shape = [_CLASS.get(ch) for ch in text]
    number, size = 0, 1
    for ch, a in zip(text, shape, strict=True):
        if a:
            number, size = number * len(a) + a.index(ch), size * len(a)
    form = "".join(ch if a is None else str(ALPHABETS.index(a)) for ch, a in zip(text, shape, strict=True))
    number = permuted(number, size, key, f"{tweak}|{form}")
    out = []
    for ch, a in zip(reversed(text), reversed(shape), strict=True):
        if a:
            number, digit = divmod(number, len(a))
            out.append(a[digit])
        else:
            out.append(ch)
    return "".join(reversed(out))


def _hex(value: str, key: bytes) -> str:
    pieces = [format(permuted(int(p, 16), 16 ** len(p), key, f"hex{len(value)}|{k}"), f"0{len(p)}x") for k, p in enumerate(_pieces(value))]
    new = "".join(pieces)
    return new.upper() if value == value.upper() and value != value.lower() else new


def _refill(form: str, digits: str) -> str:
    """Put ``digits`` in the places of the digits of ``form``."""
    rest = iter(digits)
    return "".join(next(rest) if ch in ALPHABETS[0] else ch for ch in form)


def _luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(value: str, key: bytes) -> str:
    digits = "".join(re.findall(r"[0-9]", value))
    off = (int(digits[-1]) - _luhn(digits[:-1])) % 10  # 0 for a valid number: stays as it is
    body = digits[0] + _by_class(digits[1:-1], key, "card" + digits[0])
    return _refill(value, body + str((_luhn(body) + off) % 10))


def _ip(value: str, key: bytes) -> str:
    a, b, c, d = map(int, value.split("."))
    n = permuted(a << 24 | b << 16 | c << 8 | d, 1 << 32, key, "ip")
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def _as_written(new: str, value: str, kind: str) -> str:
    """The surrogate ``new`` with its digits in the scripts of those of ``value``."""
    if kind == "ipv6":  # groups may differ in length, and a letter has no script
        like = next((ch for ch in value if ch.isdecimal()), "0")
        return "".join(_in_script(ch, like) for ch in new)
    if kind == "ip":  # octets may differ in length: each has the script of its first digit
        return ".".join("".join(_in_script(ch, old[0]) for ch in octet) for octet, old in zip(new.split("."), value.split("."), strict=True))
    if len(new) == len(value):
        return "".join(map(_in_script, new, value))
    # lower case can be longer: digits stay digits, in order
    like = iter(ch for ch in value if ch.isdecimal())
    return "".join(_in_script(ch, next(like)) if ch in ALPHABETS[0] else ch for ch in new)


def _number_v6(value: str) -> int | None:
    try:
        return int(ipaddress.IPv6Address(value))
    except ValueError:
        return None


def _ipv6(value: str, key: bytes) -> str:
    number, low = _number_v6(value), (1 << 112) - 1
    lead = number >> 112  # the kind of network
    number = lead << 112 | permuted(number & low, 1 << 112, key, f"ipv6|{lead}")
    full = "::" not in value and all(len(group) == 4 for group in value.split(":"))
    new = ":".join(format(number >> s & 0xFFFF, "04x" if full else "x") for s in range(112, -1, -16))
    return new.upper() if value != value.lower() else new


def _iban(value: str, key: bytes) -> str:
    """Country and account; the check digits stay as far off the right ones as they were."""
    plain = value.replace(" ", "")
    country, check, account = plain[:2], int(plain[2:4]), plain[4:]
    new = _by_class(account, key, "iban" + country)
    check = (check - _mod_97(country, account) + _mod_97(country, new)) % 100
    rest = iter(f"{country}{check:02d}{new}")
    return "".join(ch if ch == " " else next(rest) for ch in value)


def _mod_97(country: str, account: str) -> int:
    """The check digits of an IBAN."""
    return 98 - int("".join(str(int(ch, 36)) for ch in account + country + "00")) % 97


def _is_hex(value: str) -> bool:
    return re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None and not value.isdecimal()


def _secret(value: str, key: bytes) -> str:
    """Hexadecimal secrets with a letter are permuted among themselves, and others among the
    rest of their format: the permutation goes on until it is back in the set."""
    step, inside = (_hex, True) if _is_hex(value) else (lambda v, k: _by_class(v, k, "secret"), False)
    new = step(value, key)
    while _is_hex(new) != inside:
        new = step(new, key)
    return new.upper() if inside and value == value.upper() else new


def _phone(value: str, key: bytes) -> str:
    digits = "".join(re.findall(r"[0-9]", value))
    lead = digits[:-10]  # the country code, so that national and international forms agree
    return _refill(value, lead + _by_class(digits[len(lead):], key, "phone"))


def _email(value: str, key: bytes) -> str:
    head, _, top = value.lower().rpartition(".")
    new = f"{_by_class(head, key, 'email.' + top)}.{top}"
    return new.upper() if value.isupper() else new


def _script(word: str) -> str:
    for ch in word.lower():
        if "\u0370" <= ch <= "\u03ff":
            return "greek"
        if "\u0400" <= ch <= "\u04ff":
            return "cyrillic"
    return "latin"


def _name_part(word: str, gender: str, key: bytes) -> str:
    """Syllables for a name: the words of an alphabet, of all lengths, are numbered in one
    row; numbers have one rendering each, and the consonant after it tells alphabets apart."""
    script, low = _script(word), word.lower()
    plain = {"latin": ALPHABETS[1], "greek": ALPHABETS[5], "cyrillic": ALPHABETS[7]}[script]
    if all(ch in plain for ch in low):
        alphabet, codes = plain, [plain.index(ch) for ch in low]
        base, other = len(alphabet), 0
    else:
        codes, base, other = [ord(ch) for ch in low], 1 << 21, 1
    consonants, vowels, ending = SYLLABLES[script]
    rendered = []
    for at in range(0, len(codes), _PIECE):
        piece, number = codes[at:at + _PIECE], 0
        for c in piece:
            number = number * base + c
        number = permuted(number, base ** len(piece), key, f"name|{script}|{gender}|{other}|{at}|{len(piece)}")
        number += sum(base ** k for k in range(1, len(piece)))
        syllables = []
        while number or not syllables:
            number, k = divmod(number, len(consonants) * len(vowels))
            syllables.append(consonants[k // len(vowels)] + vowels[k % len(vowels)])
        rendered.append("".join(reversed(syllables)))
    out = consonants[0].join(rendered) + consonants[8 * other + len(codes) % 8] + ending[gender]
    return out.upper() if word.isupper() and len(word) > 1 else out.capitalize()


def _name_parts(value: str, gender: str) -> list[tuple[str, str]]:
    """A given name before others has the gender of the form of address; family names have none."""
    words = value.split(" ")
    if gender.startswith("="):
        return [(value, gender[1:])]
    return [(w, gender if k == 0 and len(words) > 1 else "n") for k, w in enumerate(words)]


@lru_cache(maxsize=8192)
def surrogate(value: str, kind: str, gender: str, key: bytes) -> str:
    """The replacement of an entity; equal entities in other spellings get matching ones."""
    plain = _plain(value)
    if plain != value and kind != "name":
        return _as_written(surrogate(plain, kind, gender, key), value, kind)
    if kind == "email":
        return _email(value, key)
    if kind == "ip":
        return _ip(value, key)
    if kind == "card":
        return _card(value, key)
    if kind == "phone":
        return _phone(value, key)
    if kind == "ssn":
        return _refill(value, _by_class("".join(re.findall(r"[0-9]", value)), key, "ssn"))
    if kind == "iban":
        return _iban(value, key)
    if kind == "ipv6":
        return _ipv6(value, key)
    if kind == "name":
        return " ".join(_name_part(w, g, key) for w, g in _name_parts(value, gender))
    return _secret(value, key)


def canonical(value: str, kind: str) -> str:
    """What spellings of one entity have in common."""
    value = _plain(value)
    if kind == "ip":
        return ".".join(str(int(octet)) for octet in value.split("."))
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv6":
        return format(_number_v6(value), "032x")
    if kind in ("card", "ssn"):
        return "".join(re.findall(r"[0-9]", value))
    if kind == "phone":
        return "".join(re.findall(r"[0-9]", value))[-10:]
    return value.lower() if kind in ("email", "name") else value


def _key_of(key: bytes, kind: str, entity: str, again: dict[tuple[str, str], int]) -> bytes:
    times = again.get((kind, entity), 0)
    return hmac.new(key, f"again|{times}".encode(), hashlib.sha256).digest() if times else key


def _replacement(value: str, kind: str, gender: str, key: bytes, again: dict[tuple[str, str], int]) -> str:
    """The surrogate, by another key for the entities of ``again``."""
    if not again:
        return surrogate(value, kind, gender, key)
    if kind == "name":
        return " ".join(_name_part(w, g, _key_of(key, kind, f"{w.lower()}|{g}", again)) for w, g in _name_parts(value, gender))
    return surrogate(value, kind, gender, _key_of(key, kind, canonical(value, kind), again))


def replaced(text: str, key: bytes, again: dict[tuple[str, str], int] | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """A text with surrogates, and ``(kind, first, last)`` of the places they now have."""
    out, at, length, places = [], 0, 0, []
    for start, end, kind, gender in find(text):
        new = _replacement(text[start:end], kind, gender, key, again or {})
        out += [text[at:start], new]
        length += start - at
        places.append((kind, length, length + len(new) - 1))
        length, at = length + len(new), end
    return "".join([*out, text[at:]]), places


def pseudonymise(docs: DataFrame, key: str, text: str = "text", mode: str = "replace",
                 again: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """``replace`` returns the columns of ``docs`` with surrogates in ``text``; ``annotate``
    adds ``n_entities`` and ``entities`` (kind and character range of each surrogate).
    ``again`` has the entities that need another key (see the function of that name)."""
    secret = key.encode()
    added = [T.StructField("n_entities", T.LongType()), T.StructField("entities", T.ArrayType(_ENTITY))] if mode == "annotate" else []
    names = {f.name for f in added}
    kept = [c for c in docs.columns if c == text or c.lower() not in names]
    schema = T.StructType([*(docs.schema[c] for c in kept), *added])
    places_type = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                got = [(None, []) if v is None else replaced(v, secret, again) for v in part.column(text).to_pylist()]
                own = [pa.array([t for t, _ in got], part.schema.field(c).type) if c == text else part.column(c) for c in kept]
                if added:
                    own += [pa.array([len(p) for _, p in got], pa.int64()),
                            pa.array([[{"kind": a, "first": s, "last": e} for a, s, e in p] for _, p in got], places_type)]
                yield pa.RecordBatch.from_arrays(own, names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def entities(docs: DataFrame, key: str, text: str = "text", again: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """``(kind, entity, surrogate, many)``: every distinct entity of the corpus in its canonical form."""
    secret, more = key.encode(), again or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[str, str, str]] = []
            for v in b.column("text").to_pylist():
                for start, end, kind, gender in find(v or ""):
                    value = v[start:end]
                    if kind == "name":
                        rows += [(kind, e, _name_part(w, g, _key_of(secret, kind, e, more)).lower())
                                 for w, g in _name_parts(value, gender) for e in [f"{w.lower()}|{g}"]]
                    else:
                        rows.append((kind, canonical(value, kind), canonical(_replacement(value, kind, gender, secret, more), kind)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.string())] * 3,
                                             names=["kind", "entity", "surrogate"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(lean(run), "kind string, entity string, surrogate string")
    return found.groupBy("kind", "entity", "surrogate").agg(F.count("*").alias("many"))


def collisions(found: DataFrame) -> DataFrame:
    """Of ``entities``: surrogates of more than one entity, and entities of more than one
    surrogate. No rows: distinctness and coreference hold over the whole corpus."""
    shared = found.groupBy("kind", "surrogate").agg(F.countDistinct("entity").alias("n")).where("n > 1").select("kind", F.col("surrogate").alias("what"), "n")
    split = found.groupBy("kind", "entity").agg(F.countDistinct("surrogate").alias("n")).where("n > 1").select("kind", F.col("entity").alias("what"), "n")
    return shared.unionByName(split)


def again(docs: DataFrame, key: str, text: str = "text") -> dict[tuple[str, str], int]:
    """Entities ``(kind, entity)`` that share a surrogate with a smaller one, and the number of
    the key that gives them one of their own; empty if no surrogates collide."""
    more: dict[tuple[str, str], int] = {}
    for _ in range(4):
        found = stored(entities(docs, key, text, more), "entities")
        shared = (found.groupBy("kind", "surrogate").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("least"))
                  .where("n > 1").drop("n"))
        rows = found.join(shared, ["kind", "surrogate"]).where("entity <> least").select("kind", "entity").distinct().limit(MOST_AGAIN + 1).collect()
        if not rows:
            return more
        if len(rows) > MOST_AGAIN:
            break
        for r in rows:
            more[r["kind"], r["entity"]] = more.get((r["kind"], r["entity"]), 0) + 1
    raise ValueError("surrogates collide under every key tried")
