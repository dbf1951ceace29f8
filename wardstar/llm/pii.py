"""Format-preserving pseudonyms for personal data by a keyed Feistel network.

Values are found by pattern and then validated (check digits, calendar, octet
and area ranges); only valid ones are replaced. A value is read as a number
in the mixed radix of its own format and moved by a keyed permutation of
exactly that range, so the pseudonym has the same format, is valid again, and
equal values get equal pseudonyms in all documents, whatever separators they
are written with. The permutation can be undone with the key.

==========  ============================================================
card        13 to 19 digits with Luhn's check digit, in groups of any size
            with a blank (also one that does not break) or a hyphen between;
            first digit stays
iban        country and length stay, check digits are made anew
ssn         AAA-GG-SSSS with a valid area, group and serial
phone       +C... (7 to 15 digits), (AAA) EEE-LLLL or AAA-EEE-LLLL; country
            code stays
ip          four octets; version 6 as it is written, three groups at least
date        YYYY-MM-DD, DD.MM.YYYY, DD/MM/YYYY or MM/DD/YYYY, 1900 to 2099;
            a time may follow after T; with a month's full name 5 March 2021,
            March 5, 2021, 5. Mai 2021, 5 mai 2021 and 5 de mayo de 2021
email       letters and digits of the local part; the domain stays
secret      access keys by their heads, signed web tokens, bearer tokens, the
            body of private keys, assigned passwords or tokens; by character
            class, heads stay
==========  ============================================================

A match that fails its validation does not hide others: the search goes on one
character later, an IBAN is tried at the length of its country, and of a run
of digit groups every span of 13 to 19 digits is tried. Where spans overlap,
those in the groups of cards come first (first digits 3 to 6 before others, 16
digits before 19, as a code may follow, but after a first digit 6, of which
cards of 19 are usual), then the left and longer. Other spans give way to a find
that they cut, and to any find if their separators are mixed, and are not taken
from the digits of an IBAN that is not valid. One span in ten
passes Luhn's check by chance, so beside other numbers a pseudonym can be read
in other borders than the value was; the finds (``pii``) hold the true ones.

A value of up to ``LONG`` symbols is one number, moved by a Feistel network
over its two halves as numbers. A longer one, such as a key file or minified
script after an equals sign, is two halves of symbols: every symbol of a half is
shifted within its class by a keyed stream that is as long as the half and
depends on all of the other, so no run of it stays and the cost is linear.

A text is worked on by itself in Arrow batches: no shuffle, no shared state.

Defined cases: a null text stays null and has no finds; an empty text stays
empty; overlapping finds are taken from the left, the longer and then the
earlier kind of the table first; repeated rows are replaced alike; extra
columns pass through, those that clash with ``pii`` are replaced; texts and
values may be of any length; an empty table stays empty.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from ipaddress import IPv6Address

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_text_columns, quoted

ROUNDS = 10
# Symbols up to which a value is moved as one number: half of them, at most 36
# apiece, leave the 64 bytes of the round function 16 bytes to spare.
LONG = 128
DIGITS = "0123456789"
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
N_DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


# ------------------------------------------------------------ the permutation
def _prf(key: bytes, tweak: str, i: int, half: int, below: int) -> int:
    h = hashlib.blake2b(f"{tweak}|{i}|{half}".encode(), key=key[:64],
                        digest_size=min(64, (below.bit_length() + 7) // 8 + 16))
    return int.from_bytes(h.digest(), "big") % below


def _halves(n: int) -> tuple[int, int]:
    """Two factors a * b >= n, about equal."""
    a = max(1, int(n ** 0.5) if n < 1 << 52 else 1 << (n.bit_length() // 2))
    return a, -(-n // a)


def permute(x: int, n: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """A keyed permutation of 0 .. n-1: a Feistel network over two halves of a
    range of at least ``n``, walked on while it leads out of the range."""
    if n <= 1:
        return x
    a, b = _halves(n)
    rounds = range(ROUNDS)[::-1] if undo else range(ROUNDS)
    sign = -1 if undo else 1
    while True:
        left, right = divmod(x, b)
        for i in rounds:
            if i % 2:
                left = (left + sign * _prf(key, tweak, i, right, a)) % a
            else:
                right = (right + sign * _prf(key, tweak, i, left, b)) % b
        x = left * b + right
        if x < n:
            return x


def permute_digits(values: list[int], radices: list[int], key: bytes, tweak: str,
                   undo: bool = False) -> list[int]:
    """The same for a number given by its digits in a mixed radix."""
    if len(values) > LONG:
        return permute_symbols(values, radices, key, tweak, undo)
    x, n = 0, 1
    for v, r in zip(values, radices):
        x, n = x * r + v, n * r
    x = permute(x, n, key, tweak + "|" + ",".join(map(str, radices)), undo)
    out = []
    for r in reversed(radices):
        x, v = divmod(x, r)
        out.append(v)
    return out[::-1]


def _shifts(key: bytes, tweak: bytes, i: int, half: np.ndarray, n: int) -> np.ndarray:
    """``n`` keyed 64-bit numbers that depend on all symbols of ``half``."""
    seed = hashlib.blake2b(tweak + i.to_bytes(1, "big") + half.tobytes(), key=key[:64]).digest()
    return np.frombuffer(hashlib.shake_256(seed).digest(8 * n), "<u8")


def permute_symbols(values: list[int], radices: list[int], key: bytes, tweak: str,
                    undo: bool = False) -> list[int]:
    """A keyed permutation of the sequences of these radices (256 at most), in
    linear time: a Feistel network over two halves of the sequence, in which a
    half's symbols are shifted by a stream made from the other half."""
    x, r = np.array(values, np.int64), np.array(radices, np.uint64)
    form = tweak.encode() + b"|" + hashlib.blake2b(r.astype(np.uint8).tobytes()).digest()
    cut = len(x) // 2
    sides = [(slice(0, cut), slice(cut, None)), (slice(cut, None), slice(0, cut))]
    for i in range(ROUNDS)[::-1] if undo else range(ROUNDS):
        known, moved = sides[i % 2]
        shift = (_shifts(key, form, i, x[known].astype(np.uint8), len(x[moved])) % r[moved]).astype(np.int64)
        x[moved] = (x[moved] + (-shift if undo else shift)) % r[moved].astype(np.int64)
    return x.tolist()


# ------------------------------------------------------------ formats
def _refill(shape: str, values: str, chars: str = DIGITS) -> str:
    """``shape`` with its characters of ``chars`` replaced by ``values``."""
    it = iter(values)
    return "".join(next(it) if c in chars else c for c in shape)


def _only_digits(s: str) -> str:
    return "".join(c for c in s if c in DIGITS)


def luhn_digit(payload: str) -> str:
    """The check digit that makes payload + digit valid."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def card(s: str, key: bytes, undo: bool) -> str | None:
    d = _only_digits(s)
    if not 13 <= len(d) <= 19 or d[0] == "0" or luhn_digit(d[:-1]) != d[-1]:
        return None
    new = d
    while True:  # 19 digits walk on until the first 16 are a card if they were one
        body = permute_digits([int(c) for c in new[1:-1]], [10] * (len(d) - 2), key, "card" + d[0], undo)
        new = d[0] + "".join(map(str, body))
        new += luhn_digit(new)
        if len(d) < 19 or (luhn_digit(new[:15]) == new[15]) == (luhn_digit(d[:15]) == d[15]):
            return _refill(s, new)


# Group sizes that cards are printed in.
_CARD_GROUPS = {(4, 4, 4, 1), (4, 4, 4, 2), (4, 4, 4, 3), (4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 4), (4, 6, 5)}
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _card_spans(text: str) -> Iterator[tuple[int, int, bool, bool]]:
    """(start, end, grouped as a card, one separator) of the spans of 13 to 19
    digits between group borders that pass Luhn's check."""
    for run in _DIGIT_GROUPS.finditer(text):
        if run.end() - run.start() < 13:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        if not _AT_STOP(text, run.end()):
            groups.pop()
        # sums with the digits at even or at odd places doubled
        sums, at = ([0], [0]), [0]
        for lo, hi in groups:
            for k, c in enumerate(text[lo:hi], at[-1]):
                for odd in (0, 1):
                    sums[odd].append(sums[odd][-1] + (_DOUBLED[int(c)] if k % 2 == odd else int(c)))
            at.append(at[-1] + hi - lo)
        # the digits after the head of an IBAN, valid or not, are a card in its groups only
        head = _IBAN_HEAD(text[max(0, run.start() - 6):run.start()])
        body = _IBAN_LENGTHS.get(head.group(1), 0) - 4 if head else 0
        for i, (lo, _) in enumerate(groups):
            if text[lo] == "0":
                continue
            for j in range(i, len(groups)):
                n = at[j + 1] - at[i]
                if n > 19:
                    break
                by_place = sums[at[j + 1] % 2]
                if n >= 13 and (by_place[at[j + 1]] - by_place[at[i]]) % 10 == 0:
                    one = len({text[groups[k][1]] for k in range(i, j)}) < 2
                    sizes = tuple(hi - lo for lo, hi in groups[i:j + 1])
                    grouped = one and (i == j or sizes in _CARD_GROUPS)
                    if grouped or at[i] >= body:
                        yield lo, groups[j][1], grouped, one


@lru_cache(maxsize=4096)
def _letters(c: str) -> str:
    """The letters among which a letter beyond ASCII is moved: those of its case
    in its row of 32 code points."""
    row = ord(c) & ~31
    return "".join(x for x in map(chr, range(row, row + 32)) if x.isalpha() and x.isupper() == c.isupper())


def _class(c: str) -> int:
    if c.isascii():
        return 10 if c in DIGITS else 26 if c.isalpha() else 0
    return len(_letters(c)) if c.isalpha() else 0


def _by_class(s: str, key: bytes, tweak: str, undo: bool, stays: Sequence[tuple[int, int]] = ()) -> str:
    """Letters and digits moved within their classes; case, all other
    characters and those in the ranges ``stays`` stay. Upper and lower case of
    ASCII letters are one value."""
    kinds = [_class(c) for c in s]
    for lo, hi in stays:
        kinds[lo:hi] = [0] * (hi - lo)
    values = [int(c) if k == 10 and c in DIGITS else ord(c.lower()) - 97 if c.isascii() else _letters(c).index(c)
              for c, k in zip(s, kinds) if k]
    new = iter(permute_digits(values, [k for k in kinds if k], key, tweak, undo))
    out = []
    for c, k in zip(s, kinds):
        if k and not c.isascii():
            c = _letters(c)[next(new)]
        elif k == 10:
            c = str(next(new))
        elif k:
            c = chr((65 if c.isupper() else 97) + next(new))
        out.append(c)
    return "".join(out)


def _iban_check(country: str, bban: str) -> str:
    number = "".join(str(int(c, 36)) for c in bban + country + "00")
    return f"{98 - int(number) % 97:02d}"


_IBAN_LENGTHS = {c: int(n) for c, n in re.findall("([A-Z]{2})([0-9]{2})", """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28
    EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26
    IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28
    NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25
    SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30""")}


def _iban_ends(s: str) -> list[int]:
    """Where an IBAN that ``s`` begins with may end: at its country's length,
    else at the end; of other countries at every word's end, the last first."""
    ends = [m.start() for m in re.finditer(" |$", s)][::-1]
    n = _IBAN_LENGTHS.get(s[:2])
    return ends if n is None else [e for e in ends if e - s.count(" ", 0, e) == n] + ends[:1]


def iban(s: str, key: bytes, undo: bool) -> str | None:
    t = s.replace(" ", "")
    country, bban = t[:2], t[4:]
    if not 15 <= len(t) <= 34 or _iban_check(country, bban) != t[2:4]:
        return None
    new = _by_class(bban, key, "iban" + country, undo)
    it = iter(country + _iban_check(country, new) + new)
    return "".join(c if c == " " else next(it) for c in s)


_AREAS = [a for a in range(1, 900) if a != 666]


def ssn(s: str, key: bytes, undo: bool) -> str | None:
    area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
    if not 1 <= area < 900 or area == 666 or not group or not serial:
        return None
    a, g, n = permute_digits([area - 1 - (area > 666), group - 1, serial - 1],
                             [len(_AREAS), 99, 9999], key, "ssn", undo)
    return f"{_AREAS[a]:03d}{s[3]}{g + 1:02d}{s[6]}{n + 1:04d}"


# Country codes but 1; those not listed have three digits. No code begins another.
_SHORT_CODES = set("""7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58
    60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98""".split())
_LONG_CODES = {c for c in map(str, range(200, 1000)) if not {c[:1], c[:2]} & _SHORT_CODES
               and c[:2] not in ("28", "83", "89", "99")} | {"992", "993", "994", "995", "996", "998"}


def _country_code(digits: str) -> str | None:
    return next((digits[:n] for n in (1, 2, 3) if digits[:n] in _SHORT_CODES or digits[:n] in _LONG_CODES),
                None)


def phone(s: str, key: bytes, undo: bool) -> str | None:
    """Numbers of the North American plan: area and exchange begin with 2 to 9.
    Of other numbers with a country code all digits after it are moved; a code
    with no separator after it is told by the table of codes."""
    m = re.match(r"\+?1[ .-]?(?=\(?[2-9])", s) if s[0] in "+1" else None
    head = m.group() if m else ""
    d = _only_digits(s[len(head):])
    if len(d) == 10 and (head or s[0] != "+"):
        if d[0] in "01" or d[3] in "01":
            return None
        low = [2, 0, 0, 2, 0, 0, 0, 0, 0, 0]
        new = permute_digits([int(c) - k for c, k in zip(d, low)], [10 - k for k in low], key, "nanp", undo)
        return head + _refill(s[len(head):], "".join(str(v + k) for v, k in zip(new, low)))
    if s[0] != "+":
        return None
    m = re.match(r"\+[1-9][0-9]{0,2}(?=[ .(-])", s)
    code = m.group()[1:] if m else _country_code(re.match(r"\+([0-9]*)", s).group(1))
    if code is None:
        return None
    rest = s[1 + len(code):]
    d = _only_digits(rest)
    if not (6 <= len(d) <= 13 if m else 7 <= len(code) + len(d) <= 15):
        return None
    new = permute_digits([int(c) for c in d], [10] * len(d), key, "phone+" + code, undo)
    return "+" + code + _refill(rest, "".join(map(str, new)))


def ip(s: str, key: bytes, undo: bool) -> str | None:
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    return ".".join(map(str, permute_digits(octets, [256] * 4, key, "ip", undo)))


def ip6(s: str, key: bytes, undo: bool) -> str | None:
    """Hexadecimal digits of an address as it is written: a group keeps its
    digits and is led by a nought only if it was."""
    try:
        IPv6Address(s)
    except ValueError:
        return None
    groups = [g for g in s.split(":") if g]
    if len(groups) < 3 or "." in s or not any(c in DIGITS for c in s):
        return None
    values, low, radices = [], [], []
    for g in groups:
        for i, c in enumerate(g):
            first = not i and len(g) > 1
            low.append(int(first and c != "0"))
            radices.append(1 if first and c == "0" else 16 - low[-1])
            values.append(int(c, 16) - low[-1])
    new = iter([v + k for v, k in zip(permute_digits(values, radices, key, "ip6", undo), low)])
    return "".join(c if c == ":" else _like(c, next(new)) for c in s)


def _like(c: str, value: int) -> str:
    return f"{value:X}" if c.isupper() else f"{value:x}"


def _day(y: int, m: int, d: int) -> int | None:
    try:
        n = datetime.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return n if 0 <= n < N_DAYS else None


def date(s: str, key: bytes, undo: bool) -> str | None:
    """Day and month of slashed dates: day first, unless only month first is a
    date. Such a pseudonym keeps the reading of the original."""
    a, b, c = (int(x) for x in re.split(r"[-./]", s))
    if len(s.split(s[4])[0]) == 4 and s[4] in "-./":
        order, n = "ymd", _day(a, b, c)
    else:
        order, n = "dmy", _day(c, b, a)
        if n is None and "/" in s:
            order, n = "mdy", _day(c, a, b)
    if n is None:
        return None
    if order != "ymd" and "/" in s:
        # only days that are read in the same order again
        ok = _slashed(order)
        at = ok.index(n) if order == "mdy" else n
        n = ok[permute(at, len(ok), key, "date" + order, undo)]
    else:
        n = permute(n, N_DAYS, key, "date", undo)
    day = datetime.date.fromordinal(FIRST_DAY + n)
    parts = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
    marks = re.findall(r"[-./]", s)
    return parts[order[0]] + marks[0] + parts[order[1]] + marks[1] + parts[order[2]]


# The months' names.
_MONTHS = {lang: names.split() for lang, names in {
    "en": "January February March April May June July August September October November December",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}.items()}


def _named(lang: str) -> Callable:
    """A date with a month's name in one language; the order and marks stay."""
    number = {n.lower(): i + 1 for i, n in enumerate(_MONTHS[lang])}

    def named_date(s: str, key: bytes, undo: bool) -> str | None:
        words = re.findall(r"[^\W\d_]+|[0-9]+", s)
        month = next(w for w in words if w.lower() in number)
        day, year = (w for w in words if w[0] in DIGITS)
        n = _day(int(year), number[month.lower()], int(day))
        if n is None or len(day) > 1 and day[0] == "0":
            return None
        new = datetime.date.fromordinal(FIRST_DAY + permute(n, N_DAYS, key, "date", undo))
        name = _MONTHS[lang][new.month - 1]
        name = name.upper() if month.isupper() else name.lower() if month.islower() else name.capitalize()
        it = iter([name if w == month else f"{new.year:04d}" if len(w) == 4 else str(new.day)
                   for w in words if w == month or w[0] in DIGITS])
        return re.sub(rf"{month}|[0-9]+", lambda _: next(it), s)
    return named_date


@lru_cache
def _slashed(order: str) -> list[int] | range:
    """Days that a slashed date of this order can stand for: with the month
    first only those whose day is no month."""
    if order == "dmy":
        return range(N_DAYS)
    return [n for n in range(N_DAYS) if datetime.date.fromordinal(FIRST_DAY + n).day > 12]


def email(s: str, key: bytes, undo: bool) -> str | None:
    local, _, domain = s.partition("@")
    return _by_class(local, key, "email@" + domain.lower(), undo) + "@" + domain


def secret(s: str, key: bytes, undo: bool) -> str | None:
    """Hexadecimal values stay hexadecimal, others keep their classes."""
    if re.fullmatch("[0-9a-f]+", s):
        return "".join(f"{v:x}" for v in permute_digits([int(c, 16) for c in s], [16] * len(s), key,
                                                        "hex", undo))
    if _SIGNED(s):
        second = s.index(".") + 1
        return _by_class(s, key, "signed", undo, [(0, 3), (second, second + 3)])
    m = _KEY_HEAD(s)
    head = m.group() if m else ""
    new = s[len(head):]
    while True:  # walk on where it would be read in another way
        new = _by_class(new, key, "secret" + head, undo)
        if head or not (re.fullmatch("[0-9a-f]+", new) or _KEY_HEAD(new) or _SIGNED(new)):
            return head + new


# Fixed patterns: keys with a head of their own, web tokens signed by their issuer.
_KEYS = (r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|sk-[A-Za-z0-9_-]{20,}"
         r"|AIza[0-9A-Za-z_-]{35}")
_KEY_HEAD = re.compile(rf"(?=(?:{_KEYS})\Z)(?:AKIA|gh[pousr]_|github_pat_|sk-|AIza)").match
_SIGNED_TOKEN = r"eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}"
_SIGNED = re.compile(_SIGNED_TOKEN).fullmatch
_SECRET_NAMES = r"(?:password|passwd|pwd|token|secret|(?:api|access|private)[_-]?key)"


# Fixed patterns; the named group is the value. Order breaks ties.
_EDGE, _STOP = r"(?<![\w.+-])", r"(?![\w])(?!\.[0-9])"
_NANP = r"\+1[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
FINDERS: list[tuple[str, str, Callable]] = [
    ("iban", rf"{_EDGE}(?P<v>[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}){_STOP}", iban),
    ("ssn", rf"{_EDGE}(?P<v>[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}){_STOP}", ssn),
    ("phone", r"(?<![\w.-])(?P<v>(?:\+[0-9]{1,3}[ .-]?|1[ .-])?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}"
              r"|(?:\+[0-9]{1,3}[ .-]|1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
              rf"|{_NANP})" + _STOP, phone),
    ("phone", rf"(?<![\w.-])(?!{_NANP}{_STOP})(?P<v>\+[0-9](?:[ .-]?\(?[0-9]\)?){{6,14}})" + _STOP, phone),
    ("ip", rf"{_EDGE}(?P<v>[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}){_STOP}", ip),
    ("date", rf"{_EDGE}(?P<v>[0-9]{{4}}(?P<m>[-./])[0-9]{{2}}(?P=m)[0-9]{{2}}"
             rf"|[0-9]{{2}}(?P<n>[-./])[0-9]{{2}}(?P=n)[0-9]{{4}})(?:{_STOP}|(?=[Tt][0-9]{{2}}))", date),
    ("ip", r"(?<![\w:.])(?P<v>(?=[0-9A-Fa-f:]*[0-9])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,8})(?![\w:])", ip6),
    *[("date", rf"(?i)(?<![\w.-])(?P<v>{form.format(m='(?:' + '|'.join(_MONTHS[lang]) + ')')})(?!\w)", _named(lang))
      for lang, form in (("en", "{m} [0-9]{{1,2}}, [0-9]{{4}}"), ("en", "[0-9]{{1,2}} {m},? [0-9]{{4}}"),
                         ("de", r"[0-9]{{1,2}}\. {m} [0-9]{{4}}"), ("fr", "[0-9]{{1,2}} {m} [0-9]{{4}}"),
                         ("es", "[0-9]{{1,2}} de {m} de [0-9]{{4}}"))],
    ("email", r"(?<![\w.%+-])(?P<v>[^\W_][\w.%+-]*@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*"
              r"\.[^\W\d_]{2,})", email),
    ("secret", rf"(?<![\w-])(?P<v>{_SIGNED_TOKEN})(?![\w-])", secret),
    ("secret", rf"(?<!\w)(?P<v>{_KEYS})(?!\w)", secret),
    ("secret", r"(?i)(?<!\w)bearer\s{1,3}(?P<v>(?=[^\s0-9]*[0-9])[A-Za-z0-9._~+/-]{16,}=*)", secret),
    ("secret", r"-----BEGIN (?P<k>[A-Z0-9 ]{0,40}PRIVATE KEY)-----\s+(?:[A-Za-z-]{1,40}: [^\n]*\n)*"
               r"(?P<v>[A-Za-z0-9+/=\s]+)-----END (?P=k)-----", secret),
    ("secret", rf"(?i)(?<![A-Za-z0-9]){_SECRET_NAMES}(?:[_-](?:access[_-])?key)?\s{{0,3}}[=:]\s{{0,3}}[\"']?"
               r"(?P<v>[^\s\"']{6,})", secret),
]
_MAY_HOLD = re.compile(rf"[0-9@]|AKIA|gh[pousr]_|github_pat_|sk-|AIza|eyJ|PRIVATE KEY|(?i:{_SECRET_NAMES})").search
_COMPILED = [(kind, re.compile(pattern), fn) for kind, pattern, fn in FINDERS]
# digit groups with one blank, breaking or not, or hyphen between
_DIGIT_GROUPS, _GROUP = re.compile(rf"{_EDGE}[0-9]+(?:[ \u00a0\u2007\u202f-][0-9]+)*"), re.compile("[0-9]+")
_AT_STOP = re.compile(_STOP).match
_IBAN_HEAD = re.compile(r"(?:^|\W)([A-Z]{2})[0-9]{2} $").search


def _matches(text: str, kind: str, pattern: re.Pattern, fn: Callable, key: bytes,
             undo: bool) -> Iterator[tuple[int, int, str]]:
    """(start, end, pseudonym) of one finder's valid values, from the left."""
    at = 0
    while m := pattern.search(text, at):
        v, (start, end) = m.group("v"), m.span("v")
        at = start + 1
        for n in _iban_ends(v) if kind == "iban" else [end - start]:
            new = fn(v[:n], key, undo)
            if new is not None:
                yield start, start + n, new
                at = start + n
                break


def find(text: str, key: bytes, undo: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the values in a text, in order."""
    if not _MAY_HOLD(text):
        return []
    spans = list(_card_spans(text))
    found, taken = [], []
    # in the groups of cards, those that begin as the common cards do first
    for start, end, grouped, _ in sorted(spans, key=lambda x: (
            text[x[0]] not in "3456", x[0], -x[1] if text[x[0]] == "6" else x[1])):
        if not grouped:
            continue
        at = bisect_left(taken, (start, end))
        if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (start, end))
        found.append((start, -end, -1, "card", card(text[start:end], key, undo)))
    for rank, (kind, pattern, fn) in enumerate(_COMPILED):
        found += [(start, -end, rank, kind, new)
                  for start, end, new in _matches(text, kind, pattern, fn, key, undo)]
    out, done = [], 0
    for start, end, _, kind, new in sorted(found):
        if start >= done:
            out.append((start, -end, kind, new))
            done = -end
    odd = sorted((start, -end, one) for start, end, grouped, one in spans if not grouped)
    return _with_odd_cards(text, out, odd, key, undo) if odd else out


def _with_odd_cards(text: str, found: list[tuple[int, int, str, str]], odd: list[tuple[int, int, bool]],
                    key: bytes, undo: bool) -> list[tuple[int, int, str, str]]:
    """Finds and cards in other groups, which give way to finds that they cut
    and, if their separators are mixed, to all finds."""
    starts, ends = [f[0] for f in found], [f[1] for f in found]
    out, done, used = [], 0, 0
    for start, end, one in odd:
        end = -end
        lo, hi = bisect_right(ends, start), bisect_left(starts, end)
        if start < done or lo < hi and (not one or starts[lo] < start or ends[hi - 1] > end
                                        or any(f[2] == "card" for f in found[lo:hi])):
            continue
        out += [*found[used:lo], (start, end, "card", card(text[start:end], key, undo))]
        done, used = end, hi
    return [*out, *found[used:]]


def replace(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, done = [], 0
    for start, end, _, new in found:
        out += [text[done:start], new]
        done = end
    return "".join([*out, text[done:]])


PII = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                T.StructField("length", T.IntegerType())]))


def pseudonymize(df: DataFrame, key: str, text_col: str = "text", keep: list[str] | None = None,
                 undo: bool = False) -> DataFrame:
    """Input columns in their order with the text replaced, then ``pii``: kind,
    start and length (code points) of every replaced value."""
    secret_key = hashlib.blake2b(key.encode(), digest_size=32).digest()
    passed = [c for c in (df.columns if keep is None else keep) if c.lower() != "pii"]
    made = T.StructType([T.StructField("__new_text", T.StringType()), T.StructField("pii", PII)])

    def make():
        def run(texts):
            found = [find(t, secret_key, undo) if t else [] for t in texts]
            return [[replace(t, f) if f else t for t, f in zip(texts, found)],
                    pa.array([[{"kind": k, "start": s, "length": e - s} for s, e, k, _ in f] for f in found],
                             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                                 ("length", pa.int32())])))]
        return run
    carried = [c for c in passed if c != text_col]
    out = add_text_columns(df, text_col, made, make, keep=carried)
    return out.select(*[F.col("__new_text").alias(text_col) if c == text_col else F.col(quoted(c))
                        for c in passed], "pii")
