"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Found values that pass their check (Luhn, mod 97, calendar, octets, assigned ranges) are numbered within the
valid values of their format, the number is permuted by a balanced Feistel network over a power of four
(ROUNDS rounds of keyed BLAKE2b, walked until it falls into the range again), and the result is written in
the same format: separators, lengths and letter cases stay, check digits are made anew. The permutation
depends on key, kind and size only, so equal values have equal pseudonyms in all documents, different
values different ones, and whoever holds the key can take them back. Dates are numbered by day, so one day
written in several formats stays one day. Days are permuted among those that look the same (day below 10, from 10 to 12, above; month below 10
or not; 1,800 days at least): a date with slashes or hyphens that has only one reading keeps it, and one without leading zeros
comes back as it was. Where both readings are possible, slashes mean month first and hyphens day first.

Kinds: card, iban, ssn, phone, ip, date, email (the part before the @), secret (hexadecimal keys). Numbers that
fail their check are left as they are; shorter forms of them and what starts at their later words are tried then. Phone numbers are
numbered by the digits behind the country code, so one number written in several forms stays one number; national forms are those of
ten digits, (ddd) ddd-dddd and ddd-ddd-dddd. IPv6 addresses are those of the unicast ranges, written in the compressed form. An IBAN in small letters
must have the length of its country.

A month of three letters that becomes May comes back with its whole name.

Defined cases: null stays null; texts without a find are returned unchanged, byte by byte; finds
do not overlap, the one that starts first (then the earlier kind in the list of patterns) wins. Each row has a result of
its own. Extra columns are returned unchanged, except that a column named like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, timedelta
from functools import cache
from hashlib import blake2b
from ipaddress import AddressValueError, IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

_RUN = re.compile(r"[+0-9][0-9 ().\-/]{5,}[0-9]")
_NUMBER_FORMS = (
    r"(?:(?P<ymd>[0-9]{4}(?P<ymd_mark>[-/])[0-9]{2}(?P=ymd_mark)[0-9]{2})|(?P<dmy>[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})|(?P<mdy>[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
    r"|(?P<dmy_hyphen>[0-9]{1,2}-[0-9]{1,2}-[0-9]{4})"
    r"|(?P<ssn>[0-9]{3}(?P<ssn_mark>[- ])[0-9]{2}(?P=ssn_mark)[0-9]{4})|(?P<national>[0-9]{3}(?:\) ?|-)[0-9]{3}-[0-9]{4})|(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})"
    r"|(?P<phone>\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[2-9][0-9]{0,2}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})){2,4})"
    r"|(?P<card>[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}))(?![0-9A-Za-z_])")
_NUMBER = re.compile(r"(?<![\w.+-])" + _NUMBER_FORMS)
#: Within a candidate that failed, a number may also stand behind a hyphen.
_LATER_NUMBER = re.compile(r"(?<![\w.+])" + _NUMBER_FORMS)
_TOKEN = re.compile(r"\+?[0-9]+")
#: Country codes of one and two digits; all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
#: Lengths of the IBANs of a country. They are tried first, so that a word behind an IBAN is not read with it.
_IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 "
    "GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 "
    "PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_SMALL_IBAN = re.compile(r"(?<![0-9A-Za-z])[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?(?![0-9A-Za-z])")
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{3,4}:(?:[0-9A-Fa-f]{0,4}:){1,7}(?:[0-9A-Fa-f]{1,4})?(?![\w:])")
#: Unicast ranges of IPv6: the value of their leading bits and how many these are.
_UNICAST = ((0b001, 3), (0b1111110, 7), (0b1111111010, 10))
_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = "(?P<m>" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in _MONTHS) + ")"
_MONTH_DATES = (
    re.compile(r"(?<![\w.,/-])(?P<d>[0-9]{1,2}) " + _MONTH + r" (?P<y>[0-9]{4})(?![\w/-])"),
    re.compile(r"(?<!\w)" + _MONTH + r" (?P<d>[0-9]{1,2}),? (?P<y>[0-9]{4})(?![\w/-])"))
_EMAIL = re.compile(r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]{32})[0-9a-fA-F]{32,128}(?![0-9A-Za-z])")


class Permutation:
    """Keyed permutations of the numbers below any size."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, size: int, k: int, half: int, mask: int) -> int:
        given = f"{kind}:{size}:{k}:{half}".encode()
        width = (mask.bit_length() + 7) // 8 + 8
        out, block = b"", 0
        while len(out) < width:
            out += blake2b(given + b":%d" % block, key=self.key, digest_size=64).digest()
            block += 1
        return int.from_bytes(out[:width], "big") & mask

    def _walk(self, kind: str, size: int, value: int, rounds: range) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        back = rounds.step < 0
        while True:
            left, right = value >> half, value & mask
            for k in rounds:
                left, right = (right ^ self._round(kind, size, k, left, mask), left) if back else (right, left ^ self._round(kind, size, k, right, mask))
            value = left << half | right
            if value < size:
                return value

    def forward(self, kind: str, size: int, value: int) -> int:
        return self._walk(kind, size, value, range(ROUNDS)) if size > 1 else value

    def backward(self, kind: str, size: int, value: int) -> int:
        return self._walk(kind, size, value, range(ROUNDS - 1, -1, -1)) if size > 1 else value


Map = Callable[[str, int, int], int]


def _luhn(digits: str) -> int:
    """The check digit behind `digits`."""
    doubled = (int(d) * (2 - k % 2) for k, d in enumerate(reversed(digits)))
    return -sum(x // 10 + x % 10 for x in doubled) % 10


def _refill(shape: str, chars: str) -> str:
    """`shape` with its letters and digits replaced in order."""
    left = iter(chars)
    return "".join(next(left) if c.isalnum() else c for c in shape)


def _classes(chars: str, alphabet: Callable[[str], str]) -> tuple[int, int]:
    """Size of the format and number of `chars` in it, in mixed radix."""
    size, value = 1, 0
    for c in chars:
        symbols = alphabet(c)
        size, value = size * len(symbols), value * len(symbols) + symbols.index(c)
    return size, value


def _written(value: int, chars: str, alphabet: Callable[[str], str]) -> str:
    out = []
    for c in reversed(chars):
        symbols = alphabet(c)
        value, k = divmod(value, len(symbols))
        out.append(symbols[k])
    return "".join(reversed(out))


def _alnum(c: str) -> str:
    return "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _mixed(kind: str, chars: str, mapped: Map, alphabet: Callable[[str], str] = _alnum) -> str:
    size, value = _classes(chars, alphabet)
    return _written(mapped(kind, size, value), chars, alphabet)


def _card(found: str, mapped: Map) -> str | None:
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or _luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = _mixed("card", digits[:-1], mapped)
    return _refill(found, body + str(_luhn(body)))


def _ssn(found: str, mapped: Map) -> str | None:
    area, group, serial = (int(x) for x in re.split("[- ]", found))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = mapped("ssn", 898 * 99 * 9999, ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1)
    rest, serial = divmod(value, 9999)
    area, group = divmod(rest, 99)
    area += 1 + (area >= 665)
    return _refill(found, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


def _ip(found: str, mapped: Map) -> str | None:
    octets = [int(x) for x in found.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in found.split(".")):
        return None
    return ".".join(str(b) for b in mapped("ip", 1 << 32, int.from_bytes(bytes(octets), "big")).to_bytes(4, "big"))


def _phone(found: str, mapped: Map) -> str | None:
    """The digits behind the country code are permuted, and a trunk zero in brackets stays, so that all forms of a number are linked."""
    digits = re.sub(r"\D", "", found)
    size = next((n for n in (1, 2) if digits[:n] in _CODES), 3)
    code = re.match(r"\+(?:[^0-9]*[0-9]){%d}(?:[ .-]?\(0\))?" % size, found)[0]
    rest = found[len(code):]
    own = re.sub(r"\D", "", rest)
    return code + _refill(rest, _mixed("phone", own, mapped)) if len(digits) >= 7 and 4 <= len(own) <= 14 else None


def _ipv6(found: str, mapped: Map) -> str | None:
    try:
        value = int(IPv6Address(found))
    except AddressValueError:
        return None
    for lead, bits in _UNICAST:
        size = 1 << 128 - bits
        if value // size == lead:
            new = str(IPv6Address(lead * size + mapped(f"ipv6/{bits}", size, value % size)))
            return new.upper() if any(c.isupper() for c in found) else new
    return None


def _national(found: str, mapped: Map) -> str:
    return _refill(found, _mixed("phone", re.sub(r"\D", "", found), mapped))


def _look(day: date) -> tuple[bool, bool, bool]:
    """What shows in the written forms of a day: parts of one digit, and whether the day can be taken for a month."""
    return day.day < 10, day.day > 12, day.month < 10


@cache
def _days() -> tuple[dict[tuple, list[date]], dict[date, int]]:
    """All days by their look, and the place of each among those of its look."""
    by_look, place = {}, {}
    for k in range((LAST_DAY - FIRST_DAY).days + 1):
        day = FIRST_DAY + timedelta(k)
        same = by_look.setdefault(_look(day), [])
        place[day] = len(same)
        same.append(day)
    return by_look, place


def _other_day(day: date, mapped: Map) -> date:
    """The pseudonym of a day, one that looks the same."""
    (by_look, place), look = _days(), _look(day)
    return by_look[look][mapped("date/%d%d%d" % look, len(by_look[look]), place[day])]


def _day_of(year: int, month: int, day: int) -> date | None:
    try:
        found = date(year, month, day)
    except ValueError:
        return None
    return found if FIRST_DAY <= found <= LAST_DAY else None


def _day(*orders: str) -> Callable[[str, Map], str | None]:
    """A date in the first of `orders` in which it is one."""
    def change(found: str, mapped: Map) -> str | None:
        mark = re.search("[^0-9]", found)[0]
        numbers = found.split(mark)
        for order in orders:
            parts = dict(zip(order, numbers))
            day = _day_of(int(parts["y"]), int(parts["m"]), int(parts["d"]))
            if day:
                new = _other_day(day, mapped)
                padded = all(len(p) > 1 for p in numbers)
                values = {"y": f"{new.year:04d}", "m": f"{new.month:02d}" if padded else str(new.month), "d": f"{new.day:02d}" if padded else str(new.day)}
                return mark.join(values[c] for c in order)
        return None

    return change


def _month_date(m: re.Match, mapped: Map) -> str | None:
    """A date with the name of its month, whole or of three letters."""
    short = len(m["m"]) == 3 and m["m"] != "May"
    day = _day_of(int(m["y"]), next(k for k, x in enumerate(_MONTHS, 1) if x.startswith(m["m"])), int(m["d"]))
    if day is None:
        return None
    new, out, at = _other_day(day, mapped), [], m.start()
    name = _MONTHS[new.month - 1]
    written = {"d": f"{new.day:02d}" if m["d"][0] == "0" else str(new.day), "m": name[:3] if short else name, "y": str(new.year)}
    for c in sorted("dmy", key=m.start):
        out += [m.string[at:m.start(c)], written[c]]
        at = m.end(c)
    return "".join(out)


def _iban(found: str, mapped: Map) -> str | None:
    chars = found.replace(" ", "")
    value = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(chars) <= 34 or value(chars[4:] + chars[:4]) % 97 != 1:
        return None
    body = _mixed("iban" + chars[:2], chars[4:], mapped)
    return _refill(found, f"{chars[:2]}{98 - value(body + chars[:2] + '00') % 97:02d}{body}")


def _email(found: str, mapped: Map) -> str:
    name, host = found.split("@")
    return _refill(name, _mixed("email", re.sub(r"[^A-Za-z0-9]", "", name), mapped)) + "@" + host


def _secret(found: str, mapped: Map) -> str:
    upper = any(c.isupper() for c in found)
    new = _mixed("secret", found.lower(), mapped, lambda c: "0123456789abcdef")
    return new.upper() if upper else new


_NUMBERS = {"ymd": ("date", _day("ymd")), "dmy": ("date", _day("dmy")), "mdy": ("date", _day("mdy", "dmy")), "dmy_hyphen": ("date", _day("dmy", "mdy")),
            "ssn": ("ssn", _ssn), "ip": ("ip", _ip), "phone": ("phone", _phone), "national": ("phone", _national), "card": ("card", _card)}


def _numbers(text: str, start: int, end: int, mapped: Map) -> list[tuple[int, int, str, str]]:
    """The valid numbers of a run. Behind a failed candidate shorter forms of it are tried, then its later tokens."""
    out, at, failed = [], start, start
    tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
    for k, (first, _) in enumerate(tokens):
        pattern = _LATER_NUMBER if first < failed else _NUMBER
        if first < at or not (m := pattern.match(text, first, end)):
            continue
        tried = m.end()
        shorter = [e for _, e in tokens[k:k + 12] if e < tried]
        for m in (m, *(pattern.fullmatch(text, first, e) for e in reversed(shorter))):
            if m:
                kind, change = _NUMBERS[next(g for g in _NUMBERS if m[g] is not None)]
                new = change(m[0], mapped)
                if new is not None:
                    out.append((*m.span(), kind, new))
                    at = m.end()
                    break
        else:
            failed = max(failed, tried)
    return out


def _small_iban(found: str, mapped: Map) -> str | None:
    """An IBAN in small letters, of the length of its country, as there are words that look like one."""
    known = len(found.replace(" ", "")) == _IBAN_LENGTHS.get(found[:2].upper())
    new = _iban(found.upper(), mapped) if known else None
    return new and new.lower()


def _ibans(text: str, mapped: Map, pattern: re.Pattern = _IBAN, change: Callable[[str, Map], str | None] = _iban) -> list[tuple[int, int, str, str]]:
    """The valid IBANs: of each candidate the length of its country, then the longest; behind a failed one its later tokens."""
    out, at = [], 0
    while m := pattern.search(text, at):
        first, at = m.start(), m.end()
        blanks = [m.start() + k for k, c in enumerate(m[0]) if c == " "]
        ends = sorted([*blanks, at], key=lambda e: (e - first - text.count(" ", first, e) != _IBAN_LENGTHS.get(m[0][:2].upper()), -e))
        for e in ends:
            if (n := pattern.fullmatch(text, first, e)) and (new := change(n[0], mapped)) is not None:
                out.append((first, e, "iban", new))
                at = e
                break
        else:
            at = blanks[0] if blanks else at
    return out


def finds(text: str, mapped: Map) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every valid value, in order, not overlapping."""
    found = []
    for run in _RUN.finditer(text):
        found += _numbers(text, run.start(), min(len(text), run.end() + 1), mapped)
    found += [(*m.span(), "secret", _secret(m[0], mapped)) for m in _SECRET.finditer(text)]
    if "@" in text:
        found += [(*m.span(), "email", _email(m[0], mapped)) for m in _EMAIL.finditer(text)]
    found += _ibans(text, mapped) + _ibans(text, mapped, _SMALL_IBAN, _small_iban)
    for pattern, kind, change in ((_IPV6, "ip", lambda m, to: _ipv6(m[0], to)), *((p, "date", _month_date) for p in _MONTH_DATES)):
        found += [(*m.span(), kind, new) for m in pattern.finditer(text) if (new := change(m, mapped)) is not None]
    out, end = [], 0
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if f[0] >= end:
            out.append(f)
            end = f[1]
    return out


def pseudonymise(text: str, mapped: Map) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and their places in it."""
    parts, spans, at, size = [], [], 0, 0
    for start, end, kind, new in finds(text, mapped):
        parts += [text[at:start], new]
        size += start - at
        spans.append({"kind": kind, "start": size, "end": size + len(new)})
        size, at = size + len(new), end
    return ("".join([*parts, text[at:]]), spans) if parts else (text, [])


_RESULT = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def with_pseudonyms(docs: DataFrame, key: bytes, text: str = "text", column: str = "private") -> DataFrame:
    """`docs` with (text, spans): the text with pseudonyms and where (in characters) they are."""
    def change(texts: pa.Array) -> pa.Array:
        mapped, out = Permutation(key).forward, []
        for t in texts.to_pylist():
            new, spans = (None, []) if t is None else pseudonymise(t, mapped)
            out.append({"text": new, "spans": spans})
        return pa.array(out, _RESULT)

    returns = "struct<text:string,spans:array<struct<kind:string,start:bigint,end:bigint>>>"
    return docs.withColumn(column, F.arrow_udf(change, returns).asNondeterministic()(F.col(text).cast("string")))
