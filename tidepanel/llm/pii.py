"""Format-preserving pseudonyms: personal values permuted within their own format by a keyed Feistel cipher.

A value is found by pattern, validated (checksums, ranges, calendar), read as a number of its format's domain, permuted by
a Feistel network with cycle walking, and written back in the same format. Equal values therefore get equal pseudonyms in
every document and task without a shared table, different ones stay different, and who holds the key can reverse it.
Card numbers keep their issuer's digit and a valid check digit, dates stay dates, phone numbers keep their country.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.llm.common import query, table, texts

ROUNDS = 8
# For the registered query only; callers give their own.
QUERY_KEY = b"pseudonyms of the registered query"

FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Feistel:
    """Permutations of 0..n-1, one for each (key, purpose, n)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()

    def _round(self, purpose: str, size: int, n: int, half: int, bits: int) -> int:
        text = f"{purpose}|{size}|{n}|{half}".encode()
        out, block = b"", 0
        while len(out) * 8 < bits:
            out += hashlib.blake2b(text + b"|%d" % block, key=self.key).digest()
            block += 1
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def permute(self, value: int, size: int, purpose: str, back: bool = False) -> int:
        """The value's image among 0..size-1; walks on while the network leaves the domain."""
        if size < 2:
            return value
        bits = ((size - 1).bit_length() + 1) // 2
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            if back:
                for n in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(purpose, size, n, left, bits), left
            else:
                for n in range(ROUNDS):
                    left, right = right, left ^ self._round(purpose, size, n, right, bits)
            value = left << bits | right
            if value < size:
                return value


def luhn_digit(payload: str) -> str:
    """Check digit that makes payload + digit valid."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        n = int(c) * (2 - i % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def refill(template: str, symbols: str) -> str:
    """``template`` with its letters and digits replaced in turn, separators kept."""
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in template)


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = "0123456789abcdef"
_PIECE = 64


def permute_symbols(f: Feistel, text: str, purpose: str, classes: tuple[str, ...] = _CLASSES, back: bool = False) -> str:
    """Permutes text among all texts whose symbols have the same classes; other characters stay.

    Long texts go in pieces, each by a permutation of its own that the pseudonym of the piece before chooses: linear in the length.
    """
    if len(text) > _PIECE:
        out, before = [], ""
        for i in range(0, len(text), _PIECE):
            piece = text[i : i + _PIECE]
            new = permute_symbols(f, piece, f"{purpose}/{i}/{before}", classes, back)
            out.append(new)
            before = piece if back else new
        return "".join(out)
    held = [next((k for k in classes if c in k), c) for c in text]
    value, size = 0, 1
    for c, k in zip(text, held):
        value, size = value * len(k) + k.index(c), size * len(k)
    shape = "".join(k[0] if len(k) > 1 else k for k in held)
    value = f.permute(value, size, f"{purpose}:{shape}", back)
    out = []
    for k in reversed(held):
        value, i = divmod(value, len(k))
        out.append(k[i])
    return "".join(reversed(out))


# Each kind: value -> pseudonym, or None if the value is not valid.


def card(f: Feistel, text: str, back: bool = False) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    inner = permute_symbols(f, digits[1:-1], "card" + digits[0], back=back)
    payload = digits[0] + inner
    return refill(text, payload + luhn_digit(payload))


def phone(f: Feistel, text: str, back: bool = False) -> str | None:
    digits = re.sub(r"\D", "", text)
    if digits.startswith("1") and len(digits) == 11 or len(digits) == 10 and not text.startswith("+"):
        country, number = digits[:-10], digits[-10:]
        if number[0] < "2" or number[3] < "2":
            return None
        value = (int(number[:3]) - 200) * 8_000_000 + (int(number[3:6]) - 200) * 10_000 + int(number[6:])
        value = f.permute(value, 800 * 800 * 10_000, "phone", back)
        area, rest = divmod(value, 8_000_000)
        return refill(text, f"{country}{area + 200}{rest // 10_000 + 200}{rest % 10_000:04d}")
    if not text.startswith("+") or not 8 <= len(digits) <= 15:
        return None
    return refill(text, digits[:2] + permute_symbols(f, digits[2:], "phone" + digits[:2], back=back))


def social(f: Feistel, text: str, back: bool = False) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    value = f.permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "social", back)
    value, serial = divmod(value, 9999)
    place, group = divmod(value, 99)
    return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(f: Feistel, text: str, back: bool = False) -> str | None:
    plain = re.sub(r"\s", "", text)
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1 or not 2 <= int(plain[2:4]) <= 98:
        return None
    account = permute_symbols(f, plain[4:], "iban" + plain[:2], back=back)
    return refill(text, f"{plain[:2]}{98 - _mod97(account + plain[:2] + '00'):02d}{account}")


def address(f: Feistel, text: str, back: bool = False) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = f.permute(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, "address", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def email(f: Feistel, text: str, back: bool = False) -> str | None:
    name, _, ending = text.lower().rpartition(".")
    return f"{permute_symbols(f, name, 'email', back=back)}.{ending}"


def day(f: Feistel, text: str, back: bool = False) -> str | None:
    parts = re.split(r"[-./]", text)
    a, b, c = (int(p) for p in parts)
    year_first = len(parts[0]) == 4
    # Day first with points or if there is no such month, month first with slashes and hyphens.
    day_first = not year_first and ("." in text or a > 12)
    y, m, d = (a, b, c) if year_first else (c, b, a) if day_first else (c, a, b)
    try:
        number = datetime.date(y, m, d).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= number <= LAST_DAY:
        return None
    # Month-first dates must not become readable as day-first: they keep to days up to the twelfth or beyond alike.
    early = None if year_first or "." in text else d <= 12
    # Days and months written with one digit keep one.
    one_day, one_month = (False, False) if year_first else (len(parts[not day_first]) == 1, len(parts[day_first]) == 1)
    alike = _days(early, one_day, one_month)
    purpose = "day" + ("" if early is None else str(early)) + "d" * one_day + "m" * one_month
    new = datetime.date.fromordinal(alike[f.permute(bisect_left(alike, number), len(alike), purpose, back)])
    order = (new.year, new.month, new.day) if year_first else (new.day, new.month, new.year) if day_first else (new.month, new.day, new.year)
    first, second, third = (f"{n:0{len(p)}d}" for n, p in zip(order, parts))
    separators = re.findall(r"[-./]", text)
    return f"{first}{separators[0]}{second}{separators[1]}{third}"


@functools.cache
def _days(early: bool | None, one_day: bool, one_month: bool) -> list[int]:
    """Days up to the twelfth of their month or beyond (None: all), with a day or month of one digit where that is asked for."""
    every = ((n, datetime.date.fromordinal(n)) for n in range(FIRST_DAY, LAST_DAY + 1))
    return [n for n, d in every if (early is None or (d.day <= 12) == early) and (d.day < 10 or not one_day) and (d.month < 10 or not one_month)]


def access_key(f: Feistel, text: str, back: bool = False) -> str | None:
    return text[:4] + permute_symbols(f, text[4:], "access_key", ("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",), back)


def secret(f: Feistel, text: str, back: bool = False) -> str | None:
    name, value = re.fullmatch(r"(.*?[=:]\s*[\"']?)([^\"'\s]+)", text, re.S).groups()
    classes = (_HEX,) if set(value) <= set(_HEX) else _CLASSES
    return name + permute_symbols(f, value, "secret", classes, back)


KINDS: dict[str, tuple[str, Callable[..., str | None]]] = {
    # From the beginning of a token, with parts of bounded length, so that no run is scanned from each of its places.
    "email": (r"(?<![A-Za-z0-9])[A-Za-z0-9][\w.+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z])", email),
    "secret": (r"(?i:password|passwd|token|secret|api_?key)\s*[=:]\s*[\"']?[A-Za-z0-9/+_.-]{8,}", secret),
    "access_key": (r"\bAKIA[A-Z0-9]{16}\b", access_key),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    "address": (r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)", address),
    "day": (r"(?<![\w./-])(?:\d{4}-\d\d-\d\d(?=T\d\d)|(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d?\.\d\d?\.\d{4}|\d\d?/\d\d?/\d{4}|\d\d-\d\d-\d{4})(?![\w/-]|\.\d))", day),
    "social": (r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])", social),
    "card": (r"(?<![\w+])\d(?:[ -]?\d){12,18}(?![\w])", card),
    "phone": (r"(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])|(?<![\w.-])\d{3}\.\d{3}\.\d{4}(?![\w-]|\.\d)", phone),
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))
_EACH = {k: re.compile(p) for k, (p, _) in KINDS.items()}
# Every pattern needs one of these.
_HINT = re.compile(r"[0-9@]|(?i:password|passwd|token|secret|api_?key)\s*[=:]")

# Characters of an IBAN by country, from the registry.
_IBAN_LENGTHS = {
    k: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 33: "RU", 32: "LC",
    }.items()
    for k in countries.split()
}
# Digits after the country code where all numbers of the country have as many.
_PHONE_LENGTHS = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "47": 8, "48": 9, "61": 9, "86": 11, "91": 10, "351": 9}
_CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), *((n,) for n in range(13, 20))}


@functools.lru_cache(10_000)
def _shorter_ends(text: str) -> list[str]:
    """``text`` up to each of its tokens, longest first, the whole left out."""
    return [text[: m.end()] for m in list(re.finditer(r"[A-Za-z0-9]+\)?", text))[-2::-1]]


def _iban_ends(text: str) -> list[str]:
    length = _IBAN_LENGTHS.get(text[:2])
    if length is None:
        return [text, *_shorter_ends(text)]
    at = 0
    for n, c in enumerate(text):
        at += not c.isspace()
        if at == length:
            # The country's length comes first; inside a token it is no end.
            return [text[: n + 1], text] if n + 1 < len(text) and text[n + 1].isspace() else [text]
    return [text]


@functools.lru_cache(10_000)
def _card_ends(text: str) -> list[str]:
    """The whole, then shorter ends; of these only common groupings if a card of such grouping begins later in ``text``."""
    spans = [m.span() for m in re.finditer(r"\d+", text)]
    sizes = tuple(b - a for a, b in spans)
    long_enough = next((i for i, n in enumerate(sizes) if n < 3), len(sizes))  # groups before one of fewer than three digits
    ends = [j for j in range(min(len(sizes) - 1, long_enough), 0, -1) if sum(sizes[:j]) >= 13]
    usual = [j for j in ends if sizes[:j] in _CARD_GROUPS]
    later = ((i, j) for i in range(1, len(sizes)) for j in range(len(sizes), i, -1) if sizes[i:j] in _CARD_GROUPS)
    if len(ends) > len(usual) and any(_is_card(text[spans[i][0] : spans[j - 1][1]]) for i, j in later):
        return [text, *(text[: spans[j - 1][1]] for j in usual)]
    return [text, *(text[: spans[j - 1][1]] for j in [*usual, *(e for e in ends if e not in usual)])]


def _is_card(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1


def _phone_ends(text: str) -> list[str]:
    """Where the number ends by its country's length, or after six digits without a gap; then the whole and what is shorter."""
    ends = _shorter_ends(text)
    if not text.startswith("+"):
        return [text]
    digits = re.sub(r"\D", "", text)
    code = next((c for c in (digits[:n] for n in (1, 2, 3)) if c in _PHONE_LENGTHS), None)
    if code:
        wanted = len(code) + _PHONE_LENGTHS[code]
        fit = [e for e in (text, *ends) if len(re.sub(r"\(0\)|\D", "", e)) == wanted]
    else:
        m = re.match(r"\+\d{1,3}(?!\d).*?(?<!\d)\d{6,}(?![\d-])", text)
        fit = [m[0]] if m else []
    return list(dict.fromkeys([*fit, text, *ends]))


_ENDS: dict[str, Callable[[str], list[str]]] = {"iban": _iban_ends, "card": _card_ends, "phone": _phone_ends}


class Pseudonyms:
    """Replaces personal values in texts; values met before are remembered up to a bounded number."""

    def __init__(self, key: bytes):
        feistel = Feistel(key)
        self.value = functools.lru_cache(100_000)(lambda kind, text: KINDS[kind][1](feistel, text))

    def _at(self, text: str, first: re.Match) -> tuple[str, int, str] | None:
        """Kind, end and pseudonym of a valid value where ``first`` begins: of its kind or a later one, whole or with a shorter end."""
        kinds = list(KINDS)
        for kind in kinds[kinds.index(first.lastgroup) :]:
            m = first if kind == first.lastgroup else _EACH[kind].match(text, first.start())
            if m:
                for value in _ENDS[kind](m[0]) if kind in _ENDS else [m[0]]:
                    if (new := self.value(kind, value)) is not None:
                        return kind, m.start() + len(value), new
        return None

    def apply(self, text: str) -> tuple[str, Counter]:
        counts: Counter = Counter()
        if not _HINT.search(text):
            return text, counts
        out, done, at = [], 0, 0
        while m := _ANY.search(text, at):
            found = self._at(text, m)
            if found is None:
                at = m.start() + 1  # a valid value can begin inside; the patterns see to it that it does so at a token
                continue
            kind, end, new = found
            out += [text[done : m.start()], new]
            done = at = end
            counts[kind] += 1
        return "".join([*out, text[done:]]), counts


def pseudonymise(docs: DataFrame, key: bytes, *, column: str = "text", counts: str | None = None) -> DataFrame:
    """``docs`` with the personal values of ``column`` replaced, same columns and rows.

    ``counts`` names an added map column with the number of replaced values by kind. A null text stays null; empty texts,
    repeated rows and empty tables stay as they are; values that fail validation are left alone. Values are
    linked as written: letter case of an address of mail is ignored, other spellings of a number keep their separators
    and the same digits. Time is linear in the text, also in long runs of digits, letters or signs. Not looked for: addresses of mail with
    other than ASCII letters or parts of over 64 characters, IBANs in small letters.
    """
    kinds = pa.map_(pa.string(), pa.int64())
    names = [f"c{i}" for i in range(len(docs.columns))]  # positions: column names may clash in case
    at = docs.columns.index(column)
    schema = T.StructType([*[T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)]])
    if counts:
        schema = schema.add("counts", T.MapType(T.StringType(), T.LongType()))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key)
        for part, rows in texts(batches, names[at]):
            found = [pseudonyms.apply(t) for t in rows]
            known = part.column(at).is_valid().to_pylist()
            columns = part.columns
            columns[at] = pa.array([t if k else None for (t, _), k in zip(found, known)], pa.string())
            if counts:
                columns.append(pa.array([sorted(c.items()) for _, c in found], kinds))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    out = docs.toDF(*names).mapInArrow(replace, schema)
    return out.toDF(*docs.columns, *[counts] * bool(counts))


@query()
def op10_pii_pseudonyms(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its personal values replaced, and how many there were by kind."""
    docs = table(spark, d, "documents")
    found = pseudonymise(docs, QUERY_KEY, counts="replaced")
    counts = [F.coalesce(F.col("replaced")[k], F.lit(0)).alias(f"n_{k}") for k in KINDS]
    return found.select(*docs.columns, *counts)
