"""PII: values are found, validated, and replaced by keyed permutations within their own format."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise.functions.text import let
from regwise.llm.common import free

ROUNDS = 8
# Runs of characters (first code point, length) that are permuted within themselves: digits, Latin, Greek, Cyrillic,
# Hebrew, Arabic and Devanagari letters, kana, Han and Hangul.
DIGITS, LOWER, UPPER = (0x30, 10), (0x61, 26), (0x41, 26)
LETTERS = (DIGITS, LOWER, UPPER, (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x100, 128), (0x391, 17), (0x3A3, 7), (0x3B1, 25), (0x410, 32), (0x430, 32),
           (0x5D0, 27), (0x621, 26), (0x641, 10), (0x904, 54), (0x3041, 86), (0x30A1, 90), (0x4E00, 20902), (0xAC00, 11172))
HEX = "0123456789abcdef"
# days from 1900-03-01 to 2100-03-01: 50 whole cycles of four years; their later days lie in 200 years that begin in March
FIRST_DAY, CYCLES, CYCLE, YEARS = "1900-03-01", 50, 1461, 200
LONG_MONTHS = (0, 2, 4, 5, 7, 9, 10)  # months of 31 days, counted from March
LEAP_YEARS = 49  # 1904 to 2096
MONTH_NAMES = "JanFebMarAprMayJunJulAugSepOctNovDec"

_LETTER = r"\p{L}\p{N}&&[\x00-\uFFFF]"
EMAIL = rf"(?<![{_LETTER}._%+-])[[{_LETTER}]._%+-]++@[[{_LETTER}]-]++(?:\.[[{_LETTER}]-]++)+"
_PHONE_ABROAD = r"(?<![\w+])\+\d{1,3}(?:[ .()-]{0,2}\d){6,14}(?!\d)"
_PHONE_HERE = r"(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])"
ADDRESS = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
ADDRESS_6 = r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}|:)(?![\w:])|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![\w:])"
_MONTH = "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
ISO_DATE, DOT_DATE, SLASH_DATE = r"\d{4}-\d{2}-\d{2}", r"\d{1,2}\.\d{1,2}\.\d{4}", r"\d{1,2}/\d{1,2}/\d{4}"
MONTH_DATE, DAY_MONTH_DATE = rf"{_MONTH} \d{{1,2}},? \d{{4}}", rf"\d{{1,2}} {_MONTH} \d{{4}}"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d+])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
SECRET = r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])"
# The calling codes in use are prefix-free: one or two digits as listed, else three.
CALLING_CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|2[2-6]\d|29\d|35\d|3[78]\d|42[013]|50\d|59\d|6[7-9]\d|8[0578]\d|9[67]\d|99[2-68])"
FIND = "|".join((EMAIL, SECRET, ADDRESS_6, ACCOUNT, _PHONE_ABROAD, ADDRESS, rf"(?<!\d)(?<!\d[-.]){ISO_DATE}(?!\d|[.-]\d)", rf"(?<!\d)(?<!\d[./]){DOT_DATE}(?!\d|[./]\d)",
                 rf"(?<!\d)(?<!\d[./]){SLASH_DATE}(?!\d|[./]\d)", rf"(?<![A-Za-z]){MONTH_DATE}(?!\d)", rf"(?<!\d){DAY_MONTH_DATE}(?!\d)", CARD, _PHONE_HERE, SOCIAL))


def permute(values: Column, moduli: Column, label: str, key: str) -> Column:
    """A keyed permutation of ``values[i]`` in ``0..moduli[i]-1``, all at once.

    A Feistel network: the values stand in two halves, and in turn each half
    has a keyed digest of the other added to it, element by element, modulo
    its own size. Every step can be undone, so distinct values stay distinct.
    """
    def halves(x: Column) -> Column:
        values, moduli = x["v"], x["m"]
        half = F.floor(F.size(values) / 2).cast("int")
        rest = F.size(values) - half
        return F.struct(F.slice(values, 1, half).alias("a"), F.slice(values, half + 1, rest).alias("b"),
                        F.slice(moduli, 1, half).alias("ma"), F.slice(moduli, half + 1, rest).alias("mb"))

    # the halves and their sizes travel in the state, so that each is made once
    start = let(F.struct(values.alias("v"), moduli.alias("m")), halves)

    def add(mine: Column, sizes: Column, other: Column, i: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(label), i.cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ",")), 256)

        def step(pair: Column, j: Column) -> Column:
            drawn = F.conv(F.substring(F.sha2(F.concat(pair["seed"], j.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.pmod(pair["v"] + drawn, pair["m"])
        paired = F.zip_with(mine, sizes, lambda v, m: F.struct(v.alias("v"), m.alias("m"), seed.alias("seed")))
        return F.transform(paired, step)

    def round_(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, add(s["a"], s["ma"], s["b"], i)).otherwise(s["a"]).alias("a"),
                        F.when(even, s["b"]).otherwise(add(s["b"], s["mb"], s["a"], i)).alias("b"), s["ma"].alias("ma"), s["mb"].alias("mb"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda s: F.concat(s["a"], s["b"]))


def _longs(*values: Column) -> Column:
    return F.array(*[v.cast("long") for v in values])


def _characters(text: Column, runs: tuple[tuple[int, int], ...], label: str, key: str) -> Column:
    """``text`` with every character permuted within its run; others stay where they are."""
    known = F.array(*[F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")) for first, n in runs])

    def cell(c: Column) -> Column:
        inside = lambda run: F.ascii(c).between(run["first"], run["first"] + run["n"] - 1)
        return F.struct(c.alias("c"), F.get(F.filter(known, inside), F.lit(0)).alias("run"))

    def written(x: Column, v: Column) -> Column:
        point = v + x["run"]["first"]
        return F.when(x["run"].isNull(), x["c"]).when(x["run"]["first"] < 128, F.chr(point)).otherwise(
            F.decode(F.unhex(F.lpad(F.hex(point), 4, "0")), "UTF-16BE"))

    def moved(cells: Column) -> Column:
        values = F.transform(cells, lambda x: F.coalesce(F.ascii(x["c"]) - x["run"]["first"], F.lit(0)).cast("long"))
        sizes = F.transform(cells, lambda x: F.coalesce(x["run"]["n"], F.lit(1)).cast("long"))
        return F.array_join(F.zip_with(cells, permute(values, sizes, label, key), written), "")
    return let(F.transform(F.split(text, ""), cell), moved)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, characters: Column, place: str = "[0-9]") -> Column:
    """``value`` with the characters of a class replaced in order."""
    def at(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), f"[^{place[1:-1]}]", ""))
        return F.when(c.rlike(place), F.substring(characters, before, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), at), "")


def _luhn(digits: Column, doubled: int) -> Column:
    """The checksum, where every second digit from the right counts double, from place ``doubled`` on."""
    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda s, x: s + x) % 10


def _card(value: Column, key: str) -> tuple[Column, Column]:
    digits = _digits(value)
    payload = _characters(F.substring(digits, F.lit(1), F.length(digits) - 1), (DIGITS,), "card", key)
    valid = F.length(digits).between(13, 19) & (_luhn(digits, 1) == 0)
    return valid, _refill(value, F.concat(payload, ((10 - _luhn(payload, 0)) % 10).cast("string")))


def _phone(value: Column, key: str) -> tuple[Column, Column]:
    """A number with a known calling code and 8 to 15 digits (eleven with code 1 or 7), or one of ten digits; not one digit throughout."""
    digits = _digits(value)
    abroad = value.startswith("+")
    country = F.when(abroad, F.regexp_extract(digits, CALLING_CODE, 0)).otherwise("")
    rest = F.substring(digits, F.length(country) + 1, F.length(digits))
    long_enough = F.when(abroad & ~country.isin("1", "7"), F.length(digits).between(8, 15)).otherwise(F.length(rest) == 10)
    valid = ((country != "") | ~abroad) & long_enough & ~rest.rlike(r"^(\d)\1*$")
    return valid, _refill(value, F.concat(country, _characters(rest, (DIGITS,), "phone", key)))


def _mod_97(characters: Column) -> Column:
    """The remainder of the number written by digits and by letters as 10 to 35."""
    step = lambda s, c: F.when(c.rlike("[0-9]"), s * 10 + F.ascii(c) - 48).otherwise(s * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(characters, ""), F.lit(0), step)


def _account(value: Column, key: str) -> tuple[Column, Column]:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, rest = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    check = lambda new: F.lpad((98 - _mod_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    made = let(_characters(rest, (DIGITS, UPPER), "account", key), lambda new: F.concat(country, check(new), new))
    valid = F.length(plain).between(15, 34) & (_mod_97(F.concat(rest, F.substring(plain, 1, 4))) == 1)
    return valid, let(made, lambda new: _refill(value, new, "[A-Z0-9]"))


def _address(value: Column, key: str) -> tuple[Column, Column]:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    sizes = F.array_repeat(F.lit(256).cast("long"), 4)
    return F.forall(octets, lambda x: x < 256), F.array_join(F.transform(permute(octets, sizes, "address", key), lambda x: x.cast("string")), ".")


def _address_6(value: Column, key: str) -> tuple[Column, Column]:
    """Eight groups, or fewer around one ``::``; the new address is written with all groups."""
    short = F.instr(value, "::") > 0
    filled = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    left, right = filled(F.substring_index(value, "::", 1)), F.when(short, filled(F.substring_index(value, "::", -1))).otherwise(F.array().cast("array<string>"))
    missing = 8 - F.size(left) - F.size(right)
    groups = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    valid = F.when(short, missing >= 1).otherwise(missing == 0) & (F.size(F.split(value, "::")) <= 2) & value.rlike("[0-9]") & value.rlike("^[0-9A-Fa-f]{2}")
    numbers = F.transform(groups, lambda g: F.conv(g, 16, 10).cast("long"))
    moved = let(numbers, lambda n: permute(n, F.array_repeat(F.lit(65536).cast("long"), 8), "address 6", key))
    return valid, F.lower(F.array_join(F.transform(moved, lambda x: F.hex(x)), ":"))


def _moved_day(day: Column, key: str) -> Column:
    """A day permuted among all days."""
    since = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))
    moved = let(_longs(F.floor(since / CYCLE), since % CYCLE), lambda v: permute(v, _longs(F.lit(CYCLES), F.lit(CYCLE)), "date", key))
    return let(moved, lambda m: F.date_add(F.lit(FIRST_DAY).cast("date"), (m[0] * CYCLE + m[1]).cast("int")))


def _moved_late_day(day: Column, key: str) -> Column:
    """A day after the 12th of a month, permuted among such days: those up to the 28th, the 29th and 30th, the 31st, and leap days, each for themselves."""
    of_month = F.day(day)
    made = lambda m, d: F.make_date((1900 + F.floor((m + 2) / 12)).cast("int"), ((m + 2) % 12 + 1).cast("int"), d.cast("int"))

    def moved(values: tuple[Column, ...], sizes: tuple[int, ...], label: str, back: Callable[[Column], Column]) -> Column:
        return let(let(_longs(*values), lambda v: permute(v, _longs(*map(F.lit, sizes)), label, key)), back)

    def by_kind(months: Column) -> Column:
        year, month, long_months = F.floor(months / 12), months % 12, F.array(*map(F.lit, LONG_MONTHS))
        usual = moved((months, of_month - 13), (12 * YEARS, 16), "late", lambda v: made(v[0], v[1] + 13))
        last = moved((year, F.array_position(long_months, month) - 1), (YEARS, len(LONG_MONTHS)), "31st",
                     lambda v: made(v[0] * 12 + F.get(long_months, v[1].cast("int")), F.lit(31)))
        leap = moved(((F.year(day) - 1904) / 4,), (LEAP_YEARS,), "leap", lambda v: F.make_date((v[0] * 4 + 1904).cast("int"), F.lit(2), F.lit(29)))
        late = moved((year, month, of_month - 29), (YEARS, 11, 2), "30th", lambda v: made(v[0] * 12 + v[1], v[2] + 29))
        return F.when(of_month <= 28, usual).when(of_month == 31, last).when(month == 11, leap).otherwise(late)
    return let(((F.year(day) - 1900) * 12 + F.month(day) - 3).cast("int"), by_kind)


def _date(value: Column, key: str) -> Column:
    """A day in the spelling of ``value``; days without leading zeros stay without.

    In a date with slashes the month comes first, unless the first number is
    above 12. Such a day keeps a number above 12, so that no other day's
    pseudonym reads the same.
    """
    iso, dotted, slashed = value.contains("-"), value.contains("."), value.contains("/")
    return let(F.split(value, "[-./, ]+"), lambda parts: _date_of(value, parts, iso, dotted, slashed, key))


def _date_of(value: Column, parts: Column, iso: Column, dotted: Column, slashed: Column, key: str) -> Column:
    at = lambda i: F.get(parts, F.lit(i))
    name_first, plain = at(0).rlike("^[A-Z]"), ~(iso | dotted | slashed)
    named = ((F.instr(F.lit(MONTH_NAMES), F.substring(F.when(name_first, at(0)).otherwise(at(1)), 1, 3)) + 2) / 3).cast("int").cast("string")
    late = slashed & (F.length(at(0)) < 3) & (at(0).try_cast("int") > 12)
    year = F.when(iso, at(0)).otherwise(at(2))
    month = F.when(plain, named).when(slashed & ~late, at(0)).otherwise(at(1))
    of_month = F.when(iso, at(2)).when((slashed & ~late) | (plain & name_first), at(1)).otherwise(at(0))
    day = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(of_month, 2, "0")).try_cast("date")
    short = ~iso & F.exists(parts, lambda p: p.rlike("^[0-9]$"))

    def shown(new: Column) -> Column:
        word = F.when(value.rlike("[A-Za-z]{4}"), F.date_format(new, "MMMM")).otherwise(F.date_format(new, "MMM"))
        d, m, y = F.day(new).cast("string"), F.month(new).cast("string"), F.year(new).cast("string")
        d2, m2 = (F.when(short, x).otherwise(F.lpad(x, 2, "0")) for x in (d, m))
        return (F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dotted, F.concat_ws(".", d2, m2, y)).when(late, F.concat_ws("/", d2, m2, y))
                .when(slashed, F.concat_ws("/", m2, d2, y)).when(name_first, F.concat(word, F.lit(" "), d, F.when(value.contains(","), ", ").otherwise(" "), y))
                .otherwise(F.concat_ws(" ", d, word, y)))

    def moved(day: Column) -> Column:
        return let(F.when(late, _moved_late_day(day, key)).otherwise(_moved_day(day, key)), shown)
    known = lambda day: F.date_diff(day, F.lit(FIRST_DAY).cast("date")).between(0, CYCLES * CYCLE - 1)
    return let(day, lambda x: F.when(known(x), moved(x)))


def _social(value: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.substring(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    moved = permute(_longs(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1), _longs(F.lit(898), F.lit(99), F.lit(9999)), "social", key)
    new_area = F.when(moved[0] >= 665, moved[0] + 2).otherwise(moved[0] + 1)
    return valid, F.format_string("%03d-%02d-%04d", new_area, moved[1] + 1, moved[2] + 1)


def _email(value: Column, key: str) -> tuple[Column, Column]:
    """A local part that holds a letter or digit, before a domain that ends in two letters or more."""
    local = F.substring_index(value, "@", 1)
    valid = local.rlike(r"[\p{L}\p{N}]") & value.rlike(r"\.\p{L}[\p{L}\p{N}-]+$")
    return valid, F.concat(_characters(local, LETTERS, "email", key), F.substring(value, F.length(local) + 1, F.length(value)))


def _secret(value: Column, key: str) -> tuple[Column, Column]:
    """Hexadecimal digits, permuted among all sixteen."""
    digits = F.split(value, "")
    moved = permute(F.transform(digits, lambda c: (F.instr(F.lit(HEX), c) - 1).cast("long")), F.transform(digits, lambda _: F.lit(16).cast("long")), "secret", key)
    return value.rlike("[a-f]"), F.array_join(F.transform(moved, lambda v: F.substring(F.lit(HEX), (v + 1).cast("int"), F.lit(1))), "")


KINDS: tuple[tuple[str, str, Callable[[Column, str], Column | tuple[Column, Column]]], ...] = (
    ("email", "@", _email), ("secret", "^[0-9a-f]{32,64}$", _secret), ("account", "^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$", _account),
    ("phone", r"^[+(]|^\d{3}([.-])\d{3}[.-]\d{4}$", _phone), ("address", r"^\d{1,3}(\.\d{1,3}){3}$", _address), ("address", ":", _address_6),
    ("date", f"^(?:{ISO_DATE}|{DOT_DATE}|{SLASH_DATE}|{MONTH_DATE}|{DAY_MONTH_DATE})$", _date), ("social", r"^\d{3}-\d{2}-\d{4}$", _social), ("card", r"^\d", _card))


def _named(kind: str, value: Column) -> Callable[[Column], Column]:
    return lambda new: F.struct(F.when(new.isNotNull(), kind).alias("kind"), F.coalesce(new, value).alias("text"))


def _replaced(value: Column, key: str) -> Column:
    """``struct<kind, text>``: a valid value's pseudonym, or the value itself without a kind."""
    out = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("text"))
    for kind, pattern, change in reversed(KINDS):
        made = change(value, key)
        new = F.when(made[0], made[1]) if isinstance(made, tuple) else made  # null where it is not valid
        read = let(new, _named(kind, value))
        out = F.when(value.rlike(pattern), read).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", kinds: str | None = None) -> DataFrame:
    """``docs`` with the personal values of ``text`` replaced; all other columns and all rows stay.

    Found, validated and replaced are: mail addresses (the local part's
    letters of many scripts and digits permuted, the domain kept); phone
    numbers with a calling code, or of ten digits in three groups (the code
    kept); IPv4 and IPv6 addresses (the latter written with all groups);
    calendar dates from 1900-03-01 to 2100-03-01, ISO, with dots, slashes or
    English month names, one-digit days and months too; social security
    numbers; payment card numbers that pass their checksum and IBANs that pass
    theirs (the new ones pass it too); long hexadecimal secrets. What fails its
    validation stays as it is. Equal values get equal pseudonyms in every
    document, distinct ones distinct: numbers however they are spaced, days
    however they are spelt, except that day-first dates with slashes are a
    kind of their own. A mail address is known by its local part in full:
    letters outside the scripts listed stay. A null text stays null, an empty
    one empty. ``kinds`` names a column to add with the kinds replaced, in
    order (it takes the place of a column of that name). No row meets another:
    nothing is shuffled, and only texts in which something was found are taken
    apart.
    """
    held = F.col(text).rlike("[0-9@]") & F.col(text).rlike(FIND)
    found = F.when(held, F.transform(F.regexp_extract_all(F.col(text), F.lit(FIND), F.lit(0)), lambda m: _replaced(m, key)))
    name = free("__found", docs)
    rows = docs.select("*", F.inline(F.array(F.struct(found.alias(name)))))
    gaps = F.split(F.col(text), FIND, -1)
    # the gap after the last value has no partner
    joined = F.array_join(F.zip_with(gaps, name, lambda g, v: F.concat(g, F.coalesce(v["text"], F.lit("")))), "")
    new = F.when(F.col(name).isNull(), F.col(text)).otherwise(joined)
    replaced = F.coalesce(F.filter(F.transform(name, lambda v: v["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    changed = {text: new} | ({kinds: replaced} if kinds else {})
    return rows.withColumns(changed).drop(name)
