"""Format-preserving pseudonyms: validated numbers and dates are permuted within their format by a keyed Feistel network.

Equal values get equal pseudonyms in all documents, two values never the same one, and a pseudonym passes the check its
original passed (check digit, octets, calendar). Everything is built-in expressions; the key is a parameter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The shapes of personal data, as Java patterns. The order settles what a stretch of text counts as.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
SECRET = r"(?<![A-Za-z0-9])[0-9a-f]{40}(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])\+1 ?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_FIRST = r"(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9./])"
IBAN_DE = r"(?<![A-Za-z0-9])DE[0-9]{2}(?: ?[0-9]{4}){4} ?[0-9]{2}(?![A-Za-z0-9])"
# Cards by their groupings: 4-4-4-4, as some stand with three more digits, 4-6-5, 4-6-4, and unbroken. Then all else.
CARD_FOURS = r"[0-9]{4}(?:[ -]?[0-9]{4}){3}"
CARD_GROUPED = rf"(?:{CARD_FOURS}[ -]?[0-9]{{3}}|{CARD_FOURS}|[0-9]{{4}}[ -]?[0-9]{{6}}[ -]?[0-9]{{4,5}}|[0-9]{{13,19}})(?![0-9])"
# A place where a card in one of these groupings may begin; it takes no character, so places may lie within each other's cards.
CARD_START = rf"(?<![0-9])(?={CARD_GROUPED})"
# 16 digits whatever their check digit; in fours, only where the number ends with them (an account number may go on).
CARD_SIXTEEN = rf"(?<![0-9])(?:[0-9]{{16}}(?![0-9])|{CARD_FOURS}(?![ -]?[0-9]))"
CARD = r"(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9])"


# ---------------------------------------------------------------- the permutation


def whole(value: Column, by: Column) -> Column:
    """Whole division of longs; a division as doubles goes wrong from 16 digits on."""
    return F.call_function("div", value, by)


def feistel(value: Column, key: str, tweak: str, left: int | Column, right: int | Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 to left * right - 1.

    The value is a pair (a below ``left``, b below ``right``). Rounds in turn add to a a keyed function of b, modulo
    ``left``, and to b one of a, modulo ``right``. Each round can be undone, so the whole is a permutation for any
    sizes, without walking cycles. ``tweak`` sets the formats apart.
    """
    left, right = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (left, right))
    start = F.struct(whole(value, right).alias("a"), (value % right).alias("b"))

    def drawn(r: Column, c: Column) -> Column:
        # 52 bits of a keyed digest: a long in any mode.
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), r.cast("string"), c.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")

    def turn(s: Column, r: Column) -> Column:
        even = F.struct(((s["a"] + drawn(r, s["b"])) % left).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + drawn(r, s["a"])) % right).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: s["a"] * right + s["b"])


def feistel_back(value: Column, key: str, tweak: str, left: int | Column, right: int | Column, rounds: int = ROUNDS) -> Column:
    """The inverse of ``feistel`` under the same key, for whoever may see the originals."""
    left, right = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (left, right))
    start = F.struct(whole(value, right).alias("a"), (value % right).alias("b"))

    def turn(s: Column, r: Column) -> Column:
        def drawn(c: Column, size: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), r.cast("string"), c.cast("string")), 256)
            return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % size

        even = F.struct(F.pmod(s["a"] - drawn(s["b"], left), left).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] - drawn(s["a"], right), right).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)), start, turn, lambda s: s["a"] * right + s["b"])


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def permuted_digits(number: Column, length: Column, key: str, tweak: str) -> Column:
    """The permutation of numbers of ``length`` (1 to 18) digits, as digits."""
    right = F.pow(F.lit(10.0), F.floor(length / 2).cast("double")).cast("long")
    left = F.pow(F.lit(10.0), (length - F.floor(length / 2)).cast("double")).cast("long")
    return F.lpad(feistel(number.cast("long"), key, tweak, left, right).cast("string"), length.cast("int"), F.lit("0"))


def filled(shape: Column, numbers: Column) -> Column:
    """``shape`` with its digits replaced, from the left, by those of ``numbers``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, ch: Column) -> Column:
        digit = ch.between("0", "9")
        nxt = F.when(digit, F.substr(numbers, s["at"], F.lit(1))).otherwise(ch)
        return F.struct(F.concat(s["out"], nxt).alias("out"), (s["at"] + digit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


# ---------------------------------------------------------------- formats


def luhn_check_digit(payload: Column) -> Column:
    """The digit that makes ``payload`` plus it pass the Luhn check."""
    figures = F.reverse(F.filter(F.split(payload, ""), lambda d: d != ""))
    weighed = F.transform(figures, lambda d, i: F.when(i % 2 == 0, 2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    total = F.aggregate(weighed, F.lit(0), lambda a, d: a + d)
    return F.pmod(-total, F.lit(10)).cast("string")


def luhn_valid(number: Column) -> Column:
    return luhn_check_digit(F.substr(number, F.lit(1), F.length(number) - 1)) == F.right(number, F.lit(1))


def moved_failing(number: Column, key: str) -> Column:
    """16 digits that fail the check, permuted among all that do: 15 digits and how far the last is from the right one."""
    payload, last = F.substr(number, F.lit(1), F.lit(15)), F.substr(number, F.lit(16), F.lit(1)).cast("int")
    off = F.pmod(last - luhn_check_digit(payload).cast("int") - 1, F.lit(10))
    rank = payload.cast("long") * 9 + off

    def digits_of(r: Column) -> Column:
        front = F.lpad(whole(r, F.lit(9).cast("long")).cast("string"), 15, "0")
        return F.concat(front, ((luhn_check_digit(front).cast("long") + 1 + r % 9) % 10).cast("string"))

    return F.get(F.transform(F.array(feistel(rank, key, "failing", 9 * 10**7, 10**8)), digits_of), F.lit(0))


def card(m: Column, key: str) -> Column:
    """13 to 19 digits with a right check digit: the digits before it are permuted and the check digit follows."""
    number = digits(m)
    payload = F.substr(number, F.lit(1), F.length(number) - 1)
    moved = permuted_digits(payload, F.length(payload), key, "card")
    checked = filled(m, F.concat(moved, luhn_check_digit(moved)))
    # A number of 16 digits that fails the check is most likely a mistyped card: it is permuted among those that fail.
    plain = filled(m, moved_failing(number, key))
    return F.when(luhn_valid(number), checked).when(F.length(number) == 16, plain).otherwise(m)


def is_card(m: Column) -> Column:
    return luhn_valid(digits(m)) | (F.length(digits(m)) == 16)


def phone(m: Column, key: str) -> Column:
    """A North American number with +1: its ten digits are permuted."""
    national = F.substr(digits(m), F.lit(2), F.lit(10))
    return filled(m, F.concat(F.lit("1"), permuted_digits(national, F.lit(10), key, "phone")))


def ipv4(m: Column, key: str) -> Column:
    """Four octets up to 255: the 32-bit address is permuted."""
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o <= 255)
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o)
    moved = feistel(number, key, "ipv4", 1 << 16, 1 << 16)
    parts = F.transform(F.array(*[F.lit(s).cast("long") for s in (16777216, 65536, 256, 1)]), lambda s: (whole(moved, s) % 256).cast("string"))
    return F.when(valid, F.array_join(parts, ".")).otherwise(m)


def ssn(m: Column, key: str) -> Column:
    """Nine digits as 3-2-4 with an area, group and serial that can be: permuted among all such numbers."""
    area, group, serial = (F.substr(m, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    # 898 areas of 99 groups of 9,999 serials.
    rank = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1) * 9999 + serial - 1

    def shown(r: Column) -> Column:
        block = whole(r, F.lit(9999).cast("long"))
        place = whole(block, F.lit(99).cast("long")) + 1
        parts = ((place + F.when(place >= 666, 1).otherwise(0), 3), (block % 99 + 1, 2), (r % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(v.cast("string"), n, "0") for v, n in parts])

    moved = F.get(F.transform(F.array(feistel(rank, key, "ssn", 898 * 99, 9999)), shown), F.lit(0))
    return F.when(valid, moved).otherwise(m)


def moved_date(day: Column, key: str) -> Column:
    """A date of the same century: its days, 36,524 or 36,525 of them, are permuted among themselves."""
    century = F.floor(F.year(day) / 100) * 100
    first = F.make_date(century.cast("int"), F.lit(1), F.lit(1))
    leap = century % 400 == 0
    # 36,525 is 75 * 487 and 36,524 is 92 * 397, so the halves fit the century without a rest.
    left, right = F.when(leap, 75).otherwise(92), F.when(leap, 487).otherwise(397)
    return F.date_add(first, feistel(F.datediff(day, first).cast("long"), key, "date", left, right).cast("int"))


def iso_date(m: Column, key: str) -> Column:
    day = F.try_to_date(m, "yyyy-MM-dd")
    return F.when(day.isNotNull() & (F.year(day) >= 1000), F.date_format(moved_date(day, key), "yyyy-MM-dd")).otherwise(m)


def day_first(m: Column, key: str) -> Column:
    day = F.try_to_date(F.replace(m, F.lit("."), F.lit("/")), "dd/MM/yyyy")
    moved = F.date_format(moved_date(day, key), "ddMMyyyy")
    return F.when(day.isNotNull() & (F.year(day) >= 1000), filled(m, moved)).otherwise(m)


def iban_de(m: Column, key: str) -> Column:
    """A German account number with right check digits: its 18 digits are permuted and the check digits follow."""
    number = digits(m)
    account = F.substr(number, F.lit(3), F.lit(18))

    def check(c: Column) -> Column:
        # The country's letters count as 13 and 14 and stand, with 00, behind the account.
        rest = (F.concat(c, F.lit("131400")).cast("decimal(38,0)") % F.lit(97).cast("decimal(38,0)")).cast("int")
        return F.lpad((98 - rest).cast("string"), 2, "0")

    moved = permuted_digits(account, F.lit(18), key, "iban")
    valid = check(account) == F.substr(number, F.lit(1), F.lit(2))
    return F.when(valid, F.concat(F.lit("DE"), filled(F.substr(m, F.lit(3), F.length(m)), F.concat(check(moved), moved)))).otherwise(m)


def email(m: Column, key: str) -> Column:
    """An address has no numeric format: the part before the @ becomes a keyed digest, under a domain that can't exist."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(m)), 256), 1, 16), F.lit("@example.invalid"))


def secret(m: Column, key: str) -> Column:
    """A hexadecimal secret becomes a keyed digest of its length."""
    return F.substring(F.sha2(F.concat(F.lit(f"{key}|secret|"), m), 256), 1, 40)


# name, pattern, what stands in for a match; the first format that fits a stretch of text is taken. What it takes is
# closed to the formats after it, so none of them reads into it.
FORMATS: list[tuple[str, str, Callable[[Column, str], Column]]] = [
    ("email", EMAIL, email),
    ("secret", SECRET, secret),
    ("iban", IBAN_DE, iban_de),
    ("ipv4", IPV4, ipv4),
    ("phone", PHONE, phone),
    ("ssn", SSN, ssn),
    ("iso_date", ISO_DATE, iso_date),
    ("day_first_date", DAY_FIRST, day_first),
    ("card", CARD, card),
]


def stretch(text: Column, name: Column) -> Column:
    """A stretch of a text and the format that took it, or null."""
    return F.struct(text.alias("text"), name.cast("string").alias("format"))


def apart(text: Column, pattern: str, name: str, change: Callable[[Column], Column], taken: Callable[[Column], Column] | None = None) -> Column:
    """The stretches of ``text``: every match of ``pattern``, put through ``change``, and what lies between."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def both(piece: Column, m: Column) -> Column:
        kind = F.lit(name) if taken is None else F.when(taken(m), F.lit(name))
        return F.when(m.isNull(), F.array(stretch(piece, F.lit(None)))).otherwise(F.array(stretch(piece, F.lit(None)), stretch(change(m), kind)))

    return F.flatten(F.zip_with(F.split(text, pattern), found, both))


def apart_by_check(text: Column, change: Callable[[Column], Column]) -> Column:
    """The stretches of ``text``: cards in their usual groupings whose check digit is right, and what lies between.

    Every place where one may begin is tried, also within another's digits, and the first right ones are taken. Where
    both 19 and 16 digits fit, the 19 are tried first.
    """
    pieces = F.split(text, CARD_START)
    longest = F.regexp_extract_all(text, F.lit(rf"(?<![0-9])(?=({CARD_GROUPED}))"), F.lit(1))
    fours = F.regexp_extract_all(text, F.lit(rf"(?<![0-9])(?={CARD_GROUPED})(?=({CARD_FOURS}(?![0-9]))?)"), F.lit(1))
    right = lambda c: (c != "") & luhn_valid(digits(c))
    best = F.zip_with(longest, fours, lambda a, b: F.when(right(a), a).when(right(b), b).otherwise(F.lit("")))
    # The pieces begin where a card may; before the first place there is one more, unless the text begins with it.
    starts = F.when(F.size(pieces) > F.size(longest), F.concat(F.array(F.lit("")), best)).otherwise(best)
    none = F.array().cast("array<struct<text:string,format:string>>")
    begin = F.struct(none.alias("out"), F.lit(0).alias("over"))

    def put(s: Column, x: Column) -> Column:
        # ``over``: how many characters of this piece and those after it the last card holds.
        piece, found, over = x["piece"], x["found"], s["over"]
        rest = lambda n: stretch(F.substr(piece, n + 1), F.lit(None))
        inside = F.struct(F.concat(s["out"], F.array(rest(over))).alias("out"), F.greatest(F.lit(0), over - F.length(piece)).alias("over"))
        new = F.concat(s["out"], F.array(stretch(change(found), F.lit("card")), rest(F.length(found))))
        taken = F.struct(new.alias("out"), F.greatest(F.lit(0), F.length(found) - F.length(piece)).alias("over"))
        return F.when((over > 0) | (found == ""), inside).otherwise(taken)

    each = F.zip_with(pieces, starts, lambda p, f: F.struct(p.alias("piece"), f.alias("found")))
    return F.aggregate(each, begin, put, lambda s: s["out"])


def still_open(cut: Callable[[Column], Column], s: Column) -> Column:
    """A stretch cut further, unless a format took it."""
    return F.when(s["format"].isNotNull(), F.array(s)).otherwise(cut(s["text"]))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with personal data in ``text`` replaced, and n_<format> columns: how many values of each format were found.

    A value that fails its format's check (octets, calendar, check digits) stays, but 16 digits are permuted among
    those that fail; a run of digits that is neither is no card and isn't counted as one. Cards are looked for in their usual
    groupings with a right check digit first, then with 16 digits, then in any grouping as the longest run.
    Null texts stay null with zero counts; empty texts stay empty. Columns of the names of the counts are
    replaced; all others pass. Rows are handled one by one, so ties and repeated rows don't matter; nothing is shuffled.
    """
    counts = [f"n_{name}" for name, _, _ in FORMATS]
    kept = docs.drop(*counts)
    out = kept.withColumn("__cut", F.lit(None).cast("array<struct<text:string,format:string>>"))
    steps: list[tuple[str, str, Callable[[Column], Column]]] = []
    for name, pattern, change in FORMATS:
        put = partial(change, key=key)
        if name == "card":
            steps.append((name, CARD_START, partial(apart_by_check, change=put)))
            steps.append((name, CARD_SIXTEEN, partial(apart, pattern=CARD_SIXTEEN, name=name, change=put)))
        steps.append((name, pattern, partial(apart, pattern=pattern, name=name, change=put, taken=is_card if name == "card" else None)))
    for name, pattern, cut in steps:
        # Each pattern is looked for only where a sign of it stands: a cheap test that saves most texts the regex.
        sign = F.contains(F.col(text), F.lit("@")) if name == "email" else F.rlike(F.col(text), F.lit("[0-9]"))
        has = F.coalesce(sign & F.rlike(F.col(text), F.lit(pattern)), F.lit(False))
        so_far = F.coalesce(F.col("__cut"), F.array(stretch(F.col(text), F.lit(None))))
        new = F.flatten(F.transform(so_far, partial(still_open, cut)))
        out = out.withColumn("__cut", F.when(has, F.filter(new, lambda s: s["text"] != "")).otherwise(F.col("__cut")))
    done = F.when(F.col("__cut").isNull(), F.col(text)).otherwise(F.array_join(F.transform("__cut", lambda s: s["text"]), ""))
    count = lambda name: F.when(F.col("__cut").isNull(), 0).otherwise(F.size(F.filter("__cut", lambda s: s["format"].eqNullSafe(F.lit(name)))))
    return out.select(*[done.alias(c) if c == text else F.col(c) for c in kept.columns], *[count(name).alias(f"n_{name}") for name, _, _ in FORMATS])
