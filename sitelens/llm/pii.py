"""Personal data as format-preserving Feistel pseudonyms (operator 4), native.

Candidates are found by one pattern at every place where one begins, also
inside of others, told apart, validated, and replaced by a keyed permutation
of their own domain, so the result is valid again, equal values get equal
pseudonyms in every document, and different values differ:

* payment cards (13-19 digits, Luhn): the digits but the last are permuted,
  the last is computed anew;
* bank accounts (IBAN, remainder 97): the digits of the account are
  permuted, the two check digits computed anew;
* social security numbers (valid area, group, serial): permuted among the
  valid ones;
* phone numbers: the last ten digits (all, if fewer follow the country
  code) are permuted, the country code stays;
* IPv4 addresses: both halves of the address are permuted;
* calendar dates from 1901 to 2099, year first, day first or month first:
  permuted among those days and written the same way;
* e-mail addresses are no numbers: they get a keyed name of the same shape.

The permutation is an alternating Feistel network over pairs (a mod p,
b mod q): eight rounds add a keyed hash of one half to the other, modulo its
own size, so no value falls outside the domain. Separators stay in place; a
candidate that fails validation stays as it is and uses up no characters: the
next one may begin inside of it. Of valid ones that overlap the first counts.
An account in groups has the length of its country, else (a country that is
not in LENGTHS) the longest one of remainder 97; a phone number of more than
15 digits is tried without its last group.

Null text stays null, an empty one empty; rows are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
FIRST_DAY, DAY_PARTS = "1901-01-01", (108, 673)     # 108 * 673 days up to 2099-12-31

_B, _E = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": _B + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _E,
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "date": _B + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})" + _E,
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _E,
    "card": _B + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _E,
}
CANDIDATE = "|".join(PATTERNS[k] for k in ("email", "iban", "ip", "date", "ssn", "phone", "card"))
WHOLE = {k: f"^(?:{x})$" for k, x in PATTERNS.items()}
BEGIN = f"(?=({CANDIDATE}))"
CHUNK = 512                     # pieces of a text that are walked at a time
LENGTHS = {                     # of accounts, by country
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lng(c: Column) -> Column:
    return c.cast("long")


def keyed(key: str, label: Column, turn: Column, value: Column) -> Column:
    """60 keyed bits."""
    said = F.concat_ws("|", F.lit(key), label, turn.cast("string"), value.cast("string"))
    return lng(F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 15), 16, 10))


def feistel(key: str, label, a: Column, p: Column, b: Column, q: Column, finish=None) -> Column:
    """The permuted pair, as a struct of a (mod p) and b (mod q), or what
    ``finish`` makes of it."""
    label = F.lit(label) if isinstance(label, str) else label

    def turn(acc: Column, i: Column) -> Column:
        left = i % 2 == 0
        add = keyed(key, label, i, F.when(left, acc["b"]).otherwise(acc["a"]))
        return F.struct(F.when(left, (acc["a"] + add % p) % p).otherwise(acc["a"]).alias("a"),
                        F.when(left, acc["b"]).otherwise((acc["b"] + add % q) % q).alias("b"))

    start = F.struct(lng(a).alias("a"), lng(b).alias("b"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn, finish)


def power(n: Column) -> Column:
    return lng(F.rpad(F.lit("1"), (n + 1).cast("int"), "0"))


def permuted_digits(key: str, label: str, digits: Column) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    out = feistel(key, F.concat_ws(":", F.lit(label), n.cast("string")),
                  F.substr(digits, F.lit(1), half), power(half), F.substr(digits, half + 1), power(n - half),
                  lambda acc: F.concat(F.lpad(acc["a"].cast("string"), half, F.lit("0")),
                                       F.lpad(acc["b"].cast("string"), n - half, F.lit("0"))))
    return out


def characters(c: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.substr(c, i, F.lit(1)))


def refilled(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by ``digits``."""
    def put(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(digit, F.substr(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, acc["k"] + 1).otherwise(acc["k"]).alias("k"))

    return F.aggregate(characters(template), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), put, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    """The check digit that belongs after ``digits``."""
    def add(acc: Column, c: Column) -> Column:
        twice = c.cast("int") * 2
        return F.struct((acc["s"] + F.when(acc["dbl"], twice - F.when(twice > 9, 9).otherwise(0)).otherwise(c.cast("int"))).alias("s"),
                        (~acc["dbl"]).alias("dbl"))

    total = F.aggregate(characters(F.reverse(digits)), F.struct(F.lit(0).alias("s"), F.lit(True).alias("dbl")), add, lambda acc: acc["s"])
    return ((10 - total % 10) % 10).cast("string")


def remainder97(account: Column) -> Column:
    """Remainder of letters (A = 10 ... Z = 35) and digits, read as a number."""
    def add(acc: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(value > 9, acc * 100 + value).otherwise(acc * 10 + value) % 97

    return F.aggregate(characters(account), F.lit(0), add)


def day_of(c: Column) -> Column:
    """(way of writing, day) of a date candidate, null where it is no day of
    the range. Slashes: month first, or day first where only that is a day."""
    day = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    said = lambda way, found: F.struct(F.lit(way).alias("way"), found.alias("day"))

    def read(p: Column) -> Column:
        x, y, z = p[0], p[1], p[2]
        slashes = bind(day(z, x, y), lambda first: F.when(first.isNotNull(), said("mdy", first)).otherwise(said("dmy/", day(z, y, x))))
        return (F.when(c.contains("-"), said("ymd", day(x, y, z))).when(c.rlike(r"^[0-9]+\.[0-9]+\."), said("dmy", day(z, y, x)))
                .when(c.rlike("^[0-9]+/[0-9]+/"), slashes))

    return bind(F.split(c, "[-./]"), read)


def date_pseudonym(key: str, c: Column) -> Column:
    first, (p, q) = F.lit(FIRST_DAY).cast("date"), DAY_PARTS
    spell = {"ymd": "yyyy-MM-dd", "mdy": "MM/dd/yyyy", "dmy": "dd.MM.yyyy", "dmy/": "dd/MM/yyyy"}

    def move(r: Column) -> Column:
        new = bind(F.datediff(r["day"], first), lambda n: feistel(
            key, "date", F.floor(n / q), F.lit(p), n % q, F.lit(q),
            lambda acc: F.date_add(first, (acc["a"] * q + acc["b"]).cast("int"))))

        def write(moved: Column) -> Column:
            out = F.when(F.lit(False), "")
            for way, form in spell.items():
                out = out.when(r["way"] == way, F.date_format(moved, form))
            return out

        return F.when(r["day"].between(first, F.lit("2099-12-31").cast("date")), bind(new, write))

    return bind(day_of(c), move)


def card_pseudonym(key: str, c: Column) -> Column:
    def of(digits: Column) -> Column:
        body = F.substr(digits, F.lit(1), F.length(digits) - 1)
        new = bind(permuted_digits(key, "card", body), lambda x: refilled(c, F.concat(x, luhn(x))))
        return F.when(luhn(body) == F.right(digits, F.lit(1)), new)

    return bind(F.regexp_replace(c, "[^0-9]", ""), of)


def iban_cut(c: Column) -> Column:
    """The account at the beginning of a candidate, null if there is none."""
    n = F.length(c)
    said = F.when(F.lit(False), 0)
    for length, countries in LENGTHS.items():
        said = said.when(F.substring(c, 1, 2).isin(countries.split()), length + (length - 1) // 4)

    def cuts(known: Column) -> Column:
        groups = F.transform(F.sequence(F.floor((n + 1) / 5).cast("int"), F.lit(0)), lambda k: F.greatest(k, F.lit(3)) * 5 - 1)
        tried = F.when(known.isNull(), F.concat(F.array(n), groups)).otherwise(F.array(known, n))
        ends = F.filter(tried, lambda k: (k == n) | ((k < n) & (F.substr(c, k + 1, F.lit(1)) == " ")))
        return F.transform(ends, lambda k: F.substr(c, F.lit(1), k))

    def ok(x: Column) -> Column:
        return bind(F.regexp_replace(x, " ", ""), lambda plain: remainder97(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))) == 1)

    return F.when(c.contains(" "), F.get(F.filter(bind(said, cuts), ok), F.lit(0))).otherwise(c)


def phone_cut(c: Column) -> Column:
    shorter = F.regexp_replace(c, "[ .-][0-9]{2,4}$", "")
    return F.when((F.length(F.regexp_replace(c, "[^0-9]", "")) > 15) & shorter.rlike(WHOLE["phone"]), shorter).otherwise(c)


def iban_pseudonym(key: str, c: Column) -> Column:
    def of(plain: Column) -> Column:
        account, country = F.substr(plain, F.lit(5)), F.substring(plain, 1, 2)
        digits = F.regexp_replace(account, "[^0-9]", "")
        check = lambda x: F.lpad((98 - remainder97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0")
        new = bind(refilled(account, bind(digits, lambda x: permuted_digits(key, "iban", x))),
                   lambda x: refilled(c, F.concat(check(x), F.regexp_replace(x, "[^0-9]", ""))))
        ok = remainder97(F.concat(account, F.substring(plain, 1, 4))) == 1
        return F.when(ok & F.length(digits).between(2, 30), new)

    return bind(F.regexp_replace(c, " ", ""), of)


def ssn_pseudonym(key: str, c: Column) -> Column:
    """Areas 1-899 but 666, groups 1-99, serials 1-9999: 898 * 989901."""
    def of(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        out = feistel(key, "ssn", area - F.when(area > 666, 2).otherwise(1), F.lit(898),
                      (group - 1) * 9999 + serial - 1, F.lit(99 * 9999))
        return F.when(ok, bind(out, write))

    def write(x: Column) -> Column:
        area = x["a"] + F.when(x["a"] >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((F.floor(x["b"] / 9999) + 1).cast("string"), 2, "0"),
                           F.lpad((x["b"] % 9999 + 1).cast("string"), 4, "0"))

    return bind(F.transform(F.split(c, "-"), lambda x: x.cast("int")), of)


def phone_pseudonym(key: str, c: Column) -> Column:
    country = F.length(F.regexp_extract(c, r"^\+([0-9]{1,3})[ .(-]", 1))

    def of(digits: Column) -> Column:
        def keep(kept: Column) -> Column:
            new = bind(F.substr(digits, kept + 1), lambda x: permuted_digits(key, "phone", x))
            return F.when(F.length(digits) - kept >= 2, refilled(c, F.concat(F.substr(digits, F.lit(1), kept), new)))

        return F.when(F.length(digits).between(7, 15), bind(F.greatest(country, F.length(digits) - 10), keep))

    return bind(F.regexp_replace(c, "[^0-9]", ""), of)


def ip_pseudonym(key: str, c: Column) -> Column:
    def of(part: Column) -> Column:
        ok = F.forall(part, lambda x: x <= 255) & ~c.rlike(r"(^|\.)0[0-9]")
        out = feistel(key, "ip", part[0] * 256 + part[1], F.lit(65536), part[2] * 256 + part[3], F.lit(65536))
        spell = lambda x: F.concat_ws(".", *[y.cast("string") for h in (x["a"], x["b"]) for y in (F.floor(h / 256), h % 256)])
        return F.when(ok, bind(out, spell))

    return bind(F.transform(F.split(c, r"\."), lambda x: x.cast("int")), of)


def email_pseudonym(key: str, c: Column) -> Column:
    hashed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(c)).cast("binary"), 256)
    return F.concat(F.lit("u"), F.substring(hashed, 1, 16), F.lit("@mail.invalid"))


MAKERS = {"email": email_pseudonym, "iban": iban_pseudonym, "card": card_pseudonym, "ssn": ssn_pseudonym,
          "phone": phone_pseudonym, "ip": ip_pseudonym, "date": date_pseudonym}


def told(x: Column, key: str) -> Column:
    """(n, kind, new) of a candidate: the characters that ``new`` stands for;
    ``new`` null where no valid value begins."""
    kind = F.when(x.contains("@"), "email")
    for k in ("iban", "ip", "date", "ssn", "phone", "card"):
        kind = kind.when(x.rlike(WHOLE[k]), k)

    def made(value: Column, kind: Column) -> Column:
        new = F.when(F.lit(False), "")
        for k in KINDS:
            new = new.when(kind == k, MAKERS[k](key, value))
        return F.struct(F.length(value).alias("n"), kind.alias("kind"), new.alias("new"))

    def cut(k: Column) -> Column:
        value = F.when(k == "iban", iban_cut(x)).when(k == "phone", phone_cut(x)).otherwise(x)
        return bind(value, lambda v: made(v, k))

    return bind(kind, cut)


def used_up(pieces: Column) -> Column:
    """For each piece (text, value) the characters at its beginning that
    values of earlier pieces stand for. Pieces are walked by CHUNK, so that
    no step copies a list as long as the text."""
    def step(acc: Column, p: Column) -> Column:
        taken = F.when((acc["used"] == 0) & p["value"]["new"].isNotNull(), p["value"]["n"]).otherwise(acc["used"])
        return F.struct(F.concat(acc["out"], F.array(acc["used"])).alias("out"), F.greatest(taken - F.length(p["text"]), F.lit(0)).alias("used"))

    def walk(acc: Column, i: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("out"), acc["used"].alias("used"))
        part = F.aggregate(F.slice(pieces, i * CHUNK + 1, F.lit(CHUNK)), start, step)
        return bind(part, lambda p: F.struct(F.concat(acc["out"], F.array(p["out"])).alias("out"), p["used"].alias("used")))

    start = F.struct(F.array().cast("array<array<int>>").alias("out"), F.lit(0).alias("used"))
    chunks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int"))
    return F.flatten(F.aggregate(chunks, start, walk, lambda acc: acc["out"]))


def replacements(text: Column, key: str) -> Column:
    """A text in pieces (new, kind, rest): the pseudonym of the value that
    begins the piece, null where there is none, and what follows it up to the
    next piece. A piece begins wherever a candidate does."""
    def put(pieces: Column, used: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            gone = F.get(used, i)
            valid = (gone == 0) & p["value"]["new"].isNotNull()
            after = F.substr(p["text"], F.when(valid, p["value"]["n"]).otherwise(gone) + 1)
            return F.struct(F.when(valid, p["value"]["new"]).alias("new"), F.when(valid, p["value"]["kind"]).alias("kind"), after.alias("rest"))

        return F.transform(pieces, one)

    def pieces(parts: Column, found: Column) -> Column:
        ahead = F.size(parts) - F.size(found)                   # 1 if text stands before the first candidate
        return F.transform(parts, lambda t, i: F.struct(t.alias("text"), told(F.when(i >= ahead, F.get(found, i - ahead)), key).alias("value")))

    parts = F.struct(F.split(text, BEGIN, -1).alias("parts"), F.regexp_extract_all(text, F.lit(BEGIN), F.lit(1)).alias("found"))
    return bind(bind(parts, lambda s: pieces(s["parts"], s["found"])), lambda p: bind(used_up(p), lambda used: put(p, used)))


def rejoined(pieces: Column) -> Column:
    """The text with its valid candidates replaced."""
    return F.array_join(F.transform(pieces, lambda x: F.concat(F.coalesce(x["new"], F.lit("")), x["rest"])), "")


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with ``text`` pseudonymised under the key ``secret``. With
    ``found``, a column of that name gets the replaced kinds, in order.
    All other columns stay; nothing is shuffled."""
    mark = unused("__pii_found", docs.columns)
    out = docs.withColumn(mark, F.when(F.col(text).rlike("[0-9@]"), replacements(F.col(text), secret)))
    new = F.when(F.size(mark) > 0, rejoined(F.col(mark))).otherwise(F.col(text))
    out = out.withColumn(text, new)
    if found:
        kinds = F.transform(F.filter(mark, lambda x: x["new"].isNotNull()), lambda x: x["kind"])
        out = out.withColumn(found, F.coalesce(kinds, F.array().cast("array<string>")))
    return out.drop(mark)
