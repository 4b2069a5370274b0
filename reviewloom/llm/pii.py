"""Personal data under format-preserving pseudonyms, with Spark expressions only.

One pattern finds candidates; those that pass the checks of their kind are
replaced, all else stays as it is:

- card numbers (Luhn), IBANs (mod 97), social security numbers (issued ranges),
  IPv4 addresses (octets) and dates (calendar) are permuted within the valid
  values of their format by a keyed Feistel network, check digits renewed;
- the digits of phone numbers behind the country code are permuted likewise;
- letters and digits of e-mail addresses, but for the last domain label, are
  replaced by ones drawn from a keyed hash of the address.

A permutation of the whole value depends on key, kind and length only, so equal
values get equal pseudonyms in all documents and different values different ones
(e-mail addresses: but for collisions of the hash). Texts keep their length but for
the digits of IPv4 octets.

Null text stays null, empty text empty; a very long one is read whole. Repeated rows are treated alike, so ties
need no order; an empty table gives no rows. Other columns, whatever their names, are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common

ROUNDS = 10
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
START, STOP = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_of_length(n: int, countries: str) -> str:
    """In one run or in groups of four: a word that follows the last group is not taken for another one."""
    groups, rest = divmod(n - 4, 4)
    spaced = r"(?: [A-Z0-9]{4}){%d}" % groups + (r" [A-Z0-9]{%d}" % rest if rest else "")
    return r"(?:%s)\d{2}(?:[A-Z0-9]{%d}|%s)%s" % (countries.replace(" ", "|"), n - 4, spaced, STOP)


#: Of other countries and lengths: as far as the groups go.
ANY_IBAN = r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + STOP
IBAN = "|".join([*(iban_of_length(n, c) for n, c in IBAN_LENGTHS.items()), ANY_IBAN])
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_.%+-]++@[\p{L}\p{N}_-]++(?:\.[\p{L}\p{N}_-]++)+",
    "iban": START + r"(?=[A-Z]{2}\d{2})(?:" + IBAN + ")",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "date": START + r"(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})" + STOP,
    "ssn": START + r"\d{3}-\d{2}-\d{4}" + STOP + r"(?!-\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{8,15}|\+\d{1,3}(?:[ -]\d{2,4}){2,4}(?!\.\d)"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})" + STOP,
    "card": START + r"(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})" + STOP,
}
#: Groups inside the parts are counted over the whole pattern: only those of cards refer back.
PATTERN = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
#: Documents without such a place are passed on at once.
HINT = r"@|\d[^A-Za-z]{0,3}\d"
#: Days from 1900-01-01 that dates are permuted in: a product, so that two halves make it up exactly.
FIRST_DAY, DAY_HALVES = "1900-01-01", (256, 286)
DATE_FORMS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy")

#: Where a run finds its key.
KEY_SETTING = "spark.reviewloom.pseudonym.key"

Fold = Callable[[Column, Column], Column]


def draw(key: str, kind: str, i: Column, value: Column) -> Column:
    """A keyed number of 60 bits for a round and a half."""
    said = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def feistel(a: Column, b: Column, radices: tuple[Column, Column], key: str, kind: str) -> Column:
    """Permutes a pair (a below the first radix, b below the second): struct of a and b."""

    def step(state: Column, i: Column) -> Column:
        radix = F.when(i % 2 == 0, radices[0]).otherwise(radices[1])
        new = (state["a"] + draw(key, kind, i, state["b"]) % radix) % radix
        return F.struct(state["b"].alias("a"), new.alias("b"))

    first = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, step)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.transform(F.array(value), use)[0]


def power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Digits (2 to 36 of them) permuted among those of their length."""

    def use(d: Column) -> Column:
        n = F.length(d)
        left = F.floor(n / 2).cast("int")
        right = n - left
        pair = feistel(
            F.substr(d, F.lit(1), left), F.substr(d, left + 1, right), (power_of_ten(left), power_of_ten(right)), key, kind
        )
        return let(pair, lambda p: F.concat(padded(p["a"], left), padded(p["b"], right)))

    return let(digits, use)


def padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refilled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, in order."""
    places = F.sequence(F.lit(1), F.length(form))

    def put(i: Column) -> Column:
        c = F.substr(form, i, F.lit(1))
        upto = F.length(only_digits(F.substr(form, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substr(digits, upto, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(places, put), "")


def luhn_sum(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def card(m: Column, key: str) -> Column:
    def use(d: Column) -> Column:
        body = permuted_digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
        check = lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))
        return F.when(luhn_sum(d) % 10 == 0, refilled(m, let(body, check))).otherwise(m)

    return let(only_digits(m), use)


def mod_97(text: Column) -> Column:
    """Digits as they are, letters from A = 10 on."""

    def add(total: Column, i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        digit = c.between("0", "9")
        return F.when(digit, (total * 10 + c.cast("int")) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def iban(m: Column, key: str) -> Column:
    def use(s: Column) -> Column:
        body, country = F.substr(s, F.lit(5), F.length(s)), F.substr(s, F.lit(1), F.lit(2))
        valid = mod_97(F.concat(body, F.substr(s, F.lit(1), F.lit(4)))) == 1

        def renewed(d: Column) -> Column:
            fresh = refilled(body, d)
            check = let(fresh, lambda b: padded(98 - mod_97(F.concat(b, country, F.lit("00"))), 2))
            return refilled(m, F.concat(check, d))

        digits = only_digits(body)
        return F.when(valid & (F.length(digits) > 1), let(permuted_digits(digits, key, "iban"), renewed)).otherwise(m)

    return let(F.replace(m, F.lit(" "), F.lit("")), use)


def ip(m: Column, key: str) -> Column:
    def use(o: Column) -> Column:
        half = lambda i: o[i] * 256 + o[i + 1]
        pair = feistel(half(0), half(2), (F.lit(65536), F.lit(65536)), key, "ip")
        octets = lambda p: F.concat_ws(".", *(x.cast("string") for h in (p["a"], p["b"]) for x in (F.floor(h / 256), h % 256)))
        return F.when(F.forall(o, lambda x: x < 256), let(pair, octets)).otherwise(m)

    return let(F.split(m, r"\.").cast("array<int>"), use)


def date(m: Column, key: str) -> Column:
    """The first form that reads the text as a day in range decides.

    Month first is read only where the day is above 12. Such days are permuted among
    themselves, by going on from day to day until another of them is met, so that their
    pseudonyms are not read as day first either.
    """
    a, b = DAY_HALVES
    first = F.lit(FIRST_DAY).cast("date")

    def day(n: Column) -> Column:
        return F.date_add(first, n.cast("int"))

    def step(n: Column) -> Column:
        pair = feistel(F.floor(n / b), n % b, (F.lit(a), F.lit(b)), key, "date")
        return let(pair, lambda p: (p["a"] * b + p["b"]).cast("bigint"))

    def walk(n: Column) -> Column:
        # six days of ten are above the 12th: 60 steps fail once in 10^24
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(60)), step(n), lambda m, _: F.when(F.dayofmonth(day(m)) > 12, m).otherwise(step(m))
        )

    def read_as(form: str, rest: Column) -> Column:
        def moved(n: Column) -> Column:
            n = n.cast("bigint")
            new = day(walk(n) if form == "MM/dd/yyyy" else step(n))
            return F.when((n >= 0) & (n < a * b), F.date_format(new, form)).otherwise(rest)

        return let(F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), first), moved)

    out = m
    for form in reversed(DATE_FORMS):
        out = read_as(form, out)
    return out


def ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""

    def use(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        place = area - 1 - F.when(area > 666, 1).otherwise(0)
        pair = feistel(place * 99 + group - 1, serial - 1, (F.lit(898 * 99), F.lit(9999)), key, "ssn")

        def text(x: Column) -> Column:
            index = F.floor(x["a"] / 99)
            number = index + 1 + F.when(index + 1 >= 666, 1).otherwise(0)
            return F.concat_ws("-", padded(number, 3), padded(x["a"] % 99 + 1, 2), padded(x["b"] + 1, 4))

        return F.when(valid, let(pair, text)).otherwise(m)

    return let(F.split(m, "-").cast("array<int>"), use)


def phone(m: Column, key: str) -> Column:
    """The country code, the digits from + to the next other character, stays; +digits in one run lose all but one."""
    code = F.regexp_extract(m, r"^\+(?:\d{1,3}(?=[ .(-])|\d)", 0)
    rest = F.substr(m, F.length(code) + 1, F.length(m))
    return F.concat(code, refilled(rest, permuted_digits(only_digits(rest), key, "phone")))


def email(m: Column, key: str) -> Column:
    """Letters and digits before the last dot are drawn anew, the case of letters included."""
    hash_ = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)).cast("binary"), 512)

    def use(h: Column) -> Column:
        last = F.length(m) - F.length(F.substring_index(m, ".", -1))

        def put(i: Column) -> Column:
            c = F.substr(m, i, F.lit(1))
            n = F.conv(F.substr(h, (i * 2) % 127 + 1, F.lit(2)), 16, 10).cast("int") + i
            letter = lambda first: F.char(F.lit(first) + n % 26)
            return (
                F.when(i > last, c).when(c.between("0", "9"), (n % 10).cast("string"))
                .when(c.between("a", "z"), letter(97)).when(c.between("A", "Z"), letter(65))
                .when(F.rlike(c, F.lit(r"\p{L}")), letter(97)).otherwise(c)
            )

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), put), "")

    return let(hash_, use)


MAKERS = {"email": email, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(m: Column, key: str) -> Column:
    """A candidate's pseudonym; itself if it fails the checks of its kind. The first kind that fits it whole decides."""
    out = m
    for kind in reversed(KINDS):
        # alone, a card's groups count from 1
        out = F.when(F.rlike(m, F.lit(f"^(?:{PATTERNS[kind]})$")), MAKERS[kind](m, key)).otherwise(out)
    return out


def pseudonymized(text: Column, key: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    between = F.split(text, PATTERN, -1)
    changed = F.zip_with(found, F.slice(between, F.lit(2), F.size(between)), lambda m, rest: F.concat(pseudonym(m, key), rest))
    whole = F.concat(between[0], F.array_join(changed, ""))
    return F.when(F.rlike(text, F.lit(HINT)), whole).otherwise(text)


def pseudonymize(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """docs with pseudonyms in place of personal data. Keep the key secret, and the same for all runs to be linked."""
    return docs.withColumn(column, pseudonymized(F.col(column), key))


def secret_key(spark: SparkSession) -> str:
    """The key in the session's setting KEY_SETTING; without it one that is public and fit for test data only."""
    return spark.conf.get(KEY_SETTING, "public key for test data")


def pseudonymize_documents(docs: DataFrame, key: str) -> DataFrame:
    """As pseudonymize; a column n_chars that counts the text's characters counts those of the new text."""
    if "n_chars" not in docs.columns:
        return pseudonymize(docs, key)
    row, new = F.col("_row"), F.col("_new")
    counted = row["n_chars"] == F.length(row["text"])
    size = F.when(counted, F.length(new)).otherwise(row["n_chars"]).cast(docs.schema["n_chars"].dataType)
    changed = {"text": new, "n_chars": size}
    both = docs.select(common.whole_row(docs), pseudonymized(F.col("text"), key).alias("_new"))
    return both.select(*(changed.get(c, row[c]).alias(c) for c in docs.columns))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, text under pseudonyms, and whether it differs from the document's text."""
    docs = common.table(spark, folder, "documents").select("doc_id", F.col("text").alias("before"), "text")
    return pseudonymize(docs, secret_key(spark)).select("doc_id", "text", (~F.col("text").eqNullSafe(F.col("before"))).alias("changed"))
