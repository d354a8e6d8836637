"""Format-preserving pseudonyms for private values, by keyed Feistel permutations.

A digit string is cut in two; the halves take turns in adding a keyed hash of the other
one, modulo their size. That permutes all strings of the length, so equal values get
equal pseudonyms and different ones different. All is done by built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Dates are permuted within these years, 1900 to 2099: FIRST_DAY and DAYS days, which are 229 * 319.
FIRST_DAY, DAYS, DAY_SIDES = "1900-01-01", 73049, (229, 319)
# How private values are written. The order decides what a text is taken for.
# A look at the first character goes before everything that costs more.
SECRET = r"(?=A)\bAKIA[A-Z0-9]{16,20}\b|(?=[TtPpSsAa])(?i:\b(?:token|password|passwd|secret|api[_-]?key)\s*[=:]\s*[\"']?)[A-Za-z0-9_\-]{8,}"
EMAIL = r"[A-Za-z0-9][\w.%+\-]{0,63}@(?:[A-Za-z0-9][A-Za-z0-9\-]{0,62}\.){1,30}[A-Za-z]{2,63}"
YEAR, MONTH_NO, DAY_NO = r"(?:19|20)\d\d", r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
MONTH = r"(?i:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
ORDINAL = r"(?i:st|nd|rd|th)?"
NUMERIC_DATE = "|".join(
    [rf"(?<![\d.\-]){YEAR}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d\-])"]
    + [rf"(?<![\d./]){YEAR}{s}(?:0[1-9]|1[0-2]){s}(?:0[1-9]|[12]\d|3[01])(?!\d|{s}\d)" for s in ("/", r"\.")]
    + [rf"(?<!\d|\d[./\-])(?:{MONTH_NO}{s}{DAY_NO}|{DAY_NO}{s}{MONTH_NO}){s}{YEAR}(?!\d|{s}\d)" for s in ("/", r"\.", "-")]
    + [rf"(?<!\d|\d[./\-]){DAY_NO}{ORDINAL} {MONTH}\.?,? {YEAR}(?!\d)"]
)
DATE = rf"(?=\d)(?:{NUMERIC_DATE})|(?=[JFMASONDjfmasond])\b{MONTH}\.? {DAY_NO}{ORDINAL},? {YEAR}(?!\d)"
IP = r"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]?\d)"
PHONE = "|".join(
    [
        r"(?=\+)(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{1,4}(?:[ .\-]?\d{2,4}){1,5}(?!\d)",
        r"(?=[1(])(?<!\d|\d[.\-])(?:1[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d|[.\-]\d)",
        r"(?=\d)(?<!\d|\d[.\-])(?:1[ .\-])?\d{3}[.\-]\d{3}[.\-]\d{4}(?!\d|[.\-]\d)",
        r"(?=\d)(?<!\d|\d[ .\-])(?:1[ .\-])?[2-9]\d\d \d{3}[ \-]\d{4}(?!\d|[ .\-]\d)",
    ]
)
#: The country code of a number: with what parts it from the rest, or by the list of such codes.
COUNTRY = r"^\+\d{1,3}[ .\-](?=[\d(])|^\+\d{1,3}(?=\()|^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})|^1[ .\-]?(?=\(|\d{3}[ .\-])|^"
SSN = r"(?=\d)(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
#: Groups of digits in which a card number may lie; possessive, as a run can be long.
RUN = r"(?=\d)(?<![\d.])\d(?:[ \-]?\d){12,}+"
#: The groups of a card number, and how many they are: sixteen digits first, one group, then other ways of writing.
SHAPES = [(4, r"(?:\d{4}[ \-]){3}\d{4}"), (1, r"\d{13,19}"), (3, r"\d{4}[ \-]\d{6}[ \-]\d{4,5}"), (2, r"\d{8}[ \-]\d{8}"), (5, r"(?:\d{4}[ \-]){4}\d{1,3}"), (3, r"\d{6}[ \-]\d{8,13}"), (4, r"\d{4}(?:[ \-]\d{3}){3}")]
# Characters that stand for none (Unicode) mark where values and cards begin and end; in a text they are written as two others.
OPEN, CLOSE, FIRST, LAST, ESCAPE = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4"
ESCAPED = [(ESCAPE, ESCAPE + "\ufdd5"), (OPEN, ESCAPE + "\ufdd6"), (CLOSE, ESCAPE + "\ufdd7"), (FIRST, ESCAPE + "\ufdd8"), (LAST, ESCAPE + "\ufdd9")]
CARD = f"{FIRST}[^{LAST}]*+{LAST}"
PRIVATE = "|".join([CARD, SECRET, EMAIL, DATE, IP, PHONE, SSN])
#: What a text without a commercial at can hold.
NO_MAIL = "|".join([CARD, SECRET, DATE, IP, PHONE, SSN])


def keyed(key: str, round_: Column, tag: Column, half: Column) -> Column:
    """A number below 2^48 from key, round, format and half."""
    hashed = F.sha2(F.concat_ws("|", F.lit(key), tag, round_.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(hashed, 1, 12), 16, 10).cast("long")


def feistel(value: Column, left_side: Column, right_side: Column, tag: Column, key: str) -> Column:
    """A permutation of the numbers from 0 to left_side * right_side - 1; a bijection for any sides."""
    start = F.struct((value / right_side).cast("long").alias("l"), (value % right_side).alias("r"))

    def turn(state: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, (state["l"] + keyed(key, i, tag, state["r"])) % left_side).otherwise(state["l"])
        right = F.when(i % 2 == 1, (state["r"] + keyed(key, i, tag, state["l"])) % right_side).otherwise(state["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * right_side + s["r"])


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """A digit string of the same length, of 2 to 18 digits."""
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")
    # powers of ten by their text, which is exact
    side = lambda k: F.concat(F.lit("1"), F.repeat(F.lit("0"), k)).cast("long")
    left = F.substring(digits, 1, n - low).cast("long")
    value = left * side(low) + F.substring(digits, n - low + 1, low).cast("long")
    return F.lpad(feistel(value, side(n - low), side(low), F.concat(F.lit(kind), n.cast("string")), key).cast("string"), n, "0")


def luhn_sum(digits: Column) -> Column:
    """The checksum of a card number, from the right; a valid one is divisible by 10."""
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * (F.lit(2) - i % 2),
    )
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(d))


def refilled(value: Column, digits: Column) -> Column:
    """`value` with its digits replaced by `digits`, one after the other."""
    letters = F.split(value, "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))

    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        taken = F.substring(digits, state["used"] + 1, F.lit(1))
        return F.struct(F.concat(state["out"], F.when(is_digit, taken).otherwise(c)).alias("out"), (state["used"] + is_digit.cast("int")).alias("used"))

    return F.aggregate(letters, start, step, lambda s: s["out"])


def replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def cut(text: Column, pattern: str) -> Column:
    """A text's pieces: what a pattern matches at the odd places, what lies between at the even ones."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{OPEN}$1{CLOSE}"), f"[{OPEN}{CLOSE}]", -1)


def cards_marked(run: Column) -> Column:
    """Groups of digits, with a mark before and behind each card number among them.

    A card number is some whole groups, in the first of SHAPES that fits there and has a
    valid check digit, or all groups of the run. The first one counts where two overlap.
    """
    groups = F.regexp_extract_all(run, F.lit(r"([ \-]?\d+)"), F.lit(1))

    def valid(span: Column) -> Column:
        digits = F.regexp_replace(span, "[^0-9]", "")
        return F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0)

    def length_at(all_: Column, i: Column) -> Column:
        found = F.lit(0)
        for n, shape in reversed(SHAPES):
            span = F.regexp_replace(F.array_join(F.slice(all_, i + 1, F.lit(n)), ""), r"^[ \-]", "")
            found = F.when((i + n <= F.size(all_)) & span.rlike(f"^{shape}$") & valid(span), F.lit(n)).otherwise(found)
        return found

    def with_groups(all_: Column) -> Column:
        places = F.transform(F.sequence(F.lit(0), F.size(all_) - 1), lambda i: F.struct(i.alias("at"), length_at(all_, i).alias("n")))
        start = F.struct(F.array().cast("array<int>").alias("begins"), F.array().cast("array<int>").alias("ends"), F.lit(0).alias("free"))

        def take(state: Column, place: Column) -> Column:
            end = place["at"] + place["n"]
            taken = F.struct(F.array_append(state["begins"], place["at"]).alias("begins"), F.array_append(state["ends"], end - 1).alias("ends"), end.alias("free"))
            return F.when(place["at"] >= state["free"], taken).otherwise(state)

        def marked(taken: Column) -> Column:
            def group(g: Column, i: Column) -> Column:
                begun = F.when(F.array_contains(taken["begins"], i), F.regexp_replace(g, r"^([ \-]?)", f"$1{FIRST}")).otherwise(g)
                return F.when(F.array_contains(taken["ends"], i), F.concat(begun, F.lit(LAST))).otherwise(begun)

            whole = F.when(valid(run), F.concat(F.lit(FIRST), run, F.lit(LAST))).otherwise(run)
            return F.when(F.size(taken["begins"]) > 0, F.array_join(F.transform(all_, group), "")).otherwise(whole)

        return once(F.aggregate(F.filter(places, lambda p: p["n"] > 0), start, take), marked)

    return once(groups, with_groups)


def once(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def day_of(value: Column) -> tuple[Column, Column, Column]:
    """The date that is written (null for none), whether its day or month goes first, and whether only its numbers show that."""
    parts = F.split(value, "[^0-9]+")
    made = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    part = lambda i: F.get(parts, F.lit(i))
    year_first, numeric = value.rlike(r"^\d{4}"), value.rlike(r"^[\d./\-]+$")
    month = F.lit(None).cast("string")
    for i, name in enumerate(MONTHS):
        month = F.when(value.rlike(f"(?i){name[:3]}"), F.lit(str(i + 1))).otherwise(month)
    named = made(F.regexp_extract(value, r"(\d{4})$", 1), month, F.regexp_extract(value, r"(?<!\d)(\d{1,2})(?!\d)", 1))
    by_month, by_day = made(part(2), part(0), part(1)), made(part(2), part(1), part(0))
    dotted = value.contains(".")
    usual, other = F.when(dotted, by_day).otherwise(by_month), F.when(dotted, by_month).otherwise(by_day)
    day_first = F.when(usual.isNotNull(), dotted).otherwise(~dotted)
    day = F.when(year_first, made(part(0), part(1), part(2))).when(numeric, F.coalesce(usual, other)).otherwise(named)
    return day, day_first, numeric & ~year_first & usual.isNull()


def hidden_date(value: Column, key: str) -> Column:
    """Another date in the same way of writing; the same date is moved alike in all of them.

    Where only a day above 12 shows what is the day, the other date has such a day too.
    """
    side = [F.lit(x).cast("long") for x in DAY_SIDES]
    base = F.lit(FIRST_DAY).cast("date")
    moved = lambda number: feistel(number, *side, F.lit("date"), key)
    date_at = lambda number: F.date_add(base, number.cast("int"))
    day, day_first, told_by_day = day_of(value)
    first = moved(F.datediff(day, base).cast("long"))
    # a move goes on until the day is above 12, which is so for 6 of 10
    walked = lambda number: F.aggregate(F.sequence(F.lit(1), F.lit(99)), number, lambda n, _: F.when(F.dayofmonth(date_at(n)) > 12, n).otherwise(moved(n)))

    def written(new: Column) -> Column:
        d, m, y = F.dayofmonth(new), F.month(new), F.date_format(new, "yyyy")
        short = value.rlike(r"(?:^|[^0-9])[1-9](?:[^0-9]|$)")
        two = lambda n: F.when(short, n.cast("string")).otherwise(F.lpad(n.cast("string"), 2, "0"))
        sep = F.regexp_extract(value, r"^\d+([./\-])", 1)
        name = F.element_at(F.array(*map(F.lit, MONTHS)), m)
        name = F.when(value.rlike("(?i)" + "|".join(MONTHS)), name).otherwise(F.substring(name, 1, 3))
        name = F.when(value.rlike("[A-Z]{3}"), F.upper(name)).otherwise(name)
        ending = F.when((d % 10 == 1) & (d != 11), "st").when((d % 10 == 2) & (d != 12), "nd").when((d % 10 == 3) & (d != 13), "rd").otherwise("th")
        number = F.concat(d.cast("string"), F.when(value.rlike(r"(?i)\d(?:st|nd|rd|th)"), ending).otherwise(""))
        point, comma = F.when(value.contains("."), ".").otherwise(""), F.when(value.contains(","), ",").otherwise("")
        return (
            F.when(value.rlike(r"^\d{4}"), F.concat(y, F.substring(value, 5, 1), F.lpad(m.cast("string"), 2, "0"), F.substring(value, 5, 1), F.lpad(d.cast("string"), 2, "0")))
            .when(value.rlike(r"^[\d./\-]+$"), F.concat(F.when(day_first, two(d)).otherwise(two(m)), sep, F.when(day_first, two(m)).otherwise(two(d)), sep, y))
            .when(value.rlike(r"^\d"), F.concat(number, F.lit(" "), name, point, comma, F.lit(" "), y))
            .otherwise(F.concat(name, point, F.lit(" "), number, comma, F.lit(" "), y))
        )

    return once(date_at(F.when(told_by_day, once(first, walked)).otherwise(first)), written)


def kind_of(value: Column) -> Column:
    """What a value that PRIVATE matches is; null for what only looks like a date or number."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    n = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(value.startswith(FIRST), "card")
        .when(whole(SECRET), "secret")
        .when(whole(EMAIL), "email")
        .when(whole(DATE), F.when(day_of(value)[0].isNotNull(), "date"))
        .when(whole(IP), "ip")
        .when(whole(PHONE), F.when(n.between(8, 15) | ~value.startswith("+"), "phone"))
        .when(whole(SSN), F.when(~value.rlike("^(?:000|666|9)|-00-|-0000$"), "ssn"))
    )


def hidden(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a kind, in the value's format.

    Cards keep their first digit and a valid check digit, phones their country code,
    dates stay dates of the same range in their way of writing, and each number of an address stays below 256.
    Mail addresses get a hashed name in a domain that can't exist, secrets a hashed text.
    """
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    body = permuted_digits(F.substring(digits, 2, n - 2), "card", key)
    unchecked = F.concat(F.substring(digits, 1, 1), body)
    check = (F.lit(10) - luhn_sum(F.concat(unchecked, F.lit("0"))) % 10) % 10
    card = refilled(value, F.concat(unchecked, check.cast("string")))
    country = F.regexp_extract(value, COUNTRY, 0)
    local = F.substring(value, F.length(country) + 1, F.length(value))
    phone = F.concat(country, refilled(local, permuted_digits(F.regexp_replace(local, "[^0-9]", ""), "phone", key)))
    ssn = refilled(value, permuted_digits(digits, "ssn", key))
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda total, p: total * 256 + p)
    moved = feistel(number, F.lit(65536).cast("long"), F.lit(65536).cast("long"), F.lit("ip"), key)
    ip = F.concat_ws(".", *((F.floor(moved / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)))
    hashed = F.sha2(F.concat_ws("|", F.lit(key), kind, value), 256)
    email = F.concat(F.lit("user-"), F.substring(hashed, 1, 16), F.lit("@pseudonym.invalid"))
    before = F.regexp_extract(value, r"^(?i:(?:token|password|passwd|secret|api[_-]?key)\s*[=:]\s*[\"']?)|^", 0)
    secret = F.concat(before, F.lit("hidden-"), F.substring(hashed, 1, 16))
    return (
        F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "date", hidden_date(value, key))
        .when(kind == "ip", ip).when(kind == "email", email).when(kind == "secret", secret).otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str = "corpus") -> DataFrame:
    """One row for each row of `docs`: doc_id, text, n_private, kinds, pseudonyms.

    `text` has a pseudonym for each private value: card numbers (valid check digit),
    dates, phone and social security numbers, IP addresses, mail addresses, and secrets.
    Equal values have equal pseudonyms in all texts under one key, and all else stays as
    it was. `kinds` and `pseudonyms` list the values in their order. A null text stays
    null, with n_private 0 and empty lists. Repeated rows give repeated results, other
    columns are ignored, an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    # most texts have nothing to replace; only the others are taken apart
    odd = text.rlike(f"[{OPEN}{CLOSE}{FIRST}{LAST}{ESCAPE}]")
    plain = docs.select("doc_id", text.alias("text"), F.when(odd, replaced(text, ESCAPED)).otherwise(text).alias("plain"), odd.alias("odd"))
    # all kinds but secrets have a digit or a commercial at, and secrets have a sign or these letters
    digits, mail = F.col("plain").rlike("[0-9]"), F.col("plain").contains("@")
    hint = digits | mail | F.col("plain").rlike("[=:]") | F.col("plain").contains("AKIA")
    runs = F.array_join(F.transform(cut(F.col("plain"), RUN), lambda p, i: F.when(i % 2 == 1, cards_marked(p)).otherwise(p)), "")
    with_cards = plain.withColumn("marked", F.when(digits & F.col("plain").rlike(RUN), runs).otherwise(F.col("plain")))
    marked = F.col("marked")
    held = F.when(~hint, F.lit(False)).when(mail, marked.rlike(PRIVATE)).when(digits, marked.rlike(NO_MAIL)).otherwise(marked.rlike(SECRET))
    parts = F.when(mail, cut(marked, PRIVATE)).otherwise(cut(marked, NO_MAIL))
    pieces = with_cards.withColumn("pieces", F.when(held, parts))
    bare = lambda v: F.translate(v, FIRST + LAST, "")
    known = F.transform("pieces", lambda p, i: F.struct(bare(p).alias("value"), F.when(i % 2 == 1, kind_of(p)).alias("kind")))
    told = pieces.withColumn("known", known)
    told = told.withColumn("new", F.transform("known", lambda k: F.when(k["kind"].isNull(), k["value"]).otherwise(hidden(k["value"], k["kind"], key))))
    whole = F.array_join("new", "")
    back = [(new, old) for old, new in reversed(ESCAPED)]
    private = F.coalesce(F.filter(F.arrays_zip("known", "new"), lambda z: z["known"]["kind"].isNotNull()), F.array().cast("array<struct<known:struct<value:string,kind:string>,new:string>>"))
    told = told.withColumn("private", private)
    return told.select(
        "doc_id",
        F.when(F.col("pieces").isNull(), F.col("text")).when(F.col("odd"), replaced(whole, back)).otherwise(whole).alias("text"),
        F.size("private").alias("n_private"),
        F.transform("private", lambda z: z["known"]["kind"]).alias("kinds"),
        F.transform("private", lambda z: z["new"]).alias("pseudonyms"),
    )
