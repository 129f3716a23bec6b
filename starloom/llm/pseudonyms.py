"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Mail addresses, telephone numbers, payment cards, account numbers, social security
numbers, network addresses and dates are found by one pattern and validated, each by
its own rule. A value is cut into two halves; in each round one half is shifted,
place by place and within what each place may hold, by numbers that a keyed digest
draws from the other half. This permutes the values of a format, so equal values get
equal pseudonyms in all documents, different values of a kind get different ones
(except that a slash date whose day stands second may meet one whose day stands first),
and a pseudonym is valid again: check digits are computed anew. Mail addresses are equal
whatever their case, telephone numbers whatever their separators; country codes stay.
A mail address has at most 64 signs before its @ (of more, what begins within the last 64) and
eleven labels of at most 63 behind it.

A value may have neighbours that look like a part of it, such as an expiry behind a card
or a BIC behind an account number. So at every place where a format begins, all ends at
which one fits are tried, kind by kind, and the first valid part counts; the search goes
on behind it. Parts shorter than the longest must be written in a usual way: cards in
groups of four digits or more, the last one excepted; account numbers as long as their
country's are.

Dates from 1900-01-01 to 2100-05-01 are permuted; earlier and later ones count as not
valid and stay in clear text.

Everything is SQL expressions on whole texts. A null text stays null. Rows with equal
or null ``doc_id`` are rewritten each by itself. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

# The formats, each with its kind; at one place the first that matches counts.
_BEFORE, _BEHIND = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
FORMATS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,10}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ip": r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\1[0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}",
}
KINDS = list(FORMATS)
PATTERN = f"{_BEFORE}(?:{'|'.join(FORMATS.values())}){_BEHIND}"

# A date may be followed by a time of day.
_STAMPED = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]{2}:)"

# Where a format begins, whatever is before. Group 2 has the signs that follow, more than any other format has, and if
# there is a mail address that as well. Group 1 is that of dates.
_REACH = 50
# A card behind a digit and a separator counts only in usual groups, so it begins with four digits.
_STARTS = FORMATS | {"card": f"(?:(?<![0-9][ .-])|(?=[0-9]{{4}})){FORMATS['card']}"}
START = (
    f"{_BEFORE}(?=(?:{'|'.join(_STARTS.values())}){_BEHIND}|{_STAMPED})"
    f"(?=((?:{FORMATS['email']}{_BEHIND})?(?s:.{{0,{_REACH}}})))"
)
_BLOCK = 512  # starts that are put together at a time

# How cards are written, and how long account numbers are by country.
_SOLID, _GROUPED = r"^[0-9]+$", r"^[0-9]{4,}(?:[ -][0-9]{4,})*(?:[ -][0-9]{1,3})?$"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DJ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_COUNTRIES = "^(?:" + "|".join(IBAN_LENGTHS.values()).replace(" ", "|") + ")"
_OWN_LENGTH = "^(?:" + "|".join(f"(?:{c.replace(' ', '|')})[A-Z0-9]{{{n - 2}}}" for n, c in IBAN_LENGTHS.items()) + ")$"
_AMERICAN = r"^\+1[ .-]?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}$"

# What the letters of a mask allow at their place: first sign and number of signs. Other places stay as they are.
_ALPHABETS = {"9": ("0", 10), "a": ("a", 26), "A": ("A", 26), "h": ("0", 16), "n": ("2", 8), "b": ("0", 2)}
_HEX = "0123456789abcdef"

_FIRST_DAY, _DAYS = "1900-01-01", (270, 271)  # 73,170 days, to 2100-05-01


def _draws(key: str, kind: str, round_: Column, other: Column) -> Column:
    """128 hexadecimal digits that depend on the key, the kind, the round and the other half."""
    parts = (F.lit(key), F.lit(kind), round_.cast("string"), other)
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 512)


def _number(draws: Column, place: Column) -> Column:
    """The number below 65,536 for a place, counted from 1."""
    return F.conv(F.substr(draws, F.pmod(place - 1, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _shift(half: Column, mask: Column, draws: Column) -> Column:
    """``half`` with each place moved on within what its mask allows."""

    def sign(place: Column) -> Column:
        own, kind, move = F.substr(half, place, F.lit(1)), F.substr(mask, place, F.lit(1)), _number(draws, place)
        out = own
        for letter, (first, size) in _ALPHABETS.items():
            if letter == "h":
                at = F.pmod(F.instr(F.lit(_HEX), own) - 1 + move, F.lit(size))
                new = F.substr(F.lit(_HEX), at + 1, F.lit(1))
            else:
                new = F.char((F.pmod(F.ascii(own) - ord(first) + move, F.lit(size)) + ord(first)).cast("long"))
            out = F.when(kind == letter, new).otherwise(out)
        return out

    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(half), F.lit(1))), lambda i: i <= F.length(half))
    return F.array_join(F.transform(places, sign), "")


def permuted(value: Column, mask: Column, key: str, kind: str) -> Column:
    """``value`` permuted within the format that ``mask`` gives, one sign for each place."""
    cut = F.floor(F.length(value) / 2).cast("int")
    # Rounds turn by turn: the halves swap places, so that one step serves both.
    state = lambda a, b, c, d: F.struct(a.alias("l"), b.alias("r"), c.alias("lm"), d.alias("rm"))
    part = lambda x, first: F.substr(x, F.lit(1), cut) if first else F.substr(x, cut + 1, F.length(x))
    start = state(part(value, True), part(value, False), part(mask, True), part(mask, False))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda s, i: state(s["r"], _shift(s["l"], s["lm"], _draws(key, kind, i, s["r"])), s["rm"], s["lm"]),
        lambda s: F.concat(s["l"], s["r"]),
    )


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _plain_mask(text: Column) -> Column:
    masked = F.regexp_replace(text, "[0-9]", "9")
    return F.regexp_replace(F.regexp_replace(masked, "[a-z]", "a"), "[A-Z]", "A")


def _refill(pattern_text: Column, signs: Column) -> Column:
    """``pattern_text`` with its letters and digits replaced, in order, by ``signs``; separators stay."""
    return F.aggregate(
        F.filter(F.split(pattern_text, ""), lambda c: c != ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike("[A-Za-z0-9]"),
            F.struct(F.concat(s["out"], F.substr(signs, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum of payment cards; a valid number's is a multiple of 10."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda total, i: total
        + _once(
            F.coalesce(F.substr(digits, i, F.lit(1)).try_cast("int"), F.lit(0)) * F.when(F.pmod(n - i, F.lit(2)) == 1, 2).otherwise(1),
            lambda d: d - F.when(d > 9, 9).otherwise(0),
        ),
    )


def _card(text: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        body = F.substr(digits, F.lit(1), F.length(digits) - 1)
        own = permuted(body, F.regexp_replace(body, "[0-9]", "9"), key, "card")
        filled = _once(own, lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(F.pmod(luhn_sum(digits), F.lit(10)) == 0, filled)

    return _once(_bare(text), lambda d: _once(new(d), lambda n: F.when(n.isNotNull(), _refill(text, n))))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of a number in which letters stand for 10 to 35."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0),
        lambda total, c: F.when(c.rlike("[0-9]"), (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(text: Column, key: str) -> Column:
    def new(plain: Column) -> Column:
        country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
        valid = _mod97(F.concat(body, country, F.substr(plain, F.lit(3), F.lit(2)))) == 1
        check = lambda b: F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        own = permuted(body, _plain_mask(body), key, "iban")
        return F.when(valid & F.length(plain).between(15, 34), _once(own, lambda b: F.concat(country, check(b), b)))

    return _once(_bare(text), lambda p: _once(new(p), lambda n: F.when(n.isNotNull(), _refill(text, n))))


def _ip(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, "\\."), lambda o: o.cast("int"))
    as_hex = lambda parts: F.array_join(F.transform(parts, lambda o: F.lpad(F.lower(F.hex(o)), 2, "0")), "")
    back = lambda x: F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substr(x, i * 2 + 1, F.lit(2)), 16, 10)), "."
    )
    valid = F.forall(octets, lambda o: o <= 255)
    return F.when(valid, _once(permuted(as_hex(octets), F.lit("hhhhhhhh"), key, "ip"), back))


def _ssn(text: Column, key: str) -> Column:
    valid = lambda t: t.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    one = lambda t: permuted(t, F.lit("999-99-9999"), key, "ssn")
    # A permutation of all numbers, walked until it is at a valid one again, permutes the valid ones.
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(12)), one(text), lambda t, _: F.when(valid(t), t).otherwise(one(t)))
    return F.when(valid(text), walked)


def _date(text: Column, key: str) -> Column:
    iso, slash = text.rlike("^[0-9]{4}-"), text.rlike("/")
    day_first = F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))
    month_first = F.to_date(F.try_to_timestamp(text, F.lit("MM/dd/yyyy")))
    form = (
        F.when(iso, "yyyy-MM-dd").when(~slash, "dd.MM.yyyy").when(day_first.isNotNull(), "dd/MM/yyyy").otherwise("MM/dd/yyyy")
    )
    value = (
        F.when(iso, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))
        .when(~slash, F.to_date(F.try_to_timestamp(text, F.lit("dd.MM.yyyy"))))
        .otherwise(F.coalesce(day_first, month_first))
    )
    rows, columns = _DAYS

    def moved(day: Column) -> Column:
        state = lambda a, b: F.struct(a.cast("int").alias("l"), b.cast("int").alias("r"))
        # After each round the halves swap, so their sizes do by turns.
        step = lambda s, i: state(
            s["r"],
            F.pmod(
                s["l"] + _number(_draws(key, "date", i, s["r"].cast("string")), F.lit(1)),
                F.when(F.pmod(i, F.lit(2)) == 1, rows).otherwise(columns),
            ),
        )
        start = state(F.floor(day / columns), F.pmod(day, F.lit(columns)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * columns + s["r"])

    day = F.date_diff(value, F.lit(_FIRST_DAY).cast("date"))
    new = _once(day, lambda d: F.when(d.between(0, rows * columns - 1), F.date_add(F.lit(_FIRST_DAY).cast("date"), moved(d))))
    written = lambda n: (
        F.when(form == "yyyy-MM-dd", F.date_format(n, "yyyy-MM-dd"))
        .when(form == "dd.MM.yyyy", F.date_format(n, "dd.MM.yyyy"))
        .when(form == "dd/MM/yyyy", F.date_format(n, "dd/MM/yyyy"))
        .otherwise(F.date_format(n, "MM/dd/yyyy"))
    )
    return _once(new, written)


# How country codes begin; no code begins like another one.
_COUNTRY_CODE = r"^(\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}))"


def _phone(text: Column, key: str) -> Column:
    # The country code stays. Groups of the North American plan start with 2 to 9; in any number of ten
    # digits the first signs of the first two groups stay within 0 and 1, or within 2 to 9.
    country = F.regexp_extract(text, _COUNTRY_CODE, 1)
    rest = F.substr(text, F.length(country) + 1, F.length(text))
    digits = _bare(rest)
    group = lambda place: F.when(F.substr(digits, F.lit(place), F.lit(1)) < "2", "b").otherwise("n")
    mask = F.when(F.length(digits) == 10, F.concat(group(1), F.lit("99"), group(4), F.lit("999999"))).otherwise(F.regexp_replace(digits, "[0-9]", "9"))
    valid = F.length(_bare(text)).between(7, 15) & (F.length(digits) > 3)
    return F.when(valid, F.concat(country, _refill(rest, permuted(digits, mask, key, "phone"))))


def _email(text: Column, key: str) -> Column:
    # All but the last label of the domain, as if in lower case; case, digits and signs stay where they are.
    name, last = F.regexp_extract(text, r"^(.*)(\.[A-Za-z0-9-]+)$", 1), F.regexp_extract(text, r"^(.*)(\.[A-Za-z0-9-]+)$", 2)
    valid = last.rlike("^\\.[A-Za-z]{2,}$")
    sign = lambda x, i: F.substr(x, i, F.lit(1))
    cased = lambda new: F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.when(sign(name, i).rlike("[A-Z]"), F.upper(sign(new, i))).otherwise(sign(new, i))), ""
    )
    return F.when(valid, F.concat(_once(permuted(F.lower(name), _plain_mask(F.lower(name)), key, "email"), cased), last))


_RULES = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def _ends(window: Column) -> Column:
    """The beginnings of ``window`` that end with a word, the longest first."""
    words = F.regexp_extract_all(window, F.lit("[^A-Za-z0-9]*[A-Za-z0-9]+"), F.lit(0))
    upto = lambda w: F.transform(
        F.filter(F.sequence(F.size(w), F.lit(0)), lambda i: i > 0), lambda i: F.array_join(F.slice(w, F.lit(1), i), "")
    )
    return F.filter(_once(words, upto), lambda t: F.length(t) < _REACH)


def _first_of(texts: Column, rule) -> Column:
    """``texts`` with those that meet the rule in front."""
    return F.concat(F.filter(texts, rule), F.filter(texts, lambda t: ~rule(t)))


def _parts(kind: str, ends: Column, window: Column, before: Column) -> Column:
    """The beginnings of ``window`` that have the form of ``kind``, in the order in which they are tried."""
    own = F.filter(ends, lambda t: t.rlike(f"^(?:{FORMATS[kind]})$"))
    if kind == "date":
        return F.concat(F.filter(F.array(F.substr(window, F.lit(1), F.lit(10))), lambda _: window.rlike(f"^{_STAMPED}")), own)
    if kind == "ip":
        dotted = before.endswith(".")
        return F.filter(own, lambda t: ~dotted & ~F.substr(window, F.length(t) + 1, F.lit(2)).rlike("^\\.[0-9]"))
    if kind == "card":
        # Any writing for the longest part of a run, usual ones for what is shorter or within.
        usual = lambda o: F.filter(o, lambda t: t.rlike(_GROUPED) | ((before == "") & (t == F.get(o, F.lit(0)))))
        return _first_of(_once(own, usual), lambda t: t.rlike(_SOLID))
    if kind == "iban":
        fits = lambda t: _bare(t).rlike(_OWN_LENGTH)
        counts = lambda o: F.filter(o, lambda t: fits(t) | ~t.rlike(_COUNTRIES) | (t == F.get(o, F.lit(0))))
        return _first_of(_once(own, counts), fits)
    if kind == "phone":
        return _first_of(own, lambda t: t.rlike(_AMERICAN))
    return own


def pseudonym(window: Column, email: Column, before: Column, key: str) -> Column:
    """``kind, n, value`` of the first valid part of ``window``, ``n`` signs from its start on; null if there is none."""

    def first(kind: str, texts: Column) -> Column:
        made = F.transform(texts, lambda t: F.struct(F.lit(kind).alias("kind"), F.length(t).alias("n"), _RULES[kind](t, key).alias("value")))
        return F.get(F.filter(made, lambda m: m["value"].isNotNull()), F.lit(0))

    mail = first("email", F.filter(F.array(email), lambda t: t != ""))
    others = _once(_ends(window), lambda e: F.coalesce(*(first(k, _parts(k, e, window, before)) for k in KINDS if k != "email")))
    return F.coalesce(mail, others)


def _put_together(starts: Column) -> Column:
    """``text, kinds`` of ``body, new`` in order; a start within a value that is taken already counts no more."""
    state = lambda skip, texts, kinds: F.struct(skip.cast("int").alias("skip"), texts.alias("texts"), kinds.alias("kinds"))
    none = F.array().cast("array<string>")

    def step(s: Column, x: Column) -> Column:
        taken = (s["skip"] == 0) & x["new"].isNotNull()
        gone = F.when(taken, x["new"]["n"]).otherwise(s["skip"])
        rest = F.substr(x["body"], gone + 1, F.length(x["body"]))
        text = F.when(taken, F.concat(x["new"]["value"], rest)).otherwise(rest)
        kinds = F.when(taken, F.array(x["new"]["kind"])).otherwise(none)
        left = F.greatest(gone - F.length(x["body"]), F.lit(0))
        return state(left, F.concat(s["texts"], F.array(text)), F.concat(s["kinds"], kinds))

    def block(s: Column, b: Column) -> Column:
        own = F.aggregate(F.slice(starts, b * _BLOCK + 1, F.lit(_BLOCK)), state(s["skip"], none, none), step)
        joined = lambda o: state(o["skip"], F.concat(s["texts"], F.array(F.array_join(o["texts"], ""))), F.concat(s["kinds"], o["kinds"]))
        return _once(own, joined)

    blocks = F.sequence(F.lit(0), F.floor((F.size(starts) - 1) / _BLOCK).cast("int"))
    return F.aggregate(
        blocks, state(F.lit(0), none, none), block, lambda s: F.struct(F.array_join(s["texts"], "").alias("text"), s["kinds"].alias("kinds"))
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_<kind>``: every text with pseudonyms for personal data, and how many of each kind."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # Every format has a digit or the sign of mail addresses; texts without them are not searched.
    searched = F.col("text").rlike("[0-9@]")
    rows = rows.select("*", F.when(searched, F.regexp_extract_all("text", F.lit(START), F.lit(2))).alias("ahead"))
    some = F.size(F.coalesce("ahead", F.array().cast("array<string>"))) > 0
    rows = rows.select("*", F.when(some, F.split("text", START, -1)).alias("cut"))
    # What joins a start to a digit before it: two signs, and no two starts are nearer to each other than that.
    first = F.size("cut") - F.size("ahead")

    def new(ahead: Column, number: Column) -> Column:
        at = number + first - 1
        behind = F.when(at >= 0, F.right(F.get("cut", at), F.lit(2))).otherwise("")
        before = F.when(behind.rlike("^[0-9][ .-]$"), behind).otherwise("")
        email = F.regexp_extract(ahead, f"^({FORMATS['email']}){_BEHIND}", 1)
        return _once(F.substr(ahead, F.lit(1), F.lit(_REACH)), lambda w: pseudonym(w, email, before, key))

    rows = rows.select("doc_id", "text", F.when(some, F.transform("ahead", new)).alias("new"), "cut")
    # What is before the first start is a part of its own, unless the text begins with a start.
    head = F.size("cut") - F.size("new")
    bodies = F.slice("cut", head + 1, F.size("new"))
    pairs = F.zip_with(bodies, "new", lambda b, n: F.struct(b.alias("body"), n.alias("new")))
    valid = F.exists("new", lambda n: n.isNotNull())
    rows = rows.select("doc_id", "text", F.array_join(F.slice("cut", F.lit(1), head), "").alias("head"), F.when(valid, _once(pairs, _put_together)).alias("found"))
    rewritten = F.coalesce(F.concat("head", F.col("found.text")), F.col("text"))
    kinds = F.coalesce("found.kinds", F.array().cast("array<string>"))
    number = lambda kind: F.size(F.filter(kinds, lambda k: k == kind)).cast("long")
    return rows.select("doc_id", rewritten.alias("text"), *(number(kind).alias(f"n_{kind}") for kind in KINDS))
