import datetime
import hashlib
import re
import time

import pytest
from cases import SMALL, bag, make_docs
from pyspark.sql import functions as F

from starloom.llm import pseudonyms
from starloom.llm.pseudonyms import permuted, pseudonymised
from starloom.llm.queries import QUERIES

KEY = "test"

TEXTS = {
    "email": ["jo.Doe+7@mail4.example.com", "a@b.org", "x_y-z@sub.host-1.co.uk"],
    "phone": ["+1 (274) 555-9629", "+49 30 1234 5678", "(212) 555-0100", "212-555-0100"],
    "card": ["4495114827612972", "4495 1148 2761 2972", "378282246310005"],
    "iban": ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "ip": ["88.100.187.118", "0.0.0.0", "255.255.255.255"],
    "ssn": ["123-45-6789", "899-99-9999"],
    "date": ["1980-02-29", "31.12.1999", "25/12/2001", "12/25/2001", "2099-12-31"],
}
INVALID = ["4495114827612973", "256.1.1.1", "1.2.3.4.5", "2001-02-30", "DE89370400440532013001", "000-12-3456", "1850-01-01", "x@localhost", "99.99.2000", "a4495114827612972"]


def luhn(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def mod97(text):
    plain = re.sub(r"\W", "", text)
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


VALID = {
    "card": luhn,
    "iban": mod97,
    "ip": lambda t: all(int(o) <= 255 for o in t.split(".")),
    "ssn": lambda t: re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t),
    "date": lambda t: any(_parses(t, f) for f in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y")),
}


def _parses(text, form):
    try:
        return datetime.datetime.strptime(text, form)
    except ValueError:
        return None


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


@pytest.fixture(scope="module")
def new(spark):
    """Pseudonyms of all values, each in a document of its own."""
    flat = [v for values in TEXTS.values() for v in values] + INVALID
    found = pseudonymised(make_docs(spark, [(i, f"see: {v}, end") for i, v in enumerate(flat)]), KEY).collect()
    return {flat[r.doc_id]: r for r in found}


@pytest.mark.parametrize("kind", TEXTS)
def test_values_change_within_their_format(new, kind):
    for value in TEXTS[kind]:
        row = new[value]
        assert row.text.startswith("see: ") and row.text.endswith(", end")
        got = row.text[5:-5]
        assert got != value and row[f"n_{kind}"] == 1
        assert sum(row[f"n_{k}"] for k in TEXTS) == 1
        assert VALID.get(kind, lambda t: True)(got)
        if kind != "ip":
            assert shape(got) == shape(value)


def test_invalid_values_stay(new):
    for value in INVALID:
        assert new[value].text == f"see: {value}, end", value
        assert sum(new[value][f"n_{k}"] for k in TEXTS) == 0


def test_equal_values_stay_linked_in_any_writing(new):
    bare = lambda t: re.sub(r"\W", "", t)
    assert bare(new["4495 1148 2761 2972"].text[5:-5]) == new["4495114827612972"].text[5:-5]
    assert bare(new["DE89 3704 0044 0532 0130 00"].text[5:-5]) == new["DE89370400440532013000"].text[5:-5]


def test_permutations_are_one_to_one(spark):
    for mask, n in (("9", 10), ("99", 100), ("h9", 160), ("an", 208), ("999", 1000)):
        signs = {"9": "0123456789", "h": "0123456789abcdef", "a": "abcdefghijklmnopqrstuvwxyz", "n": "23456789"}
        values = [""]
        for m in mask:
            values = [v + s for v in values for s in signs[m]]
        rows = spark.createDataFrame([(v,) for v in values], "v string")
        found = [r[0] for r in rows.select(permuted(F.col("v"), F.lit(mask), KEY, "x")).collect()]
        assert sorted(found) == sorted(values) and len(values) == n


def test_all_days_keep_apart(spark):
    first = datetime.date(1900, 1, 1)
    days = [(first + datetime.timedelta(days=i)).isoformat() for i in range(0, 73170, 37)]
    found = pseudonymised(make_docs(spark, list(enumerate(days))), KEY).collect()
    assert len({r.text for r in found}) == len(days)
    assert all(first <= datetime.date.fromisoformat(r.text) <= datetime.date(2100, 5, 1) for r in found)


def test_keys_differ(spark):
    docs = make_docs(spark, [(1, "4495114827612972")])
    assert pseudonymised(docs, "a").first().text != pseudonymised(docs, "b").first().text


def test_edge_rows(spark):
    long = "word 88.100.187.118 " * 3000
    rows = [(1, None), (2, ""), (3, "no data"), (None, "1980-02-29"), (4, "1980-02-29"), (4, "1980-02-29"), (5, long), (6, "1980-02-29" * 2), (7, "a@b.org a@b.org")]
    found = pseudonymised(make_docs(spark, rows), KEY)
    assert found.columns == ["doc_id", "text", *(f"n_{k}" for k in ("email", "iban", "ip", "date", "ssn", "card", "phone"))]
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[3].text == "no data"
    assert by_id[None].text == by_id[4].text != "1980-02-29"
    assert by_id[5].n_ip == 3000 and "88.100.187.118" not in by_id[5].text
    assert by_id[6].text == "1980-02-29" * 2
    assert len(set(by_id[7].text.split())) == 1
    assert found.count() == len(rows)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op1_feistel_pseudonyms"](spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(texts)
    private = r"\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\w)\d{16}(?!\w)|(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.])|[\w.]+@[\w.]+\w"
    for r in found:
        old, new = re.findall(private, texts[r.doc_id]), re.findall(private, r.text)
        # Some numbers of the given rows are no card numbers.
        kept = {n for n in old if re.fullmatch("[0-9]{16}", n) and not luhn(n)}
        assert len(old) == len(new) and set(old) & set(new) == kept
        assert re.sub(private, "", texts[r.doc_id]) == re.sub(private, "", r.text)


def test_empty_table(spark):
    assert bag(pseudonymised(make_docs(spark, []), KEY)) == []


# A text, the kinds in it, and what stays as it is.
NEIGHBOURS = [
    ("4111 1111 1111 1111 12/26", {"card": 1}, "12/26"), ("4111111111111111 123", {"card": 1}, " 123"), ("2 4111 1111 1111 1111", {"card": 1}, "2 "),
    ("4111 1111 1111 1111 555-123-4567", {"card": 1, "phone": 1}, ""), ("4111 1111 1111 1111 4111 1111 1111 1111", {"card": 2}, ""),
    ("ES9121000418450200051332 BIC", {"iban": 1}, " BIC"), ("BE68 5390 0754 7034 EUR", {"iban": 1}, " EUR"), ("ES91 2100 0418 4502 0005 1332 1234 5678", {"iban": 1}, " 1234 5678"),
    ("555-123-4567 555-987-6543", {"phone": 2}, ""), ("555-123-4567 2024-01-15", {"phone": 1, "date": 1}, ""), ("12 2024-01-15 2024-02-15", {"date": 2}, "12 "),
    ("+1 (274) 555-9629 2024-01-15", {"phone": 1, "date": 1}, ""), ("4111 1111 1111 1111.jo@example.com", {"card": 1, "email": 1}, ""), ("x@localhost 1980-02-29", {"date": 1}, "x@localhost "),
]


def test_values_with_neighbours(spark):
    found = pseudonymised(make_docs(spark, [(i, t) for i, (t, _, _) in enumerate(NEIGHBOURS)]), KEY)
    by_id = {r.doc_id: r for r in found.collect()}
    alone = pseudonymised(make_docs(spark, [(1, "4111 1111 1111 1111")]), KEY).first().text
    for i, (text, kinds, stays) in enumerate(NEIGHBOURS):
        row = by_id[i]
        assert {k: row[f"n_{k}"] for k in TEXTS if row[f"n_{k}"]} == kinds, text
        assert stays in row.text and shape(row.text) == shape(text)
        old, new = re.findall("[0-9]+", text.replace(stays, "|")), re.findall("[0-9]+", row.text.replace(stays, "|"))
        assert len(old) == len(new) and old != new
        assert ("4111 1111 1111 1111" not in text) or alone in row.text


def test_many_values_in_one_text(spark):
    text = " ".join(f"{i} 4111 1111 1111 1111" for i in range(1500))
    row = pseudonymised(make_docs(spark, [(1, text)]), KEY).first()
    assert row.n_card == 1500 and "4111" not in re.sub(r"(?<![0-9])[0-9]{1,4} (?=[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4})", "", row.text)


def test_dates_outside_the_stated_range_stay(spark):
    days = ["1899-12-31", "1900-01-01", "2100-05-01", "2100-05-02"]
    found = {r.doc_id: r for r in pseudonymised(make_docs(spark, list(enumerate(days))), KEY).collect()}
    assert [found[i].n_date for i in range(4)] == [0, 1, 1, 0]
    assert "1900-01-01 to 2100-05-01" in pseudonyms.__doc__


# -- a second version in Python --------------------------------------------------


def moved(text, mask, draws):
    signs = {"9": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "0123456789abcdef", "n": "23456789", "b": "01"}
    out = ""
    for place, (own, kind) in enumerate(zip(text, mask)):
        step = int(draws[place % 32 * 4 :][:4], 16)
        out += signs[kind][(signs[kind].index(own) + step) % len(signs[kind])] if kind in signs else own
    return out


def drawn(kind, turn, other):
    return hashlib.sha512(f"{KEY}|{kind}|{turn}|{other}".encode()).hexdigest()


def feistel(text, mask, kind):
    cut = len(text) // 2
    left, right, left_mask, right_mask = text[:cut], text[cut:], mask[:cut], mask[cut:]
    for turn in range(1, 9):
        left, right = right, moved(left, left_mask, drawn(kind, turn, right))
        left_mask, right_mask = right_mask, left_mask
    return left + right


def refilled(text, signs):
    signs = iter(signs)
    return re.sub("[A-Za-z0-9]", lambda m: next(signs), text)


def second_email(text):
    name, dot, last = text.rpartition(".")
    new = feistel(name.lower(), shape(name.lower()), "email")
    return "".join(n.upper() if o.isupper() else n for o, n in zip(name, new)) + dot + last


def second_phone(text):
    code = re.match(r"\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})", text)
    rest = text[code.end() :] if code else text
    digits = re.sub(r"\D", "", rest)
    mask = "".join(("b" if d < "2" else "n") if len(digits) == 10 and i in (0, 3) else "9" for i, d in enumerate(digits))
    return text[: len(text) - len(rest)] + refilled(rest, feistel(digits, mask, "phone"))


def second_card(text):
    body = re.sub(r"\D", "", text)[:-1]
    new = feistel(body, "9" * len(body), "card")
    return refilled(text, new + next(c for c in "0123456789" if luhn(new + c)))


def second_iban(text):
    plain = re.sub(r"\W", "", text)
    new = feistel(plain[4:], shape(plain[4:]), "iban")
    return refilled(text, next(p for p in (f"{plain[:2]}{c:02}{new}" for c in range(2, 99)) if mod97(p)))


def second_ip(text):
    new = feistel("".join(f"{int(o):02x}" for o in text.split(".")), "h" * 8, "ip")
    return ".".join(str(int(new[i : i + 2], 16)) for i in range(0, 8, 2))


def second_ssn(text):
    while True:
        text = feistel(text, "999-99-9999", "ssn")
        if VALID["ssn"](text):
            return text


def second_date(text):
    form = next(f for f in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y") if _parses(text, f))
    first = datetime.datetime(1900, 1, 1)
    left, right = divmod((_parses(text, form) - first).days, 271)
    for turn in range(1, 9):
        left, right = right, (left + int(drawn("date", turn, right)[:4], 16)) % (270 if turn % 2 else 271)
    return (first + datetime.timedelta(days=left * 271 + right)).strftime(form)


def test_against_a_second_version(new):
    second = {"email": second_email, "phone": second_phone, "card": second_card, "iban": second_iban, "ip": second_ip, "ssn": second_ssn, "date": second_date}
    for kind, values in TEXTS.items():
        for value in values:
            assert new[value].text == f"see: {second[kind](value)}, end", value


def rewritten(spark, *texts):
    rows = pseudonymised(make_docs(spark, list(enumerate(texts))), KEY).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_links_whatever_the_writing(spark):
    digits = lambda t: re.sub(r"\D", "", t)
    joined, parted, short, german, german_parted = rewritten(spark, "+15552345678", "+1 555 234 5678", "(555) 234-5678", "+4930123456", "+49 30 123 456")
    assert digits(joined) == digits(parted) == "1" + digits(short) and joined.startswith("+1") and joined != "+15552345678"
    assert digits(german) == digits(german_parted) and german.startswith("+49")
    upper, lower = rewritten(spark, "John.Doe@Example.com", "john.doe@example.com")
    assert upper.lower() == lower != "john.doe@example.com" and shape(upper) == "Aaaa.Aaa@Aaaaaaa.aaa"


def test_dates_before_a_time_of_day(spark):
    stamp, day = rewritten(spark, "at 2024-02-29T10:00:00Z.", "2024-02-29")
    assert stamp == f"at {day}T10:00:00Z." and day != "2024-02-29"


def test_numbers_of_ten_digits_keep_apart(spark):
    values = [f"{a}{i % 10}{i % 7}-{b}{i % 9}{i % 5}-{1000 + i}" for a in "0159" for b in "0159" for i in range(40)]
    found = rewritten(spark, *values)
    assert len(set(found)) == len(set(values)) and found == [second_phone(v) for v in values]


@pytest.mark.parametrize("text", ["x" + ".a" * 40 + "@b.org", "-x.y@z.org", "a@" + "b." * 14 + "org", "@" * 50 + "a@b.org", "%%%%%%%%%%%%a@b.org"])
def test_odd_addresses_do_no_harm(spark, text):
    new = rewritten(spark, text)[0]
    assert shape(new) == shape(text)


def test_long_texts_take_linear_time(spark):
    units = ["a.a.", "a-a-", "1 1 1 ", "1.1.", "a@a.", "1-1-", "+1 1", "A1 "]
    begun = time.time()
    docs = make_docs(spark, [(i, u * ((1 << 20) // len(u)) + "1") for i, u in enumerate(units)]).repartition(len(units), "doc_id")
    assert pseudonymised(docs, KEY).count() == len(units)
    assert pseudonymised(docs, KEY).agg(F.sum(F.length("text"))).first()[0] == sum((1 << 20) // len(u) * len(u) + 1 for u in units)
    assert time.time() - begun < 240
