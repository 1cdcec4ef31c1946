import datetime
import random
import re
import time

import pytest

from pulse.llm import pseudonyms as p

KEY = b"secret"


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation_without_fixed_points(size):
    network = p.Feistel(KEY, "test", size)
    new = [network.swap(x) for x in range(size)]
    assert sorted(new) == list(range(size))
    assert all(x != y for x, y in enumerate(new))
    assert [network.swap(y, back=True) for y in new] == list(range(size))


CASES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "address": ["10.0.0.1", "255.255.255.255", "192.168.1.20"],
    "date": ["1984-02-29", "02/29/1984", "31/12/1990", "24.12.2001"],
    "written date": ["5 March 1984", "March 5, 1984", "12 may 1999", "MAY 4 1990"],
    "social": ["123-45-6789"],
    "phone": ["+1 (974) 555-3436", "+49 30 1234567", "(415) 555-2671", "415-555-2671"],
    "email": ["jo.doe@example.com", "a1@x.org", "heitlich.60@mail8.example.com"],
    "secret": ['token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', 'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"', "api_key: Zz12345678abcdefXY"],
}


@pytest.mark.parametrize("kind", CASES)
def test_values_change_within_their_format(kind):
    shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", t)))
    for value in CASES[kind]:
        text = f"before {value} after {value}."
        new, spans = p.replace(text, KEY)
        assert [s[2] for s in spans] == [kind, kind], value
        first, second = (new[a:b] for a, b, _ in spans)
        assert first == second and value not in new
        assert new[spans[1][0] : spans[1][1]] == second
        if kind not in ("address", "secret", "date", "written date"):
            assert shape(first) == shape(value)
        assert p.replace(new, KEY, back=True)[0] == text
        assert p.replace(text, b"another")[0] != new


def test_new_values_are_valid():
    for i in range(200):
        digits = f"{i * 7919:015d}"
        new, spans = p.replace(digits + p.luhn_digit(digits), KEY)
        if spans:
            assert p.luhn_digit(new[:-1]) == new[-1]
    for i in range(300):
        day = datetime.date(1950, 1, 1) + datetime.timedelta(days=i * 53)
        forms = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%d.%m.%Y", "%B {}, %Y", "{} %b %Y", "{} %B %Y")
        for form in forms:
            text = day.strftime(form).format(day.day)
            new, spans = p.replace(text, KEY)
            assert spans and p.replace(new, KEY, back=True)[0] == text, (text, new)


def test_secrets_of_any_length_and_with_dots():
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_"
    draw = lambda n, of=letters: "".join(random.Random(n).choices(of, k=n))
    values = [draw(n) for n in (16, 128, 129, 512, 513, 5000, 200_000)] + [draw(n, "0123456789abcdef") for n in (300, 600, 2000)]
    values += [draw(1000, "0123456789ABCDEF"), f"{draw(36)}.{draw(700)}.{draw(43)}", f"v1.{draw(40)}", f"{draw(24)}.{draw(6)}.{draw(27)}"]
    for value in values:
        text = f"first token = '{value}'. Then more."
        new, spans = p.replace(text, KEY)
        assert [s[2] for s in spans] == ["secret"], value[:50]
        changed = new[len("first token = '") : -len("'. Then more.")]
        assert len(changed) == len(value) and p.replace(text, KEY)[0] == new
        # No stretch of it stays, and each part changes.
        assert all(changed[a : a + 16] != value[a : a + 16] for a in range(0, len(value) - 15, 16))
        assert all(a != b for a, b in zip(changed.split("."), value.split("."), strict=True) if len(a) > 5)
        assert p.replace(new, KEY, back=True)[0] == text
    # A short dotted word hides no secret behind it, and long rows of them are read once.
    assert p.replace("key: a.key: 0123456789abcdef01.", KEY)[1] and p.replace("key: a.b1 c", KEY) == ("key: a.b1 c", [])
    began = time.perf_counter()
    assert p.replace("key=a1." * 100_000, KEY)[1] == [] and time.perf_counter() - began < 20


@pytest.mark.parametrize("text", ["3/5/1984", "12/5/1984", "3/15/1984", "31/1/1990", "5.3.1984", "24.3.1984", "5.12.1984", "1984-3-5", "1984/11/5", "1984-3-25", "03/5/1984", "5.03.1984"])
def test_days_and_months_of_one_digit(text):
    new, spans = p.replace(f"on {text}.", KEY)
    assert spans == [(3, 3 + len(text), "date")] and new != f"on {text}."
    assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"on {text}.")
    assert p.replace(new, KEY, back=True)[0] == f"on {text}."
    assert p.replace("0/5/1984 2021-2-30", KEY)[1] == []


@pytest.mark.parametrize("text", ["9807915762804490", "10.0.0.300", "1.2.3.4.5", "2021-13-40", "000-12-3456", "version 3.0, page 12345", "GB00WEST12345698765432", "", "no numbers"])
def test_what_is_not_valid_stays(text):
    assert p.replace(text, KEY) == (text, [])


def test_columns_nulls_and_empty_tables(spark):
    rows = [(1, "mail a.b@x.org", "kept", None), (2, None, "k", None), (3, "", None, None), (1, "mail a.b@x.org", "kept", None), (4, "a.b@x.org " * 5000, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `text.new` string, pii_spans string")
    out = p.pseudonymise(docs, "k")
    assert out.columns == ["doc_id", "text", "text.new", "pii_spans"]
    got = out.collect()
    texts = {r.doc_id: r.text for r in got}
    assert texts[2] is None and texts[3] == "" and len({r.text for r in got if r.doc_id == 1}) == 1
    name = texts[1].split()[1]
    assert texts[4] == (name + " ") * 5000 and name != "a.b@x.org"
    back = p.pseudonymise(out.drop("pii_spans"), "k", back=True)
    assert sorted((r.doc_id, r.text or "") for r in back.collect()) == sorted((r[0], r[1] or "") for r in rows)
    assert p.pseudonymise(docs.limit(0), "k").count() == 0


def test_addresses_of_any_length():
    names = ["a@b.c.d.e.f.g.h.i.j.k.com", "n" * 65 + "@x.org", "Long.name-7" * 60 + "@mail.x.org", "_first@x.org", "a%b+c@x.org"]
    for name in names:
        text = f"to <{name}>, and {name}."
        new, spans = p.replace(text, KEY)
        assert [s[2] for s in spans] == ["email"] * 2 and name not in new
        assert new[slice(*spans[0][:2])] == new[slice(*spans[1][:2])]
        assert new.split("@")[1].startswith(name.split("@")[1]) and len(new) == len(text)
        assert p.replace(new, KEY, back=True)[0] == text
    began = time.perf_counter()
    assert p.replace("a%b." * 200_000, KEY)[1] == [] and p.replace("a@" + "b." * 200_000, KEY)[1] == []
    assert time.perf_counter() - began < 20


def test_secrets_without_digits(spark):
    for text in ("password=SuperSecretPassphraseHere", "password=correcthorsebatterystaple", "token: Ab-cdEfgh_ijklMnop", 'secret = "ABCDEFGHijklmnopqr"'):
        new, spans = p.replace(text, KEY)
        assert [s[2] for s in spans] == ["secret"], text
        assert new != text and len(new) == len(text) and p.replace(new, KEY, back=True)[0] == text
    for text in ("key: responsibilities", "The secret: Internationalization", "TOKEN: ABCDEFGHIJKLMNOPQ", "password=short"):
        assert p.replace(text, KEY) == (text, [])
    docs = spark.createDataFrame([(1, "password=SuperSecretPassphraseHere")], "doc_id long, text string")
    assert "Super" not in p.pseudonymise(docs, "k").first().text


def plain_feistel(key, kind, size, x, back=False):
    """The permutation written out: walk, step, walk back."""
    import hashlib
    import hmac

    half = max(1, ((size - 1).bit_length() + 1) // 2)
    own = hmac.new(key, f"{kind}:{size}".encode(), hashlib.sha256).digest()

    def mix(i, v):
        width = half // 8 + 1
        digest = hashlib.blake2b(bytes([i]) + v.to_bytes(width, "little"), key=own, digest_size=min(64, width)).digest()
        return int.from_bytes(digest, "little") % 2**half

    def forward(v):
        while True:
            a, b = divmod(v, 2**half)
            for i in range(p.ROUNDS):
                a, b = b, a ^ mix(i, b)
            v = a * 2**half + b
            if v < size:
                return v

    def backward(v):
        while True:
            a, b = divmod(v, 2**half)
            for i in reversed(range(p.ROUNDS)):
                a, b = b ^ mix(i, a), a
            v = a * 2**half + b
            if v < size:
                return v

    return backward((forward(x) + (-1 if back else 1)) % size)


def test_values_are_those_of_a_plain_permutation():
    for i in range(60):
        digits = f"{4 * 10**14 + i * 104729:015d}"
        card = digits + p.luhn_digit(digits)
        body = plain_feistel(KEY, "card", 10**15, int(digits))
        new = f"{body:015d}"
        assert p.replace(f"pay {card} now", KEY)[0] == f"pay {new}{p.luhn_digit(new)} now"
        address = plain_feistel(KEY, "address", 2**32, i * 65_537 + 9)
        dotted = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
        assert p.replace(f"from {dotted(i * 65_537 + 9)}", KEY)[0] == f"from {dotted(address)}"
        day = datetime.date(1960, 1, 1) + datetime.timedelta(days=i * 211)
        start = datetime.date(1900, 1, 1).toordinal()
        new = datetime.date.fromordinal(start + plain_feistel(KEY, "date", 73_049, day.toordinal() - start))
        assert p.replace(f"on {day}", KEY)[0] == f"on {new}"
