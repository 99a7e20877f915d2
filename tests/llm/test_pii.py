"""Surrogates: nothing private stays, everything else does."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from cardsentry.llm import pii


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d)
    return total % 10 == 0


def _replaced(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.text for r in pii.replace(df, "a key", **kw).orderBy("doc_id").collect()]


def test_formats(spark):
    texts = [
        "Call +1 (743) 555-3824 now", "or +1 743 555 3824.", "card 4111 1111 1111 1111, again 4111111111111111!",
        "from 192.168.1.77 to 8.8.8.8", "Mail Ann.Lee01@mail.example.com", "mail ann.lee01@MAIL.example.com",
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "ssn 123-45-6789", "Mrs Jane Smith met Mr. Tom Smith and Herr Müller",
        "г-жа Анна Петрова", "FRAU SMITH", "Mr SMITH",
    ]
    a = _replaced(spark, texts)
    phone = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) now", a[0])
    assert phone and a[0] != texts[0]
    assert a[1] == f"or +1 {phone[1]} {phone[2]} {phone[3]}."
    spaced, solid = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), again (\d{16})!", a[2]).groups()
    assert spaced.replace(" ", "") == solid != "4" + "1" * 15 and _luhn(solid) and solid[0] == "4"
    assert re.fullmatch(r"from \d+\.\d+\.\d+\.\d+ to \d+\.\d+\.\d+\.\d+", a[3]) and "8.8.8.8" not in a[3]
    assert re.fullmatch(r"Mail [a-z]{3}\.[a-z]{3}\d\d@\w+\.example", a[4]) and a[5] == a[4].replace("Mail", "mail")
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', a[6]) and a[6] != texts[6]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", a[7]) and a[7] != texts[7]
    names = re.fullmatch(r"Mrs (\w+na) (\w+) met Mr\. (\w+r) (\w+) and Herr (\w+)", a[8])
    assert names and names[2] == names[4] != "Smith" and names[5] != names[2]
    assert re.fullmatch(r"г-жа [А-Яа-я]+на [А-Яа-я]+лин", a[9])
    assert a[10] == texts[10]  # not a title in this form
    assert a[11] == f"Mr {names[2].upper()}"


def test_clean_texts_stay(spark):
    texts = ["Version 1.2.3.4.5 of 2024-05-06, 12:30, 1,234,567.89 and 3.14159", "a@b", "x" * 50_000, "", None, "+1 is a vote",
             "Miss the bus", "ids 123456789012 and 1234-5678", "I token = you"]
    assert _replaced(spark, texts) == texts


def test_secret_names_and_national_numbers(spark):
    hidden = ["Zq81LmPx02RtYw77KdVb", "deadbeefdeadbeefdead", "hunter2x", "P@ssw0rd!", "correcthorse", "abcdEFGH12345678wxyz"]
    texts = [f"API_KEY={hidden[0]}", f"access_token={hidden[1]}; client_secret = '{hidden[0]}'", f"Password: {hidden[2]}.", f"PASSWORD: {hidden[3]} ok",
             f'{{"password": "{hidden[4]}", "api_key": "{hidden[5]}"}}', f"my passwd={hidden[3]}",
             "Call (555) 201-7788 or 555-201-7788 or 1-555-201-7788, abroad +1 (555) 201-7788."]
    out = _replaced(spark, texts)
    assert not any(x in t for t in out for x in hidden)
    assert re.fullmatch(r"API_KEY=[A-Za-z0-9]{20}", out[0]) and re.fullmatch(r"Password: [a-z]{6}\d[a-z]\.", out[2])
    assert re.fullmatch(r'\{"password": "[a-z]{12}", "api_key": "[A-Za-z0-9]{20}"\}', out[4])
    one, two, three, four = re.fullmatch(
        r"Call (\(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}) or 1-(\d{3}-\d{3}-\d{4}), abroad \+1 (\(\d{3}\) \d{3}-\d{4})\.", out[6]).groups()
    assert "201-7788" not in out[6] and one == four and two == three == one.replace("(", "").replace(") ", "-")
    blanks = ["Password: ________________", 'password = "******"', "the secret: everything we knew", "Token: none", "10-555-201-77889"]
    assert _replaced(spark, blanks) == blanks


def test_every_position(spark):
    one = "a.b@c.org"
    texts = [one, f"{one} x", f"x {one}", f"{one} {one}", f"{one},8.8.4.4,{one}"]
    out = _replaced(spark, texts)
    (mail,) = {m for t in out for m in re.findall(r"\S+?@\w+\.example", t.replace(",", " "))}
    assert out[:4] == [mail, f"{mail} x", f"x {mail}", f"{mail} {mail}"]
    assert re.fullmatch(rf"{re.escape(mail)},[\d.]+,{re.escape(mail)}", out[4])


def test_collisions_are_drawn_again(spark, monkeypatch):
    """Many short values of one small space, and a space with room for all but few."""
    values = [(f"{i:03d}-00-0000".replace("-", ""),) for i in range(600)]
    entities = spark.createDataFrame([("ssn", v) for (v,) in values], "type string, value string")
    plain = pii.surrogate

    def crowded(key, kind, value, rnd):
        return F.concat(F.substring(plain(key, kind, value, rnd), 1, 3), F.lit("999999"))

    monkeypatch.setattr(pii, "surrogate", crowded)
    done = pii.resolve(entities, "k").collect()
    assert len(done) == 600 == len({r.surrogate for r in done}) == len({r.value for r in done})
    assert not {r.surrogate for r in done} & {v for (v,) in values}


def test_keys_differ_and_repeat(spark):
    text = ["mail some.body77@mail.example.com"]
    df = spark.createDataFrame([(0, text[0])], "doc_id long, text string")
    a, b, c = (pii.replace(df, k).first().text for k in ("one", "one", "two"))
    assert a == b != c


def test_odd_documents(odd_docs, no_docs):
    got = pii.replace(odd_docs, "k", count="n_replaced")
    assert got.columns == [*odd_docs.columns, "n_replaced"] and got.count() == odd_docs.count()
    same = odd_docs.where(~F.coalesce("text", F.lit("")).rlike("[@]"))
    left = got.where("n_replaced = 0").drop("n_replaced")
    assert left.exceptAll(same).isEmpty() and same.exceptAll(left).isEmpty()
    changed = [r.text for r in got.where("n_replaced > 0").collect()]
    assert len(changed) == 2 and not any("ann.lee" in t.lower() or "4111" in t or "deadbeef" in t for t in changed)
    assert pii.replace(no_docs, "k").count() == 0


def test_long_hostile_texts_of_every_alphabet(spark):
    """Much of what each part of the pattern repeats: no recursion, no
    matches where there are none."""
    n = 100_000
    texts = ["mail x@" + "a." * (n // 2) + "com", "x@" + "a" * n, "a." * (n // 2), "x@" * (n // 2), "x@" + "-." * (n // 2), "+1 " + "555 " * (n // 4), "1" * n,
             "1234 " * (n // 5), "1.2.3." * (n // 6), "555-" * (n // 4), "token = " + "a" * n, "token = \"" + "a" * n, "token = " * (n // 8), "Mr " + "Aa" * (n // 2),
             "Mr A" + "' A" * (n // 3), "secret:" + " " * n, "%+-._" * (n // 5), "(" * n, "Mr " * (n // 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in pii.replace(df, "k", count="n").select("doc_id", "n", F.length("text").alias("l"), F.substring("text", 1, 8).alias("h")).collect()}
    assert len(got) == len(texts)
    assert all(got[i].n == 0 and got[i].l == len(texts[i]) for i in (0, 1, 2, 3, 4, 6, 15, 16, 17))


def test_numbers_and_words_that_are_nobodys(spark):
    texts = ["ISBN 9780306406157", "at 1700000000000 ms", "order 4111111111111112", "version 1.2.3.4", "v1.2.3.4", "no personal data", "a@b..", "a@.com"]
    assert _replaced(spark, texts) == texts
    out = _replaced(spark, ["card 4111111111111111", "Dr. John Brown came", "Prof Ann Brown too", "host 8.8.4.4", "4111 1111 1111 1112", "mail a.b@c-d.co.uk."])
    assert "4111111111111111" not in out[0] and re.fullmatch(r"card 4\d{15}", out[0])
    first, second = re.fullmatch(r"Dr\. (\w+) (\w+) came", out[1]), re.fullmatch(r"Prof (\w+) (\w+) too", out[2])
    assert first[2] == second[2] != "Brown" and "John" not in out[1]
    assert "8.8.4.4" not in out[3] and "1112" not in out[4] and re.fullmatch(r"mail [a-z]\.[a-z]@[a-z]{6}\.example\.", out[5])


def _plain_entities(text):
    """Independent scan for mail addresses, US social security numbers and
    four-group cards, by Python."""
    found = [("email", m[0].lower()) for m in re.finditer(r"(?<![\w.%+-])[\w.%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}", text)]
    found += [("ssn", m[0].replace("-", "")) for m in re.finditer(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", text)]
    return found + [("card", re.sub(r"\D", "", m[0])) for m in re.finditer(r"(?<![\d.-])(?:\d{4}[ -]){3}\d{4}(?!\d)", text)]


def test_random_texts_by_a_plain_scan(spark):
    """Every entity of the plain scan goes, one surrogate each, distinct, the
    rest of the text stays letter for letter."""
    rng = random.Random(11)
    bits = ["bob@mail.example.org", "Bob@mail.example.org", "ann.x@a-b.co.uk", "123-45-6789", "987-65-4321", "4111 1111 1111 1111", "4111-1111-1111-1111", "word", "and", "12",
            "x@", "@y", "1234 5678", "a.b", "Ünder"]
    texts = [" , ".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(200)]
    out = _replaced(spark, texts)
    said: dict[tuple[str, str], set[str]] = {}
    for before, after in zip(texts, out, strict=True):
        a, b = before.split(" , "), after.split(" , ")
        assert len(a) == len(b)
        for x, y in zip(a, b, strict=True):
            found = _plain_entities(x)
            if not found:
                assert x == y
                continue
            kind, value = found[0]
            said.setdefault((kind, value), set()).add(re.sub(r"\D", "", y) if kind != "email" else y)
    assert all(len(v) == 1 for v in said.values()) and len({next(iter(v)) for v in said.values()}) == len(said) == 5
    assert not {next(iter(v)) for v in said.values()} & {k[1] for k in said}
