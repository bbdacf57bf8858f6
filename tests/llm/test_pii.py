import re

from pyspark.sql import functions as F

from .conftest import ODD
from dqflow.llm import pii

ROWS = [
    (1, "Write to Jane.Doe7@mail.example.com or JANE.DOE7@MAIL.EXAMPLE.COM, call +1 (264) 555-5961."),
    (2, "jane.doe7@mail.example.com again; server 67.218.116.82 and 67.218.116.83. Version 1.2.3 stays."),
    (3, "Card 4568668072826647 or 4111 1111 1111 1111, SSN 123-45-6789, not 1234567."),
    (4, "Mr. John Smith met Mrs. Anna Smith and Herr Müller; г-жа Анна Иванова тоже. Smith alone goes too."),
    (5, "DE89 3704 0044 0532 0130 00 and 415-555-0123"),
    (6, None), (7, ""), (8, "nothing personal"), (8, "nothing personal"), (9, "twice +1 (264) 555-5961"), (9, "twice +1 (264) 555-5961"),
]


def luhn(number):
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def run(spark, rows=ROWS, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return pii.pseudonymise(df, **options).collect()


def test_surrogates(spark):
    rows = run(spark)
    got = {r.doc_id: r.text for r in rows}
    assert len(rows) == len(ROWS)
    mail, upper = re.findall(r"\S+@\S+?(?=[ ,])", got[1])
    assert upper == mail.upper() and mail != "jane.doe7@mail.example.com" and re.fullmatch(r"[a-z]{4}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{7}\.example", mail)
    assert got[2].startswith(mail + " again")  # one entity, one surrogate, in every document
    phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1])[0]
    assert phone != "+1 (264) 555-5961" and [r.text for r in rows if r.doc_id == 9] == [f"twice {phone}"] * 2
    a, b = re.findall(r"\d+\.\d+\.\d+\.\d+", got[2])
    assert a != b and {a, b}.isdisjoint({"67.218.116.82", "67.218.116.83"}) and all(int(x) < 256 for x in (a + "." + b).split(".")) and "Version 1.2.3 stays." in got[2]
    card = re.search(r"Card (\d{16}) or (\d{4} \d{4} \d{4} \d{4}), SSN (9\d\d-\d\d-\d{4}), not 1234567\.", got[3])
    assert card and card[1][0] == card[2][0] == "4" and luhn(card[1]) == luhn("4568668072826647") and luhn(card[2]) and "4111 1111" not in got[3]
    people = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+) and Herr (\w+); г-жа (\w+) (\w+) тоже\. (\w+) alone goes too\.", got[4])
    assert people and people[2] == people[4] == people[8] != people[5] and people[1] in pii._GIVEN["m", "latin"] and people[3] in pii._GIVEN["f", "latin"]
    assert people[6] in pii._GIVEN["f", "cyrillic"] and re.fullmatch("[А-я]+", people[7])
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d and \d{3}-\d{3}-\d{4}", got[5]) and "3704" not in got[5]
    assert got[6] is None and got[7] == "" and got[8] == "nothing personal"
    counts = {r.doc_id: {k: r[f"n_{k}"] for k in pii.KINDS if r[f"n_{k}"]} for r in rows}
    assert counts == {1: {"email": 2, "phone": 1}, 2: {"email": 1, "ip": 2}, 3: {"card": 2, "ssn": 1}, 4: {"person": 4}, 5: {"iban": 1, "phone": 1},
                      6: {}, 7: {}, 8: {}, 9: {"phone": 1}}


def test_keys_decide(spark):
    one, same, other = (sorted(str(r.text) for r in run(spark, ROWS[:2], key=k)) for k in ("a", "a", "b"))
    assert one == same != other


def test_collisions_are_drawn_again(spark):
    """Sixteen given names cannot serve three hundred people."""
    syllables = pii._SYLLABLES["latin"].split()[:18]
    names = [(f"given_m_latin", a + b) for a in syllables for b in syllables][:300]
    names += [("given_m_latin", n.lower()) for n in pii._GIVEN["m", "latin"].split()]  # drawn names that are entities themselves
    entities = spark.createDataFrame(names, "entity string, norm string")
    got = pii.surrogates(entities, "k").collect()
    assert len(got) == len(names) == len({r.surrogate for r in got})
    assert {r.surrogate for r in got}.isdisjoint({n for _, n in names})


def test_odd_rows_and_plan(spark, odd, empty):
    got = pii.pseudonymise(odd)
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted((str(k), t or "") for k, t in ODD)
    assert pii.pseudonymise(empty).count() == 0
    plan = pii.pseudonymise(odd.withColumn("n_email", F.lit(1)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


WHOLE = {
    "person": ["Mrs Anna-Maria Smith-Jones", "Mr John Michael Smith", "Mr O'Brien", "Mr. J. Smith", "Dr. Anna Smith", "Herr Prof. Dr. Jörg Müller-Lüdenscheidt"],
    "email": ["jörg.müller@example.de", "info@müller.de", "иван@почта.рф"],
    "phone": ["415 555 0123", "1-800-555-0199", "01 23 45 67 89", "0171 2345678", "+1 (264) 555-5961"],
    "card": ["4111 1111 1111 1111", "4568668072826647"],
}


def test_nothing_of_an_entity_is_left(spark):
    cases = [(kind, x) for kind, xs in WHOLE.items() for x in xs]
    for (kind, x), r in zip(cases, sorted(run(spark, [(k, f"ask {x}, now") for k, (_, x) in enumerate(cases)])), strict=True):
        assert r[f"n_{kind}"] == 1 and sum(r[f"n_{k}"] for k in pii.KINDS) == 1, x
        assert r.text.startswith("ask ") and r.text.endswith(", now")
        left = {w.lower() for w in re.findall(r"[^\W\d]{2,}", x)} & {w.lower() for w in re.findall(r"[^\W\d]{2,}", r.text)}
        assert left <= {"mr", "mrs", "dr", "herr", "prof", "example"}, (x, r.text)  # titles, and the domain of all surrogates
        assert kind != "email" or r.text.isascii()
        assert not re.search(r"\d", x) or re.sub(r"\D", "", r.text) != re.sub(r"\D", "", x)


def test_a_card_has_a_check_digit(spark):
    texts = ["no card 4111 1111 1111 1112 here", "id 4568668072826649", "2 4111 1111 1111 1111 12", "on 01.02.2024 and 01-02-2024"]
    got = sorted(run(spark, list(enumerate(texts))))
    assert [got[k].text for k in (0, 1, 3)] == [texts[k] for k in (0, 1, 3)] and got[0].n_card == got[1].n_card == 0
    found = re.fullmatch(r"2 (4\d{3} \d{4} \d{4} \d{4}) 12", got[2].text)
    assert found and luhn(found[1]) and "1111 1111" not in found[1] and got[2].n_card == 1


def test_small_spaces_do_not_run_out(spark):
    """More addresses of a format than the format has values."""
    texts = [(k, f"{chr(97 + k // 26 % 26)}@{chr(97 + k % 26)}.de and {chr(97 + k // 26 % 26)}@{chr(97 + k % 26)}.com") for k in range(676)]
    got = run(spark, texts)
    mails = [m for r in got for m in re.findall(r"\S+@\S+", r.text)]
    assert len(mails) == 1352 == len(set(mails)) and all(m.endswith(".example") for m in mails)


def test_names_are_replaced_wherever_they_stand(spark):
    texts = [(1, "John SMITH rang. Mr John Smith came; John Smith left, Smith's hat stayed. Smithson and smith stay."), (2, "John Smith is not introduced here."),
             (3, "Mrs Anna Maria O'Brien-Lee, then Anna, O'Brien-Lee’s and Maria.")]
    got = {r.doc_id: r.text for r in run(spark, texts)}
    m = re.fullmatch(r"(\w+) (\w+) rang\. Mr (\w+) (\w+) came; (\w+) (\w+) left, (\w+)'s hat stayed\. Smithson and smith stay\.", got[1])
    assert m and m[1] == m[3] == m[5] != "John" and m[2].isupper() and m[2].title() == m[4] == m[6] == m[7] != "Smith"
    assert got[2] == texts[1][1]
    m = re.fullmatch(r"Mrs (\w+) (\w+) (\w+), then (\w+), (\w+)’s and (\w+)\.", got[3])
    assert m and (m[1], m[2], m[3]) == (m[4], m[6], m[5]) and "Brien" not in got[3]


def iban_ok(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def test_ibans_keep_country_and_check_digits(spark):
    texts = [(1, "DE89 3704 0044 0532 0130 00"), (2, "GB82WEST12345698765432"), (3, "FR14 2004 1010 0505 0001 3M02 606")]
    for r, (_, old) in zip(sorted(run(spark, texts)), texts):
        assert r.text != old and r.text[:2] == old[:2] and [c == " " for c in r.text] == [c == " " for c in old] and iban_ok(old) and iban_ok(r.text), r.text
        assert [c.isdigit() for c in r.text] == [c.isdigit() for c in old]


def test_registered_query_against_a_plain_reading(spark):
    """Entities by the same patterns in plain Python: every other character stays, equal entities get equal surrogates, others different ones."""
    import regex

    from .conftest import SF
    from dqflow.llm import queries

    python = regex.compile(pii.DETECT.replace("(?<s>", "(?P<s>").replace(r"\k<s>", "(?P=s)").replace("(?<t>", "(?P<t>").replace(r"\k<t>", "(?P=t)").replace("++", "+"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pairs = {}
    for r in queries.queries()["op8_pii_surrogates"](spark, SF).collect():
        old = texts[r.doc_id] or ""
        found = [m[0] for m in python.finditer(old)]
        between = python.split(old) if not python.groups else [old[a:b] for a, b in zip([0, *(m.end() for m in python.finditer(old))], [*(m.start() for m in python.finditer(old)), len(old)])]
        if r.n_person == 0:
            at = 0
            for k, part in enumerate(between):  # what stands between entities is there, in order
                assert r.text.startswith(part, at) if k == 0 else part in r.text[at:], r.doc_id
                at = r.text.index(part, at) + len(part)
        counted = sum(r[f"n_{k}"] for k in pii.KINDS)
        assert counted <= len(found)
        for entity in found:
            if "@" in entity:
                assert entity not in r.text
                (new,) = {m for m in re.findall(r"\S+@\S+\.example", r.text, re.I)} if len(set(found)) == 1 else {None}
                if new:
                    pairs.setdefault(entity.lower(), set()).add(new.lower().strip(".,;"))
    assert all(len(v) == 1 for v in pairs.values())
    every = [x for v in pairs.values() for x in v]
    assert len(every) == len(set(every))
