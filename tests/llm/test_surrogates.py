import random

import pytest

from loadsieve.llm import QUERIES
from loadsieve.llm.surrogates import assign_surrogates, entities_of, luhn, rendered, replace_entities, script, surrogate

KEY = b"a key"
CASES = {
    "mail und.34@mail7.example.com### ok": [("email", "und.34@mail7.example.com")],
    "UND.34@MAIL7.EXAMPLE.COM": [("email", "und.34@mail7.example.com")],
    "+1 (743) 555-3824%%%": [("phone", "7435553824")],
    "(743) 555-3824": [("phone", "7435553824")],
    "+49 30 1234567": [("phone", "+49301234567")],
    "ip 233.254.104.120.": [("ip", "233.254.104.120")],
    "9807915762804490!! 4111 1111 1111 1111": [("card", "9807915762804490"), ("card", "4111111111111111")],
    "7536784127813050 4845168114407329": [("card", "7536784127813050"), ("card", "4845168114407329")],
    "123-45-6789": [("ssn", "123456789")],
    "DE89 3704 0044 0532 0130 00": [("iban", "DE89370400440532013000")],
    "Mrs Ann Lee met LEE.": [("given:f:LATIN", "ann"), ("family::LATIN", "lee"), ("family::LATIN", "lee")],
    "г-жа Анна Петрова": [("given:f:CYRILLIC", "анна"), ("family::CYRILLIC", "петрова")],
    'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"': [],
    "version 4.0. 2.0 3.14.15.9265 2026-12-01 BY-NC 4.0": [],
    "a@b @c d@ 12345 Mrs. no": [],
}


@pytest.mark.parametrize("text", CASES)
def test_detection(text):
    assert [(k, f) for _, _, k, f in entities_of(text)] == CASES[text]


def test_surrogates_keep_kind_and_format():
    draw = random.Random(1)
    for _ in range(300):
        card = "".join(draw.choice("0123456789") for _ in range(16))
        made = surrogate(KEY, "card", card, 0)
        assert len(made) == 16 and made[0] == card[0] and luhn(made) == luhn(card)
    assert surrogate(KEY, "ip", "192.168.3.4", 0).startswith("192.168.") and surrogate(KEY, "ip", "10.3.4.5", 0).startswith("10.")
    assert all(1 <= int(o) <= 254 for o in surrogate(KEY, "ip", "233.1.2.3", 0).split("."))
    iban = surrogate(KEY, "iban", "DE89370400440532013000", 0)
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    for kind, s in (("family::LATIN", "LATIN"), ("given:f:CYRILLIC", "CYRILLIC"), ("given:m:GREEK", "GREEK")):
        assert script(surrogate(KEY, kind, "x", 0)) == s
    assert surrogate(KEY, "given:f:LATIN", "ann", 0) != surrogate(KEY, "given:m:LATIN", "ann", 0)
    assert rendered("phone", "+1 (743) 555-3824", "3354432999") == "+1 (335) 443-2999"
    assert rendered("email", "A.B@C.DE", "x.y@z.de") == "X.Y@Z.DE"
    assert rendered("family::LATIN", "SMITH", "marson") == "MARSON"
    assert surrogate(KEY, "email", "a@b.de", 0) != surrogate(b"other", "email", "a@b.de", 0)


def test_collisions_are_settled(spark):
    """One-letter addresses of one domain soon draw alike, and draw each other."""
    forms = [f"{a}@q.co" for a in "abcdefghijklmnopqrstuvwxyz"] + [f"{a}{b}@q.co" for a in "abcdefghij" for b in "0123456789"]
    entities = spark.createDataFrame([("email", f) for f in forms] + [("ssn", f"{i:09d}") for i in range(200)], "kind string, form string")
    rows = assign_surrogates(entities, KEY).collect()
    assert sorted(r.form for r in rows) == sorted([*forms, *(f"{i:09d}" for i in range(200))])
    for kind in ("email", "ssn"):
        own = [r for r in rows if r.kind == kind]
        assert len({r.stand_in for r in own}) == len(own)
        assert not {r.stand_in for r in own} & {r.form for r in own}


def test_coreference_and_clean_texts(spark):
    texts = [
        "Mr John Smith wrote to j.smith@corp.example.com.",
        "Ask J.SMITH@corp.example.com or Mr Smith, (743) 555-3824.",
        "Mr Smith: +1 743-555-3824",
        "nothing here 42 @",
        None,
        "",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in replace_entities(docs, KEY).collect()}
    assert [got[i].text for i in (3, 4, 5)] == texts[3:]
    assert got[4].entities == []
    for i in range(3):
        assert "mith" not in got[i].text.lower() and "555" not in got[i].text
    name = got[0].text.split()[2]
    assert f"Mr {name}," in got[1].text and got[2].text.startswith(f"Mr {name}:")
    mail = got[0].text.split()[-1].rstrip(".")
    assert mail.lower() in got[1].text.lower()
    digits = lambda t: "".join(c for c in t if c.isdigit())[-10:]
    assert digits(got[1].text) == digits(got[2].text)


def test_query(spark, sf_dir, docs):
    rows = QUERIES["op2_surrogates"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    stand_in, changed = {}, 0
    for r in rows:
        found = entities_of(texts[r.doc_id])
        assert r.n_entities == len(found)
        if not found:
            assert r.text == texts[r.doc_id]
            continue
        changed += 1
        # a walk through both texts: what lies between entities is as before
        at, parts = 0, []
        for a, b, kind, form in found:
            parts.append(texts[r.doc_id][at:a])
            at = b
        parts.append(texts[r.doc_id][at:])
        rest = r.text
        for i, part in enumerate(parts):
            where = rest.index(part) if part else 0
            if i:
                a, b, kind, form = found[i - 1]
                if not part and i == len(parts) - 1:
                    where = len(rest)
                assert form.lower() not in rest[:where].lower()
                stand_in.setdefault((kind, form), set()).add(rest[:where].lower())
            rest = rest[where + len(part) :]
    assert changed
    assert all(len({"".join(c for c in s if c.isalnum())[-10:] for s in v}) == 1 for (k, _), v in stand_in.items() if k in ("email", "ip"))


def test_edges(edge, nothing):
    out = replace_entities(edge, KEY)
    assert out.columns == [c for c in edge.columns if c != "entities"] + ["entities"]
    assert sorted(str(r.text) for r in out.collect()) == sorted(str(r.text) for r in edge.collect())
    assert replace_entities(nothing, KEY).count() == 0


PHONES = {
    "+33 6 12 34 56 78": "+33612345678",
    "+33 1 42 68 53 00": "+33142685300",
    "+46 8 123 456 78": "+46812345678",
    "+33 12 34 56 78 90": "+331234567890",
    "0033 6 12 34 56 78": "+33612345678",
    "1-800-555-0199": "8005550199",
    "1 (800) 555-0199": "8005550199",
    "18005550199": "8005550199",
    "5551234567": "5551234567",
    "06 12 34 56 78": "0612345678",
    "06.12.34.56.78": "0612345678",
    "030 1234567": "0301234567",
    "(030) 1234567": "0301234567",
}


@pytest.mark.parametrize("phone", PHONES)
def test_phone_spellings(phone):
    text = f"call {phone}, or 2 others."
    assert [(text[a:b], k, f) for a, b, k, f in entities_of(text)] == [(phone, "phone", PHONES[phone])]
    made = rendered("phone", phone, surrogate(KEY, "phone", PHONES[phone], 0))
    assert made != phone and [(k, f) for _, _, k, f in entities_of(f"call {made}.")] == [("phone", surrogate(KEY, "phone", PHONES[phone], 0))]
    assert [c.isdigit() or c for c in made] == [c.isdigit() or c for c in phone]


@pytest.mark.parametrize("text", ["01.02.2026 10:30", "01/02/2026 1000", "1700000000", "2026-12-01 10:30:00", "0.0123456789", "5551234567.89", "https://a.example/5551234567"])
def test_no_phones(text):
    assert entities_of(text) == []


def test_more_addresses_than_a_private_block_has_room_for(spark):
    """A block draws 254 * 254 addresses, of which none may be an original."""
    forms = [f"192.168.{a}.{b}" for a in range(1, 161) for b in range(1, 255)]
    rows = assign_surrogates(spark.createDataFrame([("ip", f) for f in forms], "kind string, form string"), KEY, max_rounds=24).collect()
    assert sorted(r.form for r in rows) == sorted(forms)
    assert len({r.stand_in for r in rows}) == len(forms) and not {r.stand_in for r in rows} & set(forms)
    assert {r.stand_in.split(".")[0] for r in rows} == {"192", "10"}
