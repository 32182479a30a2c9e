from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from marketspark.llm import surrogates as sg


def luhn_ok(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_ok(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def replaced(documents, *texts, key="k"):
    return {r.doc_id: r for r in sg.replace_personal_data(documents(*texts), key).collect()}


def test_every_kind_keeps_its_form(documents):
    secrets = ["jo.98@mail5.example.com", "+1 (017) 555-7713", "4111 1111 1111 1111", "4952935900253052", "123-45-6789", "43.21.141.162",
               "DE89 3704 0044 0532 0130 00", "555-123-4567", "+493012345678"]
    text = "a " + " , ".join(secrets) + ". end"
    row = replaced(documents, text)[0]
    assert row.n_entities == len(secrets) and row.kinds == "card,email,iban,ip,phone,ssn"
    new = row.text.removeprefix("a ").removesuffix(". end").split(" , ")
    for old, got in zip(secrets, new, strict=True):
        assert old != got and old not in row.text
        if "@" not in old and old.count(".") != 3:
            assert re.sub("[0-9]", "0", old) == re.sub("[0-9]", "0", got)
    assert re.fullmatch(r"[a-z]{2}\.\d\d@h[0-9a-f]{12}\.example\.com", new[0])
    assert new[1].startswith("+1 (") and luhn_ok(new[2].replace(" ", "")) and luhn_ok(secrets[3]) == luhn_ok(new[3]) and new[4][0] == "9"
    assert all(0 < int(x) < 255 for x in new[5].split(".")) and iban_ok(new[6]) and new[6][:2] == "DE"


def test_coreference_over_documents_and_layouts(documents):
    found = replaced(documents, "call +1 (017) 555-7713 or +1-017-555-7713", "X@Y.example.org wrote", "so x@y.example.org, z@y.example.org",
                     "Mr. John Smith met Mrs. Smith", "Dr. John MILLER and Frau Anna Weiß", "г-жа Анна Петрова", "Mr Smith-Jones")
    one, two = re.findall(r"\+1[^a-z]+\d", found[0].text)
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two)
    address = found[1].text.split()[0]
    assert found[2].text.split()[1].rstrip(",") == address
    hosts = {a.lower().split("@")[1].rstrip(",") for a in re.findall(r"\S+@\S+", found[1].text + " " + found[2].text)}
    assert len(hosts) == 1
    _, given, family, _, _, again = found[3].text.split()
    assert family == again and "Smith" not in found[3].text and found[3].text.startswith("Mr. ")
    assert found[4].text.split()[1] == given and found[4].text.split()[2].isupper()
    assert any(found[4].text.split()[5].endswith(e) for e in sg.LATIN["f"]) and any(given.endswith(e) for e in sg.LATIN["m"])
    assert re.fullmatch(r"г-жа [А-Яа-яё]+ [А-Яа-яё]+", found[5].text) and "Анна" not in found[5].text


def test_distinct_stay_distinct_when_replacements_collide(documents, monkeypatch):
    monkeypatch.setitem(sg.LATIN, "syllables", ("ba", "de"))
    monkeypatch.setitem(sg.LATIN, "family", ("ton",))
    names = ["".join(chr(97 + (i // k) % 5) for k in (1, 5, 25)).capitalize() for i in range(100)] + ["Babaton", "Dedeton"]
    found = replaced(documents, *[f"so Mr {n} left" for n in names])
    new = [found[i].text.split()[2] for i in range(len(names))]
    assert len(set(new)) == len(names) and not set(new) & set(names)


def test_key_decides_and_clean_texts_stay(documents):
    texts = ["no data, only words. Version 2.0 of 1999", None, "", "ends with a@b.example.net", "a@b.example.net"]
    one, two = replaced(documents, *texts), replaced(documents, *texts, key="other")
    assert [one[i].text for i in range(3)] == texts[:3] and [one[i].n_entities for i in range(5)] == [0, 0, 0, 1, 1]
    assert one[3].text != two[3].text and one[3].text.startswith("ends with ") and one[4].text == one[3].text.split()[-1]


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "a.b-" * 80_000 + "@", "1.2." * 80_000, "word 12-34 " * 30_000])
def test_long_texts_are_left_alone(documents, text):
    assert replaced(documents, text)[0].text == text


def test_edges(documents):
    docs = documents("to q@r.example.com", "to q@r.example.com", ids=[1, None]).withColumn("row", F.lit(1)).withColumn("kind", F.lit("x"))
    found = sg.replace_personal_data(docs, "k").collect()
    assert len(found) == 2 and len({r.text for r in found}) == 1
    assert sg.replace_personal_data(docs.limit(0), "k").count() == 0


def test_untitled_mentions_of_a_names_words_follow(documents):
    found = replaced(documents, "Dr Anna Weiss spoke. Weiss then left; Anna agreed, as WEISS’s notes, Weissbier and Dr Nolan say", "Anna and Weiss",
                     "Weiss? Mr Smith's case: Smith's. Call 555-123-4567, Smith-Jones or Smith", "Anna Weiss met Dr Weiss and asked the Dr", "Mr 'x'", None)
    text = found[0].text
    _, given, family, *_ = text.split()
    assert text.startswith(f"Dr {given} {family} spoke. {family} then left; {given} agreed, as {family.upper()}’s notes, Weissbier and Dr ")
    assert "Weiss " not in text and "Anna" not in text and found[0].n_entities == 5 and found[0].kinds == "name"
    assert found[1].text == "Anna and Weiss" and found[1].n_entities == 0
    smith = found[2].text.split()[2].removesuffix("'s")
    assert re.fullmatch(rf"Weiss\? Mr {smith}'s case: {smith}'s\. Call \d{{3}}-\d{{3}}-\d{{4}}, Smith-Jones or {smith}", found[2].text)
    assert found[3].text == f"Anna {family} met Dr {family} and asked the Dr"
    many = "Mr Abel Smith. " + "Smith and Other words " * 20_000
    assert "Smith" not in replaced(documents, many)[0].text


def test_one_phone_number_is_replaced_alike_with_and_without_separators(documents):
    spellings = ["+14155552671", "+1 415 555 2671", "+1415 555 2671", "+1 (415) 555-2671"]
    others = ["+493012345678", "+49 30 1234 5678", "+351213456789", "+351 213 456 789", "415 555 2671"]
    found = replaced(documents, *[f"call {p} now" for p in spellings + others])
    new = [re.sub("[^+0-9]", "", found[i].text) for i in range(len(found))]
    assert len(set(new[:4])) == 1 and new[0] != spellings[0] and new[0].startswith("+1")
    assert new[4] == new[5] and new[4].startswith("+49") and new[6] == new[7] and new[6].startswith("+351")
    assert new[8] != new[0][2:]
    old = [re.sub("[0-9]", "0", p) for p in spellings + others]
    assert [re.sub("[0-9]", "0", found[i].text)[5:-4] for i in range(len(found))] == old


def test_scripts_are_kept(documents):
    texts = ["Prof أحمد منصور wrote", "Dr Γιώργος Παπαδάκης wrote", "Prof דוד כהן wrote", "γιώργος5@mail.example.org wrote",
             "Herr " + "Langer" * 20 + " wrote", "Prof أحمد منصور again"]
    found = replaced(documents, *texts)
    scripts = [r"Prof [؀-ۿ]+ [؀-ۿ]+ wrote", r"Dr [Α-Ωα-ωά-ώϊϋΐΰς]+ [Α-Ωα-ωά-ώϊϋΐΰς]+ wrote", r"Prof [֐-׿]+ [֐-׿]+ wrote",
               r"[α-ως]+\d@h[0-9a-f]{12}\.example\.com wrote", r"Herr [A-Z][a-z]+ wrote"]
    for k, pattern in enumerate(scripts):
        assert re.fullmatch(pattern, found[k].text), found[k].text
        assert set(texts[k].split()) & set(found[k].text.split()) <= {"Prof", "Dr", "Herr", "wrote"}
    assert found[5].text.split()[1] == found[0].text.split()[1] and "Langer" not in found[4].text


def test_further_formats(documents):
    olds = ["3782 822463 10005", "378282246310005", "+49 (0)30 1234567", "030 12345678", "(089) 1234567", "2001:0db8:85a3:0000:0000:8a2e:0370:7334",
            "fe80::1ff:fe23:4567:890a", "2001:db8::1"]
    found = replaced(documents, *[f"a {old} end" for old in olds], "call +49 30 1234567 now", "Capt John Smith met Rev. Mary Jones")
    news = [found[k].text.removeprefix("a ").removesuffix(" end") for k in range(len(olds))]
    for old, new in zip(olds[:5], news[:5], strict=True):
        assert old != new and re.sub("[0-9]", "0", old) == re.sub("[0-9]", "0", new)
    assert luhn_ok(news[0].replace(" ", "")) and re.sub(" ", "", news[0]) == news[1]
    assert "(0)" in news[2] and re.sub(r"\D", "", news[2].replace("(0)", "")) == re.sub(r"\D", "", found[len(olds)].text)
    assert all(re.fullmatch(r"2001:db8(:[0-9a-f]{4}){6}", new) for new in news[5:]) and len(set(news[5:])) == 3
    assert not {"John", "Smith", "Mary", "Jones"} & set(found[len(olds) + 1].text.split())


def test_clean_texts_stay(documents):
    texts = ["at 12:30:45 on 2024-01-02", "std::vector<int> a::b::c face::add", "::", "version 1.2.3 :: 4", "in 030 ways", "Prof. of 1234 words", "Sir", "a:b:c:d"]
    found = replaced(documents, *texts)
    assert [found[k].text for k in range(len(texts))] == texts


def plainly(texts):
    """Every pattern's matches as plain Python finds them, kind by kind in the order of the patterns."""
    import regex

    whole = regex.compile(sg.ANY.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}"))
    kinds = {k: regex.compile(p) for k, p in sg.PATTERNS.items()}
    return [[(next((k for k, p in kinds.items() if p.fullmatch(m[0])), "name"), m[0]) for m in whole.finditer(t or "")] for t in texts]


def test_detection_and_mapping_equal_brute_force(spark):
    """On a test table: what is found, that one identity has one surrogate, and that all else stays."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in sg.replace_personal_data(docs, "k").collect()}
    expected = plainly([r.text for r in rows])
    assert sum(map(len, expected)) > 20
    mapping = {}
    for row, entities in zip(rows, expected, strict=True):
        got = found[row.doc_id]
        assert got.kinds == ",".join(sorted({kind for kind, _ in entities}))
        if not entities:
            assert got.text == row.text
            continue
        names = {w.lower() for kind, e in entities if kind == "name" for w in e.split(" ")[1:]}
        place = 0
        for kind, entity in entities:
            assert entity not in got.text or kind == "name"
            at = row.text.index(entity, place)
            between = row.text[place:at]
            if not any(w.lower() in names for w in re.findall(r"\w+", between)):
                assert between in got.text
            place = at + len(entity)
        mapping.update({(kind, e.lower()): None for kind, e in entities})
    assert len(found) == len(rows)
