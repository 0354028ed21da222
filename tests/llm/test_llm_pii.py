import re

import pytest
from pyspark.sql import functions as F

from daypanel.llm import pii


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


TEXTS = {
    1: "Write to Anna.Lee+x@mail.example.org or ANNA.LEE+X@MAIL.EXAMPLE.ORG, not to bob@mail.example.org.",
    2: "Call +1 (017) 555-7713 or +1 017 555 7713; local (212) 555-0100 and 212-555-0188.",
    3: "Cards 4539 1488 0343 6467, 4539-1488-0343-6467 and 4539148803436467; next 9807915762804490 7536784127813050.",
    4: "From 192.168.0.1 and 10.0.0.254, version 1.2.3.4.5 and 999.1.1.1 are none.",
    5: "SSN 078-05-1120. IBAN DE89 3704 0044 0532 0130 00 or DE89370400440532013000.",
    6: "Mr. John Smith met Mrs. Mary Jones; Dr. Smith left. Господин Иванов и Анна Петрова. John Smith again.",
    7: "", 9: "nothing here", 10: "4539148803436467",
}


def replace(docs):
    return pii.replace_personal_data(docs, key="a key of the tests")


@pytest.fixture
def replaced(spark, table):
    rows = [*TEXTS.items(), (8, None), (3, TEXTS[3]), (None, TEXTS[1])]
    docs = table(rows, clashing=("mentions", "h", "part", "surrogate", "parts", "kind"))
    out = replace(docs)
    assert out.columns == [*docs.columns, "pii_counts"]
    found = out.collect()
    assert sorted((str(r.doc_id), r.part) for r in found) == sorted((str(d), "part") for d, _ in rows)
    return {r.doc_id: r for r in found}


def test_formats_stay_and_values_go(replaced):
    text = {k: r.text for k, r in replaced.items()}
    assert text[7] == "" and text[8] is None and text[9] == TEXTS[9] and text[None] == text[1]
    low, up, bob = re.findall(r"[\w.+]+@[\w.]+\w", text[1])
    assert up == low.upper() and low.split("@")[1] == bob.split("@")[1] and low != bob and low.endswith(".example")
    assert re.fullmatch(r"[a-z]{4}\.[a-z]{3}\+[a-z]@.*", low)
    a, b, c, d = re.search(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}); local (\(\d{3}\) \d{3}-\d{4}) and "
                           r"(\d{3}-\d{3}-\d{4})\.", text[2]).groups()
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(a) == digits(b) and len({digits(a), digits(c), digits(d)}) == 3
    cards = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{16}", text[3])
    assert digits(cards[0]) == digits(cards[1]) == cards[2] == text[10] and luhn(cards[2]) and cards[1].count("-") == 3
    assert len(set(cards[2:])) == 3
    assert "version 1.2.3.4.5 and 999.1.1.1 are none" in text[4] and len(re.findall(r"\b2[45]\d\.\d+\.\d+\.\d+", text[4])) == 2
    assert re.search(r"SSN 9\d\d-\d\d-\d{4}\. IBAN DE", text[5])
    spaced, plain = re.search(r"IBAN (DE[\d ]+) or (DE\d+)\.", text[5]).groups()
    assert spaced.replace(" ", "") == plain and spaced.count(" ") == 5
    for doc_id, before in TEXTS.items():
        for value in re.findall(r"[\w.+]+@[\w.]+\w|\d[\d() -]{8,}\d", before):
            assert value not in (text[doc_id] or ""), value


def test_names_keep_gender_script_and_reference(replaced):
    text = replaced[6].text
    first = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Dr\. (\w+) left\. Господин (\w+) и (\w+) (\w+)\. (\w+) (\w+) again\.", text)
    john, smith, mary, jones, smith2, ivanov, anna, petrova, john2, smith3 = first.groups()
    assert john == john2 and smith == smith2 == smith3 and len({john, smith, mary, jones}) == 4
    assert john.endswith("nus") and mary.endswith("na") and anna.endswith("на")
    assert all(re.fullmatch("[А-я]+", name) for name in (ivanov, anna, petrova)) and "Smith" not in text


def test_whole_names_and_bare_repeats(table):
    texts = {1: "John Fitzgerald Kennedy met Mr. John Ronald Tolkien. Kennedy left, TOLKIEN's friend John stayed; the smith too.",
             2: "Robert Miller called. Miller and Milleriana are two; Smith is a word here.",
             3: "Mr. John Smith, then Smith, and John. Jürgen Groß and Groß"}
    text = {r.doc_id: r.text for r in replace(table(list(texts.items()))).collect()}
    john, fitz, kennedy, john2, ronald, tolkien, kennedy2, loud, john3 = re.fullmatch(
        r"(\w+) (\w+) (\w+) met Mr\. (\w+) (\w+) (\w+)\. (\w+) left, (\w+)'s friend (\w+) stayed; the smith too\.", text[1]).groups()
    assert john == john2 == john3 and kennedy == kennedy2 and loud == tolkien.upper()
    assert len({john, fitz, kennedy, ronald, tolkien}) == 5
    assert not re.search("John|Fitzgerald|Kennedy|Ronald|Tolkien", text[1], re.I)
    _, miller, miller2 = re.fullmatch(r"(\w+) (\w+) called\. (\w+) and Milleriana are two; Smith is a word here\.", text[2]).groups()
    assert miller == miller2 != "Miller"
    assert not re.search("John|Smith|Jürgen|Groß", text[3])


def test_national_phone_numbers(table):
    numbers = ["01 23 45 67 89", "01.23.45.67.89", "030 1234567", "0170/1234567", "020 7946 0958", "612 345 678", "612 34 56 78"]
    others = "In 2024 06 12, 100 000 and 5 612 345 678 900 or 5 612 345 678, 01 02 03; +1 017 555 7713 22"
    rows = [*enumerate(f"call {n}, or" for n in numbers), (99, others)]
    found = {r.doc_id: r for r in replace(table(rows)).collect()}
    for i, number in enumerate(numbers):
        shape = re.sub("[0-9]", "[0-9]", re.escape(number))
        assert re.fullmatch(f"call {shape}, or", found[i].text) and number not in found[i].text, number
        assert found[i].pii_counts == {"phone": 1}
    assert found[99].text.startswith(others.split("+")[0]) and found[99].pii_counts == {"phone": 1}


def test_counts(replaced):
    assert replaced[3].pii_counts == {"card": 5} and replaced[6].pii_counts == {"name": 5} and replaced[9].pii_counts == {}


def test_colliding_draws_are_drawn_again(spark, monkeypatch):
    """A draw with few values: every entity still gets one of its own, and none a real one."""
    monkeypatch.setattr(pii, "_candidate", lambda key, attempt: F.concat(
        F.lit("v"), (F.pmod(F.xxhash64("canonical", F.lit(attempt)), F.lit(30))).cast("string")))
    entities = spark.createDataFrame([("email", f"v{i}", "n", "latin") for i in range(12)],
                                     "kind string, canonical string, gender string, script string")
    found = [r.surrogate for r in pii.surrogates(entities, key="k").collect()]
    assert len(found) == len(set(found)) == 12 and not set(found) & {f"v{i}" for i in range(12)}
    monkeypatch.setattr(pii, "_candidate", lambda key, attempt: F.lit("one"))
    with pytest.raises(RuntimeError):
        pii.surrogates(entities, key="k", stalled=3)


def test_long_texts_without_spaces(table):
    text = "a" * 200_000 + "1" * 200_000 + "@" + "." * 1000 + "x@y.zz"
    row = replace(table([(1, text)])).first()
    assert row.text.startswith("a" * 200_000) and "x@y.zz" not in row.text


def test_empty_table(table):
    assert replace(table([])).count() == 0


def test_no_spelling_ends_the_job(table):
    """Letters whose upper, lower or title case has another length or no way back."""
    names = ["Strauß", "Weiß", "İnan", "Iı", "ΟΔΟΣ", "Οδός", "Ŀǆ", "Ǆu", "ŉa", "Ǳez", "Ʞa", "O’Ça", "Ba-Ça", "ẞa", "Ⅻ", "Éa", "Ａb"]
    rows = []
    for i, name in enumerate(names):
        for j, bare in enumerate((name, name.upper(), name.lower(), name.title(), name.swapcase(), name + "s")):
            rows.append((10 * i + j, f"Mr. Hans {name} met {bare} today. Frau {name} sagte {name.upper()} nichts, John {name}."))
    got = {r.doc_id: r for r in replace(table(rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        assert "Hans" not in got[doc_id].text
        name = names[doc_id // 10]
        if name in text.split("Mr. Hans ")[1] and name[0].isupper() and name[1:].isalpha() and name.isascii():
            assert f" {name} " not in got[doc_id].text
    one, two, three = (re.search(r"Mr\. \w+ (\w+) met (\w+) today\. Frau (\w+) sagte", got[1].text).groups())
    assert two == one.upper() and three == one != "Strauß"


def test_titles_in_a_row_and_titles_alone(table):
    texts = {1: "Frau Dr. Weber, Herr Prof. Dr. Hans Weber und Mr. Dr", 2: "Mr. John Dr Smith", 3: "Frau Dr", 4: "Dr. Dr. No"}
    text = {r.doc_id: r.text for r in replace(table(list(texts.items()))).collect()}
    weber, hans, weber2 = re.fullmatch(r"Frau Dr\. (\w+), Herr Prof\. Dr\. (\w+) (\w+) und Mr\. Dr", text[1]).groups()
    assert weber == weber2 != "Weber" and hans != "Hans"
    assert len(text[2].split()) == 4 and "Smith" not in text[2]
    assert text[3] == texts[3] and re.fullmatch(r"Dr\. Dr\. \w+", text[4]) and "No" not in text[4]


def plain(text):
    """The parts of a text around its mentions, and the mentions, by the regex module."""
    import regex
    pattern = regex.compile(pii.ANY.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}"))
    return pattern.split(text), pattern.findall(text)


def test_all_but_mentions_stays_and_entities_stay_apart(spark):
    """Brute force over the whole small corpus: what stands between mentions is
    unchanged but for bare names, and distinct entities get distinct surrogates."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    out = {r.doc_id: r for r in replace(docs).collect()}
    seen, back = {}, {}
    n_mentions = 0
    for r in docs.collect():
        gaps, mentions = plain(r.text or "")
        assert sum(out[r.doc_id].pii_counts.values()) == len(mentions)
        n_mentions += len(mentions)
        words = {w for m in mentions for w in re.split(r"[ .]", m)}
        at, text = 0, out[r.doc_id].text or ""
        for gap, mention in zip(gaps, [*mentions, None], strict=True):
            known = not any(w and re.search(rf"\b{re.escape(w)}\b", gap, re.I) for w in words)
            if known:
                assert text.startswith(gap, at), (r.doc_id, gap)
            end = at + len(gap)
            if mention is None or not known or not re.fullmatch(r"[0-9 ()+.-]+", mention):
                break
            # Numbers keep their length, so the next gap can be found.
            new = text[end:end + len(mention)]
            if "." not in mention.strip("."):
                digits, drawn = re.sub(r"\D", "", mention), re.sub(r"\D", "", new)
                assert digits != drawn and seen.setdefault(digits, drawn) == drawn and back.setdefault(drawn, digits) == digits
                assert re.sub(r"\d", "0", mention) == re.sub(r"\d", "0", new)
            else:
                break
            at = end + len(mention)
    assert n_mentions > 20 and seen
