import re

from cases import EDGES, documents, edge_docs, no_docs

from tradewind.llm import pii

ROWS = [
    (1, "Mail Anna.Bell@mail3.shop.com or call +1 (988) 555-2485 today."), (2, "anna.bell@MAIL3.shop.com, 1 (988) 555-2485 / +1 (988) 555-2485"),
    (3, "host 42.144.35.254 and 42.144.35.254. card 4111 1111 1111 1111, ssn 123-45-6789"), (4, "Frau Weber met Maria Schulz and Иван Петров."),
    (5, "version 1.2.3 and 2024-05-06, hash 0641917ea4e9feb9cda83477b57ac2654884f485 stay"), (6, None), (7, "")]


def replaced(spark, rows, key="k"):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in pii.replace_pii(frame, key).collect()}


def test_types_formats_and_coreference(spark):
    got = replaced(spark, ROWS)
    one, two, three, four = (got[i].text for i in (1, 2, 3, 4))
    mail = re.search(r"\S+@\S+", one)[0]
    assert mail in two and "bell" not in (one + two).lower() and re.fullmatch(r"[a-z]{4}\.[a-z]{4}@[a-z]{4}\d\.example\.org", mail)
    phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", one)[0]
    assert phone in two and phone != "+1 (988) 555-2485" and "555-2485" not in two
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", three)
    assert len(ips) == 2 and ips[0] == ips[1] != "42.144.35.254"
    card = re.search(r"4\d{3} \d{4} \d{4} \d{4}", three)[0]
    assert pii.luhn(card.replace(" ", "")) == 0 and "123-45-6789" not in three
    assert four.startswith("Frau ") and "Schulz" not in four and "Петров" not in four
    given = four.split(" met ")[1].split()[0]
    assert given in pii.GIVEN["latin", "f"] and re.search(r"[А-Я][а-яё]+ [А-Я][а-я]+\.", four)
    assert got[5].text == ROWS[4][1] and got[6].text is None and got[7].text == ""
    assert got[5].n_entities == 0 and got[3].n_entities == 4


def test_whole_names_are_found(spark):
    spans = ["Anna Maria Schulz", "Frau Anna Maria Schulz", "Mr. John F. Kennedy", "Maria Schulz-Weber", "John O'Brien", "Mr. O'Brien",
             "Anna van der Berg", "Frau von Weber", "Anna-Maria Schulz", "Carlos de la Cruz", "Peter D’Angelo"]
    for name in spans:
        text = f"dort sah {name} etwas"
        assert [text[a:b] for a, b, *_ in pii.find(text)] == [name]
    got = replaced(spark, [(i, f"dort sah {name} etwas") for i, name in enumerate(spans)])
    for i, name in enumerate(spans):
        assert got[i].n_entities == 1 and not any(x in got[i].text for x in ("Schulz", "Kennedy", "Brien", "Berg", "Cruz", "Angelo"))
    for text, name in (("John Smith's car", "John Smith"), ("Carlos y Maria van", None), ("Anna zu Hause", None)):
        assert [text[a:b] for a, b, *_ in pii.find(text)] == ([name] if name else [])


def test_key_decides(spark):
    assert replaced(spark, ROWS[:2], "k")[1].text == replaced(spark, ROWS[:2], "k")[1].text
    assert replaced(spark, ROWS[:2], "k")[1].text != replaced(spark, ROWS[:2], "other")[1].text


def test_surrogates_stay_distinct(spark, monkeypatch):
    names = [f"{a} {b}" for a in ("Anna", "Maria", "John", "Peter") for b in ("Abel", "Bode", "Conrad", "Dorn", "Ebert", "Funk", "Graf", "Hahn")]
    rows = [(i, f"so {name} said") for i, name in enumerate(names)]
    got = replaced(spark, rows)
    assert len({r.text for r in got.values()}) == len(names)
    # A draw that always meets an entity of the corpus first.
    entities = spark.createDataFrame([("ip", "1.1.1.1", ""), ("ip", "2.2.2.2", "")], "kind string, entity string, base string")
    known = {r.entity: r.surrogate for r in pii.resolve(entities, "k").collect()}
    assert len(set(known.values())) == 2 and not set(known.values()) & set(known)


def test_names_keep_their_format_and_their_parts(spark):
    texts = ["so John Smith came", "then Mr. Smith left", "and Mr. John F. Kennedy", "but Ms. Anna-Maria van der Berg-Smith", "so Peter O'Brien did",
             "and HERR", "as Frau SCHULZ did", "as Frau Schulz did", "mit Иван Орлинский ging"]
    got = [r.text for _, r in sorted(replaced(spark, list(enumerate(texts))).items())]
    smith = re.fullmatch(r"then Mr\. (\w+) left", got[1])[1]
    given = re.fullmatch(rf"so (\w+) {smith} came", got[0])[1]
    assert given in pii.GIVEN["latin", "m"] and given != "John"
    assert re.fullmatch(rf"and Mr\. {given} [A-EG-Z]\. (?!Kennedy)\w+", got[2])
    first, second = re.fullmatch(rf"but Ms\. (\w+)-(\w+) van der (?!Berg)\w+-{smith}", got[3]).groups()
    assert {first, second} <= set(pii.GIVEN["latin", "f"]) and first not in ("Anna", second) and second != "Maria"
    assert re.fullmatch(r"so (?!Peter)\w+ O'(?!Brien)\w+ did", got[4]) and got[5] == texts[5]
    schulz = re.fullmatch(r"as Frau (\w+) did", got[7])[1]
    assert got[6] == f"as Frau {schulz.upper()} did"
    assert re.fullmatch(r"mit (?!Иван)[А-Я][а-яё]+ (?!Орл)[А-Я][а-яё]+ ging", got[8])


def test_telephone_numbers_agree_with_and_without_country_code(spark):
    texts = ["call +49 30 1234567 now", "call 030 1234567 now", "call +1 (988) 555-2485 now", "call (988) 555-2485 now", "call +351 21 555 1234 now"]
    got = [r.text for _, r in sorted(replaced(spark, list(enumerate(texts))).items())]
    shape = lambda t: re.sub(r"\d", "0", t)
    assert [shape(t) for t in got] == [shape(t) for t in texts]
    digits = ["".join(re.findall(r"\d", t)) for t in got]
    assert digits[0][:2] == "49" and digits[1][0] == "0" and digits[0][2:] == digits[1][1:] != "301234567"
    assert digits[2] == "1" + digits[3] and digits[3] != "9885552485" and digits[4][:3] == "351"


def test_addresses_of_short_hosts_end_distinct(spark):
    mails = [f"{a}@{h}.com" for h in "dr" for a in pii.LETTERS]
    got = replaced(spark, [(i, f"to {m} now") for i, m in enumerate(mails)])
    made = [re.fullmatch(r"to (\S+)@(\S+) now", got[i].text).groups() for i in range(52)]
    assert len(set(made)) == 52 and len({h for _, h in made[:26]}) == len({h for _, h in made[26:]}) == 1 and made[0][1] != made[26][1]


def test_numbers_that_fill_their_space_are_permuted(spark):
    every = [("phone", f"{n:04d}", "") for n in range(10000)]
    entities = spark.createDataFrame(every, "kind string, entity string, base string")
    known = {r.entity: r.surrogate for r in pii.resolve(entities, "k").collect()}
    assert len(known) == 10000 and set(known) == set(known.values()) and sum(a == b for a, b in known.items()) < 20


def test_many_surnames_stay_distinct(spark):
    entities = spark.createDataFrame([("family", f"latin:name{n}", "") for n in range(3000)], "kind string, entity string, base string")
    known = [r.surrogate for r in pii.resolve(entities, "k").collect()]
    assert len(known) == len(set(known)) == 3000


def test_all_documents_lose_their_entities(spark, small):
    docs = documents(spark, small)
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r for r in pii.replace_pii(docs).collect()}
    assert set(before) == set(after)
    for i, text in before.items():
        found = pii.find(text)
        assert after[i].n_entities == len(found)
        assert not any(text[a:b] in after[i].text for a, b, *_ in found)
        if not found:
            assert after[i].text == text


def test_edges(spark):
    rows = pii.replace_pii(edge_docs(spark)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str(e[:2]) for e in EDGES)
    assert pii.replace_pii(no_docs(spark)).count() == 0
