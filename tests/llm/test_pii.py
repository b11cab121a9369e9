"""Surrogates: type, format, coreference, distinctness, nothing else touched."""

import re

import pytest
from pyspark.sql import functions as F

from landgrid.llm import pii
from tests.llm import cases

KEY = b"test"


def fake(kind, value, attempt=0):
    (found,) = [f for f in pii.detect(value) if f[2].split("/")[0] == kind][:1]
    return pii.dressed(found[2], value[found[0]:found[1]], found[3], pii.surrogate(KEY, found[2], found[3], attempt))


def test_formats():
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.example\.com", fake("email", "und.34@mail7.example.com"))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", fake("phone", "+1 (017) 555-7713"))
    assert fake("phone", "+49 30 1234567").startswith("+49 ")
    assert re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", fake("card", "4111 1111 1111 1111"))
    for card in ("4111 1111 1111 1111", "4111111111111112", "9807915762804490"):
        assert pii._luhn(re.sub(r"\D", "", fake("card", card))) == pii._luhn(re.sub(r"\D", "", card))
    assert re.fullmatch(r"9\d\d-\d\d-\d{4}", fake("ssn", "123-45-6789"))
    iban = fake("iban", "DE89 3704 0044 0532 0130 00").replace(" ", "")
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert fake("ip", "10.1.2.3").startswith("10.") and not fake("ip", "97.51.17.173").startswith(("10.", "127."))


def test_names_keep_gender_and_script():
    for name, script, gender in [("Anna Smith", "latin", "f"), ("Иван Петров", "cyrillic", "m"), ("Ελένη Παππά", "greek", "f")]:
        text, spans = pii.rewritten(f"We met {name} there; {name.split()[0]} waved.", KEY, {})
        assert [s["kind"] for s in spans] == [f"name/{script}/{gender}", f"name/{script}/", f"name/{script}/{gender}"]
        given, family, again = (text.split()[k] for k in (2, 3, 5))
        assert given == again and any(given.endswith(e) for e in pii.ENDINGS[script, gender])
        assert pii._script(given) == pii._script(family.rstrip(";")) == script and not set(name.split()) & set(text.split())


@pytest.mark.parametrize("text, hidden", [
    ("We met Emily Carter there.", "Emily Carter"), ("John Smith came. Later Smith said so, and SMITH left.", "John Smith SMITH"),
    ("John F. Kennedy and J. F. Kennedy spoke.", "John Kennedy"), ("John McDonald ate.", "John McDonald"),
    ("Patient SMITH, JOHN was seen.", "SMITH JOHN"), ("Smith, John", "Smith John"), ("Then O'Brien sang with Mary O’Neil.", "O'Brien Mary O’Neil"),
    ("ask Dr. Zorica Petrovka about it; Petrovka knows", "Zorica Petrovka"), ("Hans van Beethoven and Anna von Trapp", "Hans Beethoven Anna Trapp"),
    ("Yesterday JOHN SMITH WENT TO THE SHOP", "JOHN SMITH")])
def test_names_in_all_forms(text, hidden):
    out, spans = pii.rewritten(text, KEY, {})
    assert not [w for w in hidden.split() if re.search(rf"(?<!\w){w}(?!\w)", out)]
    covered = " ".join(text[s["start"]:s["end"]] for s in spans)
    assert not [w for w in re.findall(r"\w{3,}", covered) if w not in re.findall(r"\w+", hidden)]


def test_surname_keeps_one_surrogate():
    out, _ = pii.rewritten("John F. Kennedy came. Kennedy spoke, KENNEDY left, J. Kennedy stayed.", KEY, {})
    fakes = re.findall(r"(\w+) (?:came|spoke|left|stayed)", out.replace(".", "").replace(",", ""))
    assert len({f.lower() for f in fakes}) == 1 and fakes[2].isupper() and len(fakes) == 4
    assert pii.rewritten("In Paris, John Brown said brown bread is good. Brown left.", KEY, {})[0].startswith("In Paris, ")


def test_phones_in_any_form():
    for forms in (["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958"], ["+1 (555) 010-1234", "+15550101234"], ["+353 1 234 5678", "+35312345678"]):
        fakes = {re.sub(r"\D", "", pii.rewritten(f"call {f} now", KEY, {})[0]) for f in forms}
        (normal,) = {pii.detect(f)[0][3] for f in forms}
        assert fakes == {pii.surrogate(KEY, "phone", normal, 0)[1:]}
        assert next(iter(fakes)).startswith(re.match(r"\+(\d+)", forms[0]).group(1))


def test_only_whole_entities():
    assert pii.detect("version 1.2.3.4.5, a1.2.3.4, deadbeef12345678901234, 999.1.1.1, x@y, 12-34, AnnaLena") == []
    assert [f[2] for f in pii.detect("mail a.b+c@d-e.co.uk. or 1.2.3.4, 4111111111111111!")] == ["email", "ip", "card"]


def many(n):
    return [(6000 + k, f"call +1 (555) 01{k % 10}-{k:04d} or write user{k}@mail.example.com, backup user{k}@mail.example.com") for k in range(n)]


def test_corpus_coreference_and_distinctness(spark):
    docs = cases.awkward(spark, more=[*many(300), (5000, "user3@mail.example.com and USER3@mail.example.com, Anna Smith")])
    out = pii.anonymised(docs, key=KEY, report="spans_found")
    before = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    mapped = {}
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns == [*docs.columns, "spans_found"]
    for r in rows:
        if r.doc_id is None:
            continue
        if not r.spans_found:
            assert r.text == before[r.doc_id]
            continue
        now = pii.detect(r.text)
        assert [f[2].split("/")[0] for f in now] in ([s.kind.split("/")[0] for s in r.spans_found], ["email", "email"])
        for s, f in zip(r.spans_found, now):
            mapped.setdefault((s.kind, pii.detect(before[r.doc_id][s.start:s.end])[0][3] if not s.kind.startswith("name") else "n"), set()).add(f[3])
    values = [next(iter(v)) for v in mapped.values()]
    assert all(len(v) == 1 for v in mapped.values()) and len(set(values)) == len(values)
    assert not {n for _, n in mapped} & set(values)
    assert pii.replaced(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("text", [
    "They sailed on Lake Victoria. Victoria Station was shut.", "St. Louis and Santa Monica Boulevard and Alice Springs.",
    "The Adam optimizer converges. Jean jackets sell.", "Max is the maximum. Ines in onndreed esatth. Dora onered."])
def test_places_and_words_are_no_names(text):
    assert pii.detect(text) == []


def test_names_that_open_sentences_need_evidence():
    assert len(pii.detect("Victoria said no.")) == len(pii.detect("We saw Dora")) == len(pii.detect("Mrs Victoria came")) == 1
    assert len(pii.detect("Dora came. Then we saw Dora.")) == len(pii.detect("Alice Miller came")) == 2


def draws(entities, key):
    """The replacements in plain Python, by a dictionary of draws."""
    originals = {(k.split("/")[0], n) for k, n in entities}
    taken, out, open_ = set(originals), {}, sorted(entities, key=lambda e: (e[1], e[0]))
    for attempt in range(pii.DRAWS):
        now, lost = set(), []
        for kind, normal in open_:
            value = (kind.split("/")[0], pii.surrogate(key, kind, normal, attempt))
            if value in taken or value in now:
                lost.append((kind, normal))
            else:
                now.add(value)
                out[kind, normal] = value[1]
        taken, open_ = taken | now, lost
    return out, open_


def frame(spark, entities):
    return spark.createDataFrame(list(entities), "kind string, normal string").repartition(3)


def test_collisions_are_drawn_again(spark):
    # four-digit numbers only: many draws meet each other or an original
    entities = [("phone", f"{k:04d}") for k in range(0, 9000, 3)] + [("name/latin/f", f"anna{k}") for k in range(60)]
    again = {(r.kind, r.normal): r.fake for r in pii.redrawn(frame(spark, entities), KEY).collect()}
    fakes = {e: again.get(e) or pii.surrogate(KEY, *e, 0) for e in entities}
    assert again and len(set(fakes.values())) == len(entities) and not set(fakes.values()) & {n for _, n in entities}
    assert (fakes, []) == draws(entities, KEY)


@pytest.mark.parametrize("entities", [
    [("phone", str(k)) for k in range(10)],                                        # a full format
    [("email", f"a@d{k}.com") for k in range(1000)],                               # one-letter addresses
    [("ip", f"192.168.{a}.{b}") for a in range(256) for b in range(256)]], ids=["digits", "letters", "private"])
def test_crowded_formats_never_raise(spark, entities):
    again = {(r.kind, r.normal): r.fake for r in pii.redrawn(frame(spark, entities), KEY).collect()}
    fakes = {e: again.get(e) or pii.surrogate(KEY, *e, 0) for e in entities}
    assert len(set(fakes.values())) == len(entities) and all(f != n for (_, n), f in fakes.items())
    if entities[0][0] != "phone":
        assert not set(fakes.values()) & {n for _, n in entities}
    if entities[0][0] == "ip":
        assert all(f.startswith(("192.168.", "10.")) for f in fakes.values())


def test_null_ids_and_corpus_against_plain_python(spark):
    texts = [f"write to a@d{k}.com today, or ring 555-01{k % 10}-00{k:02d}" for k in range(40)] * 2 + ["", None]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(4)
    entities = {f[2:] for t in texts if t for f in pii.detect(t)}
    fakes, lost = draws(entities, KEY)
    want = sorted(pii.rewritten(t, KEY, fakes)[0] for t in texts if t) 
    got = [r.text for r in pii.anonymised(docs, key=KEY).collect()]
    assert not lost and sorted(t for t in got if t) == want and got.count(None) == got.count("") == 1


def test_key_decides(spark):
    docs = spark.createDataFrame(many(3), "doc_id long, text string")
    one, two, same = (pii.anonymised(docs, key=k).agg(F.sort_array(F.collect_list("text"))).first()[0] for k in (b"a", b"b", b"a"))
    assert one == same != two
