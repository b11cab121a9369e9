"""Templates, leaks and slots."""

import random
import time

from landgrid.llm import common, decontamination
from tests.llm import cases

ITEMS = "item_id long, text string, doc_id string, place string"
QUESTION = ("Maria Lopez has 12 apples and buys 30 more apples for $4.50 at the market. She gives 12 apples to Tom Baker and walks 3 km home. "
            "How many apples does Maria Lopez have now")


def test_template():
    words = decontamination.template("Anna Smith buys 12 kg of apples for $3.50. Then Bob pays 1,200 dollars to Anna Smith.")
    assert [w for w, _ in words] == ["<name>", "buys", "<number>", "<unit>", "of", "apples", "for", "<unit>", "<number>", "<name>",
                                     "pays", "<number>", "<unit>", "to", "<name>"]
    assert [v for _, v in words if v] == ["anna smith", "12", "kg", "$", "3.50", "then bob", "1200", "dollars", "anna smith"]
    assert decontamination.template("") == [] == decontamination.template(" \n.!?")


def test_odd_characters():
    words = decontamination.template("É. “l'été” d’Été: 3€ 5 °C ﬁ İx Иван Петров 中文 naïve—x 1,5:3 $")
    assert words[:4] == [("é", None), ("l'été", None), ("d", None), ("<name>", "été")]
    assert ("<unit>", "€") in words and ("<name>", "иван петров") in words and ("<number>", "15:3") in words
    assert decontamination.template("a" * 200 + " b")[-1] == ("b", None)


def test_pieces_do_not_show(monkeypatch):
    text = " ".join(t for _, t, _ in cases.corpus(20)) + " " + QUESTION
    whole = decontamination.template(text)
    monkeypatch.setattr(common, "BLOCK", 40)
    assert decontamination.template(text) == whole


def around(rng, text):
    return f"{cases.words(rng, 'en', 20)}. {text}. {cases.words(rng, 'en', 20)}."


def test_leaks(spark):
    rng = random.Random(6)
    items = [(k, cases.words(rng, "en", rng.randint(15, 40)), "x", "y") for k in range(12)]
    items[5] = (5, cases.words(rng, "en", 40), "x", "y")
    items += [(50, QUESTION, "x", "y"), (51, QUESTION + "?", "x", "y"), (60, None, None, None), (61, "", None, None), (62, "too few words", None, None),
              (None, "an item that has no id and is long enough for windows", None, None)]
    consistent = (QUESTION.replace("Maria Lopez", "Ines Braun").replace("12", "17").replace("30", "45").replace("4.50", "9.99")
                  .replace("Tom Baker", "Paul Weiss").replace("3 km", "5 km"))
    mixed = QUESTION.replace("12 apples and", "17 apples and")           # 12 stands for 17 here and for 12 there
    half = " ".join(items[1][1].split()[:len(items[1][1].split()) // 2])
    bent = items[5][1].split()
    bent = " ".join([*bent[:4], "then", *bent[4:]])                     # one word more: 4 of its windows are gone
    texts = {2008: around(rng, bent), 2000: around(rng, items[0][1]), 2001: items[2][1].upper(), 2002: around(rng, QUESTION), 2003: around(rng, consistent),
             2004: around(rng, mixed), 2005: around(rng, half), 2006: around(rng, "too few words"), 2007: around(rng, items[3][1]) * 2}
    docs = cases.awkward(spark, more=[*texts.items(), (2000, texts[2000]), (None, around(rng, items[4][1]))])
    bench = spark.createDataFrame(items, ITEMS)
    found = decontamination.contaminated(docs, bench)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert set(got) == {(2000, 0), (2001, 2), (2002, 50), (2002, 51), (2003, 50), (2003, 51), (2007, 3), (2008, 5), (None, 4)}
    assert {k for k, r in got.items() if r.kind == "reparameterised"} == {(2003, 50), (2003, 51)}
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    bad = {2000, 2001, 2002, 2003, 2007, 2008, None}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in bad)


def test_repeated_windows(spark):
    # one template window with a number, twice in the item and 1 to 15 words apart
    rng = random.Random(8)
    items, texts = [], {}
    for gap in range(1, 16):
        filler = [f"w{gap}x{k}" .translate(str.maketrans("0123456789", "abcdefghij")) for k in range(40)]
        phrase = "holds {} red pens and" if gap >= 6 else "so {} so {} so {} so {} so {} so {}"
        body = " ".join([*filler[:12], phrase, *filler[12:12 + gap], phrase, *filler[30:]])
        n = body.count("{}")
        values = [12 + 7 * k for k in range(n)]
        items.append((gap, body.format(*values), "x", "y"))
        texts[100 + gap] = around(rng, items[-1][1])
        texts[200 + gap] = around(rng, body.format(*[v + 100 for v in values]))
        texts[300 + gap] = around(rng, body.format(*values[:-1], values[0]))          # two values became one
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {**{(100 + g, g): "copy" for g in range(1, 16)}, **{(200 + g, g): "reparameterised" for g in range(1, 16)}}


def test_letter_case(spark):
    german = ("Die Straße vor dem Haus hat 12 Bäume und jeder Baum trägt 30 Äpfel für die Kinder der Schule am Markt. "
              "Wie viele Äpfel haben die Kinder der Schule im Sommer")
    clips = ("Natalia sold 48 clips to her friends in spring. Then in May she saw that Natalia had half as many clips left. "
             "Natalia gives 12 clips away to Peter. Natalia keeps the rest at home")
    items = [(1, QUESTION, "x", "y"), (2, german, "x", "y"), (3, clips, "x", "y")]
    texts = {10 * k + j: case(t) for k, t, _, _ in items for j, case in enumerate([str.upper, str.lower, str.title])}
    texts[40] = around(random.Random(9), clips.replace("Natalia", "Zorica").replace("48", "52"))
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {**{(10 * k + j, k): "copy" for k in (1, 2, 3) for j in range(3)}, (40, 3): "reparameterised"}


def test_names_that_open_sentences():
    words = [w for w, _ in decontamination.template("Zorica runs. The dog saw the mouse, the cat saw Zorica. The Shop saw The Cat. Emily ran. The End. The cat ran. Zoric ran.")]
    assert words == ["<name>", "runs", "the", "dog", "saw", "the", "mouse", "the", "cat", "saw", "<name>", "<name>", "saw", "<name>",
                     "<name>", "ran", "<name>", "the", "cat", "ran", "zoric", "ran"]


def test_short_items(spark):
    items = [(1, "What is 12 + 30?", "x", "y"), (2, "Anna Smith", "x", "y"), (3, "Wie heißt\nsie?", "x", "y"), (4, "?!", "x", "y")]
    texts = {1: "What is 12 + 30?", 2: "WHAT IS 12 + 30", 3: "what is 7 + 8?", 4: "Some words come first.\nWhat is 12 + 30?\nAnd some words follow",
             5: "What is 12 + 30 of these", 6: "anna smith", 7: "Ben Jones", 8: "First\nWIE HEISST\nSIE\n", 9: "what is 5 + 5"}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(1, 1): "copy", (2, 1): "copy", (3, 1): "reparameterised", (4, 1): "copy", (6, 2): "copy", (8, 3): "copy"}


def test_long_insertions(spark):
    rng = random.Random(10)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("al", "er", "in", "os", "ut") for c in ("ba", "de", "fi", "go", "ku")]
    rng.shuffle(words)
    body, remark = words[:150], [f"{w}x" for w in words]
    items = [(1, " ".join(body), "x", "y"), (2, " ".join(words[150:180]), "x", "y")]
    short = items[1][1].split()
    texts = {1: [*body[:75], *remark[:20], *body[75:]], 2: [*body[:75], *body[95:]], 3: [*body[:50], *remark[:60], *body[50:100], *remark[60:130], *body[100:]],
             4: [*short[:15], *remark[:40], *short[15:]], 5: [*body[75:], *body[:75]], 6: [*short[:15], *remark, *remark, *short[15:]],
             7: [*remark[:37], *body[:75], *remark[:20], *body[75:]] * 2}
    docs = spark.createDataFrame([(k, around(rng, " ".join(t))) for k, t in texts.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in decontamination.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(1, 1): 142, (2, 1): 122, (3, 1): 138, (4, 2): 22, (7, 1): 142}


def by_all_windows(docs, items, window=decontamination.WINDOW):
    """Every window of every document against every window of every item; texts without names."""
    def cut(text):
        words = decontamination.template(text)
        return [(tuple(w for w, _ in words[k:k + window]), tuple(v for _, v in words[k:k + window])) for k in range(len(words) - window + 1)]

    out = {}
    for i, text in docs:
        for j, item in items:
            found, asked = cut(text), cut(item)
            half = 2 * len(asked) + decontamination.SLACK
            hits = [(p, q) for p, (a, _) in enumerate(found) for q, (b, _) in enumerate(asked) if a == b]
            for shift in (0, half):
                for stretch in {(p + shift) // (2 * half) for p, _ in hits}:
                    part = [(p, q) for p, q in hits if (p + shift) // (2 * half) == stretch]
                    made = decontamination._aligned([p for p, _ in part], [q for _, q in part], [found[p][1] for p, _ in part],
                                                    [asked[q][1] for _, q in part], decontamination._needed(len(asked), 0.8), len(asked))
                    for matched, first, changed in made:
                        best = (matched / len(asked), not changed, -(part[first][0] - part[first][1]))
                        out[i, j] = max(out.get((i, j), best), best)
    return {(i, j, -place, round(s, 9), "copy" if same else "reparameterised") for (i, j), (s, same, place) in out.items()}


def test_all_windows_find_no_more(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("alpha beta gamma delta of the and sum".split() + [str(rng.randint(0, 9))] * 4)
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 24)))) for k in range(25)]
    items += [(25, "1 2 3 4 5 6 7"), (26, "4 4 4 4 4 4"), (27, "sum of 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7"), (28, "the sum of the sum of the sum of the sum")]

    def altered(text):
        words = text.split()
        if rng.random() < 0.5:
            words = [str((int(w) + 3) % 10) if w.isdigit() else w for w in words]
        if rng.random() < 0.6:
            words[rng.randrange(len(words))] = word()
        return " ".join(words)

    docs = [(k, " ".join([word() for _ in range(30)] + altered(rng.choice(items)[1]).split() + [word() for _ in range(90)]
                         + altered(rng.choice(items)[1]).split())) for k in range(60)]
    docs += [(60, " ".join("4" * 80)), (61, " ".join(str(k % 10) for k in range(300)))]
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id, r.place, round(r.similarity, 9), r.kind) for r in got.collect()}
    want = by_all_windows(docs, items)
    assert got == want and len({kind for *_, kind in want}) == 2 and len(want) > 60


def test_tables_of_numbers(spark):
    rng = random.Random(12)
    items = [(k, " ".join(str(rng.randint(0, 999)) for _ in range(40))) for k in range(200)] + [(200, "7 " * 40)]
    table = [str(rng.randint(0, 999)) for _ in range(100_000)]
    table[50_000:50_040] = items[17][1].split()
    docs = [(1, " ".join(table)), (2, "7 " * 5_000), (3, "costs of 2020 by month: " + " ".join(map(str, range(3000, 8000))))]
    items.append((201, "costs of 2021 by month: " + " ".join(map(str, rng.sample(range(1000, 2000), 60)))))     # each value once
    started = time.monotonic()
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.kind) for r in got.collect()} == {(1, 17, "copy"), (2, 200, "copy"), (3, 201, "reparameterised")}
    assert time.monotonic() - started < 120         # 36 to 49 s where this was written; hours if all numbers meet


def test_shared_openings_open_nothing(spark):
    rng = random.Random(13)
    phrase = "what is the value of the following sum of terms that are given in the list"
    items = [(k, phrase + " " + " ".join(f"w{rng.randint(0, 10 ** 6):06d}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(12)))
             for k in range(3000)]
    docs = [(k, f"{phrase} and so on {phrase}") for k in range(300)] + [(300, items[5][1])]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    asked = decontamination._keyed(decontamination.windows(items, "item_id", "text").withColumnsRenamed(
        {"id": "item_id", "place": "item_place", "windows": "item_windows", "slots": "item_slots"}), "item_slots")
    found = decontamination._keyed(decontamination.windows(docs, "doc_id", "text"), "slots")
    opening = decontamination._opening(asked, found, 0.8)
    assert found.join(opening, ["plain", "key"]).count() < 50
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()] == [(300, 5)]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, QUESTION, "", "")], ITEMS)
    assert decontamination.contaminated(cases.empty(spark), bench).count() == 0
    assert decontamination.contaminated(cases.awkward(spark), cases.empty(spark, ITEMS)).count() == 0
