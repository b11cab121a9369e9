"""Personal data replaced by surrogates.

Detected entities (emails, phone and card numbers, IP addresses, social security numbers, IBANs,
names) get keyed replacements of the same type and format: separators, lengths, country codes and
check digits stay valid, names keep gender and script. A surrogate is drawn by HMAC from the entity's
normal form, so all mentions of an entity, in any document, get the same one. Draws are checked over
the whole corpus: one that another entity has drawn too, or that is itself an entity of the corpus, is
drawn again, from a space that grows with the attempt where the kind allows it. A format that the corpus
itself fills (all numbers of a short form, say) has no values left to draw; its entities then exchange
their values in a keyed order, so they stay distinct and none keeps its own. Only entities that did not
keep their first draw have to be looked up when texts are rewritten.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm import common
from landgrid.llm.names import BEFORE_PLACES, GIVEN, PLACES, SPEECH
from landgrid.operators.tables import row_ids
from landgrid.shared import saved

KEY = b"change this key for each release of a corpus"
DRAWS = 40               # attempts after which a format counts as full
FULL = 16                # a format is full, too, if of many entities fewer than one in so many finds a value,
MANY = 64
BARREN = 6               # or if none does for so many rounds

# fixed values: words before a name, and small words inside one
TITLES = """Mr Mrs Ms Miss Mx Dr Prof Professor Doctor Sir Herr Frau Madame Mme Monsieur Señor Señora Signor Signora
Господин Госпожа Г-н Г-жа Κύριος Κυρία""".split()
PARTICLES = "van von de da del della di la le der den du dos bin ibn al el ten ter zu".split()
# fixed values: what surrogate names are put together from
STEMS = {"latin": "al ber cor dan el fer gal hol is jor kel lor mar nor or per ros sal tor val".split(),
         "cyrillic": "ал бор вел гор дар ев зор ил кор лад мир нор ол рад сав тор".split(),
         "greek": "αλ βερ γαλ δαν ελ ζεν θαλ κορ λαν μιρ νικ ορ περ ροδ σελ τιμ".split()}
ENDINGS = {("latin", "f"): ["a", "ine", "elle"], ("latin", "m"): ["us", "in", "ard"], ("latin", ""): ["man", "ton", "ley"],
           ("cyrillic", "f"): ["а", "ина"], ("cyrillic", "m"): ["ан", "ор"], ("cyrillic", ""): ["енко", "ич"],
           ("greek", "f"): ["α", "η"], ("greek", "m"): ["ος", "ης"], ("greek", ""): ["ίδης", "άκης"]}
_GENDER = {name: kind for kind, names in GIVEN.items() for name in names}
_GENDER |= {name.upper(): kind for name, kind in _GENDER.items()}
# fixed values: country codes of two digits; 1 and 7 stand alone, all others have three
CODES = frozenset("""20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66
81 82 84 86 90 91 92 93 94 95 98""".split())
_SCRIPTS = (("cyrillic", "Ѐ", "ӿ"), ("greek", "Ͱ", "Ͽ"))

_CAPITAL = "A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я"
_SMALL = "a-zß-öø-ÿά-ώЀ-ӿ"
_PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)", re.A)),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A)),
    ("phone", re.compile(r"(?<!\w)(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)", re.A)),
    ("card", re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)", re.A)),
]
_DIGIT = re.compile(r"\d", re.A)
# a word of a name: O'Brien, McDonald, Smith, SMITH; between words: a hyphen, or blanks with initials and particles
_FORM = rf"(?:[{_CAPITAL}]['’](?=[{_CAPITAL}]))?[{_CAPITAL}](?:[{_SMALL}]+(?:[{_CAPITAL}][{_SMALL}]+)*|[{_CAPITAL}]+)"
_INITIALS = rf"(?:[{_CAPITAL}]\. ?|[{_CAPITAL}] )"
_WORD = re.compile(rf"(?<![\w'’]){_FORM}(?!\w)")
_NAME = re.compile(rf"(?<![\w'’]){_FORM}(?:(?:-| (?:{_INITIALS}|(?:{'|'.join(PARTICLES)}) )*){_FORM})*(?!\w)")
_LEAD = re.compile(rf"{_INITIALS}+")
_BACK = re.compile(rf"(?<!\w){_INITIALS}+$")
_TITLE = re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? $")
_CELTIC = re.compile(rf"O['’][{_CAPITAL}]|Mc[{_CAPITAL}]|MC[{_CAPITAL}]{{3}}")
_CAPITALISED = re.compile(rf"(?<![\w'’]){_FORM}")
_OPENS = re.compile(r"(?:^|[^\w\s,;:&/'’()|+=@-]|[\n\r])[\s\"'“”„»«()\[\]*#>-]*$")
_ARTICLE = re.compile(r"(?<!\w)(?:[Tt]he|[Aa]n?) $")
_BEHIND = re.compile(rf" ?([\w’'-]+)")
_PLACE_BEFORE = re.compile(rf"(?<!\w)(?:{'|'.join(BEFORE_PLACES)})\.? $")
_EVIDENCE = frozenset(_GENDER) | frozenset(TITLES)
_TURNED = re.compile(rf"(?<![\w'’])({_FORM}(?:[ -]{_FORM})?), ({_FORM})(?: [{_CAPITAL}]\.?)?(?!\w)")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _script(word: str) -> str:
    return next((name for name, low, high in _SCRIPTS if low <= word[0] <= high), "latin")


def _surname(text: str, start: int, end: int) -> tuple[int, int, str, str]:
    """A name's word with the initials before it."""
    lead = _BACK.search(text, max(0, start - 12), start)
    return lead.start() if lead else start, end, f"name/{_script(text[start:])}/", text[start:end].lower().replace("’", "'")


def _of_place(text: str, words: list[tuple[int, int, str]], first: int) -> bool:
    """Whether a listed name is part of a place's name, or a thing's: Lake Victoria, Alice Springs, the Adam optimizer."""
    start = words[first][0]
    if first and words[first - 1][2] in BEFORE_PLACES or _PLACE_BEFORE.search(text, max(0, start - 16), start):
        return True
    if any(w[2] in PLACES for w in words[first + 1:]):
        return True
    return first == len(words) - 1 and bool(_ARTICLE.search(text, max(0, start - 5), start))


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Words of names, as evidence shows them: a listed given name or a title before them, the forms O'..., Mc...
    and SURNAME, GIVEN; what is known as a surname is one at its bare mentions in the text, too. A listed name is none
    as part of a place's name; one that stands alone and opens a sentence may be any word: it needs a verb of speech
    behind it, or the same name inside a sentence of the text."""
    found: dict[int, tuple[int, int, str, str]] = {}
    shapes = set(_CAPITALISED.findall(text))
    if shapes.isdisjoint(_EVIDENCE) and not any(map(_CELTIC.match, shapes)):
        return []
    lone: list[tuple[int, int, str, str]] = []
    for m in _NAME.finditer(text):
        words = [(m.start() + w.start(), m.start() + w.end(), w.group()) for w in re.finditer(_FORM, m.group())]
        given = next((k for k, w in enumerate(words) if w[2] in _GENDER and not (w[2].isupper() and len(w[2]) < 4 and len(words) == 1)), None)
        titled = 0 if _TITLE.search(text, max(0, m.start() - 12), m.start()) else next(
            (k + 1 for k, w in enumerate(words[:-1]) if w[2] in TITLES), None)
        first = min((k for k in (given, titled) if k is not None), default=None)
        if first is None:
            first = next((k for k, w in enumerate(words) if _CELTIC.match(w[2])), None)
            if first is None:
                continue
            words = words[:first + 1]
        elif titled is None:
            if _of_place(text, words, first):
                continue
            start, end, word = words[first]
            if len(words) == 1 and _OPENS.search(text, max(0, start - 12), start):
                behind = _BEHIND.match(text, end)
                if not (behind and behind.group(1).lower() in SPEECH):
                    script, gender = _GENDER[word]
                    lone.append((start, end, f"name/{script}/{gender}", word.lower()))
                    continue
        if words[first][2].isupper() and len(words) > 3:                   # text in capitals: a name ends with its surname
            last = first
            while last + 1 < len(words) and words[last][2] in _GENDER:
                last += 1
            words = words[:last + 1]
        for start, end, word in words[first:]:
            if word in _GENDER:
                script, gender = _GENDER[word]
                found[start] = (start, end, f"name/{script}/{gender}", word.lower())
            elif word not in TITLES:
                found[start] = _surname(text, start, end)
    for m in _TURNED.finditer(text):
        if m.group(2) not in _GENDER:
            continue
        before, behind = text[:m.start()].rstrip(" ")[-1:], text[m.end():].lstrip(" ")[:1]
        alone = before in "\n;:(|\t\"" and behind in "\n;,.)|\t\""        # a field or line of its own ('' is in every text)
        words = list(re.finditer(_FORM, m.group(1)))
        if not alone:                                     # in running text the surname stands out by its capitals
            words = [w for k, w in enumerate(words) if all(x.group().isupper() for x in words[k:])]
            at = m.start() + words[0].start() if words else m.start()
            near = [w.strip(".,;:()\"") for w in (text[max(0, at - 40):at].split()[-1:] + text[m.end():m.end() + 40].split()[:1])]
            words = [] if any(w.isupper() and len(w) > 1 for w in near) else words
        for w in words:
            start, end = m.start() + w.start(), m.start() + w.end()
            if start not in found:
                found[start] = (start, end, f"name/{_script(w.group())}/", w.group().lower().replace("’", "'"))
    inside = {f[3] for f in found.values()}
    found.update({f[0]: f for f in lone if f[3] in inside})
    known = {f[3]: f[2] for f in found.values() if f[2].endswith("/")}
    known = {n: k for n, k in known.items() if not re.search(rf"(?<!\w){re.escape(n)}(?!\w)", text)}      # not if it is a word, too
    if known:
        taken = {f[1] for f in found.values()}
        for w in _WORD.finditer(text):
            if w.end() not in taken and w.group().lower().replace("’", "'") in known:
                found[w.start()] = _surname(text, w.start(), w.end())
    return list(found.values())


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, normal form)`` of the entities of a text, without overlaps; earlier kinds win."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m.group().lower()) for m in _PATTERNS[0][1].finditer(text)]
    if _DIGIT.search(text):
        for kind, pattern in _PATTERNS[1:]:
            for m in pattern.finditer(text):
                value = m.group()
                plain = value if kind == "ip" else "".join(c for c in value if c.isalnum())
                if kind != "phone" or 7 <= len(plain) <= 15:
                    found.append((m.start(), m.end(), kind, "+" + plain if value[0] == "+" else plain))
    found += _names(text)
    rank = {kind: k for k, (kind, _) in enumerate(_PATTERNS)}
    out: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    if len(found) > 1:
        found.sort(key=lambda f: (rank.get(f[2], 9), f[0]))
        for f in found:
            k = bisect.bisect_left(taken, (f[0], f[1]))
            if (k == 0 or taken[k - 1][1] <= f[0]) and (k == len(taken) or f[1] <= taken[k][0]):
                taken.insert(k, (f[0], f[1]))
                out.append(f)
        return sorted(out)
    return found


class _Draw:
    """A stream of numbers that depends on the key, the entity and the attempt."""

    def __init__(self, key: bytes, kind: str, normal: str, attempt: int):
        self.seed, self.key, self.count, self.pool = f"{kind}|{normal}|{attempt}".encode(), key, 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.seed + b"|%d" % self.count, hashlib.sha256).digest()
            self.count += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n

    def like(self, c: str) -> str:
        if c.isdigit():
            return str(self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        return chr(65 + self.below(26)) if "A" <= c <= "Z" else c


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The replacement's normal form."""
    draw = _Draw(key, kind, normal, attempt)
    if kind == "email":
        local, _, domain = normal.partition("@")
        labels = domain.split(".")
        host = ["".join(map(draw.like, x)) for x in labels[:-2]]
        if attempt > 1:                                   # one more label, longer with each attempt
            host.append("".join(map(draw.like, "a" * attempt)))
        return f"{''.join(map(draw.like, local))}@{'.'.join([*host, 'example', labels[-1] if labels[-1] in ('com', 'org', 'net') else 'com'])}"
    if kind == "ip":
        octets = [int(x) for x in normal.split(".")]
        kept = 1 if octets[0] in (10, 127) else 2 if octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32 else 0
        if kept == 2 and attempt > 2:                     # the largest private range
            octets, kept = [10], 1
        fresh = [1 + draw.below(254) for _ in range(4)]
        while not kept and (fresh[0] in (10, 127, 172, 192) or fresh[0] > 223):      # a public address stays public
            fresh[0] = 1 + draw.below(254)
        return ".".join(map(str, octets[:kept] + fresh[kept:]))
    if kind == "card":
        body = normal[0] + "".join(draw.like(c) for c in normal[1:-1])
        check = next(str(d) for d in range(10) if _luhn(body + str(d)))
        return body + (check if _luhn(normal) else str((int(check) + 1 + draw.below(9)) % 10))
    if kind == "ssn":
        return "9" + "".join(draw.like(c) for c in normal[1:])            # area numbers that are never given out
    if kind == "iban":
        body = "".join(draw.like(c) for c in normal[4:])
        number = int("".join(str(int(c, 36)) for c in body + normal[:2] + "00"))
        return f"{normal[:2]}{98 - number % 97:02d}{body}"
    if kind.startswith("name/"):
        _, script, gender = kind.split("/")
        stems, ends = STEMS[script], ENDINGS[script, gender]
        count = 2 + attempt // 4
        return "".join(stems[draw.below(len(stems))] for _ in range(count)) + ends[draw.below(len(ends))]
    kept = _prefix(kind, normal)
    return normal[:kept] + "".join(draw.like(c) for c in normal[kept:])


def _prefix(kind: str, normal: str) -> int:
    """The length of a phone number's country code, which stays, however the number is written."""
    if kind != "phone" or normal[0] != "+":
        return 0
    return 2 if normal[1] in "17" else 3 if normal[1:3] in CODES else 4


def shape(kind: str, normal: str) -> str:
    """What entities of a kind must have in common to exchange their values."""
    if kind == "phone":
        return f"{kind}|{normal[:_prefix(kind, normal)]}|{len(normal)}"
    if kind == "card":
        return f"{kind}|{normal[0]}|{len(normal)}|{_luhn(normal)}"
    if kind == "iban":
        return f"{kind}|{normal[:2]}|{''.join('0' if c.isdigit() else 'A' for c in normal[4:])}"
    return kind


def dressed(kind: str, original: str, normal: str, fake: str) -> str:
    """The replacement's normal form in the written form of a mention."""
    if kind.startswith("name/"):
        lead = _LEAD.match(original)                      # initials follow the surrogate's letters
        lead, body = (lead.group(), original[lead.end():]) if lead else ("", original)
        letters = iter(fake.upper() * len(original))
        lead = "".join(next(letters) if c.isalpha() else c for c in lead)
        return lead + (fake.upper() if body.isupper() else fake[0].upper() + fake[1:])
    if kind == "email":
        if original.upper() == original:
            return fake.upper()
        local, _, domain = fake.partition("@")
        return "".join(f.upper() if o.isupper() else f for o, f in zip(original, local)) + "@" + domain
    if kind == "ip":
        return fake
    letters = iter(fake.lstrip("+"))
    return "".join(next(letters) if c.isalnum() else c for c in original)


def rewritten(text: str, key: bytes, fakes: dict[tuple[str, str], str]) -> tuple[str, list[dict]]:
    """The text with surrogates, and the entities' kinds and places in the original.

    ``fakes`` holds the replacements' normal forms of entities that did not keep their first draw.
    """
    out, last, found = [], 0, detect(text)
    for start, end, kind, normal in found:
        fake = fakes.get((kind, normal)) or surrogate(key, kind, normal, 0)
        out += [text[last:start], dressed(kind, text[start:end], normal, fake)]
        last = end
    return "".join([*out, text[last:]]), [{"kind": f[2], "start": f[0], "end": f[1]} for f in found]


# -- over the corpus -------------------------------------------------------------------------------

def mentions(docs: DataFrame, text: str) -> DataFrame:
    """``mark, kind, normal, form``: the distinct entities of every text; ``mark`` is a hash of the text, ``form`` a
    written form. Equal texts hold equal entities, so neither ids nor their repetition matter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, body in enumerate(batch.column(1).to_pylist()):
                if body:
                    seen = {(kind, normal): body[a:b] for a, b, kind, normal in reversed(detect(body))}
                    rows += [(k, *entity, form) for entity, form in seen.items()]
            at, kind, normal, form = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.string()) for c in (kind, normal, form))],
                names=["mark", "kind", "normal", "form"])

    return docs.select(F.xxhash64(text).alias("mark"), F.col(text).alias("source")).mapInArrow(
        run, "mark long, kind string, normal string, form string")


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, normal, attempt, fake``: the replacement's normal form, which written forms have no part in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, normals, attempts = (c.to_pylist() for c in batch.columns)
            fakes = [surrogate(key, k, n, a) for k, n, a in zip(kinds, normals, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fakes, pa.string())], names=["kind", "normal", "attempt", "fake"])

    return entities.select("kind", "normal", "attempt").mapInArrow(run, "kind string, normal string, attempt int, fake string")


def _shaped(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, normal, shape, turn``: ``turn`` is a keyed order of the entities of one shape."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, normals = (c.to_pylist() for c in batch.columns)
            shapes = [shape(k, n) for k, n in zip(kinds, normals)]
            turns = [hmac.new(key, f"turn|{k}|{n}".encode(), hashlib.sha256).hexdigest() for k, n in zip(kinds, normals)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shapes, pa.string()), pa.array(turns, pa.string())],
                                             names=["kind", "normal", "shape", "turn"])

    return entities.select("kind", "normal").mapInArrow(run, "kind string, normal string, shape string, turn string")


def _exchanged(entities: DataFrame, lost: DataFrame, key: bytes) -> DataFrame:
    """``kind, normal, attempt, fake`` of all entities whose shape is one of a lost entity's: each takes the value of
    its successor in the keyed order, the last one that of the first. No draw of another entity is an original, so
    these values are free."""
    full = _shaped(lost, key).select("shape").distinct()
    turns = saved(row_ids(_shaped(entities, key).join(full, "shape", "left_semi"), ["shape", "turn", "kind", "normal"], "place"))
    ends = turns.groupBy("shape").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    behind = turns.join(F.broadcast(ends), "shape").withColumn(      # shapes are bounded: lengths, country codes, masks
        "place", F.when(F.col("place") == F.col("last"), F.col("first")).otherwise(F.col("place") + 1))
    values = turns.select("place", F.col("normal").alias("fake"))
    return behind.join(values, "place").select("kind", "normal", F.lit(DRAWS).alias("attempt"), "fake")


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, normal, attempt, fake`` of the entities that did not keep their first draw.

    ``entities`` holds every entity once (``kind, normal``). Of entities with one draw in common the first by normal
    form keeps it. Settled draws stay settled, so the rounds end; what finds no value after ``DRAWS`` rounds, or in a
    round where hardly any does, takes part in an exchange of values (:func:`_exchanged`, with ``attempt`` = ``DRAWS``).
    """
    originals = entities.select("kind", F.col("normal").alias("fake"))
    family = F.split("kind", "/")[0]
    open_ = entities.withColumn("attempt", F.lit(0))
    settled, barren = None, 0
    for _ in range(DRAWS):
        drawn = saved(_drawn(open_, key))
        # a name must not meet a name of another gender or script either
        taken = originals.select(family.alias("family"), "fake")
        if settled is not None:
            taken = taken.unionByName(settled.select(family.alias("family"), "fake"))
        first = drawn.groupBy(family.alias("family"), "fake").agg(F.min(F.struct("normal", "kind")).alias("first"))
        good = first.join(taken.distinct(), ["family", "fake"], "left_anti")
        good = good.select("fake", F.col("first.normal").alias("normal"), F.col("first.kind").alias("kind"))
        won = saved(drawn.join(good, ["kind", "normal", "fake"], "left_semi"))
        settled = won if settled is None else settled.unionByName(won)
        found = won.count()
        left = drawn.count() - found
        if not left:
            return settled.filter("attempt > 0")
        open_ = (drawn.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti")
                 .select("kind", "normal", (F.col("attempt") + 1).alias("attempt")))
        barren = barren + 1 if not found else 0
        if barren == BARREN or left > MANY and found * FULL < left:
            # formats that grow are left alone; the others' draws stay within a full space
            growing = F.col("kind").isin("email", "ip") | F.col("kind").startswith("name/")
            stuck = saved(open_.filter(~growing))
            if not stuck.isEmpty():
                turned = saved(_exchanged(entities, stuck, key))
                settled = settled.join(turned, ["kind", "normal"], "left_anti").unionByName(turned)
                open_ = saved(open_.join(turned, ["kind", "normal"], "left_anti"))
                if open_.isEmpty():
                    return settled.filter("attempt > 0")
    turned = saved(_exchanged(entities, open_, key))
    return settled.join(turned, ["kind", "normal"], "left_anti").unionByName(turned).filter("attempt > 0")


def anonymised(docs: DataFrame, key_column: str = "doc_id", text: str = "text", key: bytes = KEY, report: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten and, if named, a column ``report`` of the entities found.

    Null texts stay null, others without entities stay as they are. Ids have no part in it: rows of any id, null too,
    are rewritten alike if their texts are. All columns stay. ``key_column`` is kept for callers and not read.
    """
    seen = saved(mentions(docs, text))
    entities = saved(seen.select("kind", "normal").distinct())
    again = redrawn(entities, key).select("kind", "normal", "fake")
    again = seen.select("mark", "kind", "normal").distinct().join(again, ["kind", "normal"])
    # at most the entities of one text in a list (of two, should their hashes meet)
    lookup = saved(again.groupBy("mark").agg(F.collect_list(F.struct("kind", "normal", "fake")).alias("again")))
    own, extra, found = (common.fresh(docs, c) for c in ("lookup_mark", "lookup", "found"))
    lookup = lookup.select(F.col("mark").alias(own), F.col("again").alias(extra))
    joined = docs.join(lookup, F.xxhash64(F.col(text)) == F.col(own), "left").drop(own)
    at = docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = [*docs.columns, report or found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            bodies, spans = [], []
            for body, draws in zip(columns[at].to_pylist(), columns[-1].to_pylist()):
                fakes = {(d["kind"], d["normal"]): d["fake"] for d in draws or ()}
                body, places = (body, []) if body is None else rewritten(body, key, fakes)
                bodies.append(body)
                spans.append(places)
            columns[at] = pa.array(bodies, pa.string())
            yield pa.RecordBatch.from_arrays([*columns[:-1], pa.array(spans, kind)], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = joined.mapInArrow(run, f"{kinds}, `{report or found}` array<struct<kind: string, start: bigint, end: bigint>>")
    return out if report else out.drop(found)


def replaced(docs: DataFrame) -> DataFrame:
    """Every document's rewritten text and the entities of the original.

    Empty table: no rows. Repeated rows: one result each, with the same surrogates.
    """
    out = anonymised(docs.select("doc_id", "text"), report="entities")
    return out.select("doc_id", "text", F.size("entities").alias("n_entities"), "entities")
