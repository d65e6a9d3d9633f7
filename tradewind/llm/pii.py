"""Surrogates for personal data: keyed, true to type and format, distinct and consistent over the corpus.

Detection finds e-mail addresses, telephone numbers, IPv4 addresses, long card or account numbers, social security numbers
and names of persons (a known given name or a title, then further known given names, initials and particles, and a
capitalised surname with its hyphens and apostrophes; a second surname after a space is not recognised).  A mention consists of parts,
and each part is an entity of its own: the host of an address beside the address, the national digits of a telephone number
without country code and leading zero, the given names, initials and surnames of a name.  So partial mentions follow full ones
("John Smith", "Mr. Smith"), and whatever stands between the parts stays: titles, particles, hyphens, signs, country codes.

A surrogate is drawn by a keyed hash: digits for digits, letters for letters; a given name becomes the next one of the same gender
and script in a keyed order, so that different ones stay different.  Proposals are checked against all entities of the
corpus and against one another, and who loses draws anew, with more letters after some attempts, until all are distinct.
Where the numbers of one kind and length fill more than a twentieth of what that many digits can say, all of them are mapped by a
keyed permutation instead; these stay distinct, but may be numbers of the corpus.  Every text is searched once; only texts with an entity move.

Defined cases: a null text stays null; repeated rows get equal texts; a null key column is an ordinary value; an
empty table gives no rows.  Long texts are searched whole.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import by_batch, stored

KEY = "replace-this-key"
# Given names by script and gender, titles by gender, surnames by script.
GIVEN = {
    ("latin", "f"): "Anna Maria Laura Julia Sophie Emma Claire Elena Lucia Carmen Alice Helen Nora Ruth Clara Ines".split(),
    ("latin", "m"): "John Peter Paul Thomas Martin Daniel David Lukas Pierre Carlos Diego Hans Felix Simon Mark Oscar".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Сергей Дмитрий Николай Андрей Михаил".split(),
}
SURNAMES = {
    "latin": "Miller Weber Moreau Garcia Novak Rossi Jensen Baker Fischer Laurent Romero Keller Hughes Lindberg Costa Meyer".split(),
    "cyrillic": "Орлов Соколов Лебедев Морозов Волков Зайцев Павлов Козлов".split(),
}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra".split(), "m": "Mr Herr Monsieur Señor Sr".split()}
_names = "|".join(name for names in GIVEN.values() for name in names)
_titles = "|".join(title for titles in TITLES.values() for title in titles)
# A surname may have a first letter with an apostrophe, hyphens and particles; initials and given names may stand before it.
_upper, _letter = "A-ZÀ-ÖØ-ÞА-ЯЁ", r"[^\W\d_]"
_word = rf"(?:[OoDdLl]['’](?=[{_upper}]))?[^\W\d_a-zа-яё]{_letter}+(?:['’](?!s\b){_letter}+)?(?:-{_letter}+(?:['’]{_letter}+)?)*"
_given = rf"(?:{_names})(?:-(?:{_names}))*(?![\w-])"
_particle = r"(?:van(?:\s+(?:de[nr]?|het))?|von(?:\s+der)?|de(?:\s+(?:la|las|los))?|da|do|dos|das|del|della|di|du|ten|ter|af|av|bin|ibn)"
_between = rf"(?:(?:{_given}|[{_upper}]\.?(?![\w'’]))\s+)*(?:{_particle}\s+)?"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
             r"|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])|(?<![\w.+-])0\d{1,4}[ -]\d{5,8}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "name": rf"(?<!\w)(?:(?:{_titles})\.?\s+{_between}{_word}|{_given}\s+{_between}{_word})(?!\w)",
}
PATTERNS["email"] = r"(?<![A-Za-z0-9._%+-])" + PATTERNS["email"]
MAIL, NAME = re.compile(PATTERNS["email"]), re.compile(PATTERNS["name"])
# Numbers are looked for only in runs of the signs that numbers are made of.
RUN = re.compile(r"[0-9+(][0-9 ().+-]{5,}")
NUMBER = re.compile("|".join(f"(?P<{kind}>{PATTERNS[kind]})" for kind in ("ssn", "ip", "phone", "card")), re.ASCII)
GENDER = {**{n: g for (_, g), names in GIVEN.items() for n in names}, **{t: g for g, ts in TITLES.items() for t in ts}}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CAPITALS = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"}
# Made-up surnames beyond the list are syllables.
SYLLABLES = {"latin": "bar den fel gar hol kin lan mor nes rin sel tor val wen dor mil".split(),
             "cyrillic": "бар ден гор кол лам мир нов рад сав тал вер дом зим лев".split()}
# Country codes of one and two digits; all others have three.
COUNTRY = {"1", "7", "20", "27", "28", *map(str, range(30, 35)), "36", "39", "40", "41", *map(str, range(43, 50)), *map(str, range(51, 59)),
           *map(str, range(60, 67)), "81", "82", "84", "86", *map(str, range(90, 96)), "98"}
DIGITS = ("phone", "card", "ssn")
DENSE = 20   # numbers that fill more than the DENSE-th part of their space are permuted
TOKEN, PART = re.compile(r"\S+"), re.compile(r"[^\s-]+")


def script_of(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def national(mention: str) -> int:
    """How many digits of a telephone number are country code or leading zeros."""
    digits = "".join(c for c in mention if c.isdigit())
    skip = next((n for n in (1, 2) if digits[:n] in COUNTRY), 3) if mention.startswith("+") else 0
    while skip < len(digits) - 4 and digits[skip] == "0":
        skip += 1
    return skip if len(digits) - skip >= 4 else 0


def canonical(kind: str, mention: str) -> str:
    """What all mentions of one entity share: digits, or lower-case text."""
    if kind in DIGITS:
        return "".join(c for c in mention if c.isdigit())[national(mention) if kind == "phone" else 0:]
    return mention.lower()


def parts(start: int, stop: int, kind: str, text: str) -> list[tuple[int, int, str, str]]:
    """The parts of a mention that are replaced: place in the text, kind and canonical form."""
    if kind != "name":
        return [(start, stop, kind, canonical(kind, text[start:stop]))]
    found, tokens = [], list(TOKEN.finditer(text, start, stop))
    for at, token in enumerate(tokens):
        word, last = token[0], at == len(tokens) - 1
        if word.rstrip(".") in TITLES["f"] + TITLES["m"] and not last or word[0].islower() and not last:
            continue
        for part in PART.finditer(text, token.start(), token.end()):
            own, begin = part[0], part.start()
            if not last:
                bare = own.rstrip(".")
                found.append((begin, begin + len(bare), "given" if bare in GENDER else "initial", bare))
                continue
            if len(own) > 3 and own[0] in "OoDdLl" and own[1] in "'’":
                own, begin = own[2:], begin + 2
            found.append((begin, part.end(), "family", f"{script_of(own)}:{own.lower()}"))
    return found


class Draw:
    """Keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: str, *what: object):
        self.seed, self.count, self.pool = (key.encode(), "\x1f".join(map(str, what)).encode()), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hmac.new(self.seed[0], self.seed[1] + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
            self.count += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n


def luhn(digits: str) -> int:
    return sum(int(d) if at % 2 == 0 else sum(divmod(2 * int(d), 10)) for at, d in enumerate(reversed(digits))) % 10


def alike(text: str, draw: Draw) -> str:
    """Digits for digits (a leading one not 0), letters for letters, the rest as it is."""
    return "".join(str(draw.below(10)) if c.isdigit() else LETTERS[draw.below(26)] if c.isalpha() else c for c in text)


def next_in(key: str, values: list[str] | str, value: str) -> str:
    """The value behind this one in a keyed round order, so that no two have the same and none has itself."""
    order = sorted(values, key=lambda v: hmac.new(key.encode(), v.encode(), hashlib.sha256).digest())
    return order[(order.index(value) + 1) % len(order)]


def permuted(key: str, kind: str, digits: str) -> str:
    """A keyed one-to-one image among the numbers of as many digits."""
    half = len(digits) // 2
    sizes, values = (10**half, 10 ** (len(digits) - half)), [int(digits[:half] or 0), int(digits[half:])]
    for turn in range(8):
        own, other = turn % 2, 1 - turn % 2
        draw = Draw(key, "permuted", kind, len(digits), turn, values[other])
        values[own] = (values[own] + (draw.below(1 << 31) << 31 | draw.below(1 << 31))) % sizes[own]
    return (str(values[0]).zfill(half) if half else "") + str(values[1]).zfill(len(digits) - half)


def surrogate(key: str, kind: str, entity: str, base: str, attempt: int) -> str:
    """Canonical form of the entity's replacement at this attempt; ``base`` is the surrogate of an address's host."""
    draw = Draw(key, kind, entity, attempt)
    more = "".join(LETTERS[draw.below(26)] for _ in range(attempt // 4))
    if kind == "email":
        return f"{alike(entity.split('@')[0], draw)}{more}@{base}"
    if kind == "host":
        return f"{alike(entity.split('.')[0], draw)}{more}.example.org"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "family":
        script = entity.split(":")[0]
        if attempt == 0:
            name = SURNAMES[script][draw.below(len(SURNAMES[script]))]
        else:
            name = "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(2 + attempt // 2))
        return f"{script}:{name.lower()}"
    made = [str(draw.below(10)) for _ in entity]
    if kind == "card":
        made[0] = entity[0]
        if luhn(entity) == 0:
            made[-1] = "0"
            made[-1] = str((10 - luhn("".join(made))) % 10)
    elif kind == "phone":
        made[0] = str(2 + int(made[0]) % 8)
    return "".join(made)


def written(key: str, kind: str, mention: str, found: str | None) -> str:
    """The surrogate in the format of the mention."""
    if kind in DIGITS:
        skip, digits, at = national(mention) if kind == "phone" else 0, iter(found), 0
        made = []
        for c in mention:
            at += c.isdigit()
            made.append(next(digits) if c.isdigit() and at > skip else c)
        return "".join(made)
    if kind == "given":
        gender = next(place for place, names in GIVEN.items() if mention in names)
        return next_in(key, GIVEN[gender], mention)
    if kind == "initial":
        letters = CAPITALS[script_of(mention)]
        return next_in(key, letters, mention) if mention in letters else mention
    if kind == "family":
        name = found.split(":")[1]
        return name.upper() if mention.isupper() and len(mention) > 1 else name.title()
    return found.upper() if mention.isupper() and any(c.isalpha() for c in mention) else found


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Spans in code points, kind and canonical form, in order and without overlap: of two that meet, the first."""
    met = [(m.start(), m.end(), m.lastgroup) for run in RUN.finditer(text)
           for m in NUMBER.finditer(text, run.start(), min(len(text), run.end() + 2))]
    if "@" in text:
        met += [(m.start(), m.end(), "email") for m in MAIL.finditer(text)]
    met += [(m.start(), m.end(), "name") for m in NAME.finditer(text)]
    found, free = [], 0
    for start, stop, kind in sorted(met, key=lambda x: (x[0], -x[1])):
        if start >= free:
            found.append((start, stop, kind, canonical(kind, text[start:stop])))
            free = stop
    return found


SPANS = "array<struct<start:int,stop:int,kind:string,entity:string,is_first:boolean>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("entity", pa.string()), ("is_first", pa.bool_())]))


def searched(docs: DataFrame) -> DataFrame:
    """``doc_id, text, version, spans``: every row with the parts of its entities."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = []
        for text in batch.column(1).to_pylist():
            own = [(part, at == 0) for start, stop, kind, _ in find(text or "") for at, part in enumerate(parts(start, stop, kind, text))]
            spans.append([dict(zip(("start", "stop", "kind", "entity", "is_first"), (*part, first))) for part, first in own])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _SPANS)], names=["doc_id", "text", "version", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return by_batch(rows.withColumn("version", F.xxhash64("text")), f"doc_id long, text string, version long, spans {SPANS}", work)


def dense_classes(entities: DataFrame) -> set[tuple[str, int]]:
    """Kinds and lengths whose numbers fill their space; there are as many rows as lengths of numbers."""
    sized = entities.where(F.col("kind").isin(*DIGITS)).groupBy("kind", F.length("entity").alias("digits")).count()
    return {(r.kind, r.digits) for r in sized.collect() if r["count"] * DENSE > 10**r.digits}


def resolve(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, surrogate`` of ``kind, entity, base``: distinct, and never an entity of the corpus (but for dense classes)."""
    dense = dense_classes(entities)

    def propose(attempt: int):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = list(zip(*[batch.column(c).to_pylist() for c in range(3)]))
            made = [permuted(key, k, e) if (k, len(e)) in dense else surrogate(key, k, e, b, attempt) for k, e, b in rows]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "base", "surrogate"])

        return work

    schema = "kind string, entity string, base string"
    is_dense = lambda: reduce(or_, [(F.col("kind") == k) & (F.length("entity") == n) for k, n in dense], F.lit(False))
    done = [stored(by_batch(entities.where(is_dense()).select("kind", "entity", "base"), schema + ", surrogate string", propose(0)).drop("base"), "pii-dense")]
    known = lambda: reduce(DataFrame.unionByName, done).select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
    real = entities.select(F.col("kind").alias("k"), F.col("entity").alias("s"))
    waiting, attempt = entities.where(~is_dense()).select("kind", "entity", "base"), 0
    while True:
        drawn = stored(by_batch(waiting, schema + ", surrogate string", propose(attempt)), "pii-drawn")
        best = drawn.groupBy(F.col("kind").alias("k"), F.col("surrogate").alias("s")).agg(F.min("entity").alias("first"))
        free = best.join(real, ["k", "s"], "left_anti").join(known(), ["k", "s"], "left_anti")
        won = stored(free.select(F.col("k").alias("kind"), F.col("first").alias("entity"), F.col("s").alias("surrogate")), "pii-won")
        done.append(won)
        waiting = stored(drawn.select("kind", "entity", "base").join(won, ["kind", "entity"], "left_anti"), "pii-waiting")
        if waiting.isEmpty():
            return reduce(DataFrame.unionByName, done)
        attempt += 1


def resolved(flat: DataFrame, key: str) -> DataFrame:
    """Surrogates of all entities; those of hosts first, as addresses are made of them."""
    entities = stored(flat.where(~F.col("kind").isin("given", "initial")).select("kind", "entity").distinct(), "pii-entities")
    host = F.substring_index("entity", "@", -1)
    mails = entities.where("kind = 'email'").withColumn("host", host)
    hosts = mails.select(F.lit("host").alias("kind"), F.col("host").alias("entity")).distinct()
    first = resolve(stored(entities.where("kind <> 'email'").unionByName(hosts).withColumn("base", F.lit("")), "pii-first"), key)
    bases = first.where("kind = 'host'").select(F.col("entity").alias("host"), F.col("surrogate").alias("base"))
    second = resolve(stored(mails.join(bases, "host").select("kind", "entity", "base"), "pii-mails"), key)
    return first.where("kind <> 'host'").unionByName(second)


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``doc_id, text, n_entities``: every row with its entities replaced."""
    rows = stored(searched(docs), "pii-searched")
    hit = rows.where(F.size("spans") > 0)
    flat = hit.dropDuplicates(["doc_id", "version"]).select("doc_id", "version", F.explode("spans").alias("s")).select("doc_id", "version", "s.*")
    flat = stored(flat, "pii-flat")
    own = F.col("kind").isin("given", "initial")   # these need no table
    steps = flat.where(~own).join(resolved(flat, key), ["kind", "entity"]).select("doc_id", "version", "start", "stop", "kind", "is_first", "surrogate")
    steps = steps.unionByName(flat.where(own).select("doc_id", "version", "start", "stop", "kind", "is_first", F.lit(None).cast("string").alias("surrogate")))
    plans = steps.groupBy(F.col("doc_id").alias("of"), F.col("version").alias("of_version")).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "surrogate", "is_first"))).alias("plan"))
    planned = hit.drop("spans").join(plans, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, counts = [], []
        for text, plan in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            made, at = [], 0
            for step in plan:
                made += [text[at: step["start"]], written(key, step["kind"], text[step["start"]: step["stop"]], step["surrogate"])]
                at = step["stop"]
            out.append("".join(made) + text[at:])
            counts.append(sum(step["is_first"] for step in plan))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(counts, pa.int64())], names=["doc_id", "text", "n_entities"])

    changed = by_batch(planned.select("doc_id", "text", "plan"), "doc_id long, text string, n_entities long", work)
    return rows.where(F.size("spans") == 0).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities")).unionByName(changed)
