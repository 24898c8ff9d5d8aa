"""Surrogates for personal data: keyed, type-consistent replacements that keep gender, script and format.

Every character stays in its class (digit, vowel, consonant, accented or not, case, script), and a keyed permutation of
all strings of one pattern picks the replacement: the same entity always gets the same surrogate, different ones get
different ones.  A person's given and family names are entities of their own, so that `Maria Weber`, `Weber` and `MARIA`
stay one person; family names that the corpus itself teaches are found without a given name too.  Given names of the gazetteer are permuted without fixed points within the list of their script and
gender; lists are short, so these surrogates may be names that occur.  Over the whole corpus, all other surrogates that
coincide with an entity that really occurs, or with each other, are drawn again until all are distinct.

Where few surrogates of a pattern are free, drawing again would not end.  Family names and e-mails then get invented words
that grow with every attempt, and IP addresses all their octets; numbers of one pattern that fill more than a quarter of it
are permuted without fixed points instead, so that they stay distinct and none stays itself, but some may occur.  After
MAX_ROUNDS rounds, which no corpus is expected to need, an error is raised.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.decontaminate import MAP_BITS, bit_map
from lexforge.llm.staging import staged, unstage
from lexforge.llm.texts import map_batches, strings

#: Given names by script and gender, for detection and replacement, where a caller has no larger lists.
NAMES = {
    ("latin", "f"): "Alice Anna Barbara Camille Carla Carmen Charlotte Claire Claudia Elena Elisabeth Emily Emma Eva Françoise Grace Hannah Heike Helen Ingrid Isabel Jane Julia Karin Laura Lucia Margaret Maria Marie Martha Mary Monika Nora Olivia Petra Rosa Sabine Sarah Sophie Susan".split(),
    ("latin", "m"): "Albert Andreas Antonio Carlos Charles Daniel David Felix Fernando François Frank George Günter Hans Henry Jacques James Jean John José Jürgen Klaus Louis Luis Martin Michael Miguel Otto Paul Pedro Peter Pierre Richard Robert Stefan Thomas Walter Wilhelm William Wolfgang".split(),
    ("greek", "f"): "Άννα Βασιλική Ελένη Ειρήνη Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Ιωάννης Κώστας Νίκος Πέτρος Σπύρος".split(),
    ("cyrillic", "f"): "Анна Екатерина Елена Ирина Мария Наталья Ольга Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Владимир Дмитрий Иван Николай Сергей".split(),
}
#: Forms of address, after which a name stands.
TITLES = frozenset("mr mrs ms miss mister dr prof professor herr frau monsieur madame mademoiselle mme mlle señor señora señorita sr sra don doña κύριος κυρία κύριε господин госпожа".split())
#: Small words inside of family names.
PARTICLES = ("von", "van", "der", "den", "de", "del", "della", "di", "du", "la", "le", "dos", "da")
#: Letters that replace each other.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "αειουωη", "βγδζθκλμνξπρστφχψ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "áàâäãåéèêëíìîïóòôöõúùûü", "çñčćłńśšźžż", "άέήίόύώ")
_CLASS = {c: k for k, cs in enumerate(CLASSES) for c in cs}
#: Attempts within the pattern of an entity, after which names, e-mails and IP addresses get a wider space.
WIDE, MAX_ROUNDS = 16, 256
KINDS = ("email", "phone", "card", "ip", "ssn", "name")
_NUMBER = re.compile(
    r"(?P<ip>(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\w|\.\d))"
    r"|(?P<phone>(?<![\w.+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![\w-])|(?<!\w)\(\d{3}\) ?\d{3}[-.]\d{4}(?!\w)|(?<![\w-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])[3-6](?:\d{12,18}|\d{3}(?:[ -]\d{4}){3})(?![\w-]))"
)
# what every number above lies in, but for its first sign; begins with a set of characters, which the search jumps to
_DIGITS = re.compile(r"[0-9][0-9 ().\-]{5,}[0-9]")
_START = re.compile(r"[+(]|(?<![0-9])[0-9]")
_LOCAL = re.compile(r"\w[\w.+-]*\Z")
_DOMAIN = re.compile(r"\w[\w-]*(?:\.\w[\w-]*)*\.[^\W\d_]{2,}(?!\w)")
_WORD = r"[^\W\d_a-zß-öø-ÿά-ώа-я](?:['’](?=[^\W\d_]))?(?:[^\W\d_]|-(?=[^\W\d_]))+"
_CAPITALISED = re.compile(_WORD)
# the same words in any case
_ANY = re.compile(r"[^\W\d_](?:['’](?=[^\W\d_]))?(?:[^\W\d_]|-(?=[^\W\d_]))*")
# begins with a set of characters, which the search jumps to; other capitals don't begin names that are looked for
_CAPITAL = re.compile("[A-ZÀ-ÖØ-ÞΆ-ΫА-Я][^\\W\\d_]+")
_FAMILY = re.compile(rf" (?:(?:{'|'.join(PARTICLES)}) ){{0,2}}({_WORD})")
_TITLED = re.compile(rf"\.?(?: [^\W\d_]\.)* ({_WORD})")
# further given names and initials, before a family name
_NEXT = re.compile(rf"((?: [^\W\d_]\.)*) ({_WORD})")


class Gazetteer:
    """Given names by their small letters: list, and place in it.  A name counts in its first list; lists of one name are left out."""

    def __init__(self, names: dict[tuple[str, str], list[str]]):
        seen: set[str] = set()
        self.names: dict[tuple[str, str], list[str]] = {}
        for k, ns in names.items():
            own = [n for n in dict.fromkeys(x.lower() for x in ns) if n not in seen]
            if len(own) > 1:
                self.names[k] = own
                seen.update(own)
        self.who = {n: (k, i) for k, ns in self.names.items() for i, n in enumerate(ns)}


DEFAULT = Gazetteer(NAMES)


def _draw(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of 0..size-1 (Feistel network on two mixed-radix halves, walked along its cycle), or its inverse."""
    if size < 2:
        return value
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    f = lambda k, x: int.from_bytes(hashlib.blake2b(x.to_bytes(64, "little"), key=key, person=bytes([k]), salt=tweak[:16]).digest()[:32], "little")
    while True:
        left, right = divmod(value, b)
        for k in reversed(range(4)) if back else range(4):
            if back:
                right = (right - f(2 * k + 1, left)) % b
                left = (left - f(2 * k, right)) % a
            else:
                left = (left + f(2 * k, right)) % a
                right = (right + f(2 * k + 1, left)) % b
        value = left * b + right
        if value < size:
            return value


def _moved(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of 0..size-1 without fixed points: one cycle through all values."""
    return _draw((_draw(value, size, key, tweak) + 1) % size, size, key, tweak, back=True)


def _foreign(text: str) -> bool:
    """Whether most letters and digits have no class, so that drawing within classes would leave them as they are."""
    return 2 * sum(c in _CLASS for c in text.lower()) < sum(c.isalnum() for c in text)


class Surrogates:
    """Replacements under one secret key."""

    def __init__(self, key: bytes, names: Gazetteer = DEFAULT):
        self.key, self.names = hashlib.blake2b(key).digest(), names

    def _pattern(self, text: str, kind: str, attempt: int, fixed: int = 0) -> str:
        """Characters after the first ``fixed`` ones, each drawn within its class."""
        low = text.lower() if len(text.lower()) == len(text) else text
        places = [(i, _CLASS[c]) for i, c in enumerate(low) if i >= fixed and c in _CLASS]
        out, tweak = list(text), hashlib.blake2b(f"{kind}|{attempt}|{''.join(str(k) for _, k in places)}".encode()).digest()
        for at in range(0, len(places), 48):  # 48 characters at a time fit a half
            part = places[at : at + 48]
            value, size = 0, 1
            for i, k in part:
                value = value * len(CLASSES[k]) + CLASSES[k].index(low[i])
                size *= len(CLASSES[k])
            value = (_moved if attempt < 0 else _draw)(value, size, self.key, tweak)
            for i, k in reversed(part):
                value, digit = divmod(value, len(CLASSES[k]))
                c = CLASSES[k][digit]
                out[i] = c.upper() if text[i] != low[i] and len(c.upper()) == 1 else c
        return "".join(out)

    def _word(self, text: str, attempt: int, vowels: str = CLASSES[1], consonants: str = CLASSES[2]) -> str:
        """An invented word, longer with every attempt after WIDE."""
        value, out = int.from_bytes(hashlib.blake2b(f"word|{attempt}|{text}".encode("utf-8", "surrogatepass"), key=self.key).digest(), "little"), ""
        for _ in range(4 + max(0, attempt - WIDE)):
            value, c = divmod(value, len(consonants))
            value, v = divmod(value, len(vowels))
            out += consonants[c] + vowels[v]
        return out

    def of(self, kind: str, text: str, attempt: int = 0) -> str:
        """The surrogate of an entity; further attempts give others.  Attempt -1, of numbers only: never itself, and distinct for all of one ``pattern``."""
        if kind == "email":
            head, _, top = text.rpartition(".")
            if attempt >= WIDE or _foreign(head):
                return f"{self._word(text, attempt)}@{self._word('@' + text, attempt)}.{top}"
            return f"{self._pattern(head, kind, attempt)}.{top}"
        if kind == "ip":
            octets = [int(x) for x in text.split(".")]
            free = [k for k, x in enumerate(octets) if 0 < x < 255]
            value = 0
            if attempt < 0 or attempt >= WIDE or not free:
                value = int.from_bytes(bytes(octets))
                return ".".join(map(str, (_moved if attempt < 0 else _draw)(value, 1 << 32, self.key, hashlib.blake2b(f"ip|{attempt}".encode()).digest()).to_bytes(4)))
            for k in free:
                value = value * 254 + octets[k] - 1
            value = _draw(value, 254 ** len(free), self.key, hashlib.blake2b(f"ip|{attempt}|{free}".encode()).digest())
            for k in reversed(free):
                value, octets[k] = value // 254, value % 254 + 1
            return ".".join(map(str, octets))
        if kind == "phone":
            code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
            return self._pattern(text, kind, attempt, code.end() if code else 0)
        if kind == "card":
            new = self._pattern(text[:-1], kind, attempt, 1)
            shift = (int(text[-1]) - _check_digit(text[:-1])) % 10
            return new + str((_check_digit(new) + shift) % 10)
        if kind == "given" and (at := self.names.who.get(text)):
            who, place = at
            return self.names.names[who][_moved(place, len(self.names.names[who]), self.key, repr(who).encode().ljust(16))]
        if kind in ("given", "family") and (attempt >= WIDE or _foreign(text)):
            script = next((k for k, cs in ((3, "αβγδεζηθικλμνξοπρστυφχψω"), (5, "абвгдежзиклмнопрстуфхцчшщ")) if any(c in cs for c in text)), 1)
            return self._word(text, attempt, CLASSES[script], CLASSES[script + 1])
        return self._pattern(text, kind, attempt)


def pattern(kind: str, text: str) -> tuple[str | None, int]:
    """The pattern that the surrogates of a number keep, and a quarter of the count of its numbers; (None, 0) for kinds whose space can grow."""
    if kind == "ip":
        return ("ip", 1 << 30) if text == ".".join(str(int(x)) for x in text.split(".")) else (None, 0)
    if kind not in ("phone", "card", "ssn"):
        return None, 0
    fixed, end, mark = 0, len(text), ""
    if kind == "phone" and (code := re.match(r"\+\d{1,3}(?=[ .(-])", text)):
        fixed = code.end()
    if kind == "card":
        fixed, end, mark = 1, len(text) - 1, f"|{(int(text[-1]) - _check_digit(text[:-1])) % 10}"
    body = text[fixed:end]
    return text[:fixed] + re.sub("[0-9]", "0", body) + mark, min(1 << 62, 10 ** len(re.findall("[0-9]", body)) // 4)


def _check_digit(text: str) -> int:
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return -sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    upto = 0
    for run in _DIGITS.finditer(text):
        for p in _START.finditer(text, max(0, run.start() - 2), run.end()):
            if p.start() >= upto and (m := _NUMBER.match(text, p.start())):
                yield m.start(), m.end(), m.lastgroup
                upto = m.end()


def _mails(text: str) -> Iterator[tuple[int, int, str]]:
    at = text.find("@")
    while at >= 0:
        a = at
        while a and (text[a - 1].isalnum() or text[a - 1] in "_.+-"):
            a -= 1
        local, domain = _LOCAL.search(text, a, at), _DOMAIN.match(text, at + 1)
        if local and domain:
            yield local.start(), domain.end(), "email"
        at = text.find("@", at + 1)


def _bounded(text: str, a: int, b: int) -> bool:
    """Whether text[a:b] is not part of a longer word."""
    return not (a and (text[a - 1].isalnum() or text[a - 1] == "_")) and not (text[b : b + 1].isalnum() or text[b : b + 1] == "_")


Part = tuple[int, int, str, str]


def _people(text: str, names: Gazetteer, families: Collection[str] = ()) -> Iterator[tuple[int, int, list[Part]]]:
    """Mentions of people, as (start, end, kind, value) of the parts to be replaced; values have small letters.

    One or more given names of the gazetteer, with initials between them, and a family name if one follows; a name after a
    form of address, where a given name may have one that the gazetteer doesn't know behind it; and other mentions of
    family names that the text gives so, or that stand in ``families``.
    """
    part = lambda kind, a, b: (a, b, kind, text[a:b].lower())
    found: list[list[Part]] = []

    def named(parts: list[Part], unknown: bool) -> list[Part]:
        """``parts``, which end in a given name, and what belongs to the same person after them."""
        while m := _NEXT.match(text, parts[-1][1]):
            more = _FAMILY.match(text, m.end()) if unknown else None
            if m.group(2).lower() in names.who or (more and not m.group(1)):
                parts.append(part("given", *m.span(2)))
                unknown = False
            elif m.group(1):
                return [*parts, part("family", *m.span(2))]
            else:
                break
        family = _FAMILY.match(text, parts[-1][1])
        return [*parts, part("family", *family.span(1))] if family else parts

    upto = 0
    capitals = [m.span() for m in _CAPITAL.finditer(text) if _bounded(text, *m.span())]
    for a, b in capitals:
        if a < upto:
            continue
        word = text[a:b].lower()
        if word in names.who:
            parts = named([part("given", a, b)], False)
        elif word in TITLES and (first := _TITLED.match(text, b)) and first.group(1).lower() not in TITLES:
            one = first.span(1)
            if text[slice(*one)].lower() in names.who:
                parts = named([part("given", *one)], True)
            else:
                second = _FAMILY.match(text, one[1])
                parts = [part("given", *one), part("family", *second.span(1))] if second else [part("family", *one)]
        else:
            continue
        found.append(parts)
        upto = parts[-1][1]
    known = ({p[3] for parts in found for p in parts if p[2] == "family"} | set(families)) - names.who.keys()
    taken = {p[0] for parts in found for p in parts}
    if known:
        found += [[part("family", a, b)] for m in re.finditer(_WORD, text) for a, b in [m.span()] if a not in taken and text[a:b].lower() in known and _bounded(text, a, b)]
    for parts in found:
        yield parts[0][0], parts[-1][1], parts


def _mentions(text: str, names: Gazetteer = DEFAULT, families: Collection[str] = ()) -> list[tuple[int, int, str, list[Part]]]:
    """Start, end, kind and parts of the entities of a text, from left to right; of two that overlap, the one that begins first, then the longer."""
    plain = [(a, b, kind, [(a, b, kind, text[a:b])]) for a, b, kind in (*_mails(text), *_numbers(text))]
    out: list[tuple[int, int, str, list[Part]]] = []
    for m in sorted([*plain, *((a, b, "name", parts) for a, b, parts in _people(text, names, families))], key=lambda x: (x[0], -x[1])):
        if not out or m[0] >= out[-1][1]:
            out.append(m)
    return out


def entities(text: str, names: Gazetteer = DEFAULT) -> list[tuple[int, int, str]]:
    """Start, end and kind of the entities of a text."""
    return [m[:3] for m in _mentions(text, names)]


def parts_of(text: str, names: Gazetteer = DEFAULT, families: Collection[str] = ()) -> set[tuple[str, str]]:
    """Kind and value of all that is replaced in a text."""
    return {p[2:] for m in _mentions(text, names, families) for p in m[3]}


def _led(text: str, names: Gazetteer) -> set[tuple[str, str]]:
    """Family names that follow a given name or a form of address, each with the word before it."""
    out = set()
    for a, _, parts in _people(text, names):
        if parts[-1][2] == "family" and (before := text[: parts[-1][0]].split()[-1:] if len(parts) == 1 else [parts[-2][3]]):
            cue = before[0].lower().rstrip(".")
            if len(parts) > 1 or cue in TITLES:
                out.add((parts[-1][3], cue))
    return out


def family_names(df: DataFrame, text_col: str = "text", names: dict[tuple[str, str], list[str]] | None = None, least: int = 3, share: float = 0.5) -> DataFrame:
    """Rows (value, n_docs, n_led, n_cues) of the family names that the texts of ``df`` teach, in small letters.

    A word is one if in ``least`` documents, and in ``share`` of all documents that have it in any case, it follows a given
    name of the gazetteer or a form of address, and it follows two different ones somewhere: common words that come behind
    a name by chance, and those of one often copied text, are none.  Each row counts as a document; null and empty texts
    have no words, an empty table teaches nothing.  Documents are counted for words that pass the other tests, which a bit
    map of fixed size tells; counts are added up in the tasks before they are shuffled.
    """
    book, texts = Gazetteer(names) if names else DEFAULT, df.select(F.col(text_col).cast("string").alias("text"))

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            for t in filter(None, strings(batch.column(0))):
                found = _led(t, book)
                counts.update(found)
                counts.update((w, "") for w in {w for w, _ in found})
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in counts], pa.string()) for c in (0, 1)] + [pa.array(counts.values(), pa.int64())], names=["value", "cue", "n"])

    cued = map_batches(texts, led, "value string, cue string, n bigint").groupBy("value", "cue").agg(F.sum("n").alias("n"))
    sums = cued.groupBy("value").agg(F.sum(F.when(F.col("cue") == "", F.col("n"))).alias("n_led"), F.count(F.when(F.col("cue") != "", 1)).alias("n_cues"))
    candidates = staged(sums.filter((F.col("n_cues") > 1) & (F.col("n_led") >= least) & ~F.col("value").isin(*TITLES)), "candidates")
    bits = df.sparkSession.sparkContext.broadcast(np.packbits(bit_map(candidates.select(F.xxhash64("value").alias("fp")))))

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            counts = Counter(w for t in (strings(batch.column(0)) if some.any() else ()) for w in _mapped(_ANY.findall(t), some))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["value", "n"])

    docs = map_batches(texts, having, "value string, n bigint").groupBy("value").agg(F.sum("n").alias("n_docs"))
    return candidates.join(docs, "value").filter(F.col("n_led") >= share * F.col("n_docs")).select("value", "n_docs", "n_led", "n_cues")


def _mapped(words: list[str], some: np.ndarray) -> set[str]:
    """Different words in small letters whose hashes stand in a bit map."""
    return {w for w in {x.lower() for x in set(words)} if some[xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42) >> (64 - MAP_BITS)]}


def _with_families(docs: DataFrame, families: DataFrame | None) -> DataFrame:
    """``docs`` (doc_id, text) with ``known``, the words of each text that stand in the table ``families``.

    The table is joined, whatever its size; a bit map of fixed size keeps other words out of the shuffle.
    """
    if families is None:
        return docs.withColumn("known", F.lit(None).cast("array<string>"))
    families = staged(families.select("value").filter("value is not null").distinct(), "families")
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(bit_map(families.select(F.xxhash64("value").alias("fp")))))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            rows = []
            whole = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2)), strict=True)
            for i, h, t in whole if some.any() else ():
                rows += [(i, h, w) for w in _mapped(_CAPITALISED.findall(t), some)]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["id", "same", "value"])

    hashed = docs.withColumn("hash", F.xxhash64("text"))
    holds = map_batches(hashed.select("doc_id", "hash", "text"), held, "id bigint, same bigint, value string").distinct().join(families, "value")
    known = staged(holds.groupBy("id", "same").agg(F.array_sort(F.collect_list("value")).alias("known")), "known")
    return hashed.join(known, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("same")), "left").select("doc_id", "text", "known")


def _cased(new: str, old: str) -> str:
    """A name in small letters in the case of the one that it replaces."""
    if old.isupper() and len(old) > 1:
        return new.upper()
    if len(new) == len(old):
        return "".join(c.upper() if o.isupper() else c for c, o in zip(new, old, strict=True))
    return new.capitalize()


def rewritten(text: str, names: Gazetteer, drawn: Callable[[str, str], str], families: Collection[str] = ()) -> tuple[str, list[str]]:
    """A text with ``drawn(kind, value)`` in place of every entity, and the kinds of its entities."""
    out, at, kinds = [], 0, []
    for _, _, kind, parts in _mentions(text, names, families):
        for a, b, what, value in parts:
            new = drawn(what, value)
            out += [text[at:a], _cased(new, text[a:b]) if kind == "name" else new]
            at = b
        kinds.append(kind)
    return "".join([*out, text[at:]]), kinds


def _clashes(drawn: DataFrame, known: DataFrame) -> DataFrame:
    """Of (kind, value, surrogate, attempt) those to draw again: the surrogate really occurs, or another entity has it.

    Given and family names count as one kind here.  Of several entities with one surrogate, the one of the fewest
    attempts, then the first by value and kind, keeps it.  Attempt -1 is of permutations that may give what occurs.
    """
    space = F.when(F.col("kind").isin("given", "family"), "name").otherwise(F.col("kind")).alias("space")
    drawn, known = drawn.select("*", space), known.select(space, "value").distinct()
    n = int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("attempt", "value", "kind")).alias("first"))
    real = known.select("space", F.col("value").alias("surrogate"), F.lit(True).alias("real")).repartition(n, "space", "surrogate")
    both = drawn.join(first, ["space", "surrogate"]).join(real, ["space", "surrogate"], "left")
    return both.filter((F.col("real") & (F.col("attempt") >= 0)) | (F.col("first.value") != F.col("value")) | (F.col("first.kind") != F.col("kind"))).select("kind", "value", "attempt")


_DRAWN = "kind string, value string, surrogate string, attempt int"


def replace_entities(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", names: dict[tuple[str, str], list[str]] | None = None, families: DataFrame | None = None) -> DataFrame:
    """One row (doc_id, n_entities, n_email, n_phone, n_card, n_ip, n_ssn, n_name, text) for each row of ``df``.

    ``text`` has a surrogate in place of every entity.  ``names``: given names by (script, gender), in lists of two at
    least; they travel with the code of the tasks, so they should stay under some 100,000.  A name in two lists belongs to
    the first.  ``families``: a table (value) of family names in small letters, of any size, such as ``family_names``
    gives; capitalised words that stand in it are people wherever they occur.  A null text stays null, an empty one empty, with no entities; repeated rows give repeated results, an
    empty table an empty one; other columns are not read.
    """
    book = Gazetteer(names) if names else DEFAULT

    def first_draw(kind: str, value: str) -> int:
        return -1 if kind == "given" and value in book.who else 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key, book)
        for batch in batches:
            rows = sorted(set().union(*(parts_of(t, book, w or ()) for t, w in zip(strings(batch.column(1)), batch.column(2).to_pylist(), strict=True))))
            shapes = [pattern(k, v) for k, v in rows]
            columns = [[k for k, _ in rows], [v for _, v in rows], [s.of(k, v) for k, v in rows], [first_draw(k, v) for k, v in rows], [x[0] for x in shapes], [x[1] for x in shapes]]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "value", "surrogate", "attempt", "pattern", "most"])

    def drawing(attempt: Callable[[int], int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = Surrogates(key, book)
            for batch in batches:
                rows = batch.to_pylist()
                tries = [attempt(r["attempt"]) for r in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.of(r["kind"], r["value"], n) for r, n in zip(rows, tries, strict=True)], pa.string()), pa.array(tries, pa.int32())], names=["kind", "value", "surrogate", "attempt"])

        return run

    docs = _with_families(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), families)
    shaped = staged(map_batches(docs, scan, f"{_DRAWN}, pattern string, most bigint").distinct(), "entities")
    drawn = shaped.select("kind", "value", "surrogate", "attempt")
    full = staged(shaped.filter("pattern is not null").groupBy("kind", "pattern").agg(F.count("*").alias("n"), F.max("most").alias("most")).filter("n > most").select("kind", "pattern"), "full")
    if not full.isEmpty():
        no = shaped.join(full, ["kind", "pattern"], "left_anti").select("kind", "value", "surrogate", "attempt")
        new = map_batches(shaped.join(full, ["kind", "pattern"], "left_semi").select("kind", "value", "attempt"), drawing(lambda _: -1), _DRAWN)
        drawn = staged(no.unionByName(new), "entities")
    known = shaped.select("kind", "value")
    for _ in range(MAX_ROUNDS):
        clash = staged(_clashes(drawn, known), "clashes")
        if clash.isEmpty():
            break
        new = map_batches(clash, drawing(lambda n: n + 1), _DRAWN)
        before = drawn
        drawn = staged(drawn.join(clash.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(new), "entities")
        unstage(clash)
        if hasattr(before, "_staged_at"):
            unstage(before)
    else:
        raise RuntimeError("no free surrogates were found")
    redrawn = drawn.join(shaped.select("kind", "value", F.col("attempt").alias("first")), ["kind", "value"]).filter("attempt != first").select("kind", "value", "surrogate")
    columns = "doc_id bigint, n_entities bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", text string"
    # entities drawn again are few, but without a bound: they travel with the documents that hold them
    if redrawn.isEmpty():
        docs = docs.withColumn("other", F.lit(None).cast("array<struct<kind:string,value:string,surrogate:string>>"))
    else:
        docs = docs.withColumn("hash", F.xxhash64("text"))

        def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2)), batch.column(3).to_pylist(), strict=True)
                rows = [(i, h, k, v) for i, h, t, w in whole for k, v in parts_of(t, book, w or ())]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["id", "same", "kind", "value"])

        holds = map_batches(docs.select("doc_id", "hash", "text", "known"), held, "id bigint, same bigint, kind string, value string").distinct().join(redrawn, ["kind", "value"])
        others = holds.groupBy("id", "same").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("other"))
        docs = docs.join(others, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("same")), "left")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key, book)
        usual = lru_cache(maxsize=1 << 16)(s.of)
        for batch in batches:
            got = []
            for t, others, w in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                other = {(o["kind"], o["value"]): o["surrogate"] for o in others or ()}
                got.append((None, []) if t is None else rewritten(t, book, lambda k, v, other=other: other.get((k, v)) or usual(k, v), w or ()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(g[1]) for g in got], pa.int64()), *[pa.array([g[1].count(k) for g in got], pa.int64()) for k in KINDS], pa.array([g[0] for g in got], pa.string())], names=[c.split()[0] for c in columns.split(", ")])

    return map_batches(docs.select("doc_id", "text", "other", "known"), rewrite, columns)
