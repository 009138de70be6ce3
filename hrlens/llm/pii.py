"""Personal data replaced by surrogates: keyed, of the same type, gender, script and format.

Detected are e-mail addresses, IP addresses, phone numbers (3-3-4 digits, 10 digits by the rules of area and exchange
codes, international ones from "+" on), payment cards (with a valid check digit), social security numbers, IBANs (valid
check digits, in one run or in groups of four) and person names (after a form of address, or a known given name with the
capitalised word after it).  A name's parts are entities of their own: given names by gender, and surnames; so
"Ms Smith" and "Jane Smith" keep referring to one person.  A second pass over the document takes every other whole-word
mention of the parts found, in any letter case, for the same entity; articles, particles and the like (``NO_MENTION``)
are left out of it.

A surrogate comes from a keyed permutation of all values with the entity's format (digits to digits, vowels to vowels,
consonants to consonants, of the same script; listed given names among those of their gender and script; check digits
made right).  A permutation keeps different values different.  What it cannot exclude is checked over the whole
corpus: no two entities of a type may share a surrogate, and none may get a value that really occurs.  Entities in
conflict take the next permutation until no conflict is left.  The same entity gets the same surrogate everywhere.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, body, bound_batches

KEY = b"surrogates-1"
MAX_ATTEMPTS = 20

# Given names by script and gender, and forms of address with the gender they tell.
GIVEN = {
    ("latin", "f"): "Alice Anna Carla Carmen Claire Elena Emma Eva Frieda Helen Ingrid Jane Julia Laura Lucia Maria Marie Mary Paula Sarah Sofia Susan".split(),
    ("latin", "m"): "Adam Alan Bruno Carlos Daniel David Emil Felix Hans Henri Jack James John Juan Karl Louis Luis Mark Martin Paul Peter Robert Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Татьяна".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Дмитрий Иван Игорь Николай Олег Павел Сергей".split(),
}
ADDRESS = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
           "Monsieur": "m", "Madame": "f", "Dr": "", "Prof": ""}
#: Words that may stand in a name's place and are ordinary words elsewhere.
NO_MENTION = frozenset("a an and at by de del den der di do dos du el et for he her his i in is it la las le les lo los of on or she that the they to van "
                       "von was we who with y you und die das был и в на не".split())
#: Country calling codes of one and two digits; all others have three.
CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "çñß", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "ъьё",
             "αεηιουω", "βγδζθκλμνξπρστφχψ"]
_CLASS = {c: a for a in ALPHABETS for c in a}
_BY_NAME = {n.lower(): (n, g, s) for (s, g), names in GIVEN.items() for n in names}

_DIGITS = re.compile(r"\d")
_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64}@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![\w@-])")
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])")
_PLAIN_PHONE = re.compile(r"(?<![\w.+-])[2-9]\d{2}[2-9]\d{6}(?![\w-]|\.\d)")
_FAR_PHONE = re.compile(r"(?<![\w+])\+[1-9](?:[ ./()-]{0,2}\d){6,14}(?!\w)")  # 7 to 15 digits
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)")
_IBAN_GROUPS = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,3})?(?!\w)")
_WORD = re.compile(r"(?<!\w)[^\W\d_]++(?!\w)")
_ADDRESSED = re.compile(r"\b(" + "|".join(sorted(ADDRESS, key=len, reverse=True)) + r")\b\.? ([^\W\d_]+)(?: ([^\W\d_]+))?")
_GIVEN = re.compile(r"\b(" + "|".join(x for names in GIVEN.values() for n in names for x in (n, n.upper())) + r")\b(?: ([^\W\d_]+))?")
SPANS = "array<struct<start:long,end:long,type:string,norm:string>>"


def luhn(digits: str) -> int:
    """Check digit sum modulo 10; 0 for a valid number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def ip6_of(text: str) -> str | None:
    """The address in full, if it is one."""
    try:
        return ipaddress.IPv6Address(text).exploded
    except ValueError:
        return None


def digits_of(text: str) -> str:
    return "".join(c for c in text if c.isdecimal() and c.isascii())


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Spans (start, end, type, normal form) without overlaps, in order; of overlapping ones the first type wins."""
    found: list[tuple[int, int, str, str]] = []

    def add(start: int, end: int, kind: str, norm: str) -> None:
        found.append((start, end, kind, norm))
    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(m.start(), m.end(), "EMAIL", m[0].lower())
    if _DIGITS.search(text):
        for m in _IBAN.finditer(text):
            if iban_rest(m[0]) == 1:
                add(m.start(), m.end(), "IBAN", m[0])
        for m in _IBAN_GROUPS.finditer(text):
            groups = re.split("[ -]", m[0])
            for n in range(len(groups), 3, -1):  # capitals after the number may look like groups of it
                joined = "".join(groups[:n])
                if len(joined) >= 15 and iban_rest(joined) == 1:
                    add(m.start(), m.start() + len(joined) + n - 1, "IBAN", joined)
                    break
        for m in _CARD.finditer(text):
            if luhn(d := digits_of(m[0])) == 0 and len(set(d)) > 1:
                add(m.start(), m.end(), "CARD", d)
        for kind, pattern in (("SSN", _SSN), ("PHONE", _PHONE), ("PHONE", _PLAIN_PHONE)):
            for m in pattern.finditer(text):
                add(m.start(), m.end(), kind, digits_of(m[0]))
        for m in _FAR_PHONE.finditer(text):
            add(m.start(), m.end(), "PHONE", "+" + digits_of(m[0]))
        for m in _IP6.finditer(text) if ":" in text else ():
            if len(m[0].replace(":", "")) >= 4 and _DIGITS.search(m[0]) and (address := ip6_of(m[0])):
                add(m.start(), m.end(), "IP", address)
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                add(m.start(), m.end(), "IP", ".".join(str(int(x)) for x in m[0].split(".")))
    for m in _ADDRESSED.finditer(text):
        words = [(m.start(k), m.end(k), m[k]) for k in (2, 3) if m[k] and m[k][0].isupper()]
        if not m[2][0].isupper():
            continue
        for i, (s, e, w) in enumerate(words):
            given = _BY_NAME.get(w.lower())
            if i == 0 and (given or len(words) == 2):
                add(s, e, "GIVEN_" + (given[1] if given else ADDRESS[m[1]] or "x").upper(), w.lower())
            else:
                add(s, e, "SURNAME", w.lower())
    for m in _GIVEN.finditer(text):
        if m[2] and m[2][0].isupper():
            add(m.start(1), m.end(1), "GIVEN_" + _BY_NAME[m[1].lower()][1].upper(), m[1].lower())
            add(m.start(2), m.end(2), "SURNAME", m[2].lower())
    out = without_overlaps(found)
    parts: dict[str, str] = {}
    for _, _, kind, norm in out:
        if kind.startswith(("GIVEN", "SURNAME")) and norm not in NO_MENTION:
            parts.setdefault(norm, kind)
    if not parts:
        return out
    return without_overlaps(out + [(m.start(), m.end(), parts[n], n) for m in _WORD.finditer(text) if (n := m[0].lower()) in parts])


def without_overlaps(found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    out, end = [], 0
    rank = {id(f): i for i, f in enumerate(found)}
    for f in sorted(found, key=lambda f: (f[0], rank[id(f)])):
        if f[0] >= end:
            out.append(f)
            end = f[1]
    return out


def permute(n: int, x: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of 0 .. n - 1: a Feistel network over two near-square halves, walked until inside."""
    if n < 2:
        return x
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for i in range(6):
            h = int.from_bytes(hashlib.blake2b(f"{tweak}|{i}|{right if i % 2 == 0 else left}".encode(), key=key, digest_size=16).digest(), "big")
            if i % 2 == 0:
                left = (left + h) % a
            else:
                right = (right + h) % b
        x = left * b + right
        if x < n:
            return x


def permute_text(text: str, key: bytes, tweak: str, first: str = "", places: tuple[int, ...] = (0,)) -> str:
    """Another text of the same pattern of character classes; ``first``: the characters its digits at ``places`` may have."""
    slots = [(i, first if first and i in places and c in first else _CLASS[c]) for i, c in enumerate(text) if c in _CLASS]
    n = x = 0
    total = math.prod(len(a) for _, a in slots)
    for i, a in slots:
        x = x * len(a) + a.index(text[i])
    n = permute(total, x, key, f"{tweak}|{len(text)}|" + "".join(str(ALPHABETS.index(_CLASS[text[i]])) for i, _ in slots))
    out = list(text)
    for i, a in reversed(slots):
        n, d = divmod(n, len(a))
        out[i] = a[d]
    return "".join(out)


def surrogate(kind: str, norm: str, attempt: int = 0, key: bytes = KEY) -> str:
    """Normal form of the surrogate of an entity."""
    tweak = f"{kind}|{attempt}"
    if attempt >= MAX_ATTEMPTS and not norm[0].isdigit() and kind not in ("PHONE", "IP"):
        return permute_text(norm, key, tweak) + permute_text("barelo", key, f"{tweak}|{norm}")  # the format is used up
    if kind == "EMAIL":
        name, _, host = norm.partition("@")
        host, dot, top = host.rpartition(".")
        mixed = permute_text(name + "@" + host, key, tweak)
        return mixed + dot + top
    if kind == "IP" and ":" in norm:
        return ipaddress.IPv6Address(permute(2**128, int(ipaddress.IPv6Address(norm)), key, tweak)).exploded
    if kind == "IP":
        x = 0
        for part in norm.split("."):
            x = x * 256 + int(part)
        x = permute(2**32, x, key, tweak)
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
    if kind == "CARD":
        start = norm[0] + permute_text(norm[1:-1], key, tweak)
        return start + str((10 - luhn(start + "0")) % 10)
    if kind == "IBAN":
        start = norm[:2]
        rest = permute_text(norm[4:].lower(), key, tweak).upper()
        return f"{start}{98 - iban_rest(start + '00' + rest):02d}{rest}"
    if kind == "PHONE" and norm[0] == "+":
        code = next((n for n in (2, 3) if norm[1:n] in CODES), 4)
        return norm[:code] + permute_text(norm[code:], key, f"{tweak}|{norm[:code]}", "23456789")
    if kind == "PHONE":
        return norm[:-10] + permute_text(norm[-10:], key, tweak, "23456789", (0, 3))
    if kind.startswith("GIVEN") and norm in _BY_NAME:
        _, gender, script = _BY_NAME[norm]
        names = GIVEN[script, gender]
        return names[permute(len(names), [n.lower() for n in names].index(norm), key, f"{tweak}|{script}")].lower()
    return permute_text(norm, key, tweak)


def render(kind: str, mention: str, value: str) -> str:
    """The surrogate in the mention's form: separators of numbers and letter case of names are kept."""
    if kind in ("PHONE", "SSN", "CARD"):
        digits = iter(digits_of(value))
        return "".join(next(digits) if c in ALPHABETS[0] else c for c in mention)
    if kind == "IBAN":
        rest = iter(value)
        return "".join(next(rest) if c.isalnum() else c for c in mention)
    if kind == "SURNAME" or kind.startswith("GIVEN"):
        return value.upper() if mention.isupper() and len(mention) > 1 else value[:1].upper() + value[1:] if mention[:1].isupper() else value
    return value


def spans_of(docs: DataFrame) -> DataFrame:
    """row, doc_id, text and spans of every row."""
    @F.pandas_udf(SPANS)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("start", "end", "type", "norm"), s, strict=True)) for s in detect(t or "")] for t in texts], dtype=object)
    return docs.select("doc_id", "text", found(body()).alias("spans"))


def _surrogates(key: bytes) -> Callable:
    @F.pandas_udf("string")
    def make(kind: pd.Series, norm: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, n, a, key) for k, n, a in zip(kind, norm, attempt, strict=True)], dtype=object)
    return make


def surrogate_table(entities: DataFrame, scratch: Scratch, key: bytes = KEY) -> DataFrame:
    """type, norm and surrogate of distinct entities, without conflicts.

    A surrogate equal to its own entity, to another entity of the type or to another's surrogate is a conflict; of
    several entities with one surrogate the least keeps it.  Listed given names may map to names that occur.  After
    ``MAX_ATTEMPTS`` permutations names and addresses get a longer surrogate; numbers still in conflict after as many
    again (nearly all values of their format occur) are an error.
    """
    make = _surrogates(key)
    table = scratch.table("map-0", entities.select("type", "norm", F.lit(0).alias("attempt"), make("type", "norm", F.lit(0)).alias("surrogate")))
    named = F.col("type").startswith("GIVEN")
    for i in range(1, 2 * MAX_ATTEMPTS):
        keeps = table.groupBy("type", "surrogate").agg(F.min("norm").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
        real = entities.select("type", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        judged = (table.join(keeps.drop("n"), ["type", "surrogate"], "left").join(real, ["type", "surrogate"], "left")
                  .withColumn("bad", (F.col("keeper").isNotNull() & (F.col("keeper") != F.col("norm"))) | (F.col("real").isNotNull() & ~named)))
        judged = scratch.table(f"judged-{i}", judged)
        if judged.where("bad").isEmpty():
            return table.select("type", "norm", "surrogate")
        attempt = F.col("attempt") + F.col("bad").cast("int")
        table = scratch.table(f"map-{i}", judged.select("type", "norm", attempt.alias("attempt"),
                              F.when(F.col("bad"), make("type", "norm", attempt)).otherwise(F.col("surrogate")).alias("surrogate")))
    raise ValueError(f"surrogates still collide after {2 * MAX_ATTEMPTS} attempts")


def replace_personal_data(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text with surrogates (NULL stays NULL), n_entities and the types found, for every row.

    Only documents with personal data are written aside and joined with the surrogates; the others pass through.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "pii")
    plain = docs.select("doc_id", "text")
    hit = scratch.table("hit", spans_of(plain).where("size(spans) > 0").withColumn("row", F.monotonically_increasing_id()))
    mention = hit.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    entities = scratch.table("entities", mention.select("type", "norm").distinct())
    mapped = (mention.join(surrogate_table(entities, scratch, key), ["type", "norm"])
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "type", "surrogate"))).alias("found")))

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for text, found in zip(batch["text"], batch["found"], strict=True):
                out, at = [], 0
                for f in found:
                    out += [text[at:f["start"]], render(f["type"], text[f["start"]:f["end"]], f["surrogate"])]
                    at = f["end"]
                texts.append("".join([*out, text[at:]]))
            yield pd.DataFrame({"row": batch["row"], "changed": texts})
    changed = hit.join(mapped, "row").select("row", "text", "found").mapInPandas(rewrite, "row long, changed string")
    done = (hit.select("row", "doc_id", F.size("spans").cast("long").alias("n_entities"),
                       F.concat_ws(",", F.array_sort(F.array_distinct(F.col("spans.type")))).alias("types")).join(changed, "row")
            .select("doc_id", F.col("changed").alias("text"), "n_entities", "types"))
    rest = spans_of(plain).where("size(spans) = 0").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("types"))
    return rest.unionByName(done)
