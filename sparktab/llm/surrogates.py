"""Operator 5: personal data replaced by keyed, type-consistent surrogates.

Detected: secrets after a key word, e-mail addresses, IBANs, IP addresses, card and
account numbers, phone numbers, social security numbers, and names after an
honorific.  An entity is (kind, canonical form): case and separators do not
matter, so all its mentions, in any document, get the same surrogate (coreference).
A name goes token by token, so a later mention by one token of it, in the same
document, is found and agrees.

A surrogate comes from a keyed hash of (kind, canonical form, attempt).  It has the
format of what it replaces: digits for digits, letters of the same script and case,
the same separators; IP octets stay octets, a valid card number or IBAN gets valid check
digits, a given name gets one of the same gender (from the honorific) and script.

Collision check, on the cluster: the distinct entities are collected in a table;
candidates that two entities share, or that equal a real entity, go on to the next
attempt (all but one of the sharers) until none is left.  Nearly all entities stay at attempt 0, which
each task computes by itself; only the others are handed to the tasks, by broadcast if
they are few, else by a join on the documents that hold them.

Defined results: null text counts as empty; rows with equal id and text get the
same result; overlapping finds: the kind listed first wins; one result row per
row; empty table, empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, saved, small_enough, text_hash

KEY = b"surrogates"
MAX_ATTEMPTS = 200
BROADCAST_ROWS = 500_000

KEYWORD = re.compile(r"(?:token|api[_ -]?key|access[_ -]?key|secret|passw(?:or)?d|passwd|pwd)[\"']?\s*$", re.I)
VALUE = re.compile(r"\s*(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|([^\s\"']{6,}))")
LOCAL = re.compile(r"[\w.%+-]+\Z")
DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NUMBER = re.compile(
    r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\d.,])(?:\d{13,19}|\d{4}([ -])\d{4}\3\d{4}\3\d{1,7})(?![\d]|[.,]\d))"
    r"|(?P<phone>(?<![\w])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))")
FEMALE = {"Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Srta", "Señora", "г-жа", "госпожа", "κυρία"}
MALE = {"Mr", "Herr", "Sr", "Señor", "г-н", "господин", "κύριος"}
TITLE = re.compile(r"(?<!\w)(" + "|".join(sorted(FEMALE | MALE | {"Dr", "Prof"}, key=len, reverse=True))
                   + r")\.? ((?:[^\W\d_a-zß-öø-ÿа-яё][^\W\d_]+)(?:[ -][^\W\d_a-zß-öø-ÿа-яё][^\W\d_]+){0,2})")
ORDER = ("secret", "email", "iban", "ip", "card", "phone", "ssn", "name")


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text: (start, end, kind, canonical form), in order, not overlapping."""
    found = []
    for sign in ("=", ":"):
        at = text.find(sign)
        while at >= 0:
            if KEYWORD.search(text[max(0, at - 24):at]) and (m := VALUE.match(text, at + 1)):
                g = m.lastindex
                s = m[g].strip()
                start = m.start(g) + m[g].index(s)
                if len(s) >= 6:
                    found.append((start, start + len(s), "secret", s.lower() if re.fullmatch("[0-9a-fA-F]+", s) else s))
            at = text.find(sign, at + 1)
    at = text.find("@")
    while at >= 0:
        window = max(0, at - 256)
        left, right = LOCAL.search(text[window:at]), DOMAIN.match(text, at + 1)
        if left and right:
            found.append((window + left.start(), right.end(), "email", text[window + left.start():right.end()].lower()))
        at = text.find("@", at + 1)
    if re.search(r"\d\d", text) or re.search(r"\d\.\d", text):
        if re.search(r"[A-Z]{2}\d{2}", text):
            for m in IBAN.finditer(text):
                c = m[0].replace(" ", "")
                if 15 <= len(c) <= 34 and iban_rest(c) == 1:
                    found.append((*m.span(), "iban", c))
        for m in NUMBER.finditer(text):
            kind = next(k for k in ("ip", "card", "phone", "ssn") if m[k])
            if kind == "ip":
                if any(int(x) > 255 for x in m[0].split(".")):
                    continue
                c = m[0]
            else:
                c = "".join(x for x in m[0] if x.isdigit())
            found.append((*m.span(), kind, c))
    if TITLE.search(text):
        found += names(text)
    if len(found) < 2:
        return found
    found.sort(key=lambda e: (ORDER.index(e[2].split(":")[0]), e[0]))
    taken, used = [], bytearray(len(text))
    for e in found:
        if 1 not in used[e[0]:e[1]]:
            used[e[0]:e[1]] = b"\1" * (e[1] - e[0])
            taken.append(e)
    return sorted(taken)


def names(text: str) -> list[tuple[int, int, str, str]]:
    out, known = [], {}
    for m in TITLE.finditer(text):
        gender = "f" if m[1] in FEMALE else "m" if m[1] in MALE else "n"
        tokens = re.findall(r"[^ -]+", m[2])
        for i, t in enumerate(tokens):
            known.setdefault(t, f"name:{gender}" if i < len(tokens) - 1 else "name:s")
    for m in re.finditer(r"(?<!\w)[^\W\d_]+(?!\w)", text):
        if m[0] in known:
            out.append((*m.span(), known[m[0]], m[0].casefold()))
    return out


def iban_rest(c: str) -> int:
    return int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97


def luhn_rest(digits: str) -> int:
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = int(x) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


class Stream:
    """Keyed random integers for one (kind, canonical form, attempt)."""

    def __init__(self, key: bytes, *parts):
        self.seed = hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key).digest()
        self.buffer, self.count = b"", 0

    def below(self, n: int) -> int:
        if len(self.buffer) < 8:
            self.buffer += hashlib.blake2b(self.count.to_bytes(8, "little"), key=self.seed).digest()
            self.count += 1
        raw, self.buffer = self.buffer[:8], self.buffer[8:]
        return int.from_bytes(raw, "little") % n


@lru_cache(maxsize=4096)
def alike(c: str) -> str:
    """Characters that may stand for ``c``: the same class, and script (block of 256 code points)."""
    if c.isascii():
        for lo, hi in (("0", "9"), ("a", "z"), ("A", "Z")):
            if lo <= c <= hi:
                return "".join(map(chr, range(ord(lo), ord(hi) + 1)))
        return c
    if not c.isalnum():
        return c
    block, kind = ord(c) >> 8 << 8, unicodedata.category(c)
    same = "".join(chr(x) for x in range(max(block, 0xC0), block + 256)
                   if unicodedata.category(chr(x)) == kind and len(chr(x).lower()) == len(chr(x).upper()) == 1)
    return same or c


def _letters(s: str, rnd: Stream) -> str:
    return "".join(a[rnd.below(len(a))] for a in map(alike, s))


GIVEN_END = {"f": {"latin": "aie", "cyrillic": "ая", "greek": "αη"}, "m": {"latin": "nosr", "cyrillic": "нрв", "greek": "ςν"}}
SYLLABLES = {
    "latin": ("bcdfglmnprstv", "aeiou"), "cyrillic": ("бвгдклмнрст", "аеио"), "greek": ("βγδκλμνπρστ", "αειο")}


def script_of(s: str) -> str:
    for c in s:
        name = unicodedata.name(c, "")
        for script in ("latin", "cyrillic", "greek"):
            if name.startswith(script.upper()):
                return script
    return "other"


def _name(kind: str, c: str, attempt: int, rnd: Stream) -> str:
    script = script_of(c)
    if script == "other":
        return _letters(c, rnd)
    first, second = SYLLABLES[script]
    out = "".join(first[rnd.below(len(first))] + second[rnd.below(len(second))]
                  for _ in range(2 + len(c) // 6 + attempt // 4))
    ends = GIVEN_END.get(kind.split(":")[1])
    return out + (ends[script][rnd.below(len(ends[script]))] if ends else first[rnd.below(len(first))])


def surrogate(key: bytes, kind: str, c: str, attempt: int) -> str:
    """Canonical surrogate of a canonical form."""
    rnd = Stream(key, kind, c, attempt)
    if kind.startswith("name:"):
        return _name(kind, c, attempt, rnd)
    if kind == "email":
        local, _, domain = c.rpartition("@")
        labels = domain.split(".")
        more = "".join(chr(97 + rnd.below(26)) for _ in range(attempt // 4))
        return _letters(local, rnd) + more + "@" + ".".join([_letters(x, rnd) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        low, high = (0, 1, 10, 100), (0, 9, 99, 255)
        return ".".join(str(low[n] + rnd.below(high[n] - low[n] + 1)) for n in map(len, c.split(".")))
    if kind == "iban":
        body = c[:2] + "00" + _letters(c[4:], rnd)
        return f"{c[:2]}{98 - iban_rest(body):02d}{body[4:]}"
    if kind == "secret" and re.fullmatch("[0-9a-f]+", c):
        return "".join("0123456789abcdef"[rnd.below(16)] for _ in c)
    out = _letters(c, rnd)
    if kind == "phone" and len(c) > 10:
        out = c[:len(c) - 10] + out[len(c) - 10:]  # the country code stays
    if kind == "card" and luhn_rest(c) == 0:
        out = next(out[:-1] + d for d in "0123456789" if luhn_rest(out[:-1] + d) == 0)
    return out


def render(mention: str, kind: str, s: str) -> str:
    """The canonical surrogate in the format of a mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(s)
        return "".join(next(rest) if x.isalnum() else x for x in mention)
    letters = [x for x in mention if x.isalpha()]
    if letters and all(x.isupper() for x in letters) and len(letters) > 1 and not kind == "secret":
        return s.upper()
    if kind == "secret":
        return s.upper() if re.fullmatch("[0-9A-F]+", mention) and re.fullmatch("[0-9a-f]+", s) else s
    if kind.startswith("name:"):
        return s[0].upper() + s[1:]
    if len(mention) == len(s):
        return "".join(y.upper() if x.isupper() and len(y.upper()) == 1 else y for x, y in zip(mention, s))
    return s


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("id"), text_hash(text_col).alias("text_hash"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash, kind, entity: the distinct entities of every row."""
    src = _sources(docs, id_col, text_col)
    id_type = src.schema["id"].simpleString().split(":", 1)[1]

    def run(batches):
        for b in batches:
            rows, kinds, entities = [], [], []
            for i, t in enumerate(b.column(2)):
                for kind, c in sorted({(k, c) for _, _, k, c in find(t.as_py())}):
                    rows.append(i)
                    kinds.append(kind)
                    entities.append(c)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(kinds, pa.string()),
                 pa.array(entities, pa.string())], ["id", "text_hash", "kind", "entity"])

    return src.mapInArrow(run, f"id {id_type}, text_hash long, kind string, entity string")


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, entity, attempt, surrogate for distinct entities; surrogates differ from each other and from entities."""

    def run(batches):
        for b in batches:
            s = [surrogate(key, k, e, a) for k, e, a in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(s, pa.string())],
                                             ["kind", "entity", "attempt", "surrogate"])

    def trial(df, attempt):
        return df.select("kind", "entity", F.lit(attempt).alias("attempt")).mapInArrow(
            run, "kind string, entity string, attempt int, surrogate string")

    # genders and surnames share one space of names
    space = F.split("kind", ":")[0]
    real = entities.select(space.alias("r_space"), F.col("entity").alias("r_entity")).distinct()
    settled, open_ = None, entities
    for attempt in range(MAX_ATTEMPTS):
        now = trial(open_, attempt).withColumn("space", space)
        best = F.min(F.struct("kind", "entity"))
        owner = now.groupBy("space", "surrogate").agg(best.alias("best"))
        owner = owner.join(real, (F.col("space") == F.col("r_space")) & (F.col("surrogate") == F.col("r_entity")),
                           "left_anti")
        if settled is not None:
            used = settled.select(F.split("kind", ":")[0].alias("u_space"), F.col("surrogate").alias("u_surrogate"))
            owner = owner.join(used, (F.col("space") == F.col("u_space"))
                               & (F.col("surrogate") == F.col("u_surrogate")), "left_anti")
        won = saved(owner.select("best.kind", "best.entity", F.lit(attempt).alias("attempt"), "surrogate"),
                    "surrogates")
        settled = won if settled is None else settled.unionByName(won)
        open_ = saved(open_.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti"), "open-entities")
        if open_.isEmpty():
            return settled
    raise RuntimeError(f"no distinct surrogates after {MAX_ATTEMPTS} attempts")


def replace(text: str, key: bytes, attempts) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds replaced."""
    out, at, kinds = [], 0, []
    for start, end, kind, c in find(text):
        out += [text[at:start], render(text[start:end], kind, surrogate(key, kind, c, attempts.get((kind, c), 0)))]
        at = end
        kinds.append(kind.split(":")[0])
    return ("".join(out) + text[at:] if out else text), kinds


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``docs``: id, text (with surrogates), kinds (array, one per mention)."""
    spark = docs.sparkSession
    held = saved(mentions(docs, id_col, text_col), "mentions")
    later = assign(held.select("kind", "entity").distinct(), key).where("attempt > 0").select("kind", "entity", "attempt")
    src = _sources(docs, id_col, text_col)
    few = small_enough(later, broadcast_rows)
    table = {(r[0], r[1]): r[2] for r in later.collect()} if few else {}
    given = spark.sparkContext.broadcast(table)
    if few:
        src = src.withColumn("own", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    else:
        own = held.join(later, ["kind", "entity"]).groupBy(F.col("id").alias("o_id"), F.col("text_hash").alias("o_hash")).agg(
            F.collect_set(F.struct("kind", "entity", "attempt")).alias("own"))
        src = src.join(own, src["id"].eqNullSafe(own["o_id"]) & (src["text_hash"] == own["o_hash"]), "left")
    id_type = src.schema["id"].simpleString().split(":", 1)[1]

    def run(batches):
        for b in batches:
            texts, kinds = [], []
            for t, o in zip(b.column(1), b.column(2)):
                own = {(x["kind"], x["entity"]): x["attempt"] for x in o.as_py()} if o.is_valid else given.value
                new, k = replace(t.as_py(), key, own)
                texts.append(new)
                kinds.append(k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))],
                ["id", "text", "kinds"])

    return src.select("id", "text", "own").mapInArrow(run, f"id {id_type}, text string, kinds array<string>")
