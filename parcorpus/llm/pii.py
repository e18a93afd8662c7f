"""Operator 6: surrogates for personal data.

Detected entities (e-mail and IP addresses, phone, card, account and social
security numbers, secrets, titled person names) are replaced by invented ones of
the same type and form: digits stay digits, separators, case, length, Luhn and
mod-97 validity, script of a name and the gender that its title tells are kept.
The replacement is derived with HMAC-SHA256 from a secret key and the entity's
canonical form, so all mentions of an entity, in whatever layout, get the same
one (coreference). A person whom a text names with a title is also found in it
without: by the whole name or one word of it, as written or in capitals; such a word becomes the
same word of the replacement. A word of several names is that of the longest,
then of one whose title tells the gender, then of the first in the text.

Two entities may draw the same replacement, or one that is a real entity of the
corpus. So all distinct entities are checked against each other and against the
real ones in grouped joins; losers draw again until none is left (distinctness).

Defined results: a null or empty text has no entities and stays. Repeated rows
get equal results. Overlapping finds: the first, then the longer one counts.
Texts and entities may be of any length; an empty table gives an empty result.
Other columns are carried along and may have any name; ``n_entities`` is added
or replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcorpus.llm.common import in_slices, ship_by_value, written

#: Draws that keep the exact form; later ones are one character longer.
STRICT_DRAWS = 16
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
NUMBER = re.compile(r"[+(]?\d[\d .()-]*\d")
PHONE = re.compile(r"(?<![\w.])(\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)")
CARD = re.compile(r"(?<!\d)\d{4}(?:[ -]?\d{4}){3}(?!\d)")
SSN = re.compile(r"(?<!\d)(?!000|666|9)\d{3}-\d{2}-\d{4}(?!\d)")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
ADDRESS = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)")
DOMAIN = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
SECRET = re.compile(r"""(?i:token|secret|password|api_?key)["']?\s*[=:]\s*["']?([A-Za-z0-9_+/-]{16,})""")
# Titles that tell a gender.
FEMALE = ["Mrs", "Ms", "Miss", "Mme", "Madame", "Frau", "Sra", "Señora", "Госпожа", "Κυρία"]
MALE = ["Mr", "Monsieur", "Herr", "Sr", "Señor", "Господин", "Κύριος"]
# Titles that tell none.
NEUTRAL = ["Dr", "Prof", "Professor", "Доктор"]
TITLES = "|".join(FEMALE + MALE + NEUTRAL)
NAME = rf"(?!(?:{TITLES})\b)[^\W\d_a-zа-яα-ω][^\W\d_]+"
TITLED = re.compile(rf"\b({TITLES})\b\.?[ \t]+({NAME}(?:[ \t]+{NAME})?)")
WORD = re.compile(r"[^\W\d_]+")
# Syllables of invented names, and endings by gender, per script.
SYLLABLES = {
    "latin": (["ba", "co", "da", "el", "fi", "ga", "ho", "ka", "le", "mi", "no", "ra", "so", "ti", "vo", "we"], {"f": "a", "m": "n", "n": "e"}),
    "cyrillic": (["ба", "во", "га", "де", "ка", "ле", "ми", "но", "ра", "со", "ти", "фе"], {"f": "а", "m": "н", "n": "е"}),
    "greek": (["βα", "γο", "δα", "κε", "λι", "μα", "νο", "ρα", "σι", "το", "φε", "χα"], {"f": "α", "m": "ος", "n": "ε"}),
}


def mod97(account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def accounts(text: str):
    """(start, end, account) of the account numbers with valid check digits."""
    for m in IBAN.finditer(text):
        shown = m[0]
        # capitals that follow the number may look like its last groups
        while len(shown) > 14 and mod97(shown.replace(" ", "")) != 1:
            shown = shown.rpartition(" ")[0]
        if len(shown) > 14:
            yield m.start(), m.start() + len(shown), shown.replace(" ", "")


def people(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions of the persons whom the text names with a title: with it, and then without."""
    titled = []
    for m in TITLED.finditer(text):
        gender = "f" if m[1] in FEMALE else "m" if m[1] in MALE else "n"
        titled.append((m.start(2), m.end(2), "name_" + gender, " ".join(m[2].lower().split())))
    whole, owner = {}, {}
    for a, b, kind, form in sorted(titled, key=lambda e: (-len(e[3].split()), e[2] == "name_n", e[0])):
        whole.setdefault(form, (kind, form))
        for word in text[a:b].split():
            owner.setdefault(word, (kind, form))
            owner.setdefault(word.upper(), (kind, form))
    found = []
    for a, b, kind, form in titled:
        of = owner.get(text[a:b], whole[form])
        found.append((a, b, *(of if kind in (of[0], "name_n") else (kind, form))))
    before = None
    for m in WORD.finditer(text) if titled else ():
        if m[0] not in owner:
            before = None
            continue
        both = f"{before[0]} {m[0]}".lower() if before and text[before.end():m.start()].isspace() else None
        if both in whole:
            found[-1] = (before.start(), m.end(), *whole[both])
            before = None
        else:
            found.append((m.start(), m.end(), *owner[m[0]]))
            before = m
    return found


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a text, in order."""
    found = []
    for m in NUMBER.finditer(text):
        # a number may begin inside a wider form, so the patterns look around it
        a, b = m.span()
        for kind, pattern in (("ip", ADDRESS), ("card", CARD), ("phone", PHONE), ("ssn", SSN)):
            for x in pattern.finditer(text, a, b):
                form = x[0] if kind == "ip" else re.sub(r"\D", "", x[0])
                if kind != "ip" or all(int(p) < 256 for p in form.split(".")):
                    found.append((x.start(), x.end(), kind, form))
    for m in DOMAIN.finditer(text):
        a = at = m.start()
        while a > 0 and text[a - 1] in LOCAL_CHARS:  # no further than to the @ before
            a -= 1
        if a < at:
            found.append((a, m.end(), "email", text[a:m.end()].lower()))
    for m in SECRET.finditer(text):
        found.append((m.start(1), m.end(1), "secret", m[1]))
    found += [(a, b, "iban", form) for a, b, form in accounts(text)]
    found += people(text)
    found.sort(key=lambda e: (e[0], -e[1]))
    kept, end = [], 0
    for e in found:
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    return kept


class Draws:
    """A stream of numbers keyed by the secret key and a message."""

    def __init__(self, key: bytes, *message):
        self.key, self.message, self.block, self.state = key, "\0".join(map(str, message)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.state) < 4:
            self.state = hmac.new(self.key, b"%d:" % self.block + self.message, hashlib.sha256).digest()
            self.block += 1
        x, self.state = int.from_bytes(self.state[:4], "big"), self.state[4:]
        return x % n


def alike(c: str, draws: Draws, digits: str = "0123456789", low: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """A character of the same class as ``c``."""
    if c.isdigit():
        return digits[draws.below(len(digits))]
    if c.isalpha() and c.isascii():
        x = low[draws.below(len(low))]
        return x.upper() if c.isupper() else x
    return c


def luhn(digits: str) -> int:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10


def script(word: str) -> str | None:
    """The script of a word, of those with syllables."""
    name = unicodedata.name(word[0], "").lower()
    return next((s for s in SYLLABLES if name.startswith(s)), None)


def near(c: str, draws: Draws) -> str:
    """A character of the same category from the same 64 places of the code chart."""
    row, kind = ord(c) & ~63, unicodedata.category(c)
    same = [x for x in map(chr, range(row, row + 64)) if unicodedata.category(x) == kind and x.lower() == x]
    return same[draws.below(len(same))] if same else c


def surrogate(key: bytes, kind: str, form: str, draw: int) -> str:
    """The canonical form of the replacement of an entity in its ``draw``-th draw."""
    draws = Draws(key, kind, form, draw)
    longer = max(0, draw - STRICT_DRAWS + 1)
    if kind == "ip":
        return ".".join(str(1 + draws.below(n)) for n in (223, 254, 254, 254))
    if kind == "card":
        body = form[0] + "".join(alike(c, draws) for c in form[1:-1])
        last = next(d for d in "0123456789" if (luhn(body + d) == 0))
        return body + (last if luhn(form) == 0 else alike("0", draws, "".join(d for d in "0123456789" if d != last)))
    if kind == "iban":
        body = "".join(alike(c, draws) for c in form[4:])
        return f"{form[:2]}{98 - mod97(form[:2] + '00' + body):02d}{body}"
    if kind == "ssn":
        return alike("0", draws, "1234578") + "".join(alike(c, draws) for c in form[1:])
    if kind == "phone":
        keep = len(form) - 10  # the country code
        return form[:keep] + "".join(alike(c, draws, "23456789" if k % 3 == 0 and k < 6 else "0123456789")
                                     for k, c in enumerate(form[keep:]))
    if kind == "email":
        local, _, domain = form.partition("@")
        host = Draws(key, "domain", domain)
        label = "".join(alike(c, host) for c in domain.rpartition(".")[0])
        return "".join(alike(c, draws) for c in local) + "".join(alike("a", draws) for _ in range(longer)) + f"@{label}.example"
    if kind == "secret":
        hexa = re.fullmatch("[0-9a-f]+|[0-9A-F]+", form)
        return "".join(alike(c, draws, low="abcdef") if hexa else alike(c, draws) for c in form + "a" * longer)
    parts = []
    for word in form.split(" "):
        if script(word) is None:
            parts.append("".join(near(c, draws) for c in word + word[0] * longer))
            continue
        syllables, endings = SYLLABLES[script(word)]
        n = max(1, len(word) // 2) + longer
        parts.append("".join(syllables[draws.below(len(syllables))] for _ in range(n)) + endings[kind[-1]])
    return " ".join(parts)


def cased(like: str, new: str) -> str:
    """``new`` with capitals where ``like`` has them, or in capitals as a whole."""
    if like.isupper():
        return new.upper()
    return "".join(c.upper() if o.isupper() else c for o, c in zip(like.ljust(len(new)), new))


def in_form(mention: str, kind: str, new: str, form: str = "") -> str:
    """The replacement ``new`` of the entity ``form`` in the layout of the mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        fill = iter(new)
        return "".join(next(fill) if c.isalnum() else c for c in mention)
    if kind.startswith("name_"):
        gaps, old, names = re.findall(r"\s+", mention), form.split(" "), new.split(" ")
        if len(mention.split()) < len(names):  # one word of the name
            names = [names[old.index(mention.lower())]]
        words = [w.upper() if o.isupper() else w.capitalize() for w, o in zip(names, mention.split())]
        return words[0] + "".join(g + w for g, w in zip(gaps, words[1:]))
    if kind == "email":
        return "@".join(map(cased, mention.split("@"), new.split("@")))
    return new


ENTITY = "array<struct<start:int,end:int,kind:string,form:string>>"


def _detected(docs: DataFrame, text: str, having: bool) -> DataFrame:
    """The rows with entities, and their ``_entities``; or else the rows without."""
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], f"_entities {ENTITY}"])

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("form", pa.string())]))
        for batch in batches:
            for part in in_slices(batch, text):
                rows = [detect(t or "") for t in part.column(text).to_pylist()]
                at = [k for k, r in enumerate(rows) if bool(r) == having]
                if at:
                    values = pa.array([[dict(zip(("start", "end", "kind", "form"), e)) for e in rows[k]] for k in at], kind)
                    taken = part.take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*taken.columns, values], [*part.schema.names, "_entities"])

    return docs.mapInArrow(run, schema)


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, new) with distinct ``new`` per kind, none of them a real form.

    Each round draws for the entities still without one, drops what is taken or
    real, and of those that drew alike keeps the smallest form."""

    @F.pandas_udf("string")
    def drawn(kind, form, draw):
        import pandas as pd

        return pd.Series([surrogate(key, *x) for x in zip(kind, form, draw)])

    entities = written(entities.select("kind", "form").distinct(), "entities")
    open_, done, draw = entities, None, 0
    while True:
        tried = written(open_.withColumn("new", drawn("kind", "form", F.lit(draw))), "draws")
        real = entities.select("kind", F.col("form").alias("new"))
        ok = tried.join(real, ["kind", "new"], "left_anti")
        if done is not None:
            ok = ok.join(done.select("kind", "new"), ["kind", "new"], "left_anti")
        won = written(ok.groupBy("kind", "new").agg(F.min("form").alias("form")).select("kind", "form", "new"), "won")
        done = won if done is None else done.unionByName(won)
        open_ = written(open_.join(won, ["kind", "form"], "left_anti"), "open")
        draw += 1
        if open_.isEmpty():
            return done


def replace_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``."""
    columns = [c for c in docs.columns if c.lower() != "n_entities"]
    packed = docs.select(F.struct(*columns).alias("_doc"), F.col(text).alias("_text"))
    found = written(_detected(packed, "_text", True).withColumn("_rid", F.monotonically_increasing_id()), "entities-in")
    mentions = found.select("_rid", F.posexplode("_entities").alias("_k", "e")).select(
        "_rid", "_k", F.col("e.kind").alias("kind"), F.col("e.form").alias("form"))
    new = mentions.join(assign(mentions, key), ["kind", "form"]).groupBy("_rid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_k", "new"))), lambda x: x["new"]).alias("_new"))
    ready = found.join(new, "_rid").select("_doc", "_text", "_entities", "_new")
    doc_type = docs.select(F.struct(*columns).alias("_doc")).schema["_doc"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("_text", "_entities", "_new"))):
                t, at, parts = row[0], 0, []
                for e, value in zip(row[1], row[2]):
                    parts += [t[at:e["start"]], in_form(t[e["start"]:e["end"]], e["kind"], value, e["form"])]
                    at = e["end"]
                out.append("".join([*parts, t[at:]]))
            n = pa.array([len(e) for e in batch.column("_new").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(out, pa.string()), n], ["_doc", "_out", "n_entities"])

    changed = ready.mapInArrow(run, f"_doc {doc_type}, _out string, n_entities long")
    same = _detected(packed, "_text", False).select("_doc", F.col("_text").alias("_out"), F.lit(0).cast("long").alias("n_entities"))
    return changed.unionByName(same).select(
        *[F.col("_out").alias(text) if c == text else F.col(f"_doc.`{c}`").alias(c) for c in columns], "n_entities")


ship_by_value(__name__)
