"""Surrogates for personal data and secrets.

Entities are found by pattern.  Each distinct entity (type and canonical form)
gets one surrogate for the whole corpus, drawn from a keyed hash, of the same
type, script and format: digits stay digits, a card number keeps its length
and check digit, a name keeps its gender and script.  Every mention of an
entity gets the same surrogate in the mention's own formatting (coreference):
a person's family name has one surrogate with or without a given name, and a
person introduced with a title is replaced in the whole text, also where the
full name, the family name or the given name stands alone.  Different entities
never share one (distinctness): surrogates that collide
with each other, or with an entity of the corpus, are drawn again until none
collides.  The collision check is a distributed aggregate over distinct
entities; only entities whose first draw collided ever travel to documents.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlab.llm.common import map_arrow, materialize

# --- fixed values: entity patterns and surrogate names ----------------------
_CYR = "А-ЯЁа-яё"
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?<![.-])",
    # the key word in any case, alone or after a prefix that ends in _ or -
    "secret": (r"(?<![^\W_])(?i:password|passwd|pwd|secret|token|api[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?"
               r"(?P<secret_value>[A-Za-z0-9_/+-]{8,})"),
    "key_id": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?![\d-])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "phone": (r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}"
              # without separators; in pairs; in other groups
              r"|\+(?:\d{8,15}|\d{1,3}[ .-]\d{7,12})|\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d(?:[ .-]\d{2}){4}"
              r"|(?=\+(?:[ .()-]{0,2}\d){8})\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]\d{2,4}){2,4}"
              r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)"),
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "name": (r"\b(?P<title>Dr|Prof|Doctor|Professor|Mr|Mrs|Ms|Miss|Sir|Madam|Herr|Frau|Monsieur|Madame|M\.|Mme|Señor|Señora|Sr|Sra|Don|Doña)\.? "
             r"(?P<name_value>[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+(?: [A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)?)(?![\w@])"),
    "name_cyr": (rf"\b(?P<title_cyr>господин|госпожа|Господин|Госпожа|доктор|Доктор|профессор|Профессор) "
                 rf"(?P<name_cyr_value>[А-ЯЁ][а-яё]+(?: [А-ЯЁ][а-яё]+)?)(?![{_CYR}])"),
}
FEMALE_TITLES = {"Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "Госпожа"}
FIRST_NAMES = {
    ("latin", "f"): "Alma Berta Clara Dora Edna Flora Greta Helga Irma Jolan Karla Lydia Mona Nadia Olga Paula Rosa Selma Thea Vera".split(),
    ("latin", "m"): "Abel Boris Cyril Denis Edgar Felix Gustav Hugo Igor Jasper Kurt Lionel Magnus Nils Otto Pablo Ralph Silas Tobias Viktor".split(),
    ("cyrillic", "f"): "Алла Белла Вера Галина Дарья Ева Жанна Зоя Инна Клара Лидия Майя Нина Ольга Полина Рита София Таисия".split(),
    ("cyrillic", "m"): "Антон Борис Вадим Глеб Денис Егор Захар Игорь Кирилл Лев Макар Назар Олег Павел Роман Семён Тимур Фёдор".split(),
}
NEUTRAL_TITLES = {"Dr", "Prof", "Doctor", "Professor", "доктор", "Доктор", "профессор", "Профессор"}
# onset, vowel and coda of an invented syllable; a given name's ending by gender
SOUNDS = {"latin": ("b c d f g h j k l m n p r s t v w z br st tr".split(), "a e i o u".split(), ["", "l", "n", "r", "s", "m"]),
          "cyrillic": ("б в г д ж з к л м н п р с т ф х ц".split(), "а е и о у".split(), ["", "л", "н", "р", "с", "м"])}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "us", ("latin", "n"): "en",
           ("cyrillic", "f"): "а", ("cyrillic", "m"): "ий", ("cyrillic", "n"): "ен"}
# -----------------------------------------------------------------------------

_RE = {k: re.compile(p) for k, p in PATTERNS.items()}
_TITLES = ("Dr", "Prof", "Doctor", "Mr", "Ms", "Miss", "Sir", "Mada", "Herr", "Frau", "Monsieur", "M.", "Mme", "Se\xf1or", "Sr", "Don", "Do\xf1a")
_SECRET_WORDS = re.compile(r"(?i)(?:pass(?:word|wd)|pwd|secret|token|api[_-]?key)\s{0,3}[=:]")
# Digits with the punctuation of numbers: where the numeric kinds can lie.
_NUMBER = re.compile(r"[+(]?\d[\d .()-]*")
_CAPITALISED = re.compile(r"(?<![\w@])(?:[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+|[А-ЯЁ][а-яё]+)(?![\w@])")
_NUMERIC = ("ssn", "card", "ipv4", "phone")


def luhn_digit(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, account: str) -> str:
    """The two check digits of an account number."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def iban_valid(iban: str) -> bool:
    return iban_check(iban[:2], iban[4:]) == iban[2:4]


def _is_ipv6(text: str) -> bool:
    """Four groups at least: shorter forms are clock times, scopes and loopbacks."""
    try:
        return len([g for g in text.split(":") if g]) >= 4 and ipaddress.IPv6Address(text) is not None
    except ValueError:
        return False


def _matches(text: str):
    """(start, order of the kind, kind, match); patterns run only where their marks are."""
    if "@" in text:
        yield from ((m.start(), 0, "email", m) for m in _RE["email"].finditer(text))
    if ("=" in text or ":" in text) and _SECRET_WORDS.search(text):
        yield from ((m.start("secret_value"), 1, "secret", m) for m in _RE["secret"].finditer(text))
    if "AKIA" in text or "ASIA" in text:
        yield from ((m.start(), 2, "key_id", m) for m in _RE["key_id"].finditer(text))
    for run in _NUMBER.finditer(text):
        if run.end() - run.start() >= 7:
            for i, kind in enumerate(_NUMERIC):
                yield from ((m.start(), 3 + i, kind, m) for m in _RE[kind].finditer(text, *run.span()))
    yield from ((m.start(), 2, "iban", m) for m in _RE["iban"].finditer(text) if iban_valid(re.sub(" ", "", m.group())))
    if text.count(":") > 2:
        yield from ((m.start(), 2, "ipv6", m) for m in _RE["ipv6"].finditer(text) if _is_ipv6(m.group()))
    if any(t in text for t in _TITLES):
        yield from ((m.start("name_value"), 8, "name", m) for m in _RE["name"].finditer(text))
    if "оспо" in text or "октор" in text or "рофессор" in text:
        yield from ((m.start("name_cyr_value"), 9, "name_cyr", m) for m in _RE["name_cyr"].finditer(text))


def find(text: str | None):
    """(type, canonical, start, end) of each entity, in order, without overlap.

    A person found after a title is also found where their full name, family name
    or (if one person of the text has it) given name stands without one; the
    canonical form of a given name alone is the full name.
    """
    found, upto = [], 0
    for start, _, kind, m in sorted(_matches(text or ""), key=lambda x: x[:2]):
        if start < upto:
            continue
        raw, end = m.group(), m.end()
        if kind == "secret":
            canonical, end = m["secret_value"], m.end("secret_value")
        elif kind in ("name", "name_cyr"):
            canonical, end = m[kind + "_value"], m.end(kind + "_value")
            title = (m["title"] if kind == "name" else m["title_cyr"]).rstrip(".")
            kind = "name_f" if title in FEMALE_TITLES else "name_n" if title in NEUTRAL_TITLES else "name_m"
        elif kind in ("card", "phone", "ssn"):
            canonical = ("+" if raw[0] == "+" else "") + re.sub(r"\D", "", raw)
        elif kind == "iban":
            canonical = raw.replace(" ", "")
        elif kind == "ipv6":
            canonical = ipaddress.IPv6Address(raw).compressed
        else:
            canonical = raw.lower() if kind == "email" else raw
        upto = end
        found.append((kind, canonical, start, end))
    return _with_repeats(text, found) if any(k.startswith("name_") for k, *_ in found) else found


def _with_repeats(text: str, found: list) -> list:
    """``found`` and the mentions without a title of the persons in it."""
    kinds, family, given = {}, {}, {}
    for kind, name, _, _ in found:
        if kind.startswith("name_"):
            if kinds.get(name, "name_n") == "name_n":   # a title that tells the gender decides
                kinds[name] = kind
            parts = name.split(" ")
            if family.get(parts[-1], "name_n") == "name_n":
                family[parts[-1]] = kind
            if len(parts) == 2:
                given.setdefault(parts[0], set()).add(name)
    found = [(kinds.get(c, k) if k.startswith("name_") else k, c, i, j) for k, c, i, j in found]
    out, at = [], 0
    for entity in [*found, (None, None, len(text), len(text))]:
        upto = at
        for m in _CAPITALISED.finditer(text, at, entity[2]):
            word, start, end = m.group(), m.start(), m.end()
            if start < upto:
                continue
            names = given.get(word, ())
            full = next((n for n in names if text.startswith(n, start) and start + len(n) <= entity[2]
                         and not re.match(r"[\w@]", text[start + len(n):start + len(n) + 1])), None)
            if full:
                upto = start + len(full)
                out.append((kinds[full], full, start, upto))
            elif word in family:
                out.append((kinds.get(word, family[word]), word, start, end))
            elif len(names) == 1:
                name, = names
                out.append((kinds[name], name, start, end))
        out.append(entity)
        at = entity[3]
    return out[:-1]


def parts_of(kind: str, canonical: str):
    """The entities that are drawn for one: a person's given and family name are
    drawn apart, so that the family name is the same with and without the other."""
    if not kind.startswith("name_"):
        return [(kind, canonical)]
    family = canonical.rpartition(" ")[2]
    return [("family", family)] if family == canonical else [(kind, canonical), ("family", family)]


class _Stream:
    """Keyed choices for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest()
        self.block, self.n = int.from_bytes(self.seed, "big"), 0

    def pick(self, choices):
        if self.block < len(choices) << 32:
            self.n += 1
            self.block = int.from_bytes(hashlib.sha256(self.seed + self.n.to_bytes(8, "big")).digest(), "big")
        self.block, r = divmod(self.block, len(choices))
        return choices[r]


_DIGITS = "0123456789"
_HEX = "0123456789abcdef"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _shaped(s: _Stream, text: str) -> str:
    """Digits for digits, letters for letters of the same case and, in
    hexadecimal text, hexadecimal letters."""
    is_hex = len(text) >= 8 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) is not None
    out = []
    for c in text:
        if c.isdigit():
            out.append(s.pick(_DIGITS))
        elif c.isalpha():
            x = s.pick(_HEX[10:] if is_hex else _LOWER)
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def _invented(s: _Stream, script: str, syllables: int, ending: str = "") -> str:
    onset, vowel, coda = SOUNDS[script]
    return "".join(s.pick(onset) + s.pick(vowel) + s.pick(coda) for _ in range(syllables - 1)).capitalize() \
        + (lambda x: x if syllables > 1 else x.capitalize())(s.pick(onset) + (ending or s.pick(vowel) + s.pick(coda)))


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate; of a full name, that of the given name
    (``parts_of``).  A family name is one of some 10^8 at first and each four further
    draws add a syllable, so the draws keep pace with the number of entities."""
    s = _Stream(key, kind, canonical, attempt)
    if kind == "email":
        local, _, domain = canonical.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_shaped(s, local)}@{_shaped(s, host.split('.')[0])}.example.{top if top in ('com', 'org', 'net') else 'com'}"
    if kind == "ipv4":
        return ".".join([s.pick([str(i) for i in range(1, 224)])] + [s.pick([str(i) for i in range(1, 255)]) for _ in range(3)])
    if kind == "card":
        body = canonical[0] + "".join(s.pick(_DIGITS) for _ in canonical[2:])
        valid = luhn_digit(canonical[:-1]) == int(canonical[-1])
        return body + (str(luhn_digit(body)) if valid else s.pick(_DIGITS))
    if kind == "phone":
        if canonical[0] == "+":           # the country's prefix stays; area codes begin with 2 to 9
            n = 2 if len(canonical) > 7 else 1
            if canonical[1] == "1" and len(canonical) == 12:
                return "+1" + s.pick("23456789") + s.pick(_DIGITS) + s.pick(_DIGITS) + "555" + "".join(s.pick(_DIGITS) for _ in range(4)) \
                    if attempt < 64 else "+1" + s.pick("23456789") + "".join(s.pick(_DIGITS) for _ in range(9))
            return canonical[:n + 1] + "".join(s.pick(_DIGITS) for _ in canonical[n + 1:])
        return s.pick("23456789") + "".join(s.pick(_DIGITS) for _ in canonical[1:])
    if kind == "key_id":
        return canonical[:4] + "".join(s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in canonical[4:])
    if kind == "iban":
        account = _shaped(s, canonical[4:])
        return canonical[:2] + iban_check(canonical[:2], account) + account
    if kind == "ipv6":                    # the prefix for documentation
        return ipaddress.IPv6Address((0x20010DB8 << 96) | int("".join(s.pick(_HEX) for _ in range(24)), 16)).compressed
    if kind == "family" or kind.startswith("name_"):
        script = "cyrillic" if re.search(f"[{_CYR}]", canonical) else "latin"
        if kind == "family":
            return _invented(s, script, 3 + attempt // 4)
        if not attempt:
            return s.pick(FIRST_NAMES[script, kind[-1] if kind[-1] in "fm" else s.pick("fm")])
        return _invented(s, script, 2 + attempt // 4, ENDINGS[script, kind[-1]])
    return _shaped(s, canonical)


def dress(kind: str, canonical: str, mention: str) -> str:
    """A surrogate in the formatting of a mention."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(canonical.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "email" and mention.isupper():
        return canonical.upper()
    if kind == "iban":
        letters = iter(canonical)
        return "".join(c if c == " " else next(letters) for c in mention)
    if kind == "ipv6" and mention.isupper():
        return canonical.upper()
    return canonical


def _entities(text):
    return {part for k, c, _, _ in find(text) for part in parts_of(k, c)}


def _mentions(batches):
    for b in batches:
        seen = set().union(*(_entities(t.as_py()) for t in b.column(0)))
        if seen:
            kinds, values = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values)], names=["kind", "canonical"])


def _draw(key: bytes):
    def run(batches):
        for b in batches:
            new = [surrogate(key, *x) for x in zip(*(b.column(c).to_pylist() for c in ("kind", "canonical", "attempt")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kind", "canonical", "attempt")), pa.array(new, pa.string())],
                                             names=["kind", "canonical", "attempt", "surrogate"])
    return run


_MAP_DDL = "kind string, canonical string, attempt int, surrogate string"


def _family():
    # given names must differ among persons of one family name only
    return F.when(F.col("kind").startswith("name_"), F.concat(F.lit("given "), F.substring_index("canonical", " ", -1))) \
        .otherwise(F.col("kind"))


def _own():
    return F.when(F.col("kind").startswith("name_"), F.substring_index("canonical", " ", 1)).otherwise(F.col("canonical"))


def surrogate_map(docs: DataFrame, key: bytes, text: str = "text", max_rounds: int = 1000) -> DataFrame:
    """kind, canonical, attempt, surrogate: one row per distinct entity, every
    surrogate of a kind unlike the others and unlike every entity of that kind."""
    entities = materialize(map_arrow(docs.select(text), _mentions, "kind string, canonical string").distinct(),
                           "pii-entities")
    real = entities.select(_family().alias("family"), _own().alias("surrogate")).distinct()
    drawn = materialize(map_arrow(entities.withColumn("attempt", F.lit(0)), _draw(key), _MAP_DDL), "pii-drawn")
    for round_ in range(max_rounds):
        # the earliest draw keeps a surrogate, then the smallest entity
        first = Window.partitionBy("family", "surrogate").orderBy("attempt", "kind", "canonical")
        ranked = drawn.withColumn("family", _family()).withColumn("rank", F.row_number().over(first))
        taken = real.withColumn("taken", F.lit(True))
        judged = materialize(ranked.join(taken, ["family", "surrogate"], "left")
                             .withColumn("again", (F.col("rank") > 1) | F.coalesce("taken", F.lit(False)))
                             .select("kind", "canonical", "attempt", "surrogate", "again"), "pii-judged")
        if judged.filter("again").isEmpty():
            return drawn
        redrawn = map_arrow(judged.filter("again").select("kind", "canonical", F.lit(round_ + 1).alias("attempt")),
                            _draw(key), _MAP_DDL)
        drawn = materialize(judged.filter("not again").drop("again").unionByName(redrawn), "pii-drawn")
    raise RuntimeError("surrogates kept colliding: the formats leave too few of them")


def _keyed_mentions(batches):
    for b in batches:
        rows = {(i, *e) for i, t in zip(b.column(0).to_pylist(), b.column(1)) for e in _entities(t.as_py())}
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["digest", "kind", "canonical"])


def _new(key: bytes, kind: str, canonical: str, mention: str, attempts: dict) -> str:
    """What a mention becomes."""
    new = [surrogate(key, *e, attempts.get(e, 0)) for e in parts_of(kind, canonical)]
    if not kind.startswith("name_"):
        return dress(kind, new[0], mention)
    return " ".join(new) if mention == canonical else new[0]


def _replace(key: bytes):
    def run(batches):
        for b in batches:
            names = b.schema.names
            out, n, kinds = [], [], []
            for t, redrawn in zip(b.column("__text"), b.column("__redrawn").to_pylist()):
                t = t.as_py()
                attempts = {(r["kind"], r["canonical"]): r["attempt"] for r in redrawn or ()}
                parts, at, found = [], 0, []
                for kind, canonical, i, j in find(t):
                    parts += [t[at:i], _new(key, kind, canonical, t[i:j], attempts)]
                    at = j
                    found.append(kind)
                out.append(t if not found else "".join(parts) + t[at:])
                n.append(len(found))
                kinds.append(sorted(set(found)))
            keep = [c for c in names if not c.startswith("__")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(out, pa.string()), pa.array(n, pa.int64()),
                                               pa.array(kinds, pa.list_(pa.string()))],
                names=[*keep, "__out", "__n", "__kinds"])
    return run


def replace_pii(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_entities and entity_kinds.

    All columns stay (columns named n_entities or entity_kinds are replaced).
    A null text stays null and an empty one empty, with no entities.  Repeated
    rows, and rows with a null or repeated id, are each replaced; an empty
    table stays empty.  Very long texts are read whole, one at a time.  Redrawn
    surrogates reach the rows by a digest of the text, so rows that share an id do
    not meet in one task, and what is gathered for a text is bounded by its mentions.
    """
    mapping = surrogate_map(docs, key, text)
    redrawn = materialize(mapping.filter("attempt > 0").drop("surrogate"), "pii-redrawn")
    plain = docs.drop("n_entities", "entity_kinds")
    # An entity whose first draw collided is rare; the others need no join.
    if redrawn.isEmpty():
        with_redrawn = plain.withColumn(
            "__redrawn", F.lit(None).cast("array<struct<kind:string,canonical:string,attempt:int>>"))
    else:
        mentions = map_arrow(docs.select(F.md5(text).alias("digest"), text), _keyed_mentions,
                             "digest string, kind string, canonical string").distinct()
        per_doc = materialize(
            mentions.join(redrawn, ["kind", "canonical"]).groupBy(F.col("digest").alias("__digest"))
            .agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("__redrawn")), "pii-redrawn")
        with_redrawn = plain.join(per_doc, F.md5(text) == F.col("__digest"), "left").drop("__digest")
    order = plain.columns
    rest = [c for c in order if c != text]
    src = with_redrawn.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)],
                              F.col(text).alias("__text"), "__redrawn")
    ddl = ", ".join(f"c{i} {plain.schema[c].dataType.simpleString()}" for i, c in enumerate(rest))
    out = map_arrow(src, _replace(key), f"{ddl + ', ' if ddl else ''}__out string, __n long, __kinds array<string>")
    named = {c: f"c{i}" for i, c in enumerate(rest)} | {text: "__out"}
    return out.select(*[F.col(named[c]).alias(c) for c in order], F.col("__n").alias("n_entities"),
                      F.col("__kinds").alias("entity_kinds"))
