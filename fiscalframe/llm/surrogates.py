"""Personal data replaced by keyed surrogates of the same kind and form.

Detected: e-mail addresses, IPv4 addresses, phone, social security and card
numbers, IBANs, secrets (quoted values of token, key, secret or password, and
long runs of hex digits) and names: all name parts behind a title, and the
same parts wherever else that document writes them.

A surrogate comes from an HMAC of kind and canonical value under the caller's
key, so one entity has one surrogate in the whole corpus, however it is
written: ASCII digits only for numbers, lower case for addresses and names, and
name by name for persons, whatever title they carry. Secrets differ by case, so
they stay as they are. All titles seen with a given name decide its gender
together; where they disagree it has none. A surrogate keeps the form: letters
stay letters of their script, digits digits of their script, separators where
they are, capitals of addresses in their places; card numbers and IBANs keep
their check digits right or wrong. A name in capitals gets its surrogate in
capitals.

Different entities must not meet in one surrogate, nor may a surrogate be a
value that occurs in the corpus. All distinct entities are checked against
each other and against all values in Spark; those that collide draw again,
longer where a kind has room, until none is left.

Defined results: a null text stays null. Texts without entities are unchanged.
Of overlapping matches the first one wins, then the longer. Repeated rows are
replaced alike. A column ``n_entities`` of the documents is replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import packed, stored

# Titles and the gender they tell.
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "κ")
FEMALE = ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "κα")
NEUTRAL = ("Dr", "Prof")
# Small words inside names, which stay.
PARTICLES = ("da", "de", "del", "den", "der", "di", "dos", "du", "la", "las", "los", "van", "von", "y", "zu")

_TITLES = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
_NAME_PART = r"\p{Lu}[\p{L}\p{M}]*(?:['’-](?!s(?!\p{L}))\p{L}[\p{L}\p{M}]*)*"
# No upper limits: runs are possessive, or read back from the @.
_DOMAIN = regex.compile(r"[\p{L}\d-]++(?:\.[\p{L}\d-]++)+")
_LOCAL = regex.compile(r"[\p{L}\p{M}\d.+%_-]++", regex.REVERSE)
_NUMBERS = regex.compile(
    r"""
    (?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d))
    |(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
    |(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)
      |\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d))
    |(?P<card>(?<!\d)\d{4}(?:[ -]\d{4}){3}(?!\d)|(?<![\p{L}\d])\d{13,19}(?![\p{L}\d]))
    |(?P<iban>(?<![\p{L}\d])[A-Z]{2}\d{2}(?:[ ]?[A-Z\d]{4}){2,7}(?:[ ]?[A-Z\d]{1,3})?(?![\p{L}\d]))
    """,
    regex.X,
)
_SECRETS = regex.compile(
    r"""(?i:token|secret|password|passwd|api[_-]?key|key)\s*+[=:]\s*+["'](?P<a>[^"'\s]{8,}+)["']|(?<![\p{L}\d])(?P<b>[0-9a-fA-F]{32,}+)(?![\p{L}\d])"""
)
_PART = regex.compile(rf"(?<![\p{{L}}\d]){_NAME_PART}(?![\p{{L}}\d])")
_NAMES = regex.compile(
    rf"(?<![\p{{L}}\d])(?P<title>{_TITLES})\.?[ ]{{1,2}}(?P<name>{_NAME_PART}(?:(?:[ ](?:{'|'.join(PARTICLES)}))*[ ]{_NAME_PART})*+)"
)
_TITLE = regex.compile(rf"(?:{_TITLES})\.?[ ]")
_FIRST = "".join(sorted({t[0] for t in (*MALE, *FEMALE, *NEUTRAL)}))
#: What a text with an entity holds at least. All but secrets and names hold a
#: digit or an @; the titles are tried only where their first letter stands.
#: Digits and white space are those of any script; Java may not know the newest
#: ones yet, to it they are unassigned (Cn).
HINT = rf"[\p{{Nd}}\p{{Cn}}@]|[a-fA-F]{{32}}|[=:][\s\p{{Z}}\p{{Cn}}\x1C-\x1F\x85]*+[\"']|(?=[{_FIRST}])(?:{_TITLES})\.?[ ]"

# Syllables of given names and surnames by script, and how they end by gender.
SYLLABLES = {
    "LATIN": ("ba", "be", "da", "do", "ga", "ka", "la", "le", "li", "ma", "me", "na", "ni", "no", "ra", "re", "ri", "ro", "sa", "ta", "ti", "va"),
    "CYRILLIC": ("ба", "ве", "да", "до", "га", "ка", "ла", "ле", "ли", "ма", "ме", "на", "ни", "но", "ра", "ре", "ри", "ро", "са", "та", "ти", "ва"),
    "GREEK": ("βα", "γε", "δα", "δο", "κα", "λα", "λε", "λι", "μα", "με", "να", "νι", "νο", "ρα", "ρε", "ρι", "ρο", "σα", "τα", "τι", "φα", "χα"),
}
ENDINGS = {
    "LATIN": {"male": "n", "female": "nia", "none": "l", "family": "rd"},
    "CYRILLIC": {"male": "н", "female": "ния", "none": "ль", "family": "рд"},
    "GREEK": {"male": "ς", "female": "νη", "none": "λ", "family": "ρδης"},
}

_SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def _ascii_digits(text: str) -> str:
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def _digit(digit: str, like: str) -> str:
    """The digit in the script of another."""
    return chr(ord(like) - unicodedata.decimal(like) + int(digit))


def canonical(kind: str, text: str) -> str:
    if kind in ("phone", "ssn", "card"):
        return _ascii_digits("".join(c for c in text if c.isdecimal()))
    if kind == "iban":
        return _ascii_digits(text.replace(" ", ""))
    if kind == "ip":
        return _ascii_digits(text)
    return text if kind == "secret" else text.lower()


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical value)`` of all entities, without overlaps."""
    found = []
    at = text.find("@")
    while at >= 0:
        local = _LOCAL.match(text, 0, at)
        domain = _DOMAIN.match(text, at + 1)
        if local and domain:
            start = local.start() + len(local[0]) - len(local[0].lstrip(".-"))
            if start < at:
                found.append((start, domain.end(), "email"))
        at = text.find("@", at + 1)
    for m in _NUMBERS.finditer(text):
        if m.lastgroup != "ip" or all(int(x) < 256 for x in m[0].split(".")):
            found.append((m.start(), m.end(), m.lastgroup))
    for m in _SECRETS.finditer(text):
        found.append((*(m.span("a") if m["a"] else m.span("b")), "secret"))
    known: dict[str, str] = {}
    for m in _NAMES.finditer(text) if _TITLE.search(text) else ():
        gender = "male" if m["title"] in MALE else "female" if m["title"] in FEMALE else "none"
        parts = list(_PART.finditer(text, *m.span("name")))
        for i, p in enumerate(parts):
            # A single name behind a title is a surname.
            kind = "name-family" if i == len(parts) - 1 else f"name-{gender}"
            known.setdefault(p[0].lower(), kind)
            found.append((*p.span(), kind))
    for p in _PART.finditer(text) if known else ():
        if p[0].lower() in known:
            found.append((*p.span(), known[p[0].lower()]))
    out, end = [], 0
    # The sort is stable: what a title tells of a name goes before what is known from elsewhere.
    for start, stop, kind in sorted(found, key=lambda f: (f[0], -f[1])):
        if start >= end:
            out.append((start, stop, kind, canonical(kind, text[start:stop])))
            end = stop
    return out


def _draws(key: bytes, *what: object) -> Iterator[int]:
    """An endless run of numbers that only key and entity decide."""
    seed = hmac.digest(key, "\x1f".join(map(str, what)).encode("utf-8", "surrogatepass"), "sha256")
    n = 0
    while True:
        block = hashlib.sha256(seed + n.to_bytes(4, "big")).digest()
        yield from (int.from_bytes(block[i : i + 4], "big") for i in range(0, 32, 4))
        n += 1


@lru_cache(4096)
def _alike(c: str) -> list[str]:
    """Letters of the same kind and case from the same row of the code table."""
    base = ord(c) & ~31
    script = unicodedata.name(c, "").split(" ")[0]
    near = [chr(x) for x in range(base, base + 32)]
    return [x for x in near if unicodedata.category(x) == unicodedata.category(c) and unicodedata.name(x, "").split(" ")[0] == script]


def _same_form(value: str, draw: Iterator[int]) -> str:
    out = []
    for c in value:
        if c.isdecimal():
            out.append(_digit(str(next(draw) % 10), c))
        elif c.isalpha():
            near = _alike(c)
            out.append(near[next(draw) % len(near)] if near else c)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value; each attempt gives another."""
    # Gender and place decide how a name ends, not what it is drawn from.
    draw = _draws(key, kind.partition("-")[0], value, attempt)
    longer = max(0, attempt - 3)
    if kind.startswith("name-"):
        script = unicodedata.name(value[0], "").split(" ")[0]
        if script not in SYLLABLES:
            return _same_form(value + value[-1] * longer, draw)
        syllables = SYLLABLES[script]
        n = 2 + longer + next(draw) % 2
        return "".join(syllables[next(draw) % len(syllables)] for _ in range(n)) + ENDINGS[script][kind[5:]]
    if kind == "email":
        local, _, domain = value.partition("@")
        *labels, top = domain.split(".")
        # One domain has one surrogate, whoever's address it is in.
        hidden = _same_form(".".join(labels), _draws(key, "domain", ".".join(labels)))
        return f"{_same_form(local + '0' * longer, draw)}@{hidden}.{top}"
    if kind == "ip":
        return ".".join(str(next(draw) % 256) for _ in range(4))
    if kind == "secret":
        # Hex digits stay hex digits.
        for digits in ("0123456789abcdef", "0123456789ABCDEF"):
            if not set(value) - set(digits):
                return "".join(digits[next(draw) % 16] for _ in range(len(value) + longer))
        return _same_form(value + "0" * longer, draw)
    if kind == "iban":
        out = value[:2] + _same_form(value[2:], draw)
        if _iban_rest(value) == 1:
            out = f"{out[:2]}{98 - _iban_rest(out[:2] + '00' + out[4:]):02}{out[4:]}"
        return out
    if kind == "card":
        out = _same_form(value, draw)
        if _luhn(value) == 0:
            out = next(out[:-1] + c for c in "0123456789" if _luhn(out[:-1] + c) == 0)
        return out
    return _same_form(value, draw)


def _cased(original: str, new: str) -> str:
    """Capitals where the original has them; what is longer follows its last letter."""
    upper = [c.isupper() for c in original] + [original[-1:].isupper()] * (len(new) - len(original))
    return "".join(c.upper() if up and len(c.upper()) == 1 else c for c, up in zip(new, upper, strict=False))


def written_like(original: str, kind: str, new: str) -> str:
    """The canonical surrogate in the way this occurrence is written."""
    if kind in ("phone", "ssn", "card", "iban"):
        rest = iter(new)
        places = ((c, next(rest, "") if c.isalnum() else c) for c in original)
        return "".join(_digit(n, c) if c.isdecimal() and n.isdecimal() else n for c, n in places) + "".join(rest)
    if kind == "ip":
        return "".join(_digit(c, original[0]) if c.isdecimal() else c for c in new)
    if kind == "email":
        return "@".join(map(_cased, original.split("@", 1), new.split("@", 1)))
    if kind.startswith("name-"):
        return new.upper() if len(original) > 1 and original.isupper() else new.capitalize()
    return new


def _spans(text: Column) -> Column:
    @F.pandas_udf(_SPAN)
    def found(texts: pd.Series) -> pd.Series:
        names = ("start", "end", "kind", "value")
        return pd.Series([[dict(zip(names, s, strict=True)) for s in detect(t)] if isinstance(t, str) else [] for t in texts], dtype=object)

    return found(text)


def _space(kind: Column) -> Column:
    """Kinds whose values are told apart by their text alone: names are one kind."""
    return F.when(kind.startswith("name-"), "name").otherwise(kind)


def settled(entities: DataFrame) -> DataFrame:
    """One ``(kind, value)`` for each value of a kind; a name's titles decide together what it is."""
    seen = lambda kind: F.bool_or(F.col("kind") == f"name-{kind}")
    told = entities.groupBy(_space(F.col("kind")).alias("space"), "value").agg(
        seen("male").alias("male"), seen("female").alias("female"), seen("none").alias("none")
    )
    role = (
        F.when(F.col("male") & ~F.col("female"), "male")
        .when(F.col("female") & ~F.col("male"), "female")
        .when(F.col("male") | F.col("none"), "none")
        .otherwise("family")
    )
    return told.select(F.when(F.col("space") == "name", F.concat(F.lit("name-"), role)).otherwise(F.col("space")).alias("kind"), "value")


def entity_map(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, value, surrogate)`` for distinct ``(kind, value)``: no two alike, none that is itself a value.

    Names share one space whatever their gender, as they are told apart by their text.
    """

    @F.pandas_udf("string")
    def drawn(kinds: pd.Series, values: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, v, int(n)) for k, v, n in zip(kinds, values, attempts, strict=True)], dtype=object)

    entities = stored(entities.withColumn("space", _space(F.col("kind"))), "entities")
    real = entities.select("space", F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
    done, open_, attempt = None, entities, 0
    while True:
        tried = open_.withColumn("surrogate", drawn("kind", "value", F.lit(attempt)))
        # One holder for each surrogate: the smallest value keeps it.
        first = tried.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "value")).alias("holder"))
        taken = real if done is None else real.unionByName(done.select("space", "surrogate").withColumn("real", F.lit(True)))
        judged = tried.join(first, ["space", "surrogate"]).join(taken.distinct(), ["space", "surrogate"], "left")
        good = F.col("real").isNull() & (F.col("holder") == F.struct("kind", "value"))
        judged = stored(judged.select("kind", "value", "space", "surrogate", good.alias("good")), "judged")
        kept = judged.filter("good").drop("good")
        done = kept if done is None else done.unionByName(kept)
        open_ = judged.filter("not good").select("kind", "value", "space")
        if not open_.limit(1).count():
            return done.select("kind", "value", "surrogate")
        attempt += 1


def pseudonymized(documents: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with all their columns, entities replaced, and ``n_entities``.

    Whoever knows the key can find out what a surrogate stands for: keep it secret.
    """
    body = F.col("_row")[text]
    rows = documents.select(packed(documents).alias("_row")).withColumn("_hint", F.coalesce(body.rlike(HINT), F.lit(False)))
    spans = rows.filter("_hint").withColumns({"_spans": _spans(body), "_hash": F.md5(body)}).filter(F.size("_spans") > 0)
    # Texts that are equal have equal spans, so a copied text counts once.
    found = stored(spans.select("_hash", "_spans").dropDuplicates(["_hash"]), "spans")
    single = found.select("_hash", F.explode("_spans").alias("s")).select("_hash", "s.start", "s.end", "s.kind", "s.value")
    mapping = stored(entity_map(settled(single), key), "surrogates")
    mapping = mapping.select(_space(F.col("kind")).alias("space"), "value", "kind", "surrogate")
    told = single.withColumn("space", _space(F.col("kind"))).drop("kind").join(mapping, ["space", "value"])
    told = told.groupBy("_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("_new"))

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, news: pd.Series) -> pd.Series:
        out = []
        for t, new in zip(texts, news, strict=True):
            parts, at = [], 0
            for s in new:
                parts += [t[at : s["start"]], written_like(t[s["start"] : s["end"]], s["kind"], s["surrogate"])]
                at = s["end"]
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    # Only texts that may hold entities are moved; the others never leave their scan.
    hinted = rows.filter("_hint").withColumn("_hash", F.md5(body)).join(told.hint("merge"), "_hash", "left")
    new = F.when(F.col("_new").isNotNull(), replaced(F.when(F.col("_new").isNotNull(), body).otherwise(""), F.coalesce("_new", F.array().cast(told.schema["_new"].dataType))))
    n = F.coalesce(F.size("_new"), F.lit(0))
    changed = hinted.select(F.col("_row").withField(text, F.coalesce(new, body)).alias("_row"), F.greatest(n, F.lit(0)).alias("_n"))
    same = rows.filter("not _hint").select("_row", F.lit(0).alias("_n"))
    out = changed.unionByName(same)
    kept = [c for c in documents.columns if c != "n_entities"]
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], F.col("_n").alias("n_entities"))
