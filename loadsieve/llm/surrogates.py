"""Personal data: detection and keyed, type-consistent surrogates.

Found are e-mail addresses, phone numbers, IPv4 addresses, card and account numbers of 13 to 19 digits, US social security numbers, IBANs, and names after a title (with
the other mentions of the same names in that text). An entity is its kind and its normal form, so spellings of one number or address are one entity. A surrogate is drawn from
an HMAC of the entity under a secret key and keeps kind and format: punctuation, letter case, length of numbers, country codes, private address ranges, the validity of check
digits, gender and script of names. The same entity gets the same surrogate in all documents.

Distinctness is checked over the whole table: of entities that draw the same surrogate one keeps it, and a surrogate that is itself an entity of the corpus goes to none; the
others draw again, round by round, until all are settled. Every round is a grouped minimum and anti joins of short rows.

Texts move only where they may hold an entity (a digit, an @ or a title); the others pass in place. Spans are joined by a hash of the text, so copies are searched
and rewritten alike. Null texts stay null. Repeated rows are kept. Columns of docs named entities are replaced. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import hmac
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import small_batches, table, unused
from loadsieve.session import saved

#: Titles by the gender that they tell.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Mister", "господин", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "госпожа", "г-жа"),
    "n": ("Dr", "Prof", "Professor"),
}
GENDER = {t: g for g, titles in TITLES.items() for t in titles}
ANY_TITLE = "|".join(sorted(GENDER, key=len, reverse=True))
NAME = r"\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)?"
MAY_HOLD = rf"[0-9@]|(?<![\p{{L}}])(?:{ANY_TITLE})\.?\s+\p{{Lu}}"

PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "phone": r"(?<![\w+.-])(?:(?:(?:\+\d{1,3}|1)[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|(?:\+|00)[1-9](?:\)?[ ./-]?\(?\d){7,14}(?<=\d\d)"
    r"|(?<!/)(?:(?!\d\d[./-]\d\d[./-]\d{4}(?!\d)|\d{3}-\d\d-\d{4}(?![\w-]))\(?0[1-9](?:\)?[ ./-]?\(?\d){7,10}(?<=\d\d)|1?[2-9]\d{9})(?![.:]\d))(?![\w-])",
    "name": rf"(?<!\p{{L}})(?:{ANY_TITLE})\.?\s+({NAME}(?:\s{NAME}){{0,2}})",
}
FINDERS = {kind: regex.compile(p, regex.ASCII if kind != "name" else 0) for kind, p in PATTERNS.items()}
SCRIPTS = ("LATIN", "CYRILLIC", "GREEK")
#: Syllables and endings that names are made of.
SYLLABLES = {
    "LATIN": ("ba", "bel", "cor", "da", "del", "fen", "ga", "hal", "jo", "ka", "lin", "lo", "mar", "mi", "nor", "pe", "ra", "ro", "sal", "ti", "va", "wen"),
    "CYRILLIC": ("ба", "вел", "гор", "да", "дин", "жа", "зор", "ка", "лев", "ми", "мар", "но", "пет", "ра", "сал", "ти", "фё", "ша"),
    "GREEK": ("βα", "γορ", "δη", "ζα", "θεο", "κα", "λεν", "μαρ", "νι", "πε", "ρο", "σα", "τι", "φι", "χα"),
}
ENDINGS = {
    "LATIN": {"m": ("rick", "bert", "ton", "ard"), "f": ("ina", "elle", "ara", "isa"), "n": ("en", "is", "yn", "el"), "family": ("son", "mann", "er", "ez", "ier", "wood")},
    "CYRILLIC": {"m": ("слав", "мир", "ий"), "f": ("ина", "ана", "ия"), "n": ("ша", "ня"), "family": ("ко", "енко", "чук")},
    "GREEK": {"m": ("ος", "ης"), "f": ("ια", "ινη"), "n": ("ι", "ω"), "family": ("ιδη", "ακη", "ου")},
}


def script(word: str) -> str | None:
    name = unicodedata.name(word[0], "")
    return next((s for s in SCRIPTS if name.startswith(s)), None)


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def normal(kind: str, raw: str) -> str | None:
    """An entity's normal form; None if the text only looks like one."""
    digits = "".join(c for c in raw if c.isdigit())
    if kind == "email":
        return raw.lower()
    if kind == "phone":
        if not 8 <= len(digits) <= 15:
            return None
        if digits[0] == "0":  # an international prefix, or a trunk 0 before a number whose country isn't known
            return "+" + digits[2:] if digits[1] == "0" else digits
        return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits if len(digits) == 10 else "+" + digits
    if kind == "iban":
        plain = raw.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and sum(c.isdigit() for c in plain) >= 8 else None
    return digits if kind in ("card", "ssn") else raw


def entities_of(text: str) -> list[tuple[int, int, str, str]]:
    """start, end, kind, normal form; in order, without overlaps. Kinds of names tell gender and script: given:f:LATIN, family::GREEK."""
    found: list[tuple[int, int, str, str]] = []
    known: dict[str, tuple[str, str]] = {}
    for kind, finder in FINDERS.items():
        if kind == "email" and "@" not in text:
            continue
        for m in finder.finditer(text):
            if kind != "name":
                form = normal(kind, m[0])
                if form:
                    found.append((m.start(), m.end(), kind, form))
                continue
            gender = GENDER[regex.match(rf"(?:{ANY_TITLE})", m[0])[0]]
            words = m[1].split()
            for i, word in enumerate(words):
                if s := script(word):
                    known.setdefault(word, ("family", s) if i == len(words) - 1 else (f"given:{gender}", s))
    if known:
        known = {w.upper(): v for w, v in known.items()} | known
        mention = regex.compile(r"(?<![\p{L}'’-])(?:" + "|".join(regex.escape(w) for w in sorted(known, key=len, reverse=True)) + r")(?![\p{L}-])")
        for m in mention.finditer(text):
            role, s = known[m[0]]
            found.append((m.start(), m.end(), f"{role}:{s}" if role != "family" else f"family::{s}", m[0].casefold()))
    chosen, end = [], 0
    for f in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
        if f[0] >= end:
            chosen.append(f)
            end = f[1]
    return chosen


class Draws:
    """Numbers that follow from a key and a text."""

    def __init__(self, key: bytes, of: str) -> None:
        self.key, self.of, self.block, self.pool, self.size = key, of, 0, 0, 1

    def below(self, n: int) -> int:
        if self.size < n << 32:
            self.pool = int.from_bytes(hmac.new(self.key, f"{self.block}|{self.of}".encode(), hashlib.sha256).digest(), "big")
            self.size, self.block = 1 << 256, self.block + 1
        self.pool, drawn = divmod(self.pool, n)
        self.size //= n
        return drawn

    def like(self, text: str) -> str:
        """Letters for letters (lower case ones for any but capitals), digits for digits."""
        letters = "abcdefghijklmnopqrstuvwxyz"
        one = lambda c: str(self.below(10)) if c.isdigit() else letters[self.below(26)].upper() if c.isupper() else letters[self.below(26)] if c.isalpha() else c
        return "".join(map(one, text))


def surrogate(key: bytes, kind: str, form: str, attempt: int) -> str:
    """The normal form that stands for an entity, at the given attempt."""
    draws = Draws(key, f"{kind}|{attempt}|{form}")
    if kind == "email":
        local, domain = form.rsplit("@", 1)
        name, tld = domain.rsplit(".", 1)
        grown = str(attempt) if attempt >= 8 else ""  # short local parts may run out
        return f"{draws.like(local)}{grown}@{Draws(key, f'domain|{domain}').like(name)}.{tld}"
    if kind == "ip":
        octets = form.split(".")
        private = 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] or octets[0] == "172" and 16 <= int(octets[1]) <= 31 else 0
        if private and attempt >= 8:  # a block's room may run out: then any address of 10.0.0.0/8, and at last any public one
            octets, private = (["10"], 1) if attempt < 24 else ([], 0)
        first = [str(1 + draws.below(222))] if not private else []
        while first and first[0] in ("10", "127", "172", "192"):
            first = [str(1 + draws.below(222))]
        kept = octets[:private] + first
        return ".".join([*kept, *(str(1 + draws.below(254)) for _ in range(4 - len(kept)))])
    if kind == "card":
        body = form[0] + draws.like(form[1:-1])
        first = draws.below(10)
        return next(x for e in range(10) if luhn(x := f"{body}{(first + e) % 10}") == luhn(form))
    if kind in ("phone", "ssn"):
        kept = form[:3] if form[0] == "+" else ""
        out = list(draws.like(form[len(kept) :]))
        for at in (0, 3):  # area and exchange codes start as they did: below two, or not
            if not kept and kind == "phone" and at < len(out):
                out[at] = str(2 + draws.below(8)) if form[at] >= "2" else str(draws.below(2))
        if kind == "phone" and form[0] == "0":  # a trunk 0 stays, and no second one comes
            out[:2] = ["0", str(1 + draws.below(9))]
        return kept + "".join(out)
    if kind == "iban":
        body = draws.like(form[4:])
        number = "".join(str(int(c, 36)) for c in body + form[:2] + "00")
        return f"{form[:2]}{98 - int(number) % 97:02d}{body}"
    role, gender, of_script = kind.split(":")
    syllables, ends = SYLLABLES[of_script], ENDINGS[of_script]["family" if role == "family" else gender]
    count = 2 + draws.below(2) + attempt // 4  # grows, so that names never run out
    return "".join(syllables[draws.below(len(syllables))] for _ in range(count)) + ends[draws.below(len(ends))]


def rendered(kind: str, raw: str, stand_in: str) -> str:
    """The surrogate in the spelling of one mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        plain = [c for c in stand_in if c.isalnum()]
        own = sum(c.isalnum() for c in raw)
        spare = iter(([c for c in raw if c.isalnum()][: own - len(plain)] if own > len(plain) else []) + plain)
        return "".join(next(spare) if c.isalnum() else c for c in raw)
    if kind == "ip":
        return stand_in
    if kind == "email":
        return stand_in.upper() if raw.isupper() else stand_in[0].upper() + stand_in[1:] if raw[0].isupper() else stand_in
    return stand_in.upper() if raw.isupper() and len(raw) > 1 else stand_in.capitalize()


def find_entities(texts: DataFrame) -> DataFrame:
    """text_hash, start, end, kind, form, raw of all entities. texts: text_hash, text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = [(h, a, b, kind, form, t[a:b]) for h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for a, b, kind, form in entities_of(t)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["text_hash", "start", "end", "kind", "form", "raw"])

    return texts.select("text_hash", "text").mapInArrow(found, "text_hash string, start int, end int, kind string, form string, raw string")


def assign_surrogates(entities: DataFrame, key: bytes, max_rounds: int = 200) -> DataFrame:
    """kind, form, stand_in for distinct entities (kind, form): no two of a kind share one, and none is an entity itself."""

    def drawn(attempt: int):
        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [surrogate(key, k, f, attempt) for k, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "form", "stand_in"])

        return draw

    space = F.substring_index("kind", ":", 1).alias("space")
    originals = entities.select(space, F.col("form").alias("stand_in"))
    settled: list[DataFrame] = []
    waiting = entities.select("kind", "form")
    for attempt in range(max_rounds):
        tried = saved(waiting.mapInArrow(drawn(attempt), "kind string, form string, stand_in string"), f"drawn-{attempt}")
        winners = tried.groupBy(space, "stand_in").agg(F.min(F.struct("kind", "form")).alias("e"))
        for taken in (originals, *(s.select(space, "stand_in") for s in settled)):
            winners = winners.join(taken, ["space", "stand_in"], "left_anti")
        settled.append(saved(winners.select("e.kind", "e.form", "stand_in"), f"settled-{attempt}"))
        waiting = tried.select("kind", "form").join(settled[-1], ["kind", "form"], "left_anti")
        if waiting.isEmpty():
            return reduce(DataFrame.unionByName, settled)
    raise ValueError("too few surrogates of some kind for its entities")


def replace_entities(docs: DataFrame, key: bytes, text: str = "text", name: str = "entities") -> DataFrame:
    """docs with surrogates in the text, and (in a column of that name, in place of one of docs) what was replaced: kind, start, end in the old text.

    All other columns pass, whatever their names."""
    docs = docs.drop(name)
    edits_of, hash_of = (unused(docs.columns, c) for c in ("edits", "text_hash"))
    may = F.coalesce(F.col(f"`{text}`").rlike(MAY_HOLD), F.lit(False))
    hashed = F.sha2(F.col(f"`{text}`"), 256)
    suspects = docs.where(may)
    mentions = saved(find_entities(suspects.select(hashed.alias("text_hash"), F.col(f"`{text}`").alias("text"))).dropDuplicates(["text_hash", "start"]), "mentions")
    distinct = saved(mentions.select("kind", "form").distinct(), "entities")
    stand_ins = assign_surrogates(distinct, key)
    edits = mentions.join(stand_ins, ["kind", "form"]).groupBy("text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind", "raw", "stand_in"))).alias(edits_of)
    )
    marked = suspects.withColumn(hash_of, hashed).join(edits.withColumnRenamed("text_hash", hash_of), hash_of, "left").drop(hash_of)
    at, width = docs.columns.index(text), len(docs.columns)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for old, edits in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist(), strict=True):
                parts, end = [], 0
                for e in edits or ():
                    parts += [old[end : e["start"]], rendered(e["kind"], e["raw"], e["stand_in"])]
                    end = e["end"]
                out.append("".join([*parts, old[end:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    none = F.array().cast("array<struct<start:int,end:int,kind:string,raw:string,stand_in:string>>")
    marked = marked.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(edits_of), none).alias(edits_of))
    whole = marked.mapInArrow(rewrite, marked.schema).unionByName(docs.where(~may).withColumn(edits_of, none))
    return whole.withColumn(name, F.transform(edits_of, lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end")))).drop(edits_of)


def secret_key(spark: SparkSession) -> bytes:
    """The key of the session's setting loadsieve.surrogate.key; a public one without it, for tests."""
    return (spark.conf.get("loadsieve.surrogate.key", "") or "not secret").encode()


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), secret_key(spark))
    listed = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", F.substring_index(e["kind"], ":", 1), e["start"], e["end"])), ",")
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), listed.alias("entities"))
