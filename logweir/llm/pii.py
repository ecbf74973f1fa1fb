"""Personal data replaced by surrogates of the same kind and form.

Found are e-mail addresses, telephone numbers, IPv4, IPv6 and MAC addresses, payment
cards, IBANs, social security numbers, secrets, and names of people (a known
given name before a surname, or a form of address before a surname, then every
later mention of one of these names alone). Every
entity has a canonical form (digits of a number, lower case of an address, the
single words of a name), and the canonical form alone, with the key, decides
the surrogate: the same person, number or address gets the same one in every
document and in every notation. Given names keep gender and script, surnames
the script, letters stay letters of their case and script, digits stay digits,
separators stay, valid checksums stay valid.

Different entities get different surrogates, and no surrogate is an entity of
the corpus: all entities are collected as a distinct table, their surrogates
compared in rounds, and those that meet one another or an original draw again.
Only these exceptions travel to the second pass; it takes them from memory
while they are few (measured), and joins them to the texts otherwise.

A null text stays null, a text without entities stays as it is. Rows are taken
as they are, other columns pass through.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import chunks, written

KEY = b"logweir surrogate key"
EXCEPTIONS_IN_MEMORY = 200_000

# Names by script and gender, surnames by script, forms of address by gender.
GIVEN = {
    ("latin", "f"): "Alice Amelia Anna Barbara Camille Carmen Caroline Charlotte Clara Elena Elizabeth Emily Emma Eva "
    "Hannah Helen Isabel Jane Jennifer Jessica Julia Karen Laura Linda Lisa Louise Lucia Margaret Maria Marie Mary "
    "Michelle Monika Nancy Olivia Patricia Paula Sabine Sandra Sara Sarah Sofia Sophie Susan Ursula".split(),
    ("latin", "m"): "Adam Alexander Andrew Antonio Benjamin Carlos Charles Christopher Daniel David Diego Edward "
    "Francisco George Hans Henri Henry Jack James Javier John Jorge Joseph Juan Karl Klaus Louis Luis Mark Markus "
    "Martin Matthew Michael Miguel Nicolas Oliver Paul Peter Pierre Richard Robert Stefan Thomas William Wolfgang".split(),
    ("cyrillic", "f"): "Анна Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Владимир Дмитрий Иван Михаил Николай Павел Сергей".split(),
    ("greek", "f"): "Άννα Ελένη Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Παύλος".split(),
}
SURNAMES = {
    "latin": "Adler Bauer Becker Bell Bennett Berger Blanc Brandt Brooks Carter Clarke Cole Cooper Cruz Dubois Ellis "
    "Fischer Fontaine Foster Garnier Gibson Graham Hartmann Hayes Hoffmann Howard Keller Lambert Lang Lopez Marchand "
    "Mendoza Meyer Morales Morris Navarro Neumann Owens Palmer Parker Perrin Reed Richter Rivera Rousseau Sanders".split(),
    "cyrillic": "Волков Зайцев Иванов Козлов Лебедев Морозов Новиков Орлов Петров Соколов".split(),
    "greek": "Αλεξίου Γεωργίου Δήμου Νικολάου Παππάς".split(),
}
TITLES = {
    "m": "Mr Sir Herr Monsieur Señor Sr Don".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña".split(),
    "": "Dr Prof Doctor Professor".split(),
}

# More given names that are found; surrogates are not drawn from these.
MORE_GIVEN = {
    ("latin", "f"): "Abigail Agnes Aisha Alejandra Alexandra Alicia Alison Amanda Amy Ana Andrea Angela Anita Anja Anne Annika "
    "Antonia Astrid Audrey Aurélie Beatrice Beatriz Birgit Brenda Brigitte Carla Carol Caterina Catherine Cecilia Céline "
    "Chantal Chiara Christina Christine Claudia Cristina Cynthia Deborah Denise Diana Diane Donna Dorothy Eleanor Élodie "
    "Emilia Erika Esther Eugenia Fatima Federica Fiona Florence Francesca Franziska Françoise Gabriela Giulia Gloria Greta "
    "Heather Heike Heidi Helena Helga Inès Ingrid Irene Isabella Isabelle Ivana Jacqueline Janet Jasmin Joan Joanna Johanna "
    "Josephine Juana Judith Juliette Karin Katharina Katherine Kathleen Katja Kelly Kerstin Kimberly Kirsten Lea Lena Leonie "
    "Lorena Lucy Luisa Magdalena Manon Manuela Marina Marta Martina Mathilde Melanie Melissa Mercedes Mia Miriam Monica "
    "Monique Nadine Natalia Natalie Nathalie Nicole Nina Nora Pamela Pauline Petra Pilar Priya Rachel Rebecca Regina Renate "
    "Rosa Ruth Samantha Sharon Silvia Simone Sonia Stefanie Stephanie Susanne Sylvie Tamara Tanja Teresa Theresa Tina "
    "Valentina Valérie Vanessa Vera Veronica Victoria Virginia Yolanda Yvonne Zoe".split(),
    ("latin", "m"): "Aaron Adrian Ahmed Alan Albert Alberto Alejandro Alessandro Alfred Ali Álvaro Andreas Andrés Anthony "
    "Antoine Arthur Axel Bernd Bernard Bernhard Brandon Brian Bruce Bruno Bryan Carl Christian Claude Colin Craig Damien "
    "Dennis Dieter Dirk Dmitri Dominic Donald Douglas Eduardo Edwin Emilio Emmanuel Enrique Eric Erik Ernesto Ethan Étienne "
    "Fabian Felipe Felix Fernando Florian François Frédéric Friedrich Gabriel Gary Georg Gerald Gerhard Gilles Giovanni "
    "Giuseppe Gonzalo Gregory Guillaume Guillermo Günther Gustavo Harald Harold Heinrich Heinz Helmut Herbert Holger Hugo "
    "Ian Ignacio Igor Ivan Jacob Jacques Jakob Jan Jason Jean Jeffrey Jeremy Jérôme Joachim Johann Johannes Jonas Jonathan "
    "José Joshua Jörg Julien Jürgen Justin Keith Kenneth Kevin Konrad Kurt Larry Laurent Leonardo Lorenzo Lothar Luca "
    "Lucas Lukas Manfred Manuel Marcel Marcelo Marco Mario Mathieu Matthias Maurice Max Maximilian Mohammed Muhammad "
    "Nathan Nicholas Niklas Noah Norbert Olivier Omar Oscar Otto Pablo Pascal Patrick Pedro Philip Philipp Philippe Pierre "
    "Rafael Rainer Ralf Ramón Raphael Raymond Reinhard René Ricardo Roberto Roger Roland Ronald Rudolf Ryan Salvador Samuel "
    "Scott Sebastian Sébastien Sergio Simon Stefano Stephan Stephen Steven Sven Theodor Thierry Thorsten Timothy Tobias "
    "Tomás Ulrich Uwe Vicente Victor Vincent Walter Werner Wilhelm Xavier Yves Zachary".split(),
    ("cyrillic", "f"): "Александра Алина Анастасия Валентина Вера Виктория Галина Дарья Евгения Ксения Людмила Марина Надежда Нина Полина".split(),
    ("cyrillic", "m"): "Антон Артём Борис Виктор Виталий Григорий Денис Евгений Егор Игорь Кирилл Константин Максим Олег Роман".split(),
    ("greek", "f"): "Αικατερίνη Βασιλική Γεωργία Δήμητρα Ειρήνη Ευαγγελία Χριστίνα".split(),
    ("greek", "m"): "Αλέξανδρος Ανδρέας Βασίλης Γεώργιος Ιωάννης Κωνσταντίνος Χρήστος".split(),
}

_GENDER = {name: kind for lists in (MORE_GIVEN, GIVEN) for kind, names in lists.items() for name in names}
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
_SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v".split(), "a e i o u".split()),
    "cyrillic": ("б в г д к л м н п р с т".split(), "а е и о у".split()),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο".split()),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PATTERN = re.compile(
    "|".join(
        f"(?P<{kind}>{pattern})"
        for kind, pattern in (
            ("email", r"(?<![\w.+%-])[\w.+%-]*+(?<=\w)@[\w-]+(?:\.[\w-]+)*\.\w{2,}"),
            ("secret", r"(?<!\w)(?i:token|api[_-]?key|secret|password|passwd|bearer)\b[ \t]*[:=][ \t]*[\"']?[\w+/.~-]*\w[\w+/.~=-]{7,}"),
            ("hexkey", r"(?<!\w)[0-9a-fA-F]{32,}(?!\w)"),
            ("accesskey", r"(?<!\w)(?:(?:AKIA|ASIA)[0-9A-Z]{16}|[sr]k_(?:live|test)_[0-9A-Za-z]{10,})(?!\w)"),
            ("mac", r"(?<![\w:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-])"),
            ("ipv6", r"(?<![\w.])(?<![0-9A-Fa-f]:)(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{0,38}(?:[0-9A-Fa-f]|::)(?!\w|\.\d)"),
            ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
            ("ip", rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"),
            ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
            ("phone", r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<!\w)\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
             r"|(?<![\w.,+-])(?<!\d )(?:1[ -])?[2-9]\d{2} \d{3} \d{4}(?! ?\d|[\w-])"
             # National with a leading 0: nine digits at least, so no date with spaces.
             r"|(?<![\w.,:/+-])(?<!\d )(?=(?:[ -]?\d){9,12}(?! ?\d))0\d{1,4}(?:[ -]\d{2,8}){1,5}(?! ?\d|[\w-])"),
            ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
        )
    )
)
_CLUE = re.compile(r"[@\d]|(?i:token|secret|passw|bearer|api)|AKIA|ASIA|k_live_|k_test_")
_UPPER = "A-ZÀ-ÖØ-ÞΆ-ΫЀ-Я"
_NAMES = re.compile(rf"(?<!\w)[{_UPPER}][\w’'-]*+\.?+(?: [{_UPPER}][\w’'-]*+\.?+)+")
_CAPITAL = re.compile(rf"(?<!\w)[{_UPPER}][\w’'-]*+")
_SECRET_VALUE = re.compile(r"[:=][ \t]*[\"']?(.+)$", re.S)

Part = tuple[int, int, str, str]  # start, end, kind, canonical form


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "greek" if "Ͱ" <= word[0] <= "Ͽ" else "latin"


def _numbers(text: str) -> Iterator[Part]:
    for m in _PATTERN.finditer(text):
        kind, value, start = m.lastgroup, m.group(), m.start()
        if kind == "card":
            digits = re.sub(r"\D", "", value)
            if len(digits) == 16 or luhn(digits):
                yield start, m.end(), kind, digits
        elif kind in ("phone", "ssn"):
            digits = re.sub(r"\D", "", value)
            if 7 <= len(digits) <= 15:
                # The country code is part of the form: it stays.
                head = re.match(r"\+\d{1,3}", value)
                skip = len(head.group()) if head and kind == "phone" else 0
                yield start + skip, m.end(), kind, re.sub(r"\D", "", value[skip:])
        elif kind == "iban":
            flat = value.replace(" ", "")
            if 15 <= len(flat) <= 34 and _iban_rest(flat) == 1:
                yield start, m.end(), kind, flat
        elif kind == "secret":
            inner = _SECRET_VALUE.search(value)
            at = start + inner.start(1)
            secret = inner.group(1)
            yield at, at + len(secret), kind, secret.lower() if re.fullmatch(r"[0-9a-fA-F]+", secret) else secret
        elif kind == "ipv6":
            try:
                canon = ipaddress.IPv6Address(value).exploded
            except ValueError:
                continue
            # Of "a::b" and the like in program text nothing is left: an address has a digit and two groups at least.
            if re.search(r"\d", value) and len([g for g in value.split(":") if g]) > 1:
                yield start, m.end(), kind, canon
        elif kind == "accesskey":
            # What says its kind stays.
            head = 4 if value[0] == "A" else 8
            yield start + head, m.end(), "secret", value[head:]
        elif kind in ("email", "mac", "hexkey"):
            yield start, m.end(), "secret" if kind == "hexkey" else kind, value.lower()
        else:
            yield start, m.end(), kind, value


def _given(word: str) -> tuple[str, str] | None:
    """Script and gender of a given name, also of one all in capitals or of the first of two joined ones."""
    if word in _GENDER or not (word.isupper() or "-" in word):
        return _GENDER.get(word)
    return _GENDER.get(word.title()) or _GENDER.get(word.split("-")[0].title())


def _bare(word: str) -> str:
    """Without what may follow a name: point, quotes, the s of a genitive."""
    word = word.rstrip(".’'-")
    return word[:-2] if word[-2:] in ("’s", "'s") else word


def _people(text: str) -> Iterator[Part]:
    for m in _NAMES.finditer(text):
        words, at = [], m.start()
        for w in m.group().split(" "):
            words.append((at, w))
            at += len(w) + 1
        i = 0
        while i < len(words):
            title = _TITLE.get(words[i][1].rstrip("."))
            after = i if title is None else i + 1
            kind = _given(words[after][1]) if after + 1 < len(words) else None
            if kind:
                start, given = words[after]
                after += 1
            elif title is None or after >= len(words):
                i += 1
                continue
            # First letters of more given names stay; a longer word with a point ends a sentence.
            while after + 1 < len(words) and len(words[after][1]) == 2 and words[after][1][1] == ".":
                after += 1
            at, word = words[after]
            surname = _bare(word)
            if len(surname) > 1 and not (word.endswith(".") and len(surname) < 3):
                if kind:
                    yield start, start + len(given), f"given {kind[0]} {kind[1]}", given.lower()
                yield at, at + len(surname), f"surname {_script(surname)}", surname.lower()
            elif kind:
                yield start, start + len(given), f"given {kind[0]} {kind[1]}", given.lower()
            i = after + 1


def _mentions(text: str, people: list[Part]) -> Iterator[Part]:
    """Later mentions of single names of people that the text names in full."""
    kinds: dict[str, tuple[int, str]] = {}
    for start, _, kind, canon in people:
        kinds.setdefault(canon, (start, kind))
    for m in _CAPITAL.finditer(text):
        bare = _bare(m.group())
        first = kinds.get(bare.lower())
        if first and m.start() > first[0]:
            yield m.start(), m.start() + len(bare), first[1], bare.lower()


def find(text: str | None) -> list[Part]:
    """Entities of a text from left to right; a name gives a part for each of its words."""
    if not text:
        return []
    parts = list(_numbers(text)) if _CLUE.search(text) else []
    people = list(_people(text))
    if people:
        parts += people
        parts += _mentions(text, people)
    parts.sort()
    out: list[Part] = []
    for p in parts:
        if not out or p[0] >= out[-1][1]:
            out.append(p)
    return out


def _stream(key: bytes, kind: str, canon: str, attempt: int) -> Callable[[int], int]:
    """Draws below a bound, the same for the same key and entity."""
    name = f"{kind}\0{canon}\0{attempt}".encode("utf-8", "surrogatepass")
    state = {"block": b"", "n": 0}

    def draw(bound: int) -> int:
        if len(state["block"]) < 8:
            state["block"] += hmac.new(key, name + state["n"].to_bytes(4, "big"), hashlib.sha256).digest()
            state["n"] += 1
        value, state["block"] = state["block"][:8], state["block"][8:]
        return int.from_bytes(value, "big") % bound

    return draw


def _like(char: str, draw: Callable[[int], int], hexadecimal: bool = False) -> str:
    if "0" <= char <= "9" and not hexadecimal:
        return chr(48 + draw(10))
    if hexadecimal and char in "0123456789abcdef":
        return "0123456789abcdef"[draw(16)]
    if not char.isalnum():
        return char
    for first, last in (("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я"), ("α", "ρ"), ("Α", "Ρ"), ("一", "龠"), ("ぁ", "ん"), ("ァ", "ン"), ("가", "힣"), ("א", "ת"), ("ا", "غ")):
        if first <= char <= last:
            return chr(ord(first) + draw(ord(last) - ord(first) + 1))
    return chr((97 if char.islower() else 65) + draw(26)) if char.isalpha() else chr(48 + draw(10))


def surrogate(kind: str, canon: str, attempt: int = 0, key: bytes = KEY) -> str:
    """Canonical form of the surrogate of an entity."""
    draw = _stream(key, kind, canon, attempt)
    what, *more = kind.split(" ")
    if what in ("given", "surname"):
        pool = GIVEN[more[0], more[1]] if what == "given" else SURNAMES[more[0]]
        if attempt < 3:
            return pool[draw(len(pool))].lower()
        # Lists end; made-up names, longer with each further draw, do not.
        consonants, vowels = _SYLLABLES[more[0]]
        return "".join(
            consonants[draw(len(consonants))] + vowels[draw(len(vowels))] for _ in range(2 + attempt // 3)
        )
    if what == "email":
        local, _, domain = canon.rpartition("@")
        name, _, top = domain.rpartition(".")
        local += "a" * (attempt // 10)  # short ones run out
        return f"{''.join(_like(c, draw) for c in local)}@{''.join(_like(c, draw) for c in name)}.{top}"
    if what == "ip":
        octets = []
        for part in canon.split("."):
            # After many draws any octet will do.
            low, high = {1: (0, 9), 2: (10, 99), 3: (100, 255)}[len(part)] if attempt < 10 else (0, 255)
            octets.append(str(low + draw(high - low + 1)))
        return ".".join(octets)
    if what == "ipv6":
        # Zeros at the front of a group stay, so the notation keeps its form; after many draws anything will do.
        groups = []
        for group in canon.split(":"):
            rest = group.lstrip("0") if attempt < 10 else group
            new = "".join(_like(c, draw, True) for c in rest)
            if rest and attempt < 10:
                new = "123456789abcdef"[draw(15)] + new[1:]
            groups.append("0" * (4 - len(rest)) + new)
        return ":".join(groups)
    if what == "iban":
        body = "".join(_like(c, draw) for c in canon[4:])
        return f"{canon[:2]}{98 - _iban_rest(canon[:2] + '00' + body):02d}{body}"
    hexadecimal = what == "mac" or (what == "secret" and re.fullmatch(r"[0-9a-f]+", canon) is not None)
    out = "".join(_like(c, draw, hexadecimal) for c in canon)
    if what == "card":
        out = canon[0] + out[1:]
        if luhn(canon):
            out = next(out[:-1] + d for d in "0123456789" if luhn(out[:-1] + d))
    return out


def fit_form(surface: str, kind: str, value: str) -> str:
    """The surrogate in the notation of the text: separators and case."""
    if kind.split(" ")[0] in ("given", "surname"):
        return value.upper() if surface.isupper() and len(surface) > 1 else value[:1].upper() + value[1:]
    if kind == "email" or (kind == "secret" and surface.lower() != surface and value == value.lower()):
        return value.upper() if surface.isupper() else value
    if kind == "mac":
        return value.upper() if surface.upper() == surface else value
    if kind == "ipv6":
        if len(surface) < 39:
            short = ipaddress.IPv6Address(value).compressed
            value = short if "::" in surface else ":".join(g.lstrip("0") or "0" for g in value.split(":"))
        return value.upper() if surface.upper() == surface else value
    if kind in ("phone", "ssn", "card", "iban"):
        chars = iter(value)
        return "".join(next(chars) if c.isalnum() else c for c in surface)
    return value


def rewrite(text: str | None, parts: list[Part], attempts: dict[tuple[str, str], int], key: bytes = KEY) -> str | None:
    if not parts:
        return text
    out, at = [], 0
    for start, end, kind, canon in parts:
        out += [text[at:start], fit_form(text[start:end], kind, surrogate(kind, canon, attempts.get((kind, canon), 0), key))]
        at = end
    return "".join([*out, text[at:]])


def entities(docs: DataFrame) -> DataFrame:
    """Distinct kind, canon of all texts, distinct in each task before the shuffle."""

    def run(batches):
        seen: set[tuple[str, str]] = set()
        for part in chunks(batches):
            new = {(kind, canon) for t in part["text"] for _, _, kind, canon in find(t)} - seen
            # A task remembers a bounded number; what it forgets is sent twice.
            seen = (seen | new) if len(seen) < 500_000 else new
            yield pd.DataFrame(sorted(new), columns=["kind", "canon"])

    return docs.select(F.col("text").cast("string")).mapInPandas(run, "kind string, canon string").distinct()


def _drawn(pending: DataFrame, key: bytes) -> DataFrame:
    def run(batches):
        for b in batches:
            values = [surrogate(k, c, a, key) for k, c, a in zip(b["kind"], b["canon"], b["attempt"], strict=True)]
            yield b.assign(value=values)

    return pending.mapInPandas(run, "kind string, canon string, attempt int, value string")


def settled(originals: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, canon, attempt, value: all values of a kind differ, none is an original.

    Rounds: of entities with equal surrogates the first by code point keeps it,
    the others, and those whose surrogate is an original or given, draw again.
    """
    taken = originals.select("kind", F.col("canon").alias("value"))
    pending = originals.withColumn("attempt", F.lit(0))
    done: DataFrame | None = None
    while True:
        drawn = written(_drawn(pending, key), "drawn")
        # Among themselves.
        first = drawn.groupBy("kind", "value").agg(F.min("canon").alias("canon"))
        ahead = drawn.join(first, ["kind", "value", "canon"], "left_semi").join(taken, ["kind", "value"], "left_anti")
        if done is not None:
            ahead = ahead.join(done, ["kind", "value"], "left_anti")
        ahead = written(ahead, "settled").select("kind", "canon", "attempt", "value")
        done = ahead if done is None else written(done.union(ahead), "settled")
        pending = drawn.join(ahead, ["kind", "canon"], "left_anti").select(
            "kind", "canon", (F.col("attempt") + 1).alias("attempt")
        )
        pending = written(pending, "pending")
        if pending.isEmpty():
            return done


def replace_pii(docs: DataFrame, key: bytes = KEY, in_memory: int = EXCEPTIONS_IN_MEMORY) -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and ``n_entities``."""
    found = written(entities(docs), "entities")
    moved = settled(found, key).where("attempt > 0").select("kind", "canon", "attempt")
    moved = written(moved, "moved")
    columns = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", n_entities long"
    if moved.count() <= in_memory:
        few = {(r["kind"], r["canon"]): r["attempt"] for r in moved.collect()}

        def run(batches):
            for part in chunks(batches):
                parts = [find(t) for t in part["text"]]
                part["text"] = [rewrite(t, p, few, key) for t, p in zip(part["text"], parts, strict=True)]
                part["n_entities"] = [len(p) for p in parts]
                yield part

        return rows.mapInPandas(run, schema)

    # Many exceptions: each text gets its own, by the hash of the text.
    def keys(batches):
        for part in chunks(batches):
            hits = [(h, k, c) for h, t in zip(part["_text"], part["text"], strict=True) for k, c in {p[2:] for p in find(t)}]
            yield pd.DataFrame(hits, columns=["_text", "kind", "canon"])

    hashed = rows.withColumn("_text", F.xxhash64("text"))
    own = (
        hashed.select("_text", "text").mapInPandas(keys, "_text long, kind string, canon string").distinct()
        .join(moved, ["kind", "canon"])
        .groupBy("_text").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("_own"))
    )

    def run_own(batches):
        for part in chunks(batches):
            parts = [find(t) for t in part["text"]]
            own = [{(o["kind"], o["canon"]): o["attempt"] for o in (x if x is not None else ())} for x in part["_own"]]
            part["text"] = [rewrite(t, p, o, key) for t, p, o in zip(part["text"], parts, own, strict=True)]
            part["n_entities"] = [len(p) for p in parts]
            yield part[[*columns, "n_entities"]]

    return hashed.join(own, "_text", "left").select(*columns, "_own").mapInPandas(run_own, schema)
