"""Surrogates for personal data: keyed replacements of the same type, script and format.

Entities are found by pattern and taken apart into tokens (an e-mail address into its local part
and its domain, a titled name into given name and surname), so that whatever shares a token before
shares one after.  A token's surrogate comes from a keyed digest of kind and token: digits become
digits, letters letters of their case and script, card numbers keep their issuer digit and a valid
check digit, names are drawn for gender and script.

Distinct tokens must have distinct surrogates, and none may be a token that really occurs.  All
distinct tokens of the corpus are checked in Spark; those in conflict draw again until none is left.
Everything is a DataFrame operation.  Only documents with an entity are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Sra", "Signora", "Г-жа", "Госпожа")
GIVEN = {
    ("male", "latin"): ("Adrian", "Bruno", "Conrad", "Dario", "Edgar", "Felix", "Gustav", "Hector", "Ivan", "Julian", "Leon", "Marius", "Nestor", "Oscar", "Pablo", "Rufus"),
    ("female", "latin"): ("Adele", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Laura", "Marina", "Nora", "Olivia", "Paula", "Rosa"),
    ("male", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан", "Юрий"),
    ("female", "cyrillic"): ("Алла", "Белла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Кира", "Лидия", "Майя", "Нина", "Ольга", "Раиса", "Юлия"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fal", "gor", "hel", "kin", "lor", "mar", "nes", "par", "ros", "sel", "tam", "ven", "wil", "zan"),
    "cyrillic": ("ба", "ден", "фал", "гор", "хел", "кин", "лор", "мар", "нес", "пар", "рос", "сел", "там", "вен", "вил", "зан"),
}

NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}",
    "secret": r"(?<=(?i:password|passwd|token|secret|api_key)\s{0,2}[=:]\s{0,2}[\"']?)(?=[^\s\"']*\d)[A-Za-z0-9+/_.=-]{8,}(?<!\.)",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "phone": r"(?<!\d)\+\d{1,3}[ -]?\(?\d{2,4}\)?[ -]?\d{3,4}[ -]?\d{3,4}(?!\d)",
    "card": r"(?<!\d)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})\.? {NAME}(?: {NAME})?",
}
ENTITY = "|".join(PATTERNS.values())
# No entity is without one of these; most texts end here.
QUICK = rf"[0-9@]|AKIA|(?<!\p{{L}})(?:{'|'.join(MALE + FEMALE)})\.? \p{{Lu}}"
ROUNDS = 40
GROW = 4  # draws before one may leave the length or prefix of its token
# Marks around entities; where a text has such characters itself, they are escaped meanwhile.
OPEN, CLOSE, ESCAPE = "\x01", "\x02", "\x03"


def kind_of(entity: Column) -> Column:
    first = F.regexp_extract(entity, r"^([^ .]+)", 1)
    return (
        F.when(entity.contains("@"), "email")
        .when(first.isin(*MALE), "male")
        .when(first.isin(*FEMALE), "female")
        .when(entity.rlike("^AKIA[A-Z0-9]{16}$"), "key")
        .when(entity.rlike(r"^\+[\d ()-]+$"), "phone")
        .when(entity.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(entity.rlike(r"^\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}$"), "card")
        .otherwise("secret")
    )


def script_of(token: Column) -> Column:
    return F.when(token.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def tokens_of(entity: Column) -> Column:
    """An entity as pieces (kind, token); those of kind ``text`` stay."""
    kind = kind_of(entity)

    def piece(name: Column | str, token: Column) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("kind"), token.alias("token"))

    title = F.regexp_extract(entity, r"^([^ ]+ )", 1)
    names = F.split(F.substring(entity, F.length(title) + 1, F.length(entity)), " ")
    surname = F.element_at(names, -1)
    given = F.element_at(names, 1)
    given_kind = F.concat(F.lit("given-"), kind, F.lit("-"), script_of(given))
    last = piece(F.concat(F.lit("surname-"), script_of(surname)), surname)
    return (
        F.when(
            kind == "email",
            F.array(
                piece("local", F.substring_index(entity, "@", 1)),
                piece("text", F.lit("@")),
                piece("domain", F.substring_index(entity, "@", -1)),
            ),
        )
        .when(
            kind.isin("male", "female"),
            F.when(F.size(names) > 1, F.array(piece("text", title), piece(given_kind, given), piece("text", F.lit(" ")), last)).otherwise(
                F.array(piece("text", title), last)
            ),
        )
        .otherwise(F.array(piece(kind, entity)))
    )


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte of a hexadecimal digest, from 0, going round."""
    return F.conv(F.substring(digest, F.pmod(i * 2, F.length(digest)) + 1, F.lit(2)), 16, 10).cast("int")


def _letter(c: Column, b: Column) -> Column:
    """A character of the class of ``c``."""

    def pick(letters: str) -> Column:
        return F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))

    return (
        F.when(c.rlike("[0-9]"), pick("0123456789"))
        .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
        .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        .when(c.rlike(r"[а-яё]"), pick("абвгдежзийклмнопрстуфхцчшщыьэюя"))
        .when(c.rlike(r"[А-ЯЁ]"), pick("АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"))
        .when(c.rlike(r"[α-ω]"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
        .when(c.rlike(r"\p{Ll}"), pick("aeiouylrstnmdbgp"))
        .when(c.rlike(r"\p{Lu}"), pick("AEIOUYLRSTNMDBGP"))
        .otherwise(c)
    )


def _same_classes(token: Column, digest: Column) -> Column:
    return F.array_join(F.transform(F.split(token, ""), lambda c, i: _letter(c, _byte(digest, i + 1))), "")


def _hexadecimal(token: Column, digest: Column) -> Column:
    return F.substring(F.repeat(digest, F.ceil(F.length(token) / F.length(digest)).cast("int")), F.lit(1), F.length(token))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits whose last one is the check digit."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
        return total + doubled

    return F.aggregate(places, F.lit(0), add)


def _card(token: Column, digest: Column) -> Column:
    """Issuer digit and separators kept, and the check digit right if it was."""
    drawn = F.concat(F.substring(token, F.lit(1), F.lit(1)), F.substring(_same_classes(token, digest), F.lit(2), F.length(token)))
    digits = F.regexp_replace(drawn, "[ -]", "")
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(F.substring(digits, 1, 15), F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    valid = F.pmod(luhn_sum(F.regexp_replace(token, "[ -]", "")), F.lit(10)) == 0
    return F.when(valid, F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), check)).otherwise(drawn)


def _phone(token: Column, digest: Column) -> Column:
    """Country code kept, the next digit from 2 to 9."""
    head = F.regexp_extract(token, r"^(\+\d{1,3}?[ (-]*)(?=\d)", 1)
    head = F.when(F.regexp_extract(token, r"^(\+\d{1,3}[ (-]+)", 1) != "", F.regexp_extract(token, r"^(\+\d{1,3}[ (-]+)", 1)).otherwise(head)
    rest = F.substring(_same_classes(token, digest), F.length(head) + 2, F.length(token))
    return F.concat(head, (F.pmod(_byte(digest, F.lit(0)), F.lit(8)) + 2).cast("string"), rest)


def _ip(token: Column, digest: Column, attempt: Column) -> Column:
    """Private and loopback prefixes kept while they have room; other octets from 1 to 254."""
    own = F.regexp_extract(token, r"^(10\.|127\.|192\.168\.)", 1)
    wider = F.when(own == "192.168.", "10.").otherwise(own)
    kept = F.when(attempt < GROW, own).when(attempt < 4 * GROW, wider).otherwise("")
    octets = [(F.pmod(_byte(digest, F.lit(2 * i)) * 256 + _byte(digest, F.lit(2 * i + 1)), F.lit(254)) + 1).cast("string") for i in range(4)]
    count = F.size(F.split(kept, r"\.")) - 1
    return F.concat(kept, F.array_join(F.slice(F.array(*octets), count + 1, 4 - count), "."))


def _given(gender: str, script: str, digest: Column, attempt: Column) -> Column:
    """One given name, and one more joined by a hyphen for each further draw."""
    names = F.array(*[F.lit(n) for n in GIVEN[gender, script]])
    return F.array_join(
        F.transform(F.sequence(F.lit(0), attempt), lambda i: F.element_at(names, F.pmod(_byte(digest, i), F.lit(16)) + 1)), "-"
    )


def _surname(script: str, digest: Column, attempt: Column) -> Column:
    parts = F.array(*[F.lit(s) for s in SYLLABLES[script]])
    drawn = F.transform(F.sequence(F.lit(0), attempt + 3), lambda i: F.element_at(parts, F.pmod(_byte(digest, i), F.lit(16)) + 1))
    return F.initcap(F.array_join(drawn, ""))


def _cased(token: Column, drawn: Column) -> Column:
    """In capitals if the token is."""
    return F.when((F.length(token) > 1) & (token == F.upper(token)), F.upper(drawn)).otherwise(drawn)


def surrogate(secret: str, kind: Column, token: Column, attempt: Column) -> Column:
    """The ``attempt``-th draw for a token."""
    digest = F.concat(*[F.sha2(F.concat_ws("|", F.lit(secret), kind, token, attempt.cast("string"), F.lit(part)), 512) for part in ("a", "b")])
    # A short token has few draws of its own length, so later ones are longer.
    grown = F.repeat(F.lit("a"), F.greatest(attempt - (GROW - 1), F.lit(0)))
    drawn = (
        F.when(kind == "card", _card(token, digest))
        .when(kind == "phone", _phone(token, digest))
        .when(kind == "ip", _ip(token, digest, attempt))
        .when(kind == "key", F.concat(F.lit("AKIA"), F.substring(_same_classes(token, digest), F.lit(5), F.length(token))))
        .when((kind == "secret") & token.rlike("^[0-9a-f]+$"), _hexadecimal(F.concat(token, grown), digest))
        .when(
            kind == "domain",
            F.concat(
                _same_classes(F.concat(F.regexp_extract(token, r"^(.*)\.", 1), grown), digest), F.lit("."), F.substring_index(token, ".", -1)
            ),
        )
        .when(kind.isin("local", "secret"), _same_classes(F.concat(token, grown), digest))
    )
    for gender, script in GIVEN:
        drawn = drawn.when(kind == f"given-{gender}-{script}", _cased(token, _given(gender, script, digest, attempt)))
    for script in SYLLABLES:
        drawn = drawn.when(kind == f"surname-{script}", _cased(token, _surname(script, digest, attempt)))
    return drawn.otherwise(_same_classes(token, digest))


def assign(tokens: DataFrame, secret: str) -> DataFrame:
    """(kind, token, surrogate) for distinct (kind, token), without any conflict.

    A draw is given up if the token's own kind really has it as a token, or if another token has
    drawn it: the one with fewer draws keeps it, then the smaller.  A token draws again until it
    keeps its draw, and only rounds with movers cost more than one pass over the distinct tokens.
    """
    real = tokens.select(F.col("kind").alias("real_kind"), F.col("token").alias("real"))
    state = cut(tokens.select("kind", "token", F.lit(0).alias("attempt")))
    for _ in range(ROUNDS):
        drawn = cut(state.withColumn("surrogate", surrogate(secret, F.col("kind"), F.col("token"), F.col("attempt"))))
        owners = drawn.groupBy(F.col("kind").alias("k"), F.col("surrogate").alias("s")).agg(F.min(F.struct("attempt", "token")).alias("owner"))
        judged = (
            drawn.join(owners, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")))
            .join(real, (F.col("kind") == F.col("real_kind")) & (F.col("surrogate") == F.col("real")), "left")
            .withColumn("moves", F.col("real").isNotNull() | (F.col("owner.token") != F.col("token")))
        )
        state = cut(judged.select("kind", "token", (F.col("attempt") + F.col("moves").cast("int")).alias("attempt"), "surrogate", "moves"))
        if state.where("moves").isEmpty():
            return state.select("kind", "token", "surrogate")
        state = state.select("kind", "token", "attempt")
    raise RuntimeError("surrogates still collide; lengthen them")


def with_surrogates(docs: DataFrame, secret: str) -> DataFrame:
    """doc_id, n_entities, text with surrogates, for every document.

    A null text stays null and an empty one empty.  Rows equal in doc_id and text have equal
    results.  ``secret`` keys the draws: the same secret and corpus give the same surrogates.
    """
    base = docs.select("doc_id", "text")
    plain = base.where(~F.coalesce(F.col("text").rlike(QUICK), F.lit(False))).select("doc_id", F.lit(0).cast("long").alias("n_entities"), "text")
    raw = F.col("text")
    for c, name in ((ESCAPE, "3"), (OPEN, "1"), (CLOSE, "2")):
        raw = F.replace(raw, F.lit(c), F.lit(ESCAPE + name))
    marked = F.regexp_replace(F.when(F.col("text").rlike("[\x01-\x03]"), raw).otherwise(F.col("text")), ENTITY, f"{OPEN}$0{CLOSE}")
    parts = (
        base.where(F.coalesce(F.col("text").rlike(QUICK), F.lit(False)))
        .select("doc_id", F.xxhash64("text").alias("print"), F.split(marked, OPEN).alias("parts"))
        .withColumn("entities", F.transform(F.slice("parts", 2, F.size("parts")), lambda p: F.substring_index(p, CLOSE, 1)))
    )
    split = parts.withColumn("tokens", F.transform("entities", tokens_of))
    found = cut(
        split.select("doc_id", "print", F.explode(F.array_distinct(F.flatten("tokens"))).alias("t"))
        .where("t.kind <> 'text'")
        .select("doc_id", "print", "t.kind", "t.token")
        .distinct()
    )
    named = assign(cut(found.select("kind", "token").distinct()), secret)
    entry = F.struct(F.concat_ws("|", "kind", "token").alias("key"), F.col("surrogate").alias("value"))
    maps = found.join(named, ["kind", "token"]).groupBy("doc_id", "print").agg(F.map_from_entries(F.collect_set(entry)).alias("drawn"))
    maps = maps.select(F.col("doc_id").alias("d"), F.col("print").alias("p"), "drawn")
    joined = split.join(maps, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p")), "left")

    def written(part: Column, pieces: Column) -> Column:
        def one(piece: Column) -> Column:
            known = F.element_at(F.col("drawn"), F.concat_ws("|", piece["kind"], piece["token"]))
            return F.when(piece["kind"] == "text", piece["token"]).otherwise(F.coalesce(known, piece["token"]))

        return F.concat(F.array_join(F.transform(pieces, one), ""), F.substring_index(part, CLOSE, -1))

    rest = F.slice("parts", 2, F.size("parts"))
    body = F.concat(F.get("parts", F.lit(0)), F.array_join(F.zip_with(rest, F.col("tokens"), written), ""))
    back = body
    for c, name in ((CLOSE, "2"), (OPEN, "1"), (ESCAPE, "3")):
        back = F.replace(back, F.lit(ESCAPE + name), F.lit(c))
    text = F.when(body.contains(ESCAPE), back).otherwise(body)
    changed = joined.select("doc_id", F.size("entities").cast("long").alias("n_entities"), text.alias("text"))
    return plain.unionByName(changed)
