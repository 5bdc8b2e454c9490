"""Personal data replaced by keyed, type-consistent surrogates; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import prepare, stage

# How personal data and credentials are written, and words of the surrogates.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Госпожа")
GIVEN = {
    ("latin", "m"): "Adam Bruno Carlos David Erik Felix Georg Hugo Ivan Jonas Karl Luis Marco Nils Oscar Paul".split(),
    ("latin", "f"): "Alma Bella Clara Diana Elena Frida Gloria Helga Irene Julia Karin Laura Maria Nora Olga Paula".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Фёдор".split(),
    ("cyrillic", "f"): "Алла Белла Вера Галина Дарья Елена Зоя Инна Кира Лидия Мария Нина Ольга Полина Рита София".split(),
}
SYLLABLES = {
    "latin": "ba del fin gor hal jen kos lam mer nov pet ris sol tar ven wil".split(),
    "cyrillic": "ба дел фин гор хал жен кос лам мер нов пет рис сол тар вен зим".split(),
}
_LUHN_SEPARATED = r"\d{4}(?<s>[ -])\d{4}\k<s>\d{4}\k<s>\d{1,7}|\d{4}(?<z>[ -])\d{6}\k<z>\d{5}"
#: Addresses with "::". One group has three or more digits, as in every range given out; "::1", "x[1::2]" and "a::b" have none.
_SHORT_IP = (r"(?=[0-9A-Fa-f]{0,4}:)(?<![\p{L}\p{N}_:.])(?=[0-9A-Fa-f:]{0,36}[0-9A-Fa-f]{3})(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::"
             r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\p{L}\p{N}_:]|\.\d)")
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])",
    "secret": r"(?<!\p{L})(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
              r"(?=[^\s\"'<>]{0,200}\d)[^\s\"'<>]{6,}",
    "key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,255}|sk-[A-Za-z0-9_-]{20,255}|"
           r"xox[baprs]-[A-Za-z0-9-]{10,255})(?![A-Za-z0-9])|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{1,20000}"
           r"-----END [A-Z ]{0,20}PRIVATE KEY-----",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?!\d)|"
             r"\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\d)|\+\d{9,15}(?!\d)",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)|"
          r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|" + _SHORT_IP,
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": rf"(?<!\d)(?:{_LUHN_SEPARATED}|\d{{13,19}})(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(MALE_TITLES + FEMALE_TITLES)})\.? \p{{Lu}}[\p{{Ll}}'’-]+(?: \p{{Lu}}[\p{{Ll}}'’-]+){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Every entity holds one of these, and few texts do.
HINT = r"[0-9@]|-----BEGIN|AKIA|ASIA|gh[pousr]_|sk-|xox[baprs]-|:[0-9A-Fa-f]{0,4}:|(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + r")\.? "


def _kind() -> Column:
    """The kind of ``entity``; NULL for digits that fail the card check, which stay."""
    tests = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        # Look-arounds hold at the ends of the lone entity.
        hit = F.regexp_like("entity", F.lit(f"^(?:{pattern})$"))
        if kind == "card":
            hit = hit & F.expr("luhn_check(regexp_replace(entity, '[ -]', ''))")
        tests = F.when(hit, kind).otherwise(tests)
    return tests


def _atoms() -> Column:
    """The parts of ``entity`` to replace, in order: (lead, kind, raw); the lead before each part is kept."""
    def atom(lead, kind, raw):
        return F.struct(lead.alias("lead"), kind.alias("kind"), raw.alias("raw"))

    empty, none = F.lit(""), F.lit(None).cast("string")
    lead = F.regexp_extract("entity", r"^([\p{L}_-]+[\"']?\s*[=:]\s*[\"']?)", 1)
    secret = atom(lead, F.lit("secret"), F.substring(F.col("entity"), F.length(lead) + 1, F.length("entity")))
    title = F.regexp_extract("entity", r"^([\p{L}]+\.? )", 1)
    words = F.split(F.substring(F.col("entity"), F.length(title) + 1, F.length("entity")), " ")
    gender = F.when(F.regexp_extract("entity", r"^(\p{L}+)", 1).isin(*MALE_TITLES), "m").otherwise("f")
    names = F.transform(words, lambda w, i: atom(
        F.when(i == 0, title).otherwise(" "),
        F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), gender)), w))
    return F.when(F.col("kind") == "secret", F.array(secret)).when(F.col("kind") == "name", names).otherwise(
        F.array(atom(empty, F.coalesce("kind", none), F.col("entity"))))


def _norm() -> Column:
    """What two mentions of one thing share: digits of numbers (of phones the last ten), lower case of words."""
    digits = F.regexp_replace("raw", "[^0-9]", "")
    return F.when(F.col("kind") == "phone", F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits)).when(
        F.col("kind").isin("card", "ssn"), digits).when(
        F.col("kind") == "iban", F.regexp_replace("raw", " ", "")).when(
        F.col("kind").isin("secret", "key"), F.col("raw")).otherwise(F.lower("raw"))


def _byte(i: Column) -> Column:
    """Keyed byte number ``i`` of the row's digest."""
    return F.conv(F.substring(F.col("digest"), 2 * F.pmod(i, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")


def _in_class(c: Column, i: Column, hexed: Column) -> Column:
    """A keyed character of the class, case and script of ``c``; other characters stay."""
    b, code = _byte(i), F.ascii(c)

    def letter(first: str, n: int) -> Column:
        return F.substring(F.lit("".join(chr(ord(first) + k) for k in range(n))), F.pmod(b, F.lit(n)) + 1, F.lit(1))

    hexes = F.substring(F.lit("0123456789abcdef"), F.pmod(b, F.lit(16)) + 1, F.lit(1))
    upper = c != F.lower(c)
    return (F.when(hexed & F.regexp_like(c, F.lit("[0-9a-fA-F]")), F.when(upper, F.upper(hexes)).otherwise(hexes))
            .when((code >= 48) & (code <= 57), letter("0", 10))
            .when((code >= 97) & (code <= 122), letter("a", 26))
            .when((code >= 65) & (code <= 90), letter("A", 26))
            .when(F.regexp_like(c, F.lit(r"\p{IsCyrillic}")), F.when(upper, letter("А", 32)).otherwise(letter("а", 32)))
            .when(F.regexp_like(c, F.lit(r"\p{IsGreek}")), F.when(upper, letter("Α", 17)).otherwise(letter("α", 17)))
            .when(F.regexp_like(c, F.lit(r"\p{IsHan}")), letter("一", 256))
            .when(F.regexp_like(c, F.lit(r"\p{IsHiragana}")), letter("あ", 64))
            .when(F.regexp_like(c, F.lit(r"\p{IsKatakana}")), letter("ア", 64))
            .when(F.regexp_like(c, F.lit(r"\p{L}")), F.when(upper, letter("A", 26)).otherwise(letter("a", 26)))
            .otherwise(c))


def _mapped(text: Column, hexed: Column | None = None, shift: int = 0) -> Column:
    flag = hexed if hexed is not None else F.lit(False)
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _in_class(c, i + shift, flag)), "")


def _pick(words: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), F.pmod(_byte(i), F.lit(len(words))) + 1)


def _surrogate() -> Column:
    """The surrogate of (kind, norm) for the row's attempt, from ``digest``."""
    norm, attempt = F.col("norm"), F.col("attempt")
    # Addresses keep their shape; the last two labels become a reserved domain under the same ending.
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    ending = F.substring_index(domain, ".", -1)
    before = F.regexp_extract(domain, r"^(.*?)[^.]+\.[^.]+$", 1)
    email = F.concat(_mapped(local), F.lit("@"), _mapped(before, shift=23), F.lit("example."), ending)
    plain_hex = F.regexp_like(norm, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)[^A-Za-z0-9]*$"))
    key_lead = F.regexp_extract(norm, r"^(AKIA|ASIA|gh[pousr]_|sk-|xox[baprs]-|-----BEGIN [A-Z ]*-----)", 1)
    key_tail = F.regexp_extract(norm, r"(-----END [A-Z ]*-----)$", 1)
    key_body = F.substring(norm, F.length(key_lead) + 1, F.length(norm) - F.length(key_lead) - F.length(key_tail))
    key = F.concat(key_lead, _mapped(key_body), key_tail)
    ip = F.when(F.contains(norm, F.lit(":")), _mapped(norm, F.lit(True))).otherwise(F.array_join(F.transform(
        F.array(*[F.lit(k) for k in range(4)]), lambda k: (1 + F.pmod(_byte(k), F.lit(254))).cast("string")), "."))
    # Cards keep the first digit and end in the digit that makes the check pass.
    stem = F.concat(F.substring(norm, 1, 1), _mapped(F.substring(norm, F.lit(2), F.length(norm) - 2)))
    last = F.filter(F.array(*[F.lit(str(k)) for k in range(10)]),
                    lambda d: F.call_function("luhn_check", F.concat(stem, d)))
    card = F.concat(stem, F.get(last, 0))
    # Account numbers keep the country; the two check digits follow from the rest (ISO 7064, mod 97).
    body = _mapped(F.substring(norm, F.lit(5), F.length(norm)))
    country = F.substring(norm, 1, 2)
    rest = F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), lambda a, c: F.pmod(
        F.when(F.ascii(c) >= 65, a * 100 + F.ascii(c) - 55).otherwise(a * 10 + F.ascii(c) - 48), F.lit(97)))
    iban = F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body)
    phone = F.concat(F.substring(norm, 1, 1), _mapped(F.substring(norm, F.lit(2), F.length(norm))))
    script = F.when(F.regexp_like(norm, F.lit(r"\p{IsCyrillic}")), "cyrillic").otherwise("latin")

    def given(gender: str) -> Column:
        def name(s: str) -> Column:
            return F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda i: _pick(GIVEN[s, gender], i)), "-")
        return F.when(script == "cyrillic", name("cyrillic")).otherwise(name("latin"))

    def surname(s: str) -> Column:
        return F.initcap(F.array_join(F.transform(
            F.sequence(F.lit(0), attempt + 2), lambda i: _pick(SYLLABLES[s], i)), ""))

    out = _mapped(norm)
    for kind, value in (("email", email), ("secret", F.when(plain_hex, _mapped(norm, F.lit(True))).otherwise(_mapped(norm))),
                        ("key", key), ("ip", ip), ("card", card), ("iban", iban), ("phone", phone),
                        ("given_m", given("m")), ("given_f", given("f")),
                        ("surname", F.when(script == "cyrillic", surname("cyrillic")).otherwise(surname("latin")))):
        out = F.when(F.col("kind") == kind, value).otherwise(out)
    return out


def _poured() -> Column:
    """``surrogate`` in the format of ``raw``: its separators between the digits, its upper case, its spaces."""
    count = lambda text: F.length(F.regexp_replace(text, "[^0-9]", ""))
    before = count(F.col("raw")) - F.length("surrogate")  # digits of a country code, which stay
    nth = lambda i: count(F.substring(F.col("raw"), F.lit(1), i + 1)) - before
    digits = F.array_join(F.transform(F.split("raw", ""), lambda c, i: F.when(
        F.regexp_like(c, F.lit("[0-9]")) & (nth(i) > 0), F.substring(F.col("surrogate"), nth(i), F.lit(1))).otherwise(c)), "")
    spaced = F.when(F.contains("raw", F.lit(" ")), F.trim(F.regexp_replace("surrogate", "(.{4})", "$1 "))).otherwise(
        F.col("surrogate"))
    shout = (F.upper("raw") == F.col("raw")) & (F.lower("raw") != F.col("raw")) & (F.length("raw") > 1)
    return (F.when(F.col("kind").isin("phone", "card", "ssn"), digits).when(F.col("kind") == "iban", spaced)
            .when(F.col("kind").isin("secret", "key"), F.col("surrogate"))
            .when(shout, F.upper("surrogate")).otherwise(F.col("surrogate")))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate): one row per distinct (kind, norm), all surrogates of a kind distinct and none of them real.

    Whoever shares a surrogate with another entity, or drew one that some text really holds, draws again with the next
    attempt number; the rest stay. Draws depend on the key alone, not on the order of the data.
    """
    state = entities.select("kind", "norm").distinct().withColumn("attempt", F.lit(0))
    drawn = stage(_draw(state, key), "surrogates")
    while True:
        real = drawn.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        first = drawn.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        clash = drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left").where(
            F.coalesce("real", F.lit(False)) | ((F.col("n") > 1) & (F.col("first.norm") != F.col("norm"))))
        again = stage(clash.select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "clashes")
        if again.isEmpty():
            return drawn.select("kind", "norm", "surrogate")
        kept = drawn.join(again.select("kind", "norm"), ["kind", "norm"], "left_anti")
        drawn = stage(kept.unionByName(_draw(again, key)), "surrogates")


def _draw(state: DataFrame, key: str) -> DataFrame:
    seed = F.concat_ws("\u0000", F.lit(key), "kind", "norm", F.col("attempt").cast("string"))
    return state.withColumn("digest", F.sha2(seed, 512)).withColumn("surrogate", _surrogate()).drop("digest")


def found_in(text_col: str = "text") -> Column:
    """All entities of a text in order, overlapping none; the hint only saves time."""
    text = F.col(text_col)
    none = F.array().cast("array<string>")
    return F.when(F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(PATTERN), 0)).otherwise(none)


def anonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
              count_col: str | None = None) -> DataFrame:
    """``docs`` with every detected entity of ``text_col`` replaced; ``count_col`` adds how many were.

    Kinds: e-mail addresses, credentials, phone, social-security, account and card numbers (with their check digits), network
    addresses, and names after a title. Equal entities (case and separators aside) get equal surrogates in all texts, different ones
    different surrogates. Numbers that fail the card check are no cards and stay, and so does all other text. A surname keeps its
    surrogate with or without a given name; names without a title are not detected. NULL text stays NULL, repeated rows are
    treated alike, an empty table gives no rows, and other columns are passed on, whatever their names; only a column named as
    ``count_col`` gives way to the count.
    """
    prepare(docs.sparkSession)
    columns = docs.columns
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(text_col).alias("text"))
    found = plain.withColumn("found", F.coalesce(found_in(), F.array().cast("array<string>")))
    some = stage(found.where(F.size("found") > 0).withColumn("row", F.monotonically_increasing_id()), "entities")
    atoms = some.select("row", F.posexplode("found").alias("pos", "entity")).withColumn("kind", _kind()).select(
        "row", "pos", F.posexplode(_atoms()).alias("sub", "atom")).select(
        "row", "pos", "sub", "atom.lead", "atom.kind", "atom.raw").withColumn("norm", _norm())
    atoms = stage(atoms, "atoms")
    known = surrogates(atoms.where("kind IS NOT NULL"), key)
    new = atoms.join(known, ["kind", "norm"], "left").select(
        "row", "pos", "sub", F.concat("lead", F.coalesce(F.when(F.col("surrogate").isNotNull(), _poured()), "raw")).alias("new"),
        F.col("surrogate").isNotNull().alias("hit"))
    entity = new.groupBy("row", "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "new"))), lambda x: x["new"]), "").alias("new"),
        F.max("hit").alias("hit"))
    per_text = entity.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("new"),
        F.sum(F.col("hit").cast("long")).alias("hits"))
    between = F.split("text", PATTERN, -1)
    rebuilt = F.array_join(F.zip_with(between, "new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = some.join(per_text, "row").select("doc", rebuilt.alias("text"), "hits")
    same = found.where(F.size("found") == 0).select("doc", "text", F.lit(0).cast("long").alias("hits"))
    rows = same.union(changed)
    out = [F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in columns if c != count_col]
    return rows.select(*out, *([F.col("hits").alias(count_col)] if count_col else []))
