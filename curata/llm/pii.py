"""Surrogates for personal data (operator 2), in DataFrame expressions only.

1. One regular expression finds the entities of every whole text: e-mail
   addresses, phone and card numbers, social security numbers, IP
   addresses, secrets after their key, and names after titles.
2. An entity's canonical form (lower case, digits only, ...) is its identity:
   all its mentions, however written, get the same surrogate (coreference).
   Only distinct (kind, canonical) pairs travel on.
3. A surrogate is drawn from a keyed hash of the pair and an attempt number:
   letters become letters of the same script and case, digits digits, marks
   stay; a card that passes the Luhn check keeps passing it; given names come
   from the list of the title's gender and the name's script.
4. Collision check: a surrogate that is taken by another entity of its kind,
   or that equals a real entity of the corpus, is drawn again (longer from the
   third attempt on), until all are distinct.
5. The surrogates are joined to the mentions and poured into the format of
   each mention (its case, and its separators between digits).

Only mentions and distinct entities are shuffled, and the texts that hold
any; all other texts pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.quality_cascade import let
from curata.session import checkpoint_dir, scratch_path

KEY = "surrogate-key-1"    # for tests and the registered query only: who knows the key can compute surrogates of guessed entities

#: Titles that tell a person's gender, by language.
MALE_TITLES = ["Mr", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Don", "Sr", "Signor", "Sig", "Senhor", "Dhr", "Pan", "г-н", "господин", "κύριος", "κ"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Doña", "Sra", "Srta", "Signora", "Signorina", "Senhora", "Mevr", "Pani", "г-жа", "госпожа", "κυρία", "κα"]
#: Titles of any gender; given names after these alone come from both lists.
NEUTRAL_TITLES = ["Dr", "Dra", "Doctor", "Docteur", "Doktor", "Prof", "Professor", "Professeur", "Profesor", "Profesora"]

#: Given names by script and gender; surnames are made of syllables.
GIVEN = {
    "latin": {"m": "Adrian Bruno Clement David Emil Felix Gabriel Hugo Ivan Julian Konrad Leon Martin Noel Oscar Paul",
              "f": "Alice Bianca Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula"},
    "cyrillic": {"m": "Алексей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Семён",
                 "f": "Алина Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Марина Нина Ольга Полина Раиса Софья"},
    "greek": {"m": "Αλέξης Βασίλης Γιώργος Δημήτρης Ευγένιος Ζήσης Ηλίας Θωμάς Ιάσων Κώστας Λάμπρος Μάριος Νίκος Παύλος Σταύρος Τάσος",
              "f": "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λίνα Μαρία Νίκη Ολυμπία Πηνελόπη Σοφία"},
}
SYLLABLES = {"latin": "ba bel dor fan gar hol jen kar lin mor nel pas rin sol tam ver", "cyrillic": "ба бел дор фан гар хол жен кар лин мор нел пас рин сол там вер",
             "greek": "βα βελ δορ φαν γαρ χολ ζεν καρ λιν μορ νελ πας ριν σολ ταμ ξερ"}

#: Alphabets that a character is replaced within.
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "äöüßàâæçéèêëîïôœùûñáíóúìò", "ÄÖÜÀÂÆÇÉÈÊËÎÏÔŒÙÛÑÁÍÓÚÌÒ"]

_NAME = r"\p{Lu}(?:[\p{L}-]|['’](?=\p{L})(?!s(?!\p{L})))*+"       # O'Neil's: without the genitive
_TITLES = "|".join(sorted(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES, key=len, reverse=True))
_BEFORE_NAME = rf"(?:(?:(?:{_TITLES})\.?|MM?\.)\x20)++"       # "Frau Prof. Dr. "; M. needs its dot
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.)+\p{L}{2,24}"
_NORTH_AMERICAN = r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\p{L}\p{N}.-])[2-9]\d\d[2-9]\d{6}(?![\p{L}\p{N}])"
_STEP = r"(?:[ ./-]|\x20?\(|\)[ ./-]?)?\d"        # a digit of a number in groups
#: Not a date, nor a card number.
_NO_PHONE = r"(?!\d{2}[ ./-]\d{2}[ ./-](?:19|20)\d{2}(?!\d)|(?:\d{4}[ -]){3}\d|\d{13})"
_INTERNATIONAL = rf"(?<![\p{{L}}\p{{N}}])\+\d(?:{_STEP}){{7,14}}(?<=\d\d)(?!\d)"
_NATIONAL = rf"(?=[(0])(?<![\p{{L}}\p{{N}}])(?<!\d[./:,-])(?:{_NO_PHONE}0[1-9](?:{_STEP}){{7,10}}|{_NO_PHONE}00[1-9](?:{_STEP}){{7,12}}|\(0\d{{1,5}}\)[ ./-]?\d(?:[ ./-]?\d){{4,9}})(?<=\d\d)(?![\p{{L}}\p{{N}}])"
PHONE = rf"{_NORTH_AMERICAN}|{_INTERNATIONAL}|{_NATIONAL}"
#: Country codes; numbers with and without one share the digits behind it.
_COUNTRY = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
CARD = r"(?<![\p{L}\p{N}.])(?:\d{4}[ -]){3}\d{1,7}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}.])\d{13,19}(?![\p{L}\p{N}])"
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
IP6 = (r"(?=[0-9A-Fa-f:])(?<![\p{L}\p{N}:.])(?=[A-Fa-f:]{0,8}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
       r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])")
_SECRET_KEY = r"""(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key)["']?\s{0,3}[=:]\s{0,3}"""
#: In quotes, or a word with a digit; of any length.
SECRET = (rf"""(?<={_SECRET_KEY}["'])[^\s"']{{6,}}+(?=["'])"""
          rf"""|(?<=[=:\s])(?<={_SECRET_KEY})(?=[^\s"'&,;<>\d]*+\d)[^\s"'&,;<>]{{5,}}[^\s"'&,;<>.!?)]""")
#: Country, two check digits, then 11 to 30 letters and digits, in groups of four or in one piece.
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?)(?![\p{L}\p{N}])"
NAME = rf"(?<![\p{{L}}\p{{N}}]){_BEFORE_NAME}{_NAME}(?:\x20{_NAME}){{0,2}}"
#: In this order; an entity is of the first kind whose expression matches it as a whole.
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "ssn": SSN, "phone": PHONE, "ip": IP, "ip6": IP6, "card": CARD, "name": NAME}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Cheap signs, one of which every entity has: texts without are not searched further.
_SIGN = "[@0-9]"
_SECRET_SIGN = "(?=[tspaTSPA])(?i:token|secret|passw|api[_-]?key|access[_-]?key)"
_TITLE_SIGN = rf"(?=[{''.join(sorted({t[0] for t in [*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES, 'M']}))}])(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLES})\.?|MM?\.)\x20\p{{Lu}}"

_KIND_OF = [("email", "@"), ("iban", r"^[A-Z]{2}\d{2}\x20?[A-Z0-9]{4}[\x20A-Z0-9]{7,36}$"), ("name", rf"^{_BEFORE_NAME}"), ("ssn", r"^\d{3}-\d{2}-\d{4}$"), ("ip", rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"),
            ("phone", rf"^(?:\+[\d()./ -]{{8,45}}|\(?\d{{3}}\)?[ .-]{{0,2}}\d{{3}}[ .-]\d{{4}}|[2-9]\d{{9}}|{_NO_PHONE}\(?0[\d()./ -]{{6,45}})$"),
            ("ip6", r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$"), ("card", r"^[\d -]{13,23}$")]


def mentions(text: Column) -> Column:
    """The entities of a whole text in order (array of strings; null and plain texts: empty)."""
    none = F.array().cast("array<string>")
    quoted = (text.contains('"') | text.contains("'")) & text.rlike(_SECRET_SIGN)
    return F.coalesce(F.when(text.rlike(_SIGN) | quoted | text.rlike(_TITLE_SIGN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))), none)


def kind_of(e: Column) -> Column:
    k = F.lit("secret")
    for name, pattern in reversed(_KIND_OF):
        k = F.when(e.rlike(pattern), F.lit(name)).otherwise(k)
    return k


def script_of(e: Column) -> Column:
    return F.when(e.rlike(r"\p{IsCyrillic}"), "cyrillic").when(e.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def parts(e: Column) -> Column:
    """The replaceable parts of a mention: ``(kind, canonical, written)``; a name has one for each of its words, others just one.

    The last word of a name is its family name, the others are given names of
    the title's gender, so "Mr John Smith" and "Mr Smith" share a surname.
    """
    words = F.split(F.regexp_replace(e, rf"^{_BEFORE_NAME}", ""), " ")
    some = lambda titles: e.rlike(rf"^(?:(?:{_TITLES})\.?\x20)*(?:{'|'.join(titles)})\x20")
    gender = F.when(some([rf"{t}\.?" for t in FEMALE_TITLES]), "f").when(some([*(rf"{t}\.?" for t in MALE_TITLES), r"MM?\."]), "m").otherwise("n")
    given = F.concat(F.lit("given_"), gender)
    of_name = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, F.lit("family")).otherwise(given).alias("kind"), F.lower(w).alias("canonical"), w.alias("written")))
    digits = F.regexp_replace(e, r"\D", "")
    kind = kind_of(e)
    # a phone number without its country code and the 0 before an area code
    north_american = e.rlike(rf"^(?:{_NORTH_AMERICAN})$") | e.rlike(r"^\+\D*1(?:\D*\d){10}$")
    behind = F.regexp_replace(F.regexp_replace(digits, r"^00", ""), _COUNTRY, "")
    national = F.regexp_replace(F.when(e.rlike(r"^(?:\+|00)"), behind).otherwise(digits), "^0", "")
    phone = F.when(north_american, F.right(digits, F.lit(10))).otherwise(national)
    canonical = (F.when(kind == "email", F.lower(e)).when(kind == "phone", phone).when(kind == "ip6", _groups_of(e))
                 .when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.regexp_replace(e, " ", "")).otherwise(e))
    return F.when(kind == "name", of_name).otherwise(F.array(F.struct(kind.alias("kind"), canonical.alias("canonical"), e.alias("written"))))


def _groups_of(ip6: Column) -> Column:
    """The eight groups of an IPv6 address, lower case and without leading zeros, joined by colons."""
    some = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    left, right = some(F.substring_index(ip6, "::", 1)), some(F.substring_index(ip6, "::", -1))
    zeros = F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right))
    groups = F.when(ip6.contains("::"), F.concat(left, zeros, right)).otherwise(F.split(ip6, ":"))
    return F.lower(F.array_join(F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":"))


def _bytes(seed: Column, n: Column) -> Column:
    """``n`` keyed pseudo-random bytes as an array of ints: SHA-256 of the seed and a counter, as often as needed."""
    hexes = F.array_join(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 32).cast("int")), lambda i: F.sha2(F.concat(seed, F.lit("#"), i.cast("string")), 256)), "")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substring(hexes, 2 * i + 1, F.lit(2)), 16, 10).cast("int"))


def _in_kind(ch: Column, byte: Column) -> Column:
    """Another character of the same alphabet; characters of none stay."""
    out = ch
    for alphabet in ALPHABETS:
        out = F.when(F.instr(F.lit(alphabet), ch) > 0, F.substring(F.lit(alphabet), 1 + byte % len(alphabet), F.lit(1))).otherwise(out)
    return out


def _scrambled(text: Column, seed: Column) -> Column:
    """Every letter and digit replaced in its alphabet (empty text stays empty)."""
    made = let(F.split(text, ""), lambda chars: let(_bytes(seed, F.size(chars)), lambda b: F.array_join(
        F.transform(chars, lambda ch, i: _in_kind(ch, F.get(b, i))), "")))
    return F.when(F.length(text) > 0, made).otherwise(text)


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda x, i: let(x.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """The remainder of an account number, letters written as 10 to 35, by 97."""
    value = lambda ch: F.when(ch.rlike(r"\d"), ch.cast("int")).otherwise(F.ascii(ch) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda n, ch: (n * F.when(ch.rlike(r"\d"), 10).otherwise(100) + value(ch)) % 97)


def surrogate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The keyed replacement of a canonical entity; from the third attempt on it is longer where its format allows."""
    seed = F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canonical), 256)), 256)
    pick = lambda options, at: F.get(F.split(options, " "), F.get(at, F.lit(0)) % 16)
    script = script_of(canonical)
    by_script = lambda f: F.when(script == "cyrillic", f("cyrillic")).when(script == "greek", f("greek")).otherwise(f("latin"))
    more = F.when(attempt >= 2, attempt - 1).otherwise(0)
    # names: listed given names (a second one joined on when the list is used up), surnames of syllables
    syllable = lambda s: F.array_join(F.transform(_bytes(seed, F.lit(3) + more), lambda b: F.get(F.split(F.lit(SYLLABLES[s]), " "), b % 16)), "")
    tail = lambda s: F.array_join(F.transform(_bytes(F.concat(seed, F.lit("t")), F.lit(1) + more), lambda b: F.get(F.split(F.lit(SYLLABLES[s]), " "), b % 16)), "")
    given = lambda g: by_script(lambda s: F.concat(pick(F.lit(GIVEN[s][g]), _bytes(seed, F.lit(1))), F.when(attempt >= 2, F.concat(F.lit("-"), F.initcap(tail(s)))).otherwise("")))
    # e-mail: local part per address, domain labels per domain, top-level domain kept
    at = F.instr(canonical, "@")
    local, domain = F.substring(canonical, F.lit(1), at - 1), F.substring(canonical, at + 1, F.length(canonical))
    top = F.regexp_extract(domain, r"\.[^.]+$", 0)
    of_domain = F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)), 256)
    extra = F.when(more > 0, _scrambled(F.repeat(F.lit("x"), more + 1), F.concat(seed, F.lit("+")))).otherwise("")
    email = F.concat(_scrambled(local, seed), extra, F.lit("@"), _scrambled(F.regexp_replace(domain, r"\.[^.]+$", ""), of_domain), top)
    # numbers
    number = _scrambled(canonical, seed)
    phone = F.when(F.length(canonical) == 10, let(_bytes(F.concat(seed, F.lit("p")), F.lit(2)), lambda b: F.concat(
        (2 + F.get(b, F.lit(0)) % 8).cast("string"), F.substring(number, 2, 2), (2 + F.get(b, F.lit(1)) % 8).cast("string"), F.substring(number, 5, 6)))).otherwise(number)
    body = F.concat(F.substring(canonical, 1, 1), F.substring(number, F.lit(2), F.length(number) - 2))
    check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(_luhn_sum(canonical) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(F.concat(F.substring(canonical, 1, 1), F.substring(number, F.lit(2), F.length(number))))
    ssn = F.concat(F.lit("9"), F.substring(number, 2, 8))          # no real number begins with 9
    octets = let(_bytes(seed, F.lit(4)), lambda b: let(F.split(canonical, r"\."), lambda o: F.when(
        canonical.rlike(r"^(?:10|127)\."), F.concat_ws(".", F.get(o, F.lit(0)), *[F.get(b, F.lit(i)).cast("string") for i in (1, 2, 3)])).when(
        canonical.rlike(r"^(?:192\.168|169\.254|172\.(?:1[6-9]|2\d|3[01]))\."), F.concat_ws(".", F.get(o, F.lit(0)), F.get(o, F.lit(1)), *[F.get(b, F.lit(i)).cast("string") for i in (2, 3)])).otherwise(
        F.concat_ws(".", (11 + F.get(b, F.lit(0)) % 89).cast("string"), *[F.get(b, F.lit(i)).cast("string") for i in (1, 2, 3)]))))
    # a zero stays zero, so that any way of writing it fits; other groups keep their number of digits
    six = let(F.split(canonical, ""), lambda chars: let(_bytes(F.concat(seed, F.lit("6")), F.size(chars)), lambda b: F.array_join(F.transform(chars, lambda ch, i: F.when(
        ch == ":", ch).when((ch == "0") & (F.coalesce(F.get(chars, i - 1), F.lit(":")) == ":"), ch).otherwise(F.substring(F.lit("123456789abcdef"), 1 + F.get(b, i) % 15, F.lit(1)))), "")))
    account = _scrambled(F.substring(canonical, F.lit(5), F.length(canonical)), seed)
    iban = F.concat(F.substring(canonical, 1, 2), F.lpad((98 - _mod97(F.concat(account, F.substring(canonical, 1, 2), F.lit("00")))).cast("string"), 2, "0"), account)
    is_hex = canonical.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    hexes = F.substring(F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(canonical) / 64).cast("int")), lambda i: F.sha2(F.concat(seed, i.cast("string")), 256)), ""),
                        F.lit(1), F.length(canonical))
    secret = F.when(is_hex & canonical.rlike("[A-F]"), F.upper(hexes)).when(is_hex, hexes).otherwise(F.concat(_scrambled(canonical, seed), extra))
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", ssn).when(kind == "ip", octets).when(kind == "ip6", six).when(kind == "iban", iban)
            .when(kind == "given_m", given("m")).when(kind == "given_f", given("f"))
            .when(kind == "given_n", F.when(F.get(_bytes(F.concat(seed, F.lit("g")), F.lit(1)), F.lit(0)) % 2 == 0, given("f")).otherwise(given("m"))).when(kind == "family", F.initcap(by_script(syllable))).otherwise(secret))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canonical, surrogate)`` for distinct entities; surrogates are distinct within a kind and equal no real entity of it.

    A given name has one surrogate: where titles of no gender come with a name
    that other titles give a gender, it is that one's. (A name with titles of
    both genders is two names.) All given names are one kind for the check.
    Each round draws for the entities that have none yet; of those that drew
    the same, the smallest keeps it. Ends because later draws are longer, or
    come from a space far larger than the entities.
    """
    checkpoint_dir(entities.sparkSession)
    every = entities.select("kind", "canonical").distinct().checkpoint()
    gendered = every.where(F.col("kind").isin("given_f", "given_m")).groupBy("canonical").agg(F.min("kind").alias("as_kind"))
    plain = every.where("kind = 'given_n'").join(gendered, "canonical").select("kind", "canonical", "as_kind").checkpoint()
    family = F.regexp_replace("kind", "^given_.$", "given").alias("space")
    pending = every.join(plain, ["kind", "canonical"], "left_anti").withColumn("attempt", F.lit(0)).checkpoint()
    taken = every.select(family, F.lower("canonical").alias("value"))
    done = None
    while not pending.isEmpty():
        drawn = (pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key))
                 .withColumns({"value": F.lower("surrogate"), "space": family}).checkpoint())
        free = drawn.join(taken, ["space", "value"], "left_anti")
        won = free.groupBy("space", "value").agg(F.min(F.struct("canonical", "kind", "surrogate")).alias("w")).select("w.kind", "w.canonical", "w.surrogate").checkpoint()
        done = won if done is None else done.unionByName(won).checkpoint()
        taken = taken.unionByName(won.select(family, F.lower("surrogate").alias("value")))
        pending = drawn.join(won, ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")).checkpoint()
    if done is None:
        return entities.select("kind", "canonical", F.lit("").alias("surrogate")).limit(0)
    same = plain.join(done.withColumnRenamed("kind", "as_kind"), ["as_kind", "canonical"]).select("kind", "canonical", "surrogate")
    return done.unionByName(same)


def _poured(kind: Column, canonical: Column, written: Column, made: Column) -> Column:
    """A surrogate in the format of one mention."""
    digits = F.regexp_replace(written, r"\D", "")
    # digits beyond the canonical ones (a country code) stay; the others are replaced from the right
    full = F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(made)), made)
    in_format = let(F.split(written, ""), lambda chars: F.array_join(F.transform(chars, lambda ch, i: F.when(
        ch.rlike(r"\d"), F.substring(full, F.length(F.regexp_replace(F.array_join(F.slice(chars, 1, i + 1), ""), r"\D", "")), F.lit(1))).otherwise(ch)), ""))
    # an IPv6 address: each group as wide as it was written
    ends = lambda n: F.filter(F.split(F.substring_index(written, "::", n), ":"), lambda g: g != "")
    wide = lambda groups, at: F.array_join(F.transform(groups, lambda g, i: F.lpad(F.get(F.split(made, ":"), at(i)), F.greatest(
        F.length(g), F.length(F.get(F.split(made, ":"), at(i)))), F.lit("0"))), ":")
    ip6 = F.when(written.contains("::"), F.concat(wide(ends(1), lambda i: i), F.lit("::"), let(ends(-1), lambda r: wide(r, lambda i: 8 - F.size(r) + i)))).otherwise(
        wide(F.split(written, ":"), lambda i: i))
    spaced = let(F.split(written, ""), lambda chars: F.array_join(F.transform(chars, lambda ch, i: F.when(ch == " ", ch).otherwise(
        F.substring(made, F.length(F.regexp_replace(F.array_join(F.slice(chars, 1, i + 1), ""), " ", "")), F.lit(1)))), ""))
    shouted = (F.upper(written) == written) & (F.lower(written) != written)
    return (F.when(kind.isin("phone", "card", "ssn"), in_format).when(kind.isin("secret", "ip"), made).when(kind == "iban", spaced)
            .when(kind == "ip6", F.when(F.lower(written) == written, ip6).otherwise(F.upper(ip6)))
            .when(shouted & (F.length(written) > 1), F.upper(made)).otherwise(made))


def replace(docs: DataFrame, text: str = "text", key: str = KEY, counts: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, all else of the text unchanged, character by character.

    Equal texts get equal results, so repeated rows stay equal and ids don't
    matter; null texts stay null. ``counts`` names a column for the number of
    mentions (long). An empty table gives none; other columns, whatever their
    names, are untouched. The expression runs once: rows and their mentions
    are written below the shared checkpoint folder, and read again.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    columns = [c for c in docs.columns if c != counts]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    path = scratch_path(spark, "mentions")
    rows.withColumn("mentions", mentions(F.col("text"))).select(
        "row", F.when(F.size("mentions") > 0, F.col("text")).alias("text"), "mentions").write.parquet(path)
    found = spark.read.parquet(path)
    held = found.where(F.size("mentions") > 0).withColumn("digest", F.sha2("text", 256))
    per_text = held.select("digest", "mentions").groupBy("digest").agg(F.first("mentions").alias("m"))
    each = per_text.select("digest", F.posexplode("m").alias("n", "mention"))
    each = each.select("digest", "n", "mention", F.posexplode(parts(F.col("mention"))).alias("p", "part")).select(
        "digest", "n", "mention", "p", "part.*").checkpoint()
    made = assign(each, key)
    each = each.join(made, ["kind", "canonical"]).withColumn("new", _poured(F.col("kind"), F.col("canonical"), F.col("written"), F.col("surrogate")))
    # words of a name back together behind their title, then the mentions of a text in order
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "new"))), lambda x: x["new"]), " ")
    title = F.regexp_extract(F.first("mention"), rf"^{_BEFORE_NAME}(?=\p{{Lu}})", 0)
    per_mention = each.groupBy("digest", "n").agg(F.concat(F.when(F.first("kind").rlike("^(?:given|family)"), title).otherwise(""), whole).alias("new"))
    news = per_mention.groupBy("digest").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "new"))), lambda x: x["new"]).alias("news")).checkpoint()
    joined = held.join(news, "digest")
    rebuilt = let(F.split("text", PATTERN, -1), lambda g: F.array_join(F.transform(g, lambda x, i: F.concat(x, F.coalesce(F.get("news", i), F.lit("")))), ""))
    number, none = ([], []) if counts is None else ([F.size("mentions").cast("long").alias(counts)], [F.lit(0).cast("long").alias(counts)])
    own = [F.col("row").getField(c).alias(c) for c in columns]
    with_new = joined.select(*[rebuilt.alias(c) if c == text else x for c, x in zip(columns, own)], *number)
    return found.where(F.size("mentions") == 0).select(*own, *none).unionByName(with_new)
