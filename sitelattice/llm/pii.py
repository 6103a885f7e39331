"""Operator 3 - PII surrogate generation (native).

Entities are found by one Java pattern with an alternative per kind: e-mail
addresses, telephone numbers, IPv4 addresses, account numbers (13 to 19 digits), IBANs,
social security numbers, and names after a form of address. Each is replaced by a surrogate
that a key, its kind and its normalised form determine, so the same entity gets the same
surrogate in every document (coreference), whatever its case or spacing.

Forms of address that are ordinary words or initials too count only where they can be
meant: "M." after a French word or at a sentence's start, "Sr." after a Spanish one, "Don",
"Sir" and "Miss" before a known first name. No name begins with a word that begins
sentences, so none reaches over a full stop. A genitive 's is not part of a name and stays.
Version numbers are no addresses, ISBNs no accounts.

A text that names someone by a form of address is read a second time for mentions without
one: each capitalised word that is a part of such a name is replaced as it was there,
unless the text also has it in lower case (then only beside another part of the name).
Names that a text gives without any form of address are not looked for.

The key comes from the session's setting ``spark.sitelattice.surrogateKey``. Where it is
unset, one is drawn at random and kept in the shared folder, so that runs on one cluster
agree and no surrogate can be undone by who has this code alone.

Numbers and addresses pass through a keyed permutation of all values of their shape
(``_permuted``): distinct entities of a shape have distinct surrogates by construction,
none its own. Digits stay digits, letters stay letters of their case and script,
separators stay; a telephone number keeps its country code, an IBAN its country and
whether its check digits are right, an account number what the Luhn sum leaves, a mail
address its last label, an IPv4 address its octets of 0 and 255.

A name's words are replaced one by one; the form of address stays, so "Mr A B" and
"Mr B" share their B. A family name becomes syllables of its script. A first name
becomes syllables with an ending of its gender: some 10^8 names a gender and script.
The gender is that of the form of address; after Dr and the like it is that of the
name: from the list of known names, else from the forms of address it has elsewhere in
the corpus (the more frequent gender), else from its ending.

Distinctness is checked over all documents: distinct entities whose surrogates clash,
or whose surrogate is itself an entity of the corpus (IPv4 addresses apart: their space
cannot widen, and is one to one as it is), are drawn again with the next attempt number,
all but the first of them, until none clashes. After ``SAME_SHAPE`` draws the surrogate
grows by a digit, letter or syllable an attempt, so a shape whose values are all taken
does not hold the rest up, and the drawing always ends.

Texts are scanned twice: for the entities (kept by the text's digest), and to rewrite
them. Texts that hold a later draw are found by digest; of 2^20 digest buckets those
concerned go to the second scan as a broadcast of bounded size, and only texts in them
are joined to their draws. All others are rewritten without a shuffle.
Only built-in expressions are used.

Nulls: a null text stays null and has no entities. A null doc_id stays null. Repeated
rows each give a row. An empty table gives an empty result. Other columns are kept by
``surrogates`` and not read by the query; a column named like a working column is kept.
A mail domain has 126 labels and an ending at most, as the rules of the net say.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .native import between, let, matches

#: The setting that holds the key, and the folder of the one drawn where it is unset.
KEY_SETTING, KEY_FOLDER = "spark.sitelattice.surrogateKey", "surrogate-key"
#: Draws again that keep the shape; later ones widen it.
SAME_SHAPE = 3
# Forms of address.
MALE = "Mr Mister Sir Herr Herrn Señor Sr Monsieur M Don Господин Г-н Κύριος".split()
FEMALE = "Mrs Ms Miss Madam Frau Fräulein Señora Señorita Sra Srta Madame Mme Mademoiselle Mlle Doña Госпожа Г-жа Κυρία".split()
NEUTRAL = "Dr Prof Professor Docteur Doktor Доктор".split()
# First names by gender and script.
FIRST = {
    ("m", "latin"): "Adam Alan Bruno Carl David Eric Felix Georg Hugo Ivan Jonas Karl Leon Marco Noel Oscar Paul Ruben Simon Thomas Victor Walter Emil Anton".split(),
    ("f", "latin"): "Alice Anna Berta Carla Diana Elena Flora Greta Helena Irene Julia Klara Laura Maria Nina Olivia Paula Rosa Sofia Teresa Vera Wanda Emma Clara".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Олег Павел Роман Сергей Тимур Юрий".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Кира Лариса Мария Нина Ольга Полина Софья Юлия".split(),
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Κώστας Λουκάς Μιχάλης Νίκος Πέτρος Στέφανος Τάσος Φίλιππος".split(),
    ("f", "greek"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χαρά".split(),
}
# Alphabets of the letters that replace letters, and of syllables.
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "accented": "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœšžß",
    "cyrillic": "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψωςάέήίόύώ",
}
SYLLABLES = {"latin": ("bdfghklmnprstvwz", "aeiou"), "cyrillic": ("бвгдзклмнпрстфхц", "аеиоу"), "greek": ("βγδζθκλμνπρστφχψ", "αεηιο")}
#: Endings of first names; those of women end in one of the letters in ``FEMALE_END``, those of men never.
ENDINGS = {
    ("m", "latin"): "o us an er ik on ard el im ert".split(), ("f", "latin"): "a ia ina ella ana ora ela ita isa ika".split(),
    ("m", "cyrillic"): "ий ан ор ей ин ар ет ом ил ак".split(), ("f", "cyrillic"): "а ия ина ана ея ела ора ика ета ира".split(),
    ("m", "greek"): "ος ιος ης ας ων ανος ιδης ευς ινος ιας".split(), ("f", "greek"): "α ια η ινα ανη ελα ουλα ιδα ηνη ισσα".split(),
}
FEMALE_END = "[aаяαη]$"
# Country codes of one and two digits; all others have three.
COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# Words that begin sentences, or offices, and are no names after a form of address.
NO_NAMES = (
    "The Then This That These Those There Here He She It They We You But And If In At For From With When While Where What Who Why How Only Not Yes As By To Of Our Their His Her My Your "
    "Der Die Das Und Aber Er Sie Es Wir Ihr Ich Dann Wenn Ein Eine Nur Nicht Le La Les Un Une Et Mais Il Elle Ils Elles Nous Vous Je Puis Ce Cette On El Los Las Una Y Pero Él Ella Ellos Nosotros Yo Luego Este Esta "
    "President Chairman Speaker Secretary Minister Chancellor Governor Ambassador Emeritus Universe World"
).split()
# Words before "M." in French and "Sr." in Spanish.
FRENCH = "et à de par que chez pour avec selon entre dont où mais ou dit est cher Cher comme sur contre si quand".split()
SPANISH = "el El del al Al y de estimado Estimado con por para que".split()
BUCKETS = 1 << 20

_WORDC = r"\p{L}\p{N}"
#: A word of a name. A genitive is none of it.
WORD = r"\p{Lu}(?:\p{L}++(?:['’-](?![sS](?!\p{L}))\p{L}++){0,3}|['’]\p{Lu}\p{L}++)"
_WEAK = {"M", "Sr", "Don", "Sir", "Miss"}
_CLEAR = "|".join(sorted({*MALE, *FEMALE, *NEUTRAL} - _WEAK, key=lambda t: (-len(t), t)))
_AFTER = lambda words: rf"(?<=^|[\n(«“\"]|[.!?]\x20|(?<!\p{{L}})(?:{'|'.join(words)})\x20)"
_KNOWN = "|".join(sorted({n for (_, script), pool in FIRST.items() if script == "latin" for n in pool}))
_ADDRESS = rf"(?:(?:{_CLEAR})\.?|(?=M\.){_AFTER(FRENCH)}M\.|(?=Sr){_AFTER(SPANISH)}Sr\.?|(?:Don|Sir|Miss)(?=\x20(?:{_KNOWN})(?!\p{{L}})))"
#: A form of address and one to three words, initials among them.
NAME = rf"(?<![{_WORDC}]){_ADDRESS}\x20(?!(?:{'|'.join(NO_NAMES)})(?!\p{{L}})){WORD}(?:(?:\x20\p{{Lu}}\.){{0,2}}\x20{WORD}){{0,2}}"
KINDS = {
    # A bounded number of labels: Java's matcher recurses once a label.
    "email": rf"(?<![{_WORDC}._%+-])[{_WORDC}._%+-]++@(?:[{_WORDC}-]++\.){{1,126}}\p{{L}}{{2,24}}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?=[0-9])(?<![0-9.]|[Vv]ersion\x20|[Vv]ersion:\x20|[Rr]elease\x20|[Bb]uild\x20|\b[Vv]\x20|\b[Vv]\.\x20)(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?=[0-9])(?<![0-9A-Za-z]|ISBN\x20|ISBN-|ISBN:\x20|ISBN-1[03]\x20|ISBN-1[03]:\x20)(?!97[89](?:[\x20-]?[0-9]){10}(?![\x20-]?[0-9]))[0-9](?:[\x20-]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,5}\)|[0-9]{1,5})(?:[\x20.-]?[0-9]{2,5}){1,4}|\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])",
    "name": NAME,
}
#: An entity does not begin inside a word: most places are passed over by one test.
ANY = rf"(?<![{_WORDC}])(?:{'|'.join(KINDS.values())})"
#: One to four capitalised words in a row, none of them a form of address: where a name
#: may be mentioned without one.
_PLAIN = rf"{WORD}(?![\p{{L}}\p{{N}}@_%+]|[.-][\p{{L}}\p{{N}}@])"
MENTION = rf"(?<![{_WORDC}.@_%+]){_PLAIN}(?:\x20(?!(?:{_CLEAR}|M|Sr|Don|Sir|Miss)\.?\x20){_PLAIN}){{0,3}}"
ANY_OR_MENTION = rf"(?<![{_WORDC}])(?:{'|'.join(KINDS.values())}|{MENTION})"


def kind_of(s: Column) -> Column:
    """Which alternative a match came from: the first that matches all of it."""
    out = None
    for kind, pattern in KINDS.items():
        whole = s.rlike(f"^(?:{pattern})$")
        out = F.when(whole, kind) if out is None else out.when(whole, kind)
    return out.when(s.rlike(f"^(?:{MENTION})$"), "mention").otherwise("name")


def normal_form(kind: Column, s: Column) -> Column:
    compact = F.upper(F.regexp_replace(s, r"[\s().-]", ""))
    return F.when(kind.isin("iban", "ssn", "account", "phone"), compact).otherwise(F.lower(s))


def _digest(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\u001f", F.lit(key), kind, norm, attempt.cast("string")), 256)


def _byte(digest: Column, i: Column) -> Column:
    """A number of 16 bits from the digest, another for each ``i`` below 61; beyond, they
    are mixed with ``i``."""
    at = F.pmod(i * 7, F.lit(61))
    return F.pmod(F.conv(F.substr(digest, at + 1, F.lit(4)), 16, 10).cast("int") + (i / 61).cast("int") * 7919, F.lit(65536))


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _cell(c: Column) -> Column:
    """A character as struct<v, r, a>: its place in its alphabet, the alphabet's size and
    the alphabet. Other characters have size 1 and stay."""
    out = F.when(c.rlike("^[0-9]$"), F.struct(c.cast("int").alias("v"), F.lit(10).alias("r"), F.lit("0123456789").alias("a")))
    for letters in LETTERS.values():
        out = out.when(F.contains(F.lit(letters), c), F.struct((F.instr(F.lit(letters), c) - 1).alias("v"), F.lit(len(letters)).alias("r"), F.lit(letters).alias("a")))
    rest = LETTERS["latin"]  # letters of other scripts: not one to one, so their tweak is their own
    out = out.when(c.rlike(r"^\p{L}"), F.struct(F.pmod(F.ascii(c), F.lit(len(rest))).alias("v"), F.lit(len(rest)).alias("r"), F.lit(rest).alias("a")))
    return out.otherwise(F.struct(F.lit(0).alias("v"), F.lit(1).alias("r"), F.lit("").alias("a")))


def _octet(o: Column) -> Column:
    n = o.cast("int")
    return F.when(n.between(1, 254), F.struct((n - 1).alias("v"), F.lit(254).alias("r"), F.lit("ip").alias("a"))).otherwise(F.struct(F.lit(0).alias("v"), F.lit(1).alias("r"), F.lit("").alias("a")))


def _permuted(cells: Column, tweak: Column) -> Column:
    """A keyed permutation, without fixed points, of all cells of the same sizes.

    Cells in even and in odd places take turns: each adds, modulo its size, a number that
    a digest of the others gives. Between those two rounds and the same undone stands one
    shift of the first cell that has a choice, so the whole is that shift seen through
    another bijection.
    """

    def turn(x: Column, even: Column, name: str, sign: int) -> Column:
        others = F.array_join(F.transform(x, lambda c, i: F.when((i % 2 == 0) == even, F.lit("")).otherwise(c["v"].cast("string"))), ",")
        digest = F.sha2(F.concat_ws("\u001f", tweak, F.lit(name), others), 256)
        moved = lambda c, i, d: F.when((i % 2 == 0) == even, F.pmod(c["v"] + sign * _byte(d, i), c["r"]).cast("int")).otherwise(c["v"])
        return let(digest, lambda d: F.transform(x, lambda c, i: F.struct(moved(c, i, d).alias("v"), c["r"].alias("r"), c["a"].alias("a"))))

    def all_turns(x: Column) -> Column:
        at, start = x["at"], x["at"] % 2 == 0
        amount = lambda r: 1 + F.pmod(_byte(F.sha2(F.concat_ws("\u001f", tweak, F.lit("shift")), 256), F.lit(0)), r - 1)
        shift = lambda y: F.transform(y, lambda c, i: F.struct(F.when(i == at, F.pmod(c["v"] + amount(c["r"]), c["r"]).cast("int")).otherwise(c["v"]).alias("v"), c["r"].alias("r"), c["a"].alias("a")))
        done = let(turn(x["cells"], start, "one", 1), lambda y: let(turn(y, ~start, "two", 1), lambda z: let(shift(z), lambda u: let(turn(u, ~start, "two", -1), lambda w: turn(w, start, "one", -1)))))
        return F.when(at < 0, x["cells"]).otherwise(done)

    first = F.array_position(F.transform(cells, lambda c: c["r"] > 1), True).cast("int") - 1
    return let(F.struct(cells.alias("cells"), first.alias("at")), all_turns)


def _luhn_rest(digits: Column) -> Column:
    """Luhn sum of a string of digits, mod 10."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(values, F.lit(0), lambda a, v: a + v), F.lit(10))


def _rest97(s: Column) -> Column:
    """The number that an IBAN's digits and letters (10 to 35) spell, mod 97."""
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(s, ""), F.lit(0), step)


def _spread(new: Column, s: Column) -> Column:
    """The characters of ``new`` in the places of those of ``s`` that are no separators."""
    before = lambda i: F.length(F.regexp_replace(F.substr(s, F.lit(1), i), r"[\s().-]", ""))
    return F.array_join(F.transform(F.split(s, ""), lambda c, i: F.when(c.rlike(r"[\s().-]"), c).otherwise(F.substr(new, before(i) + 1, F.lit(1)))), "")


def _shaped(kind: Column, s: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a number or address: the permutation of what is free in it."""
    more = F.greatest(attempt - SAME_SHAPE, F.lit(0))
    tail = F.regexp_extract(s, r"(\.\p{L}+)$", 1)

    def parts(x: Column) -> Column:
        longer, compact = x["longer"], x["compact"]
        fixed = F.when(kind == "phone", F.regexp_extract(compact, COUNTRY, 0)).when(kind == "iban", F.substr(compact, F.lit(1), F.lit(2))).when(kind == "email", F.lower(tail)).otherwise("")
        body = (
            F.when(kind == "email", F.concat(F.repeat(F.lit("a"), more), F.substr(s, F.lit(1), F.length(s) - F.length(tail))))
            .when(kind == "account", F.substr(compact, F.lit(1), F.length(compact) - 1))
            .when(kind == "iban", F.substr(compact, F.lit(5)))
            .when(kind == "phone", F.substr(compact, F.length(fixed) + 1))
            .otherwise(compact)
        )
        pieces = F.when(kind == "ip", F.split(s, r"\.")).otherwise(F.split(body, ""))
        own = F.when(F.lower(s).rlike(rf"[\p{{L}}&&[^a-zA-Z{''.join(LETTERS.values())}]]"), F.lower(s)).otherwise("")
        tweak = F.concat_ws("\u001f", F.lit(key), kind, attempt.cast("string"), fixed, own)
        return F.struct(longer.alias("longer"), compact.alias("compact"), fixed.alias("fixed"), pieces.alias("pieces"), tweak.alias("tweak"))

    def written(x: Column) -> Column:
        cells = F.when(kind == "ip", F.transform(x["pieces"], _octet)).otherwise(F.transform(x["pieces"], lambda c: _cell(F.lower(c))))

        def piece(old: Column, new: Column) -> Column:
            letter = F.substr(new["a"], new["v"] + 1, F.lit(1))
            return F.when(new["r"] == 1, old).when(new["a"] == "ip", (new["v"] + 1).cast("string")).when(old.rlike(r"^\p{Lu}"), F.upper(letter)).otherwise(letter)

        return let(F.zip_with(x["pieces"], _permuted(cells, x["tweak"]), piece), lambda made: finished(x, made))

    def finished(x: Column, made: Column) -> Column:
        joined = F.array_join(made, "")
        luhn = F.pmod(_luhn_rest(F.regexp_replace(s, "[^0-9]", "")) - _luhn_rest(F.concat(joined, F.lit("0"))), F.lit(10))
        rest = F.pmod(_rest97(F.concat(F.substr(normal_form(kind, s), F.lit(5)), F.substr(normal_form(kind, s), F.lit(1), F.lit(4)))) - _rest97(F.concat(joined, x["fixed"], F.lit("00"))) - 2, F.lit(97)) + 2
        return (
            F.when(kind == "ip", F.array_join(made, "."))
            .when(kind == "email", F.concat(joined, tail))
            .when(kind == "account", _spread(F.concat(joined, luhn.cast("string")), x["longer"]))
            .when(kind == "iban", _spread(F.concat(x["fixed"], F.lpad(rest.cast("string"), 2, "0"), joined), x["longer"]))
            .otherwise(_spread(F.concat(x["fixed"], joined), x["longer"]))
        )

    # A mail address has no separators to be left out, and is not spread.
    longer = F.concat(s, F.repeat(F.lit("0"), more))
    both = F.struct(longer.alias("longer"), F.when(kind.isin("email", "ip"), s).otherwise(F.upper(F.regexp_replace(longer, r"[\s().-]", ""))).alias("compact"))
    return let(both, lambda x: let(parts(x), written))


def _syllables(digest: Column, script: Column, n: Column) -> Column:
    """``n`` syllables of a script, two bytes of the digest each."""

    def of(name: str) -> Column:
        first, second = SYLLABLES[name]

        def syllable(i: Column) -> Column:
            b = _byte(digest, 2 * i + 1)
            return F.concat(F.substr(F.lit(first), F.pmod(b, F.lit(len(first))).cast("int") + 1, F.lit(1)), F.substr(F.lit(second), F.pmod((b / 16).cast("int"), F.lit(len(second))).cast("int") + 1, F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), syllable), "")

    return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))


def _given(digest: Column, gender: Column, script: Column, more: Column) -> Column:
    """Three syllables and ``more``, a consonant and an ending of the gender."""
    out = None
    for (g, name), endings in ENDINGS.items():
        pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(_byte(digest, F.lit(at)), F.lit(len(values))).cast("int") + 1)
        chosen = F.concat(pick(SYLLABLES[name][0], 0), pick(endings, 2))
        when = (gender == g) & (script == name)
        out = F.when(when, chosen) if out is None else out.when(when, chosen)
    return F.initcap(F.concat(_syllables(digest, script, more + 3), out))


def _cased(s: Column, like: Column) -> Column:
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(s)).otherwise(s)


def surrogate(kind: Column, s: Column, attempt: Column, key: str) -> Column:
    """The surrogate of one unit: an entity, or one word of a name (kinds ``given_m``,
    ``given_f``, ``given_n``, ``family``)."""

    def named(d: Column) -> Column:
        script, more = _script(s), F.greatest(attempt - SAME_SHAPE, F.lit(0))
        gender = F.substr(gendered(kind, s), F.lit(7), F.lit(1))
        name = F.when(kind == "family", F.initcap(_syllables(d["d"], script, more + 4))).otherwise(_given(d["d"], gender, script, more))
        return _cased(name, s)

    digest = F.struct(_digest(key, gendered(kind, s), normal_form(kind, s), attempt).alias("d"))
    return F.when((kind == "family") | kind.startswith("given"), let(digest, named)).otherwise(_shaped(kind, s, attempt, key))


def _known(word: Column) -> Column:
    """Gender of a known first name, else null."""
    names = {g: [n for (x, _), pool in FIRST.items() if x == g for n in pool] for g in "mf"}
    proper = F.initcap(F.lower(word))
    return F.when(proper.isin(*names["f"]), "f").when(proper.isin(*names["m"]), "m")


def gendered(kind: Column, s: Column) -> Column:
    """``kind``, where a first name's gender is not shown by anything else, by its ending."""
    return F.when(kind == "given_n", F.when(F.lower(s).rlike(FEMALE_END), "given_f").otherwise("given_m")).otherwise(kind)


UNIT = "struct<kind:string,s:string>"


def _titled(words: Column) -> Column:
    """Units of a name, from its words."""

    def parts(w: Column) -> Column:
        bare, n = F.regexp_replace(w[0], r"\.$", ""), F.size(w)
        given = lambda x: F.when(bare.isin(*FEMALE), "given_f").when(bare.isin(*MALE), "given_m").otherwise(F.concat(F.lit("given_"), F.coalesce(_known(x), F.lit("n"))))
        family = lambda x, i: (i == n - 1) & ((n > 2) | _known(x).isNull())
        return F.transform(w, lambda x, i: F.struct(F.when((i == 0) | x.endswith("."), "title").when(family(x, i), "family").otherwise(given(x)).alias("kind"), x.alias("s")))

    return let(words, parts)


def units(found: Column, parts: Column | None = None) -> Column:
    """Per match its units: array<array<struct<kind, s>>>. A name gives its form of
    address and initials (kind ``title``, kept), then first names, then the family name; a
    single word is a first name if it is known as one. ``parts`` (of ``name_parts``) tells
    which words of mentions are parts of names; all others are kept."""

    def mentioned(x: Column) -> Column:
        if parts is None:
            return F.array(F.struct(F.lit("title").alias("kind"), x["s"].alias("s")))
        part = lambda i: F.try_element_at(parts, F.get(x["w"], i))
        beside = lambda i: part(i - 1).isNotNull() | part(i + 1).isNotNull()
        kind = lambda i: F.when(part(i)["clear"] | beside(i), part(i)["kind"])
        return F.transform(x["w"], lambda w, i: F.struct(F.coalesce(kind(i), F.lit("title")).alias("kind"), w.alias("s")))

    def of(s: Column) -> Column:
        other = lambda x: F.array(F.struct(x["k"].alias("kind"), x["s"].alias("s")))
        split = lambda x: F.when(x["k"] == "name", _titled(x["w"])).when(x["k"] == "mention", mentioned(x)).otherwise(other(x))
        return let(F.struct(F.split(s, "\x20").alias("w"), kind_of(s).alias("k"), s.alias("s")), split).cast(f"array<{UNIT}>")

    return F.transform(found, of)


def name_parts(text: Column, names: Column) -> Column:
    """The words of a text's names as map<word, struct<kind, clear>>; ``clear`` if the text
    does not have the word in lower case."""
    made = F.flatten(F.transform(names, lambda n: _titled(F.split(n, "\x20"))))
    words = F.array_sort(F.array_distinct(F.transform(F.filter(made, lambda u: u["kind"] != "title"), lambda u: F.struct(u["s"].alias("s"), u["kind"].alias("kind")))))
    once = let(words, lambda a: F.filter(a, lambda u, i: (i == 0) | (F.get(a, i - 1)["s"] != u["s"])))

    def mapped(x: Column) -> Column:
        lower = F.array_intersect(F.transform(x["once"], lambda u: F.lower(u["s"])), F.split(x["text"], r"[^\p{L}'’-]+"))
        entry = lambda u, low: F.struct(u["s"].alias("key"), F.struct(u["kind"].alias("kind"), (~F.array_contains(low, F.lower(u["s"]))).alias("clear")).alias("value"))
        return F.map_from_entries(let(lower, lambda low: F.transform(x["once"], lambda u: entry(u, low))))

    return let(F.struct(once.alias("once"), text.alias("text")), mapped)


PARTS = "map<string,struct<kind:string,clear:boolean>>"


def _clashing(entities: DataFrame) -> DataFrame:
    """Entities (kind, norm) that must be drawn again: all but the first that share a
    surrogate, and those whose surrogate is an entity."""
    family = F.when(F.col("kind").startswith("given"), F.lit("given")).otherwise(F.col("kind"))
    e = entities.withColumn("family", family)
    first = e.groupBy("family", "shown").agg(F.min(F.struct("attempt", "kind", "norm")).alias("first"))
    shared = e.join(first, ["family", "shown"]).where((F.col("first.kind") != F.col("kind")) | (F.col("first.norm") != F.col("norm"))).select("kind", "norm")
    real = e.where("kind <> 'ip'").select("family", F.col("norm").alias("shown")).distinct()
    return shared.unionAll(e.join(real, ["family", "shown"], "left_semi").select("kind", "norm")).distinct()


def resolved(found: DataFrame) -> DataFrame:
    """(kind, norm, s, as): each unit, and the kind it is drawn as: a first name of
    unshown gender as that which its forms of address elsewhere show more often."""
    each = found.withColumn("norm", normal_form(F.col("kind"), F.col("s"))).groupBy("kind", "norm").agg(F.min("s").alias("s"), F.count("*").alias("n"))
    shown = each.where("kind in ('given_m', 'given_f')").groupBy("norm").agg(F.sum(F.when(F.col("kind") == "given_f", F.col("n")).otherwise(-F.col("n"))).alias("f"))
    unshown = each.where("kind = 'given_n'").join(shown, "norm", "left")
    by_use = F.when(F.col("f") > 0, "given_f").when(F.col("f") < 0, "given_m").otherwise(gendered(F.col("kind"), F.col("s")))
    return each.where("kind <> 'given_n'").select("kind", "norm", "s", F.col("kind").alias("as")).unionAll(unshown.select("kind", "norm", "s", by_use.alias("as")))


def redraws(found: DataFrame, key: str) -> DataFrame | None:
    """(kind, norm, as, attempt) of units that do not keep their first draw or are drawn
    as another kind than ``gendered`` says; None if there are none. ``found`` holds
    ``kind`` and ``s`` of all units, a row a mention."""
    spark = found.sparkSession
    units_at = common.new_path(spark, "pii-resolved")
    each = common.persist_table(resolved(found), "pii-resolved", units_at)
    # Compared in normal form: surrogates that differ in case alone clash.
    drawn = lambda attempt: normal_form(F.col("kind"), surrogate(F.col("kind"), F.col("s"), attempt, key))
    sample = each.groupBy(F.col("as").alias("kind"), "norm").agg(F.min("s").alias("s"))
    at = common.new_path(spark, "entities")
    entities = common.persist_table(sample.select("kind", "norm", "s", F.lit(0).alias("attempt"), drawn(F.lit(0)).alias("shown")), "entities", at)
    while True:
        again_at = common.new_path(spark, "clashes")
        again = common.persist_table(_clashing(entities), "clashes", again_at)
        if not again.take(1):
            break
        marked = entities.join(again.withColumn("again", F.lit(True)), ["kind", "norm"], "left")
        attempt = F.when(F.col("again"), F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt")
        new_at = common.new_path(spark, "entities")
        entities = common.persist_table(
            marked.select("kind", "norm", "s", attempt, F.col("again"), F.col("shown")).select("kind", "norm", "s", "attempt", F.when(F.col("again"), drawn(F.col("attempt"))).otherwise(F.col("shown")).alias("shown")), "entities", new_at
        )
        common.drop_path(spark, at)
        common.drop_path(spark, again_at)
        at = new_at
    drawn_as = entities.select(F.col("kind").alias("as"), "norm", "attempt")
    other = each.join(drawn_as, ["as", "norm"]).where((F.col("attempt") > 0) | (F.col("as") != gendered(F.col("kind"), F.col("s"))))
    other = common.persist_table(other.select("kind", "norm", "as", "attempt"), "pii-draws")
    for path in (at, units_at):
        common.drop_path(spark, path)
    return other if other.take(1) else None


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, else the one kept in the shared folder, which is
    drawn at its first use there."""
    named = spark.conf.get(KEY_SETTING, None)
    if named:
        return named
    path = f"{common.shared_dir(spark)}/{KEY_FOLDER}"
    drawn = spark.createDataFrame([(secrets.token_hex(32),)], "value string")
    drawn.write.mode("ignore").text(path)
    return min(r["value"] for r in spark.read.text(path).collect())


def surrogates(docs: DataFrame, key: str | None = None, text_col: str = "text", entities_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; with ``entities_col``, that column is
    added: the kinds of what was replaced, in order. ``key``: that of the session if not given."""
    key = key or session_key(docs.sparkSession)
    names, text = docs.columns, F.col("_text")
    rows = docs.select(F.struct(*names).alias("_row"), F.col(text_col).alias("_text"))
    digest = F.unhex(F.sha2(text, 256))
    found = rows.select(digest.alias("digest"), matches(text, ANY).alias("f")).where(F.size("f") > 0)
    found = found.select("digest", F.explode(F.flatten(units(F.col("f")))).alias("u")).select("digest", "u.kind", "u.s").where("kind <> 'title'")
    mentions = common.persist_table(found, "pii-units")
    again = redraws(mentions.select("kind", "s"), key)

    def name(u: Column) -> Column:
        return F.concat_ws("\u001f", u["kind"], normal_form(u["kind"], u["s"]))

    def rewritten(rows: DataFrame, draws: Column | None) -> DataFrame:
        def unit(u: Column) -> Column:
            plain = lambda: surrogate(u["kind"], u["s"], F.lit(0), key)
            if draws is None:
                new = plain()
            else:
                new = let(F.try_element_at(draws, name(u)), lambda d: surrogate(F.coalesce(d["as"], u["kind"]), u["s"], F.coalesce(d["attempt"], F.lit(0)), key))
            return F.when(u["kind"] == "title", u["s"]).otherwise(new)

        def made(x: Column) -> Column:
            """struct<text, kinds> of a text with entities: x has its matches, what stands
            between them, and the parts of its names."""

            def written(us: Column) -> Column:
                new = F.transform(us, lambda u: F.array_join(F.transform(u, unit), " "))
                done = F.array_join(F.zip_with(x["gaps"], F.array_append(new, F.lit("")), lambda a, b: F.concat(a, b)), "")
                kind = lambda m, u: F.when(F.exists(u, lambda v: v["kind"] != "title"), F.when(F.size(u) > 1, "name").when(F.get(u, F.lit(0))["kind"].rlike("^(?:given|family)"), "name").otherwise(F.get(u, F.lit(0))["kind"]))
                kinds = F.filter(F.zip_with(x["f"], us, kind), lambda k: k.isNotNull()) if entities_col else F.array().cast("array<string>")
                return F.struct(done.alias("text"), kinds.alias("kinds"))

            return let(units(x["f"], x["parts"]), written)

        def read(x: Column) -> Column:
            """The matches again, with mentions if there is a name."""
            more = F.size(x["names"]) > 0
            return F.struct(
                F.when(more, matches(text, ANY_OR_MENTION)).otherwise(x["f"]).alias("f"), F.when(more, between(text, ANY_OR_MENTION)).otherwise(between(text, ANY)).alias("gaps"),
                F.when(more, name_parts(text, x["names"])).otherwise(F.create_map().cast(PARTS)).alias("parts"),
            )

        named = lambda f: F.filter(f, lambda m: m.rlike(f"^(?:{NAME})$"))
        rows = rows.withColumn("_found", matches(text, ANY))
        done = let(let(F.struct(F.col("_found").alias("f"), named(F.col("_found")).alias("names")), read), made)
        nothing = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
        rows = rows.withColumn("_made", F.when(F.size("_found") > 0, done).otherwise(nothing))
        own = [F.col("_made.text").cast("string").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names]
        if entities_col:
            own.append(F.coalesce("_made.kinds", F.array().cast("array<string>")).alias(entities_col))
        return rows.select(*own)

    if again is None:
        return rewritten(rows, None)
    of_text = mentions.select("digest", F.col("kind"), normal_form(F.col("kind"), F.col("s")).alias("norm")).distinct().join(again, ["kind", "norm"])
    entry = F.struct(F.concat_ws("\u001f", "kind", "norm").alias("key"), F.struct("as", "attempt").alias("value"))
    maps = common.persist_table(of_text.groupBy("digest").agg(F.map_from_entries(F.collect_set(entry)).alias("_draws")), "pii-redraws")
    # At most BUCKETS rows, whatever the input.
    bucket = lambda d: F.pmod(F.xxhash64(d), F.lit(BUCKETS)).cast("int")
    concerned = common.persist_table(maps.select(bucket(F.col("digest")).alias("_bucket")).distinct(), "pii-buckets")
    rows = rows.withColumn("_digest", digest).withColumn("_bucket", F.coalesce(bucket(F.col("_digest")), F.lit(-1)))
    some = rows.join(F.broadcast(concerned), "_bucket", "left_semi").join(maps.withColumnRenamed("digest", "_digest"), "_digest", "left")
    rest = rows.join(F.broadcast(concerned), "_bucket", "left_anti")
    return rewritten(some, F.coalesce(F.col("_draws"), F.create_map().cast("map<string,struct<as:string,attempt:int>>"))).unionAll(rewritten(rest, None))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    new = surrogates(docs, entities_col="kinds")
    return new.select("doc_id", "text", F.size("kinds").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"))
