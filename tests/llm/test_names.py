"""Names: ordinary text is left alone, mentions and genitives follow the name, the key is
no part of the code."""

import random
import re

import pytest

from sitelattice.llm import pii


@pytest.fixture(autouse=True, scope="module")
def surrogate_key(spark):
    spark.conf.set(pii.KEY_SETTING, "key of the tests")
    yield
    spark.conf.unset(pii.KEY_SETTING)


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.surrogates(docs).orderBy("doc_id").collect()]


def clean_sentences(n, seed):
    """Ordinary sentences with words and numbers that look like forms of address,
    addresses and accounts."""
    rng = random.Random(seed)
    noun = lambda: rng.choice("steel size grade series panel cable valve filter motor bracket".split())
    proper = lambda: rng.choice("Steel Alloy Series Panel Valve Quijote Lanka Universe Corleone Giovanni Lancelot Marple".split())
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    forms = [
        lambda: f"Use Grade M {proper()} and size M. Only the M Series {noun()} fits.", lambda: f"John M. Smith wrote about the {noun()} of size M. Then it broke.",
        lambda: f"Miss {proper()} is a title, Don {proper()} a book and Sir {proper()} a legend.", lambda: f"Don Quijote never saw a {noun()}; Don Giovanni did.",
        lambda: f"Install version {rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)} of the {noun()} driver.", lambda: f"Release {rng.randint(0, 9)}.{rng.randint(0, 20)}.3.4 and v {rng.randint(1, 9)}.0.0.1 are out.",
        lambda: f"See ISBN 978-{rng.randint(0, 9)}-{digits(2)}-{digits(6)}-{rng.randint(0, 9)} on the {noun()}.", lambda: f"ISBN: 979{digits(10)} and ISBN-13 978{digits(10)} are books.",
        lambda: f"You should see the Dr. Then take the {noun()}.", lambda: f"Ask the Prof. The {noun()} is hers. Madam President agreed.",
        lambda: f"Ein {noun()} der Klasse M. Das ist gut. Don't miss it.", lambda: f"The Sr. Engineer has a {noun()}; the M Line ends here.",
        lambda: f"In {rng.randint(1900, 2024)} some {rng.randint(2, 900)} of {rng.randint(2, 900)} {noun()}s were made, {rng.random():.4f} of all.", lambda: f"Take M {proper()}, L {proper()} or S {proper()} on {rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1990, 2024)}.",
    ]
    return [rng.choice(forms)() for _ in range(n)]


def test_ordinary_sentences_are_left_alone(spark):
    made = clean_sentences(2000, 12)
    new = replaced(spark, made)
    changed = [(a, b) for a, b in zip(made, new, strict=True) if a != b]
    assert len(changed) <= 0.005 * len(made), changed[:5]


FIRST = "Maria Anna Carl Paul Olivia Zacharias Wendeline Thibault".split()
FAMILY = "Stein Müller Dupont Smith-Jones O'Brien García Nowak Iversen".split()


def test_names_with_a_form_of_address_are_found(spark):
    """Recall over forms of address, and of later mentions: nothing of a name is left."""
    rng, texts, names = random.Random(5), [], []
    titles = ["Mr", "Mr.", "Mrs", "Ms.", "Herr", "Frau", "Señor", "Señora", "Sra.", "Madame", "Mme", "Monsieur", "Dr", "Dr.", "Prof.", "Mademoiselle"]
    for _ in range(400):
        first, family, title = rng.choice(FIRST), rng.choice(FAMILY), rng.choice(titles)
        texts.append(rng.choice([
            f"Yesterday {title} {first} {family} came. {first} {family} left, and {family}'s car stayed.", f"We met {title} {family}. Later {family} wrote; {family}’s letter is here.",
            f"{title} {first} Q. {family} spoke. Then {first} sat down.", f"Ask {title} {family} or Mr Hugo {family}, said {family}.", f"Est venu et M. {first} {family}; hier {family} aussi.",
        ]))
        names.append((first, family))
    new = replaced(spark, texts)
    left = [(a, b) for a, b, both in zip(texts, new, names, strict=True) for w in both if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", b)]
    assert len(left) <= 0.02 * len(texts), left[:5]


def test_mentions_follow_the_name(spark):
    a, b, c, d, e = replaced(spark, [
        "Dr Maria met Frau Maria Stein. Maria Stein left. Steinway, Maria-Luisa and steins stay.", "Mr Müller’s house. Mr Müller left. Müller's dog.", "Mr James Brown ate brown bread. Brown is a colour. James Brown left.",
        "Maria Stein stands here without any form of address.", "Herr Stein mailed Stein.k@corp.example.org twice.",
    ])
    m = re.fullmatch(r"Dr (\w+) met Frau (\w+) (\w+)\. (\w+) (\w+) left\. Steinway, Maria-Luisa and steins stay\.", a)
    assert m and m[1] == m[2] == m[4] and m[3] == m[5] and "Maria" not in m.groups()
    m = re.fullmatch(r"Mr (\w+)’s house\. Mr (\w+) left\. (\w+)'s dog\.", b)
    assert m and m[1] == m[2] == m[3] != "Müller"
    m = re.fullmatch(r"Mr (\w+) (\w+) ate brown bread\. Brown is a colour\. (\w+) (\w+) left\.", c)
    assert m and m.groups()[:2] == m.groups()[2:] and m[2] != "Brown"
    assert d.startswith("Maria Stein") and re.fullmatch(r"Herr \w+ mailed [A-Z][a-z]{4}\.[a-z]@[a-z]{4}\.[a-z]{7}\.org twice\.", e)


def test_mentions_count_as_names(spark):
    docs = spark.createDataFrame([(1, "Frau Maria Stein. Stein left The Hague."), (2, "The Hague"), (3, "Frau Anna, 10.0.0.1")], "doc_id long, text string")
    got = {r["doc_id"]: r["kinds"] for r in pii.surrogates(docs, entities_col="kinds").collect()}
    assert got == {1: ["name", "name"], 2: [], 3: ["name", "ip"]}


def test_long_text_of_many_names(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8)).capitalize()
    names = [(word(), word()) for _ in range(400)]
    text = " ".join(f"Mr {a} {b} said that {b} went on." for a, b in names) + " filler words go here" * 20_000
    (new,) = replaced(spark, [text])
    assert new.endswith(" filler words go here" * 20_000) and not any(w in new for both in names for w in both)


def test_key(spark):
    docs = spark.createDataFrame([(1, "Mr Smith, a@corp.de")], "doc_id long, text string")
    one = pii.surrogates(docs).first()["text"]
    assert pii.surrogates(docs, key="another").first()["text"] != one == pii.surrogates(docs, key="key of the tests").first()["text"]
    spark.conf.unset(pii.KEY_SETTING)
    try:
        drawn = pii.session_key(spark)
        assert len(drawn) == 64 and pii.session_key(spark) == drawn and pii.surrogates(docs).first()["text"] == pii.surrogates(docs, key=drawn).first()["text"]
    finally:
        spark.conf.set(pii.KEY_SETTING, "key of the tests")
