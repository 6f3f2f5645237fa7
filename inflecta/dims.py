"""Fixed values of the data model: voices, moods, tenses, pronouns, persons and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Voice key, id of its HTML block, prefix of its mood blocks.
VOICES = [
    ("voix_active_avoir", "voix_active_avoir", "active"),
    ("voix_active_etre", "voix_active_être", "active"),
    ("voix_active", "voix_active", "active"),
    ("voix_passive", "voix_passive", "passive"),
    ("voix_prono", "voix_prono", "prono"),
]
VOICE_ORDER = [voice for voice, _, _ in VOICES]

# Mood key and the suffix of its HTML block id, in review order.
MOODS = [
    ("participe", "par"),
    ("indicatif", "ind"),
    ("subjonctif", "sub"),
    ("conditionnel", "con"),
    ("imperatif", "imp"),
]
MOOD_ORDER = [mood for mood, _ in MOODS]
FINITE_MOODS = MOOD_ORDER[1:]

# Tense key and its display title, in review order.
TENSES = [
    ("present", "présent"),
    ("passe", "passé"),
    ("imparfait", "imparfait"),
    ("passe_simple", "passé simple"),
    ("futur_simple", "futur simple"),
    ("passe_compose", "passé composé"),
    ("plus_que_parfait", "plus-que-parfait"),
    ("passe_anterieur", "passé antérieur"),
    ("futur_anterieur", "futur antérieur"),
]
TENSE_ORDER = [tense for tense, _ in TENSES]
TENSE_OF_TITLE = {title: tense for tense, title in TENSES}
TITLE_OF_TENSE = {**dict(TENSES), "participe": "participe"}

# Tense order of the comparison of one person across tenses.
COMPARISON_TENSES = [
    "present",
    "imparfait",
    "passe_simple",
    "futur_simple",
    "passe_compose",
    "plus_que_parfait",
    "passe_anterieur",
    "futur_anterieur",
]

# Atomic persons in output order, with display label and pronoun.
PERSONS = [
    ("1sm", "je (m)", "je"),
    ("1sf", "je (f)", "je"),
    ("2sm", "tu (m)", "tu"),
    ("2sf", "tu (f)", "tu"),
    ("3sm", "il", "il"),
    ("3sf", "elle", "elle"),
    ("3sn", "on", "on"),
    ("1pm", "nous (m)", "nous"),
    ("1pf", "nous (f)", "nous"),
    ("2pm", "vous (m)", "vous"),
    ("2pf", "vous (f)", "vous"),
    ("3pm", "ils", "ils"),
    ("3pf", "elles", "elles"),
]
PERSON_ORDER = [person for person, _, _ in PERSONS]
PERSON_LABELS = {person: label for person, label, _ in PERSONS}
PERSON_PRONOUNS = {person: pronoun for person, _, pronoun in PERSONS}

# Short person names that stand for both genders.
PERSON_ALIASES = {
    "1s": ["1sm", "1sf"],
    "2s": ["2sm", "2sf"],
    "1p": ["1pm", "1pf"],
    "2p": ["2pm", "2pf"],
}

# Pronoun key to the persons it fills.
PERSONS_OF_PRONOUN = {
    "je": ["1sm", "1sf"],
    "tu": ["2sm", "2sf"],
    "nous": ["1pm", "1pf"],
    "vous": ["2pm", "2pf"],
    "je_m": ["1sm"],
    "je_f": ["1sf"],
    "tu_m": ["2sm"],
    "tu_f": ["2sf"],
    "nous_m": ["1pm"],
    "nous_f": ["1pf"],
    "vous_m": ["2pm"],
    "vous_f": ["2pf"],
    "il": ["3sm"],
    "elle": ["3sf"],
    "on": ["3sn"],
    "ils": ["3pm"],
    "elles": ["3pf"],
}

# Present forms of the two auxiliaries.
AVOIR_FORMS = ["ai", "as", "a", "avons", "avez", "ont"]
ETRE_FORMS = ["suis", "es", "est", "sommes", "êtes", "sont"]

# Auxiliary name to voice, and voice to auxiliary label.
VOICE_OF_AUXILIARY = {
    "avoir": "voix_active_avoir",
    "etre": "voix_active_etre",
    "être": "voix_active_etre",
    "pronominal": "voix_prono",
}
AUXILIARY_OF_VOICE = {
    "voix_active_avoir": "avoir",
    "voix_active_etre": "être",
    "voix_prono": "pronominal",
}

# Prefix of current-edition entry ids.
ENTRY_ID_PREFIX = "A9"

# Gender and number slots of participles.
PARTICIPLE_FORMS = ["sm", "sf", "pm", "pf"]

# Persons a complete tense covers.
FULL_PERSONS = [person for person in PERSON_ORDER if person != "3sn"]
NEUTRAL_PERSONS = ["3sn", "1pm", "1pf", "2pm", "2pf", "3pm", "3pf"]
IMPERATIVE_PERSONS = ["2sm", "2sf", "1pm", "1pf", "2pm", "2pf"]


def literal_map(values: dict) -> Column:
    """A constant map; the optimizer folds it to one literal."""
    return F.create_map(*[F.lit(item) for pair in values.items() for item in pair])


def rank_of(values: list[str], column: Column) -> Column:
    """Position of ``column`` in ``values``, NULL when absent."""
    return literal_map({value: i for i, value in enumerate(values)})[column]


def array_of(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def atomic_persons(person: str) -> list[str]:
    """Atomic persons a person name stands for."""
    return PERSON_ALIASES.get(person, [person])


def covers(personne: Column, person: str) -> Column:
    """Whether a merged person key covers ``person`` (or, for an alias, one of its genders)."""
    return F.arrays_overlap(F.split(personne, ";"), array_of(atomic_persons(person)))


def first_person_rank(personne: Column) -> Column:
    """Rank of the first atomic person of a merged key: merged keys are in person order."""
    return rank_of(PERSON_ORDER, F.substring_index(personne, ";", 1))
