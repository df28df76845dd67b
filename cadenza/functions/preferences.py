"""The listener preference vector (REC-07) and profile attributes (REC-13) as configuration.

Fixed values: the labels and their numbers below are the survey's answers and
the vector's layout; results depend on them, so they stand here as plain text
in the vector's order.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from .standardise import parse_python_list

#: Slots in vector order: (column, {label: number}); None takes the column's own number.
VECTOR_SLOTS: list[tuple[str, dict[str, float] | None]] = [
    ("age_range", {"entre 13 et 18 ans": 0, "entre 19 et 24 ans": 1, "entre 25 et 34 ans": 2, "entre 35 et 44 ans": 3,
                   "entre 45 et 54 ans": 4, "entre 55 et 64 ans": 5, "65 ans et +": 6}),
    ("gender", {"homme": 1}),
    ("gender", {"femme": 1}),
    ("gender", {"autre": 1}),
    ("gender", {"préfère ne pas dire": 1}),
    ("position", {"redacteur administratif": 1, "administratif telecom": 1}),
    ("position", {"agriculture": 1}),
    ("position", {"animation": 1}),
    ("position", {"armée": 1}),
    ("position", {"arts & médias": 1}),
    ("position", {"petite enfance": 1, "enfance": 1}),
    ("position", {"fonctionnaire": 1}),
    ("position", {"commerce & services": 1}),
    ("position", {"communication": 1}),
    ("position", {"construction & industrie": 1}),
    ("position", {"culture": 1}),
    ("position", {"éducation": 1}),
    ("position", {"environnement": 1}),
    ("position", {"etat": 1, "fonction territoriale": 1}),
    ("position", {"santé": 1}),
    ("position", {"en invalidité": 1, "retraite": 1, "ne peux plus travailler": 1}),
    ("position", {"magnétiseuse": 1}),
    ("position", {"assistante maternelle": 1}),
    ("position", {"sciences humaines": 1}),
    ("position", {"service": 1}),
    ("position", {"étudiant": 1, "étudiante": 1, "etudiant": 1, "etudiante": 1, "formation": 1, "etudiant en sciences": 1}),
    ("position", {"sociale": 1}),
    ("position", {"technologie & informatique": 1}),
    ("position", {"transport": 1, "taxis": 1}),
    ("position", {"préfère ne pas dire": 1}),
    ("frequency", {"+ d'une fois par semaine": 0, "+ d'une fois par jour": 1, "+ d'une fois par mois": 2}),
    ("when_listening", None),
    ("duration_pref", None),
    ("energy_pref", {"avec une voix mais en fond": 1}),
    ("energy_pref", {"uniquement instrumentaux": 1}),
    ("energy_pref", {"avec des paroles": 1}),
    ("tempo_pref", None),
    ("feeling_pref", {"positives": 0, "tristes": 1}),
    ("is_live_pref", {"non": 0, "oui": 1}),
    ("quality_pref", None),
    ("curiosity_pref", None),
    ("context", {"seul(e)": 1}),
    ("context", {"en famille": 1}),
    ("context", {"entre amis": 1}),
    ("context", {"en fête": 1}),
    ("context", {"autre": 1}),
    ("how", {"cassettes": 1}),
    ("how", {"cd": 1, "mp3 de musique chargée à partir de cd": 1}),
    ("how", {"concert": 1}),
    ("how", {"téléchargements": 1}),
    ("how", {"festival": 1}),
    ("how", {"en live": 1}),
    ("how", {"radio": 1, "en roulant en voiture (radio)": 1, "radio ordinateur": 1, "en voiture": 1, "autoradios": 1}),
    ("how", {"streaming": 1, "you tube": 1, "télé .... sur mon ordi": 1, "youtube": 1}),
    ("how", {"vinyle": 1}),
    ("platform", {"amazonmusic": 1, "amazone music": 1}),
    ("platform", {"apple music": 1}),
    ("platform", {"deezer": 1}),
    ("platform", {"shazam": 1}),
    ("platform", {"spotify": 1}),
    ("platform", {"soundcloud": 1}),
    ("platform", {"youtube": 1}),
    ("platform", {"youtube revanced": 1}),
    ("platform", {"youtube music": 1}),
    ("utility", {"fond musical pendant le travail ou au volant de ma voiture": 1, "mp3 utilisé pendant la natation en piscine.": 1}),
    ("utility", {"se concentrer": 1}),
    ("utility", {"danser": 1}),
    ("utility", {"s'échapper": 1}),
    ("utility", {"passer le temps": 1}),
    ("utility", {"faire la fête": 1}),
    ("utility", {"se mettre dans sa bulle": 1}),
]

#: What a column's numbers are divided by (1 for others).
SCALE = {"duration_pref": 11.0, "age_range": 6.0, "frequency": 2.0, "when_listening": 4.0, "tempo_pref": 4.0, "quality_pref": 4.0,
         "curiosity_pref": 4.0}

#: Columns of several answers: a separator, or None for a list literal.
SEVERAL = {"energy_pref": ",  ", "context": None, "how": None, "platform": None, "utility": None}

#: REC-13: (column, points, largest difference that counts as a match or None for equal values).
PROFILE_ATTRIBUTES: list[tuple[str, int, int | None]] = [
    ("age_range", 3, None), ("gender", 2, None), ("platform", 2, None), ("how", 2, None), ("context", 1, None), ("frequency", 1, None),
    ("when_listening", 1, None), ("feeling_pref", 1, None), ("energy_pref", 1, None), ("is_live_pref", 1, None), ("utility", 1, None),
    ("duration_pref", 1, 5), ("quality_pref", 1, 2), ("curiosity_pref", 1, 2), ("tempo_pref", 1, 10),
]


def several_answers(prefs: DataFrame, columns: Sequence[str] = tuple(SEVERAL)) -> DataFrame:
    """The columns of several answers as arrays (bound once, however many slots read them); null gives none."""
    for c in columns:
        parsed = F.split(F.col(c), SEVERAL[c]) if SEVERAL[c] else parse_python_list(F.col(c))
        prefs = prefs.withColumn(c, F.coalesce(parsed, F.array().cast("array<string>")))
    return prefs


def vector_slots() -> list[tuple]:
    """The slots as :func:`operators.recommend.preference_vector` takes them."""
    out = []
    for column, labels in VECTOR_SLOTS:
        scale = SCALE.get(column, 1.0)
        if labels is None:
            out.append(("numeric", column, scale))
        else:
            out.append(("multihot" if column in SEVERAL else "ordinal", column, labels, scale))
    return out
