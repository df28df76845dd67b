"""Rule presets (JOB-04 / JOB-05): driver-side configuration, never data.

Fixed values: the survey label dictionary and the rule lists below must
equal the source's for the same cleaning result.  One deliberate change:
``isTrue`` listed as a *standardiser* for ``is_listening`` is dropped here
(the source silently ignores unknown standardisers; we reject them, Q-03).
"""

from __future__ import annotations

from ..operators.quality import TableRules
from .standardise import SURVEY_STANDARDISERS, to_quantitative
from .validate import SURVEY_VALIDATORS

# Survey answer label -> number, per question (natural order).
SURVEY_LABELS = {
    "when": {"Matin": 1, "Midi": 2, "Après-midi": 3, "Soir": 4},
    "duration": {"- de 2 minutes": 2, "- de 5 minutes": 5, "- de 10 minutes": 10, "+ de 10 minutes": 11},
    "tempo": {"Lent": 1, "Rapide": 2, "Très rapide": 3, "Très très rapide": 4},
    "quality": {"En désaccord": 1, "Plutôt en désaccord": 2, "Plutôt d'accord": 3, "D'accord": 4},
    "curiosity": {"Je veux uniquement écouter la musique que j’aime déjà": 1,
                  "Je préfère rester sur les genres que je connais déjà": 2,
                  "J’aime bien découvrir, mais je garde mes styles habituels": 3,
                  "J’adore découvrir de nouveaux genres et artistes": 4},
}


def flat_labels() -> dict[str, float]:
    """First label match across *all* questions, case-insensitive (SCL-17)."""
    out: dict[str, float] = {}
    for labels in SURVEY_LABELS.values():
        for k, v in labels.items():
            out.setdefault(k.lower().strip(), float(v))
    return out


_QUANT = lambda c: to_quantitative(c, flat_labels())
_SURVEY_STD = dict(SURVEY_STANDARDISERS, convertToQuantitative=lambda c: _QUANT(c).cast("string"))

# The survey's questions, as the raw answers file heads its columns, and their short names.
SURVEY_RENAME = {
    "Horodateur": "created_at",
    "Pour être sûr ": "has_consented",
    "Écoutez-vous de la musique ? ": "is_listening",
    "🗓️🎵 À quelle fréquence écoutez-vous de la musique ?": "frequency",
    "🏘️🎵 Dans quel(s) contexte(s) écoutez-vous vos musiques ?": "context",
    "🌞🎵 À quel moment de la journée écoutez-vous le plus de la musique ? ": "when",
    "❓🎵 Comment écoutez-vous vos musiques ?": "how",
    "📱🎵 Quelle(s) plateforme(s) de streaming utilisez-vous ?": "platform",
    "🧐🎵 Vos musiques servent à :": "utility",
    "🔡🎵 Quels sont vos genres de musique préférés": "track_genre",
    "⏰🎵 Quelle est la durée moyenne des musiques que vous écoutez ?": "duration",
    "🎧🎵 Écoutez-vous plutôt des morceaux ": "energy",
    "🚲🎵 Quel est le tempo des musiques que vous écoutez ?": "tempo",
    "👂🎵 Les musiques que vous écoutez sont plutôt": "feeling",
    "🔴🎵 Écoutez-vous des musiques interprétées en live ? (concert par exemple)": "is_live",
    "🔊🎵 La qualité de l'audio est importante pour moi": "quality",
    "💪🎵 A quel point êtes vous prêt(e) à découvrir de nouveaux genres ou artistes ?": "curiosity",
    "📊 Quelle est votre tranche d'âge ?": "age_range",
    "👤 Quel est votre genre ?": "gender",
    "👔 Dans quel domaine travaillez-vous ?": "position",
}

_T = ["trimEmoji", "trimSpaces"]
SURVEY_RULES = TableRules(
    rename=SURVEY_RENAME,
    standardisers=_SURVEY_STD,
    validators=SURVEY_VALIDATORS,
    standardisation={
        "created_at": ["parseDate"],
        "has_consented": _T + ["toString", "toLowerCase"],
        "is_listening": _T + ["toBoolean", "toLowerCase"],
        "frequency": _T + ["toString", "toLowerCase"],
        "context": _T + ["toArray", "toLowerCase"],
        "when": _T + ["convertToQuantitative", "toLowerCase"],
        "how": _T + ["toArray", "toLowerCase"],
        "platform": _T + ["toArray", "toLowerCase"],
        "utility": _T + ["toArray", "toLowerCase"],
        "track_genre": _T + ["toArray", "toLowerCase"],
        "duration": _T + ["convertToQuantitative", "toLowerCase"],
        "energy": _T + ["toString", "toLowerCase"],
        "tempo": _T + ["convertToQuantitative", "toLowerCase"],
        "feeling": _T + ["toString", "toLowerCase"],
        "is_live": _T + ["toString", "toLowerCase"],
        "quality": _T + ["convertToQuantitative", "toLowerCase"],
        "curiosity": _T + ["convertToQuantitative", "toLowerCase"],
        "age_range": _T + ["toString", "toLowerCase"],
        "gender": _T + ["toString", "toLowerCase"],
        "position": _T + ["toString", "toLowerCase"],
    },
    validation={
        "created_at": ["notNull", "beforeNow", "date"],
        "has_consented": ["notNull", "string"],
        "is_listening": ["notNull", "boolean"],
        "frequency": ["notNull", "string"],
        "context": ["notNull", "array"],
        "when": ["notNull", "float", "positiveNumber"],
        "how": ["notNull", "array"],
        "platform": ["notNull", "array"],
        "utility": ["notNull", "array"],
        "track_genre": ["notNull", "array"],
        "duration": ["notNull", "float", "positiveNumber"],
        "energy": ["notNull", "string"],
        "tempo": ["notNull", "float", "positiveNumber"],
        "feeling": ["notNull", "string"],
        "is_live": ["notNull", "string"],
        "quality": ["notNull", "float", "positiveNumber"],
        "curiosity": ["notNull", "float", "positiveNumber"],
        "age_range": ["notNull", "string"],
        "gender": ["notNull", "string"],
        "position": ["notNull", "string"],
    },
)

# Music presets, one per catalogue file (the 518-column features table shares
# one ``__all__`` rule across its columns).
TRACKS_RULES = TableRules(
    header_rows=2,
    rename={"level_0_level_1": "track_id"},
    subheader_key="track_id", subheader_values=("track_id",),
    standardisation={
        "track_id": ["toInt"], "album_id": ["toInt"], "artist_id": ["toInt"],
        "track_title": ["trimSpaces", "toString"], "track_duration": ["normalizeDuration", "toInt"],
        "track_genre_top": ["trimSpaces", "toString"], "track_genres": ["extractGenreIds", "toArray"],
        "track_tags": ["normalizeTags", "toArray"], "track_listens": ["toInt"], "track_favorites": ["toInt"],
        "track_interest": ["toFloat"], "track_comments": ["toInt"], "track_date_created": ["parseDate"],
        "track_composer": ["trimSpaces", "toString"], "track_lyricist": ["trimSpaces", "toString"],
        "track_publisher": ["trimSpaces", "toString"],
    },
    validation={
        "track_id": ["notNull", "unique", "notNegative", "int"],
        "track_title": ["notNull", "string"],
        "track_duration": ["notNull", "notNegative", "int"],
        "track_genre_top": ["string"],
        "track_genres": ["string", "array"],
        "track_tags": ["string", "array"],
        "track_listens": ["notNull", "notNegative", "int"],
        "track_favorites": ["notNull", "notNegative", "int"],
        "track_interest": ["notNull", "notNegative", "float"],
        "track_comments": ["notNull", "notNegative", "int"],
        "track_date_created": ["notNull", "beforeNow", "date"],
        "track_composer": ["string"],
        "track_lyricist": ["string"],
        "track_publisher": ["string"],
        "album_id": ["notNull", "notNegative", "int"],
        "artist_id": ["notNull", "notNegative", "int"],
    },
)

GENRES_RULES = TableRules(
    standardisation={"genre_id": ["toInt"], "parent": ["toInt"], "title": ["trimSpaces", "toString"],
                     "top_level": ["toInt"], "#tracks": ["toInt"]},
    validation={"genre_id": ["int", "notNull", "unique", "positiveNumber"],
                "parent": ["int", "notNull", "notNegative"],
                "title": ["string", "notNull"],
                "top_level": ["int", "notNull", "positiveNumber"],
                "#tracks": ["int", "notNull", "notNegative"]},
)

FEATURES_RULES = TableRules(
    header_rows=2,
    subheader_key="track_id", subheader_values=("number", "track_id"),
    rename={"feature_statistics": "track_id"},
    standardisation={"track_id": ["toInt"], "__all__": ["toFloat"]},
    validation={"track_id": ["notNull", "int"], "__all__": ["notNull", "float"]},
)

RAW_TRACKS_RULES = TableRules(
    standardisation={
        "track_id": ["toInt"], "album_id": ["toInt"], "artist_id": ["toInt"], "track_number": ["toInt"],
        "track_disc_number": ["toInt"], "track_favorites": ["toInt"], "track_listens": ["toInt"],
        "track_interest": ["toDouble"], "track_comments": ["toInt"], "track_title": ["trimSpaces", "toString"],
        "track_duration": ["normalizeDuration", "toInt"], "track_bit_rate": ["toInt"],
        "track_genres": ["extractGenreIds", "toArray"], "tags": ["normalizeTags", "toArray"],
        "track_composer": ["trimSpaces", "toString"], "track_lyricist": ["trimSpaces", "toString"],
        "track_publisher": ["trimSpaces", "toString"], "track_explicit": ["toBoolean"],
        "track_instrumental": ["toBoolean"], "track_date_created": ["parseDate"],
        "album_title": ["trimSpaces", "toString"], "artist_name": ["trimSpaces", "toString"],
    },
    validation={
        "track_id": ["notNull", "unique", "notNegative", "int"],
        "album_id": ["notNull", "notNegative", "int"],
        "artist_id": ["notNull", "notNegative", "int"],
        "track_number": ["notNegative", "int"],
        "track_disc_number": ["notNegative", "int"],
        "track_favorites": ["notNull", "notNegative", "int"],
        "track_listens": ["notNull", "notNegative", "int"],
        "track_interest": ["notNull", "notNegative", "double"],
        "track_comments": ["notNull", "notNegative", "int"],
        "track_title": ["notNull", "string"],
        "track_duration": ["notNull", "notNegative", "int"],
        "track_bit_rate": ["notNegative", "int"],
        "track_genres": ["string"],
        "tags": ["string"],
        "track_composer": ["string"],
        "track_lyricist": ["string"],
        "track_publisher": ["string"],
        "track_explicit": ["boolean"],
        "track_instrumental": ["boolean"],
        "track_date_created": ["notNull", "beforeNow", "date"],
        "album_title": ["string"],
        "artist_name": ["string"],
    },
)

RAW_ALBUMS_RULES = TableRules(
    standardisation={
        "album_id": ["toInt"], "album_title": ["trimSpaces", "toString"], "album_type": ["trimSpaces", "toString"],
        "album_tracks": ["toInt"], "album_date_released": ["parseDate"], "album_listens": ["toInt"],
        "album_favorites": ["toInt"], "album_comments": ["toInt"], "album_producer": ["trimSpaces", "toString"],
        "tags": ["normalizeTags", "toArray"],
    },
    validation={
        "album_id": ["notNull", "unique", "int", "notNegative"],
        "album_title": ["notNull", "string"],
        "album_type": ["notNull", "string"],
        "album_tracks": ["notNull", "int", "positiveNumber"],
        "album_date_released": ["date", "beforeNow"],
        "album_listens": ["notNull", "int", "notNegative"],
        "album_favorites": ["notNull", "int", "notNegative"],
        "album_comments": ["notNull", "int", "notNegative"],
        "album_producer": ["string"],
        "tags": ["array", "string"],
    },
)

RAW_ARTISTS_RULES = TableRules(
    standardisation={
        "artist_id": ["toInt"], "artist_name": ["trimSpaces", "toString"], "artist_bio": ["toString"],
        "artist_location": ["trimSpaces", "toString"], "artist_latitude": ["toFloat"],
        "artist_longitude": ["toFloat"], "artist_members": ["toString"], "artist_associated_labels": ["toString"],
        "artist_related_projects": ["toString"], "tags": ["normalizeTags", "toArray"],
        "artist_active_year_begin": ["toInt"], "artist_active_year_end": ["toInt"],
        "artist_favorites": ["toInt"], "artist_comments": ["toInt"],
    },
    validation={
        "artist_id": ["int", "notNull", "unique", "positiveNumber"],
        "artist_name": ["string", "notNull"],
        "artist_bio": ["string"],
        "artist_location": ["string"],
        "artist_latitude": ["float"],
        "artist_longitude": ["float"],
        "artist_members": ["string"],
        "artist_associated_labels": ["string"],
        "artist_related_projects": ["string"],
        "tags": ["array"],
        "artist_active_year_begin": ["int", "positiveNumber"],
        "artist_active_year_end": ["int", "positiveNumber"],
        "artist_favorites": ["int", "notNull", "notNegative"],
        "artist_comments": ["int", "notNull", "notNegative"],
    },
)

# The echonest file exists raw and pre-cleaned with the same three-row header
# and the same rules.
ECHONEST_RULES = TableRules(
    header_rows=3,
    subheader_key="track_id", subheader_values=("track_id",),
    rename={
        "level_0_level_1_level_2": "track_id",
        "echonest_audio_features_acousticness": "acousticness",
        "echonest_audio_features_danceability": "danceability",
        "echonest_audio_features_energy": "energy",
        "echonest_audio_features_instrumentalness": "instrumentalness",
        "echonest_audio_features_liveness": "liveness",
        "echonest_audio_features_speechiness": "speechiness",
        "echonest_audio_features_tempo": "tempo",
        "echonest_audio_features_valence": "valence",
        "echonest_ranks_artist_discovery_rank": "artist_discovery_rank",
        "echonest_ranks_artist_familiarity_rank": "artist_familiarity_rank",
        "echonest_ranks_artist_hotttnesss_rank": "artist_hotttnesss_rank",
        "echonest_ranks_song_currency_rank": "song_currency_rank",
        "echonest_ranks_song_hotttnesss_rank": "song_hotttnesss_rank",
        "echonest_social_features_artist_discovery": "artist_discovery",
        "echonest_social_features_artist_familiarity": "artist_familiarity",
        "echonest_social_features_artist_hotttnesss": "artist_hotttnesss",
        "echonest_social_features_song_currency": "song_currency",
        "echonest_social_features_song_hotttnesss": "song_hotttnesss",
    },
    standardisation={
        "track_id": ["toInt"],
        "acousticness": ["toFloat"], "danceability": ["toFloat"], "energy": ["toFloat"],
        "instrumentalness": ["toFloat"], "liveness": ["toFloat"], "speechiness": ["toFloat"],
        "tempo": ["toFloat"], "valence": ["toFloat"],
        "artist_discovery_rank": ["toFloat"], "artist_familiarity_rank": ["toFloat"],
        "artist_hotttnesss_rank": ["toFloat"], "song_currency_rank": ["toFloat"], "song_hotttnesss_rank": ["toFloat"],
        "artist_discovery": ["toFloat"], "artist_familiarity": ["toFloat"], "artist_hotttnesss": ["toFloat"],
        "song_currency": ["toFloat"], "song_hotttnesss": ["toFloat"],
    },
    validation={
        "track_id": ["notNull", "unique", "int", "notNegative"],
        "acousticness": ["notNull", "float", "notNegative"],
        "danceability": ["notNull", "float", "notNegative"],
        "energy": ["notNull", "float", "notNegative"],
        "instrumentalness": ["notNull", "float", "notNegative"],
        "liveness": ["notNull", "float", "notNegative"],
        "speechiness": ["notNull", "float", "notNegative"],
        "tempo": ["notNull", "float", "notNegative"],
        "valence": ["notNull", "float", "notNegative"],
        "artist_discovery_rank": ["float", "notNegative"],
        "artist_familiarity_rank": ["float", "notNegative"],
        "artist_hotttnesss_rank": ["float", "notNegative"],
        "song_currency_rank": ["float", "notNegative"],
        "song_hotttnesss_rank": ["float", "notNegative"],
        "artist_discovery": ["notNull", "float", "notNegative"],
        "artist_familiarity": ["notNull", "float", "notNegative"],
        "artist_hotttnesss": ["notNull", "float", "notNegative"],
        "song_currency": ["notNull", "float", "notNegative"],
        "song_hotttnesss": ["notNull", "float", "notNegative"],
    },
)

PRESETS = {"tracks.csv": TRACKS_RULES, "raw_tracks.csv": RAW_TRACKS_RULES, "raw_albums.csv": RAW_ALBUMS_RULES,
           "features.csv": FEATURES_RULES, "genres.csv": GENRES_RULES, "raw_echonest.csv": ECHONEST_RULES,
           "raw_artists.csv": RAW_ARTISTS_RULES, "echonest.csv": ECHONEST_RULES, "answers.csv": SURVEY_RULES}


def rules_for(file_name: str) -> TableRules | None:
    """Rule lookup by file name (missing ⇒ the file is skipped with a warning)."""
    return PRESETS.get(file_name)
