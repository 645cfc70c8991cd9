"""Moods, languages, genres and the constants of the service."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------

ANY_GENRE = "Any Genre"
MOOD_UPDATE = "mood_update"
PLAYLIST_LENGTH = 8
PRIMARY_LIMIT = 25
ALTERNATE_LIMIT = 15
TOP_GENRES = 5
DEBOUNCE_COUNT = 2
SAMPLING_GAP_SECONDS = 10.0
HISTORY_LENGTH = 10
HISTORY_SHOWN = 5
STATS_EVERY = 10
MANUAL_CONFIDENCE = 100.0

DEFAULT_LANGUAGE = "en"
DEFAULT_LANGUAGE_NAME = "English"
DEFAULT_REGION = "US"
DEFAULT_EMOJI = "🎭"
FALLBACK_GENRES = ["Pop", "Rock"]

LANGUAGES = {
    "English": "en",
    "Spanish": "es",
    "French": "fr",
    "German": "de",
    "Italian": "it",
    "Portuguese": "pt",
    "Hindi": "hi",
    "Tamil": "ta",
    "Telugu": "te",
    "Korean": "ko",
    "Japanese": "ja",
    "Chinese": "zh",
    "Arabic": "ar",
    "Russian": "ru",
}

REGIONS = {
    "en": "US",
    "es": "ES",
    "fr": "FR",
    "de": "DE",
    "it": "IT",
    "pt": "BR",
    "hi": "IN",
    "ta": "IN",
    "te": "IN",
    "ko": "KR",
    "ja": "JP",
    "zh": "CN",
    "ar": "AE",
    "ru": "RU",
}

GENRES = [
    "Pop",
    "Rock",
    "Hip Hop",
    "Jazz",
    "Classical",
    "Electronic",
    "R&B",
    "Country",
    "Indie",
    "Metal",
    "Folk",
    "Blues",
    "Reggae",
    "Latin",
    "K-Pop",
    "Bollywood",
]

MOODS = ["happy", "sad", "angry", "neutral", "fear", "surprise", "disgust"]

MOOD_EMOJI = {
    "happy": "😊",
    "sad": "😢",
    "angry": "😠",
    "neutral": "😐",
    "fear": "😨",
    "surprise": "😮",
    "disgust": "🤢",
}

MOOD_KEYWORDS = {
    "happy": ["upbeat", "cheerful", "joyful", "uplifting", "feel good"],
    "sad": ["melancholic", "emotional", "heartbreak", "slow", "ballad"],
    "angry": ["intense", "aggressive", "powerful", "hard", "energetic"],
    "neutral": ["calm", "ambient", "relaxing", "chill", "smooth"],
    "fear": ["dark", "mysterious", "suspenseful", "dramatic", "intense"],
    "surprise": ["unexpected", "exciting", "dynamic", "surprising", "energetic"],
    "disgust": ["aggressive", "intense", "raw", "powerful", "emotional"],
}

DEFAULT_GENRES = {
    "happy": ["Pop", "Electronic", "Latin", "K-Pop", "Bollywood"],
    "sad": ["Ballad", "Classical", "Blues", "Jazz", "Folk"],
    "angry": ["Metal", "Rock", "Hip Hop"],
    "neutral": ["Jazz", "Classical", "Indie"],
    "fear": ["Classical", "Electronic"],
    "surprise": ["Electronic", "Pop", "Rock"],
    "disgust": ["Metal", "Rock"],
}

# --- lookups ------------------------------------------------------------------------------


def string_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def lookup(mapping: dict, key: Column) -> Column:
    """Value for ``key`` in a fixed mapping, NULL when absent.

    The mapping folds into a literal, so the lookup costs no join.
    """
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), string_array(v) if isinstance(v, list) else F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), key)
