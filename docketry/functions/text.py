"""Text normalisation, hashing and quality as column expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"


def collapse(text: Column) -> Column:
    """White space, no-break spaces included, collapsed to single blanks and trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, NBSP, " "), r"\s+", " "))


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def canonical_text_hash(text: Column) -> Column:
    """SHA-256 of the collapsed text: the same for texts that differ in white space alone."""
    return F.sha2(collapse(text), 256)


def name_key(name: Column) -> Column:
    """Lower case, letters a-z and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")


def docket_key(docket: Column) -> Column:
    """Lower case without white space."""
    return F.lower(F.regexp_replace(docket, r"\s+", ""))


def text_is_thin(text: Column, least: int = 200) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < least


def has_body(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) > 0


def summary(text: Column, words: int = 500) -> Column:
    """The first ``words`` words."""
    return F.array_join(F.slice(F.split(collapse(text), " "), 1, words), " ")


def fit_key(value: Column, limit: int = 500) -> Column:
    """A key of bounded length: an over-long one keeps its head and gets '#' and its hash."""
    return F.when(F.length(value) <= limit, value).otherwise(F.concat(F.substring(value, 1, limit - 65), F.lit("#"), F.sha2(value, 256)))


def slug(text: Column, limit: int = 80) -> Column:
    """A file-system-safe part of a path."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, limit)


def letter_ratio(text: Column) -> Column:
    """Share of Unicode letters among the characters; 0 for an empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"\p{L}")) / F.length(text)).otherwise(0.0)


def digit_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"[0-9]")) / F.length(text)).otherwise(0.0)


# Sequences that Latin-1 readings of UTF-8 leave behind, words of schedules, and limits of the quality rules.
MOJIBAKE = r"Ã[^\n]|Â[^\n]|ï»¿|â€"
SCHEDULE_WORDS = ["schedule", "tariff", r"customs\s+duty", r"serial\s+no", r"description\s+of\s+goods", r"heading\s+no", r"rate\s+of\s+duty", r"hs\s+code"]
SCHEDULE = rf"(?i)\b({'|'.join(SCHEDULE_WORDS)})\b"
LEAST_CHARS, MOST_MOJIBAKE, LEAST_LETTERS, LEAST_LETTERS_SCHEDULE, MOST_LOST = 40, 0.012, 0.28, 0.12, 3
LEAST_GARBLED, MOST_OUTSIDE_WORDS, LEAST_SCRIPT_LETTERS = 80, 0.75, 8


def mojibake_density(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(MOJIBAKE)) / F.length(text)).otherwise(0.0)


def has_mojibake_run(text: Column) -> Column:
    """Four question marks in a row."""
    return F.coalesce(text.rlike(r"\?{4,}"), F.lit(False))


def is_schedule(text: Column) -> Column:
    """A schedule of figures: named so, and more than 8 % digits."""
    return text.rlike(SCHEDULE) & (digit_ratio(text) > 0.08)


def fails_ocr_quality(text: Column) -> Column:
    """Dense mojibake, too few letters (schedules may have fewer) or three replacement characters; short texts pass."""
    body = F.trim(F.coalesce(text, F.lit("")))
    least = F.when(is_schedule(body), LEAST_LETTERS_SCHEDULE).otherwise(LEAST_LETTERS)
    bad = (mojibake_density(body) >= MOST_MOJIBAKE) | (letter_ratio(body) < least) | (F.regexp_count(body, F.lit("�")) >= MOST_LOST)
    return (F.length(body) >= LEAST_CHARS) & bad


# Blocks of Arabic script, and the private-use area in which older fonts keep its letter forms.
ARABIC = r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}"
PRIVATE = r"\x{E000}-\x{F8FF}"


def script_letters(text: Column) -> Column:
    """Letters, with everything of Arabic script and the private-use letter forms counted as one."""
    return F.regexp_count(text, F.lit(rf"[\p{{L}}{ARABIC}{PRIVATE}]"))


def arabic_share(text: Column) -> Column:
    """Share of Arabic-script characters and private-use letter forms among the letters."""
    return F.when(script_letters(text) > 0, F.regexp_count(text, F.lit(f"[{ARABIC}{PRIVATE}]")) / script_letters(text)).otherwise(0.0)


def is_arabic_script(text: Column) -> Column:
    """At least half of the letters are of Arabic script; a text of fewer than 8 letters is not."""
    return F.coalesce((script_letters(text) >= LEAST_SCRIPT_LETTERS) & (arabic_share(text) >= 0.5), F.lit(False))


def long_word_share(text: Column) -> Column:
    """Share of the characters that are in Latin words of four letters or more."""
    longs = F.regexp_replace(text, "[A-Za-z]{4,}", "")
    return F.when(F.length(text) > 0, (F.length(text) - F.length(longs)) / F.length(text)).otherwise(0.0)


def is_garbled(text: Column) -> Column:
    """80 characters or more of which more than three quarters are outside long Latin words; Arabic script and schedules aside."""
    body = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(body) >= LEAST_GARBLED) & ~is_arabic_script(body) & ~is_schedule(body) & (1 - long_word_share(body) > MOST_OUTSIDE_WORDS)


def has_readable_words(text: Column) -> Column:
    """A text layer worth keeping: Arabic script, or 40 characters or more with 12 in long Latin words and not garbled by their share."""
    body = F.trim(F.coalesce(text, F.lit("")))
    covered = long_word_share(body) * F.length(body)
    return is_arabic_script(body) | ((F.length(body) >= LEAST_CHARS) & (F.round(covered) >= 12) & (1 - long_word_share(body) <= MOST_OUTSIDE_WORDS))


# Characters of prose beside ASCII and Arabic script, first characters of image files read as text, and names they hold.
PROSE_EXTRAS = "\u00a0\u2013\u2014\u2018\u2019\u201c\u201d\u2022\u00b7"
READABLE = rf"[\t\r\n\x20-\x7e{ARABIC}{PRIVATE}{PROSE_EXTRAS}]"
JPEG_HEAD, PNG_HEAD, IMAGE_NAMES = "\u00ff\u00d8\u00ff", "\u0089PNG", r"JFIF|ICC_PROFILE|\x00"
UNPRINTABLE = rf"[\p{{C}}\p{{Z}}&&[^ {PRIVATE}]]"


def is_binary_garbage(text: Column) -> Column:
    """A text that is no text: it begins as an image file does, or its share of readable characters is below a half (below 0.85 where it
    holds a name that image files hold), or more than a fifth of it cannot be printed. Texts of less than 8, or for the last 32,
    characters are too short for the shares; blank texts are none."""
    body = F.coalesce(text, F.lit(""))
    n = F.length(body)
    readable = F.regexp_count(body, F.lit(READABLE))
    begins = F.contains(F.substring(body, 1, 32), F.lit(JPEG_HEAD)) | F.startswith(body, F.lit(PNG_HEAD))
    needed = F.when(body.rlike(IMAGE_NAMES), 0.85).when(n >= 8, 0.5).otherwise(0.0)
    unprintable = F.when(n >= 32, F.regexp_count(body, F.lit(UNPRINTABLE))).otherwise(0)
    return (F.length(F.regexp_replace(body, r"^\s+", "")) > 0) & (begins | (readable < needed * n) | (unprintable > 0.2 * n))


def collapse_letter_spaced(text: Column) -> Column:
    """'O R D E R' and 'J U D G M E N T' back to words."""
    out = text
    for word in ("ORDER", "JUDGMENT", "JUDGEMENT"):
        out = F.regexp_replace(out, r"\b" + r"\s".join(word) + r"\b", word)
    return out


# Headers whose values are secrets, names that secrets are given under ('*' for any ending), and published token
# formats (prefix, characters that follow, least number of them).
SECRET_HEADERS = ["cookie", "set-cookie"]
SECRET_NAMES = [
    "api_key", "api-key", "apikey", "secret", "password", "passwd", "pwd", "token", "session_id", "session-id", "sessionid", "sessid", "sid", "jsessionid", "phpsessid",
    "asp.net_sessionid", ".aspnetcore.*", ".aspxauth", "csrf*", "xsrf*", "__requestverificationtoken", "access_token", "access-token", "accesstoken",
    "refresh_token", "refresh-token", "refreshtoken", "id_token", "auth*",
]
TOKEN_FORMATS = [("sgai-", r"A-Za-z0-9\-", 16), ("sk-", "A-Za-z0-9", 20), ("AKIA", "0-9A-Z", 16), ("gAAAA", r"A-Za-z0-9_\-=", 40)]


def _secret_name(name: str) -> str:
    out = name.rstrip("*").replace(".", r"\.")
    return (r"\b" if out[0].isalnum() else "") + out + (r"[\w.-]*" if name.endswith("*") else "")


def secret_shapes() -> list[str]:
    """Patterns of secrets; the first group of each, where it has one, is what may stay."""
    headers = rf"(?i)((?:{'|'.join(SECRET_HEADERS)})\s*:\s*)[^\n]+"
    login = r"(?i)(authorization\s*:\s*)(?:bearer|basic)\s+[\w.~+/-]+=*"
    named = rf"(?i)((?:{'|'.join(map(_secret_name, SECRET_NAMES))})\s*[=:]\s*)['\"]?[^\s'\"&;<]{{6,}}"
    return [login, headers, named, *(rf"()\b{prefix}[{of}]{{{least},}}" for prefix, of, least in TOKEN_FORMATS)]


def scrub_secrets(text: Column) -> Column:
    out = text
    for shape in secret_shapes():
        out = F.regexp_replace(out, shape, "$1[REDACTED]")
    return out


def contains_secret(text: Column) -> Column:
    out = F.lit(False)
    for shape in secret_shapes():
        out = out | F.coalesce(text.rlike(shape), F.lit(False))
    return out


def contains_all(text: Column, words: list[str]) -> Column:
    """Every word of two characters or more in the text without regard to case."""
    out = F.lit(True)
    for w in [w for w in words if len(w) >= 2]:
        out = out & F.contains(F.lower(text), F.lit(w.lower()))
    return out


def snippet(text: Column, words: list[str], width: int = 300, lead: int = 100) -> Column:
    """A window that begins ``lead`` characters before the first word found."""
    spots = [F.nullif(F.instr(F.lower(text), w.lower()), F.lit(0)) for w in words if len(w) >= 2]
    first = F.coalesce(F.least(*spots) if len(spots) > 1 else spots[0], F.lit(1))
    begin = F.greatest(first - lead, F.lit(1))
    body = F.substr(text, begin, F.lit(width))
    return F.concat(F.when(begin > 1, "…").otherwise(""), body, F.when(F.length(text) >= begin + width, "…").otherwise(""))
