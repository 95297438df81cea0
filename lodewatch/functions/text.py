"""Page text, page type, language and value functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodewatch.functions.url import blank_to_null, path

# They must be these for pages to be told apart as before.
SPA_MARKERS = r"""(?iu)__NEXT_DATA__|/_next/|id=["']__next["']|window\.__NUXT__|data-reactroot|ng-version=|window\.__INITIAL_STATE__|__remixContext|_sitecoreJSS"""
DOWNLOAD_BAIT = r"(?iu)click here|download|\bpdf\b|view (?:our|the)|read (?:our|the)|see (?:our|the)"
PAGE_RULES = (
    ("sustainability_page", r"sustainab|esg|environment|csr|responsib|climate|impact|sourcing|supplier|procure|supply.?chain|divers|inclusion|gender|human.?right|modern.?slavery|forced.?labo|trafficking|decarbon|net.?zero|emission|biodivers|circular.?econom|health.?safety|\behs\b|wellbeing|community|philanthrop"),
    ("reports_hub", r"report|annual|financ|result|filing|disclosur|publication|download|presentations|interim|half.?year|factbook|databook|/documents?(/|$)|librar"),
    ("investor_relations", r"investor|shareholder|/ir/|/ir$|stock|equity|\bagm\b|general.?meeting|prospectus|dividend"),
    ("news", r"news|press|media|/article|story|release|/blog"),
    ("policies", r"policy|policies|code-of-conduct|governance|ethics|compliance|whistleblow|anti.?corruption|anti.?bribery|conflict.?of.?interest|remuneration|charter|\btax\b"),
)
FREQUENCIES = {"news": "daily", "reports_hub": "mon_wed_fri", "sustainability_page": "mon_wed_fri", "investor_relations": "mon_wed_fri", "policies": "mon_fri", "other": "mon_fri"}
LABELS = {"sustainability_page": "Sustainability", "reports_hub": "Reports", "news": "News", "investor_relations": "Investor Relations", "policies": "Policies", "other": "Other", "homepage": "Homepage"}
LANGUAGES = {
    "af": "Afrikaans", "ar": "Arabic", "bg": "Bulgarian", "bn": "Bengali", "ca": "Catalan", "cs": "Czech", "cy": "Welsh", "da": "Danish", "de": "German", "el": "Greek", "en": "English",
    "es": "Spanish", "et": "Estonian", "fa": "Persian", "fi": "Finnish", "fr": "French", "gu": "Gujarati", "he": "Hebrew", "hi": "Hindi", "hr": "Croatian", "hu": "Hungarian", "id": "Indonesian",
    "it": "Italian", "ja": "Japanese", "kn": "Kannada", "ko": "Korean", "lt": "Lithuanian", "lv": "Latvian", "mk": "Macedonian", "ml": "Malayalam", "mr": "Marathi", "ne": "Nepali", "nl": "Dutch",
    "no": "Norwegian", "pa": "Punjabi", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak", "sl": "Slovenian", "so": "Somali", "sq": "Albanian", "sv": "Swedish",
    "sw": "Swahili", "ta": "Tamil", "te": "Telugu", "th": "Thai", "tl": "Tagalog", "tr": "Turkish", "uk": "Ukrainian", "ur": "Urdu", "vi": "Vietnamese", "zh-cn": "Chinese (Simplified)", "zh-tw": "Chinese (Traditional)",
}
SPA_SCAN, SPA_HTML, SPA_TEXT = 200_000, 10_000, 800
COMMENT, HIDDEN, TAG = r"(?s)<!--.*?-->", r"(?is)<(script|style|noscript|svg)[^>]*>.*?</\1>", r"(?s)<[^>]+>"
LANGUAGE_SCAN, LANGUAGE_LEAST = 10_000, 30

#: Function words by which a text's language is told; a choice of this library.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "are", "this", "by", "from", "it"),
    "de": ("der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "auf", "sich", "im"),
    "fr": ("le", "les", "des", "et", "du", "une", "est", "pour", "dans", "que", "au", "qui", "sur", "pas", "elle"),
    "es": ("el", "los", "las", "y", "en", "por", "con", "del", "para", "se", "su", "como", "una", "más", "lo"),
    "it": ("il", "di", "che", "per", "della", "sono", "gli", "nel", "non", "alla", "dei", "anche", "è", "ai", "dal"),
    "pt": ("os", "da", "do", "uma", "em", "com", "não", "ao", "dos", "das", "pela", "mais", "são", "na", "pelo"),
    "nl": ("het", "een", "van", "niet", "met", "voor", "zijn", "op", "ook", "aan", "te", "dat", "wordt", "naar", "uit"),
}


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def collapse(text: Column) -> Column:
    """White space collapsed to single spaces, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clip(text: Column, longest: int = 10_000) -> Column:
    return F.substring(collapse(text), 1, longest)


def visible_text(html: Column) -> Column:
    """The text outside comments, scripts, styles and tags; entities are left as they stand."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), COMMENT, " ")
    t = F.regexp_replace(t, HIDDEN, " ")
    return collapse(F.regexp_replace(t, TAG, " "))


def looks_like_spa(html: Column) -> Column:
    """A page drawn by scripts: a framework's mark, or much HTML with little text."""
    h = F.substring(F.coalesce(html, F.lit("")), 1, SPA_SCAN)
    return h.rlike(SPA_MARKERS) | ((F.length(h) > SPA_HTML) & (F.length(visible_text(h)) < SPA_TEXT))


def has_download_bait(html: Column) -> Column:
    return visible_text(F.substring(F.coalesce(html, F.lit("")), 1, SPA_SCAN)).rlike(DOWNLOAD_BAIT)


def lang_name(code: Column) -> Column:
    """A code's name, else its base code's, else the code; blank gives NULL."""
    names, c = literal_map(LANGUAGES), F.nullif(code, F.lit(""))
    return F.coalesce(F.try_element_at(names, c), F.try_element_at(names, F.substring_index(c, "-", 1)), c)


def declared_language(html: Column) -> Column:
    """The name of the language in <html lang>, NULL if none is declared."""
    tag = F.regexp_extract(html, r"(?is)<html\b([^>]*)>", 1)
    raw = F.regexp_extract(tag, r"""(?is)(?:^|\s)lang\s*=\s*["']?\s*([^"'\s>]*)""", 1)
    code = F.substring_index(F.substring_index(F.lower(raw), "-", 1), "_", 1)
    return F.when(code.rlike(r"^\p{L}{2,3}$"), lang_name(code))


def detect_language(text: Column) -> Column:
    """The name of the language whose function words a text holds most of; NULL for a text of under 30 letters or without any.

    Only the first 10,000 characters are looked at. A tie goes to the language named first; a null text has none.
    """
    letters = F.regexp_replace(F.lower(F.left(F.coalesce(text, F.lit("")), F.lit(LANGUAGE_SCAN))), r"[^\p{L}]+", " ")

    def best(words: Column) -> Column:
        held = lambda own: F.size(F.filter(words, lambda w: w.isin(*own)))
        return F.array_max(F.array(*(F.struct(held(own).alias("n"), F.lit(-k).alias("o"), F.lit(code).alias("code")) for k, (code, own) in enumerate(FUNCTION_WORDS.items()))))

    chosen = F.get(F.transform(F.array(F.split(letters, " ")), best), F.lit(0))
    enough = F.length(F.replace(letters, F.lit(" "), F.lit(""))) >= LANGUAGE_LEAST
    return F.when(enough & (chosen["n"] > 0), lang_name(chosen["code"]))


def page_language(html: Column) -> Column:
    """The declared language, else the one that the page's visible text tells."""
    return F.coalesce(declared_language(html), detect_language(visible_text(html)))


def page_type(url: Column, anchor: Column) -> Column:
    """The first rule that the path and anchor text meet; order is priority."""
    blob = F.lower(F.concat_ws(" ", path(url), F.coalesce(anchor, F.lit(""))))
    first, *rest = PAGE_RULES
    chosen = reduce(lambda w, rule: w.when(blob.rlike(f"(?u){rule[1]}"), rule[0]), rest, F.when(blob.rlike(f"(?u){first[1]}"), first[0]))
    return chosen.otherwise("other")


def frequency_for(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(FREQUENCIES), kind), F.lit("mon_fri"))


def label_for(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(LABELS), kind), F.lit("Other"))


def text_hash(text: Column) -> Column:
    return F.sha1(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " ")))


def truthy(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin("checked", "true", "1", "yes"), F.lit(False))


def effective_type(checked: Column, keyword: Column) -> Column:
    """The checked type, else the keyword type, else ''."""
    return F.coalesce(blank_to_null(checked), blank_to_null(keyword), F.lit(""))


def norm_value(value: Column) -> Column:
    """A value in the form in which it is compared: text trimmed and blank as NULL, a whole floating-point number without its point."""
    text = blank_to_null(value.cast("string"))
    return F.when(F.typeof(value).isin("double", "float"), F.when(value == F.floor(value), F.format_string("%.0f", value.cast("double"))).otherwise(text)).otherwise(text)


def is_due(frequency: Column, run_date: Column, force: bool = False) -> Column:
    """Whether a page of this frequency is visited on the run's day; what is unknown counts as weekly."""
    f, day = F.lower(F.trim(F.coalesce(frequency, F.lit("")))), F.weekday(run_date)
    due = F.when(f == "daily", True).when(f == "mon_wed_fri", day.isin(0, 2, 4)).when(f == "mon_fri", day.isin(0, 4)).when(f.isin("monthly", "quarterly"), F.dayofmonth(run_date) == 1)
    return F.lit(True) if force else due.otherwise(day == 0)
