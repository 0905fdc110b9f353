"""Fixed values.

Everything in this file is data that results depend on: word lists, patterns,
replacement tables, thresholds and site defaults.  No logic lives here.
"""

import sys

# --- site defaults -----------------------------------------------------------
SITE = "https://www.example.com"
SEARCH_URL = SITE + "/buscador/"
ARTICLE_SECTIONS = (
    "economia", "politica", "sociedad", "america", "deportes",
    "tecno", "cultura", "salud", "el-mundo",
)
EXCLUDED_PATHS = ("/fotos/", "/buscador/")
CORE_SECTIONS = ("economia", "politica")

# --- thresholds --------------------------------------------------------------
MIN_TITLE = 20          # a title needs at least this many characters
MIN_PARAGRAPH_V1 = 20   # a first-form paragraph must be longer
MIN_PARAGRAPH = 30      # a later-form paragraph must be longer
LOW_CONTENT = 100       # a shorter body is suspicious
ENOUGH_PARAGRAPHS = 3   # fewer than this sends the body cascade to its next step
TARGET_ARTICLES = 2000
PAGES_PER_CHECKPOINT = 5
BODIES_PER_CHECKPOINT = 10
BODIES_PER_SNAPSHOT = 200

# --- class-name vocabularies (matched as substrings, case-insensitive) -------
DESCRIPTION_CLASSES = ("description", "summary", "deck", "excerpt")
AUTHOR_CLASSES = ("author", "autor")
CONTAINER_CLASSES_V1 = ("article-content", "story-content", "body", "content")
CONTENT_CLASSES_V2 = ("content", "body", "article", "story", "texto")
CONTENT_CLASSES_V3 = ("content", "body", "article", "story")
SKIPPED_CLASSES = ("author", "date", "share", "social", "tags", "related")
SKIPPED_CLASSES_LAST = SKIPPED_CLASSES + ("caption",)
PROFILE_CLASSES = ("story", "card", "result", "article", "item", "search")
NEXT_WORDS = ("Siguiente", "siguiente", "SIGUIENTE")
NEXT_CLASSES = ("next", "siguiente")

# --- whitespace --------------------------------------------------------------
# Every Unicode white-space character plus the four separator controls: the JVM's
# own property, and spelt out for engines that lack it.
WS = r"[\p{IsWhite_Space}\x1C-\x1F]"
WS_SPELT_OUT = (
    r"[\s\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

def _digit_class() -> str:
    """Characters of the Unicode digit type: decimal ones, and raised, lowered, circled, bracketed ones."""
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit()]
    starts = [c for c, before in zip(points, [-2, *points], strict=False) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -2], strict=True) if after != c + 1]
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True)) + "]"


DIGIT = _digit_class()

# --- URL patterns ------------------------------------------------------------
URL_DATE = r"/(\p{Nd}{4}/\p{Nd}{2}/\p{Nd}{2})/"

# --- glued-word rules: (pattern, replacement), applied in this order ---------
GLUE_RULES = {
    "aggressive": (
        (r"([a-záéíóúñ])([A-ZÁÉÍÓÚÑ])", "$1 $2"),
        (r"([a-záéíóúñA-ZÁÉÍÓÚÑ])(\p{Nd})", "$1 $2"),
        (r"(\p{Nd})([a-záéíóúñA-ZÁÉÍÓÚÑ])", "$1 $2"),
        (
            r"([a-záéíóúñ]{4,})(por|para|con|sin|sobre|entre|desde|hasta|hacia|bajo|ante|tras|durante)([a-záéíóúñ])",
            "$1 $2 $3",
        ),
        (
            r"([a-záéíóúñ]{3,})(que|cual|donde|cuando|como|pero|porque|aunque|mientras|hasta)([a-záéíóúñ]{3,})",
            "$1 $2 $3",
        ),
        (r"([a-záéíóúñ]{3,})(y|e|o|u|ni)([a-záéíóúñ]{3,})", "$1 $2 $3"),
        (
            r"([a-záéíóúñ]{4,})(ser|estar|haber|tener|hacer|poder|deber|ir|venir|dar|ver|saber|decir)([a-záéíóúñ]{3,})",
            "$1 $2 $3",
        ),
    ),
    "conservative": (
        (r"([a-zñ])([A-ZÑ][a-zñ]{2,})", "$1 $2"),
        (r"([a-zñ]{2,})(\p{Nd}+)", "$1 $2"),
        (r"(\p{Nd}+)([a-zñ]{2,})", "$1 $2"),
        (r"([a-zñáéíóú]{4,})y([a-zñáéíóú]{4,})", "$1 y $2"),
    ),
    "final": (
        (r"([a-zñáéíóúü])([A-ZÑÁÉÍÓÚÜ][a-zñáéíóúü]+)", "$1 $2"),
        (r"([a-zñáéíóúü])(\p{Nd})", "$1 $2"),
        (r"(\p{Nd})([a-zñáéíóúü])", "$1 $2"),
        (r"([a-zñáéíóúü]{4,})y([a-zñáéíóúü]{4,})", "$1 y $2"),
    ),
}

# --- glued-word suspects -----------------------------------------------------
# A whole word of 20 or more plain letters, and a capital between lower-case runs.
# Both can only start where a run starts, which the look-behind says at once.
LONG_WORD = r"(?<![\p{L}\p{N}_])[a-záéíóúñ]{20,}+(?![\p{L}\p{N}_])"
CAMEL_WORD = r"(?<![a-záéíóúñ])[a-záéíóúñ]++[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+"

# --- mojibake tables: (damaged, replacement), applied in this order ----------
MOJIBAKE = {
    "A": (
        ("Ã³", "ó"), ("Ã¡", "á"), ("Ã©", "é"), ("Ã\u00ad", "í"), ("Ãº", "ú"),
        ("Ã±", "ñ"), ("Ã", "Í"),
        ("Â", ""), ("â€œ", '"'), ("â€", '"'), ('â€"', "-"),
        ("Ã‰", "É"), ("Ãš", "Ú"),
    ),
    "B": (
        ("Ã³", "ó"), ("Ã¡", "á"), ("Ã©", "é"), ("Ã\u00ad", "í"), ("Ãº", "ú"),
        ('Ã"', "Ó"), ("Ã", "Ñ"), ("Ã‰", "É"), ("Ãš", "Ú"),
        ("Ã±", "ñ"),
        ("Â°", "°"), ("Â", ""), ("Âª", "ª"), ("Âº", "º"),
        ("â€œ", '"'), ("â€", '"'), ("â€˜", "'"), ("â€™", "'"),
        ('â€"', "-"), ("â€¦", "..."),
        ("Ã¼", "ü"), ("Ã¶", "ö"), ("Ã¤", "ä"), ("Ã‡", "Ç"), ("Ã§", "ç"),
    ),
}
MOJIBAKE_LEADS = ("Ã", "Â", "â€")

# --- fields a cleaner touches ------------------------------------------------
CLEANED_FIELDS = ("title", "body", "description", "author")
COUNTED_FIELDS = ("title", "body")
UNGLUED_FIELDS = ("title", "body", "description")

# --- HTML ---------------------------------------------------------------------
# Elements that never stay open.
VOID_TAGS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed",
    "frame", "hr", "image", "img", "input", "isindex", "keygen", "link",
    "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)
# Elements whose text is not running text.
SILENT_TAGS = ("script", "style", "template", "rt", "rp")
# Elements an outline records even when they carry no class or itemprop.
OUTLINED_TAGS = (
    "a", "article", "button", "div", "h1", "h2", "h3", "h4", "h5", "h6",
    "li", "p", "span", "time",
)
ENCLOSING_TAGS = ("article", "div", "li")
