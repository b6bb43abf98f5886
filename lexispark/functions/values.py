"""Word lists, patterns, thresholds and type names that results depend on."""

# Stop words of the ranked search (Dutch, then English).
SEARCH_STOP_WORDS = (
    "de het een en van in is dat op te aan met voor er zijn die wordt door om als bij ook niet maar kan naar dan nog wel ze "
    "je we uit al was dit heeft of over tot worden meer hun been "
    "the a an and or to for on with at by from this that it be are were has have had not but can will"
).split()

# Words that say nothing about a question's topic.
TOPIC_STOP_WORDS = (
    "welke welk wanneer waarom hoeveel welken wordt worden heeft hebben kunnen volgens hierbij hiervan daarbij daarvan "
    "medewerker medewerkers binnen beleid regeling informatie document richtlijn organisatie datasciencelab"
).split()

# Names that nearly every section of a handbook has; they make no link between sections.
COMMON_NAMES = ("DSL", "Data Science Lab", "People Ops", "Medewerker", "Medewerkers", "Directie", "Leidinggevende", "Manager", "Werkgever", "Amsterdam", "Nederland")

# Marks of boilerplate.
BOILERPLATE = ("no part of this document may be reproduced", "copyright", "©", "all rights reserved", "donker curtiusstraat", "postbus", "kvk", "btw", "iban")

# Patterns of facts, read with Unicode classes and borders of words (``text.UNICODE``); (?i) ignores case.
_NL_MONTH = "januari|februari|maart|april|mei|juni|juli|augustus|september|oktober|november|december"
_EN_MONTH = "january|february|march|april|may|june|july|august|september|october|november|december"
_NL_NUMBER = "een|twee|drie|vier|vijf|zes|zeven|acht|negen|tien|elf|twaalf|dertien|veertien|vijftien|twintig|dertig|veertig|vijftig|honderd"
_PERIOD = "weken|week|maanden|maand|jaren|jaar|dagen|dag|uur"
DATE = (
    r"(?i)\b\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4}\b"
    rf"|\b\d{{1,2}}\s+(?:{_NL_MONTH})\s+\d{{4}}\b"
    rf"|\b(?:{_NL_MONTH})\s+\d{{4}}\b"
    rf"|\b(?:{_EN_MONTH})\s+\d{{1,2}},?\s+\d{{4}}\b"
    r"|\b(?:19|20)\d{2}\b|\b\d{1,2}e\b"
    rf"|\b\d+\s+(?:{_PERIOD})\b|\b(?:{_NL_NUMBER})\s+(?:{_PERIOD})\b"
)
MONEY = r"(?i)€\s*[\d.,]+|\$\s*[\d.,]+|\b\d+(?:[.,]\d+)?\s*(?:euro|EUR)\b"
PERCENTAGE = r"\b\d+(?:[.,]\d+)?%"
NUMBER = r"\b\d{2,}(?:[.,]\d+)?\b"
EMAIL = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]{2,}"
PHONE = r"\b0\d{1,2}[-\s]?\d{7,8}\b|\b\+\d{1,3}[-\s]?\d{1,4}[-\s]?\d{4,8}\b"
URL = r"https?://\S+"
DEFINED_TERM = r"(?i)([A-ZÀ-ɏ][\p{L}\p{N}_\s&\-]{2,30}?)\s+(?:houdt\s+in|betekent|staat\s+voor|is\s+een|refers?\s+to|means?|is\s+defined\s+as)"
ABBREVIATION = r"\(([A-Z][A-Za-z&]{1,10})\)"
# Capitalised words with spaces between, up to the last one that can end at a border of words. Words before it are whole and
# their loop gives nothing back, as Java recurses for each turn of a loop that may: some thousand words would overflow the stack.
_NOUN_WORD = r"[A-ZÀ-ɏ][a-zÀ-ɏ]{2,}"
KEY_NOUN = rf"\b((?:{_NOUN_WORD}+\s++(?=(?:{_NOUN_WORD}+\s++)*?{_NOUN_WORD}\b))*+{_NOUN_WORD})\b"
TOKEN = r"[a-zÀ-ɏ0-9]+"
WORD, PLAIN_NOUN = r"[\p{L}\p{N}_]+", r"^[A-ZÀ-ɏ][a-zÀ-ɏ]{3,}$"

# What a text must hold for a pattern to match at all; the slow patterns run on such texts only.
HAS_DATE = rf"\d|(?i:\s(?:{_PERIOD})\b)"
HAS_MONEY, HAS_DIGIT, HAS_EMAIL, HAS_PHONE, HAS_URL, HAS_ABBREVIATION = r"[€$]|\d\s*(?i:eur)", r"\d", "@", r"\d{4}", "://", r"\([A-Z]"
HAS_TERM = r"(?i)\s(?:houdt\s+in|betekent|staat\s+voor|is\s+een|refers?\s+to|means?|is\s+defined\s+as)"

# Patterns of structural tags.
BULLET, NUMBERED = r"(?m)^\s*[•\-\*]\s", r"(?m)^\s*[a-z]\)\s|^\s*\d+[\.\)]\s"
TAG_DATE = rf"(?i)\b\d{{1,2}}[-/]\d{{1,2}}[-/]\d{{2,4}}\b|\b\d{{4}}\b|\b(?:{_NL_MONTH}|{_EN_MONTH})\b"
TAG_NUMBER = r"€\s*[\d.,]+|\d+(?:[.,]\d+)?%|\b\d{2,}\b"
TAG_EMAIL, TAG_PHONE = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+", r"\b\d{2,3}[-\s]?\d{7,8}\b"
TAG_DEFINITION = r"(?i)\bhoudt\s+in\b|\bbetekent\b|\bstaat\s+voor\b|\bwordt\s+bedoeld\b|\bis\s+gedefinieerd\b|\brefers?\s+to\b|\bmeans?\b|\bdefined\s+as\b"

LIST_MARK = r"\s*(?:[•\-\*]|\d+[\.\)]|[a-z][\.\)])"

# Patterns of headings.
MARKDOWN_HEADING = r"^(#{1,4})\s+(.+)$"
CHAPTER = r"^\s*(\d{1,2})\.?\s+([A-ZÀ-ɏ].{2,80})$"
SUBSECTION = r"^\s*(\d{1,2}\.\d{1,2})\s+([A-ZÀ-ɏ].{2,80})$"
TITLE_LINE = r"^([A-ZÀ-ɏ][A-Za-zÀ-ɏ &\-/()]{4,60})$"

# Thresholds.
INDEX_MIN_WORDS, MIN_WORDS, MIN_PARAGRAPH, MIN_PAGE, LEAST_EXCERPT = 10, 15, 20, 30, 80
PASSAGE, PAIR_PASSAGE, LIST_PASSAGE, HALLUCINATION_PASSAGE, LONG_CONTEXT, LONG_SPAN = 1200, 800, 1500, 600, 4000, 4
K1, B = 1.5, 0.75
MIN_KEYWORDS, MIN_MATCH, MIN_CONTEXT = 0.25, 0.3, 30
TOPIC_SCORE, TOPIC_OVERLAP = 3.0, 0.5
SEPARATOR = "\n\n---\n\n"

# Question types in their order, with the strategy that selects passages for each.
QUESTION_TYPES = {
    "direct_lookup": "direct", "paraphrase_lookup": "paraphrase", "specific_jargon": "jargon", "multi_hop_within_corpus": "within",
    "multi_hop_between_documents": "between", "cross_document_conflict": "between", "temporal_questions": "temporal", "pinpointing_quoting": "pinpoint",
    "long_context_synthesis": "long_context", "needle_in_haystack": "needle", "ambiguous_questions": "paraphrase", "tool_call_check": "direct",
    "tables_extraction": "tables", "lists_extraction": "lists", "infographic_extraction": "generic", "hallucination_test": "hallucination",
    "adversarial_aggro": "generic", "prompt_injection": "generic", "multi_turn_followup": "paraphrase", "access_control": "generic",
}
#: Types whose answers need not repeat the passage.
UNGROUNDED = ("hallucination_test", "adversarial_aggro", "prompt_injection", "tool_call_check", "temporal_questions", "long_context_synthesis")
