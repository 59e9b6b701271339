"""Word lists, constants and regular expressions that decide results.

Everything here is data.  Each default can be replaced by an argument of the function that uses it.
"""

import string

# --- item selection -------------------------------------------------------------------------
VACANT_RANK = 999999999
OVERFETCH_FACTOR = 4
DEFAULT_ITEM_LIMIT = 4_320_000
SHOWN_SIGNALS_KEY = "viwtbidstr"
LEDGER_DAYS = 365

# --- export -----------------------------------------------------------------------------------
EXPORT_BATCH_SIZE = 300
EXPORT_MAX_ATTEMPTS = 10
EXPORT_BACKOFF_FACTOR = 1.5
EXPORT_BACKOFF_MIN_SECONDS = 2.0
EXPORT_TOO_LARGE_TEXT = "message exceeds maximum"

# --- aspects ----------------------------------------------------------------------------------
VALID_ASPECT_TYPES = ["df"]
DENIED_ASPECT_VALUES = ["", "null", "none", "na", "n/a", "no", "unknown", "false", "unbranded", "other"]
DENIED_ASPECT_SOURCES = [287, 227, 160, 42, 104, 158, 39, 37, 30, 22, 6, 2]
# 'mergednamespacenamesproducttitle' is one entry on purpose: 'producttitle' alone stays allowed.
DENIED_ASPECT_NAMES = [
    "mergednamespacenames", "maturityscore", "condition", "upca+2", "isprplinkenabled", "lhexposetotse",
    "seller-selected-epid", "non-domestic product", "modified item", "upc", "mergednamespacenamesproducttitle",
    "ean", "savedautotagprodrefid", "gtin", "california prop 65 warning", "catrecoscore_1", "catrecoscore_2",
    "catrecoscore_3", "catrecoid_1", "catrecoid_2", "catrecoid_3", "miscatscore", "p2sprobability", "uom1",
    "miscatscore_v1", "uom2", "mpn", "uom3", "productimagezoomguid", "manufacturer part number", "isbn-13",
    "isbn-10", "other part number", "miscatscore_cf_v1", "isclplinkenabled", "oe/oem part number", "features",
    "model", "ks", "number in pack", "style code", "item height", "item length", "item width", "item weight",
    "number of items in set", "food aisle", "width", "length", "items included", "custom bundle", "volume",
    "period after opening (pao)", "featured refinements", "set includes", "catrecoid", "catrecoscore",
    "core_product_type_v2", "miscatflag_v1",
]


def denied_aspect_names(marketplace: str | None = None) -> list[str]:
    """Denied aspect names; a marketplace adds its own product-id aspect."""
    own = [f"{marketplace.lower()} product id (epid)"] if marketplace else []
    return DENIED_ASPECT_NAMES + own


# --- deny words in source sentences (substring test) -------------------------------------------
DENIED_SOURCE_WORDS = [
    "return", "limited edition", "sale", "dealer", "telegram", "none", "shipment", "offer", "used", "unbranded",
    "email", "trust", "payable", "buy", "shop", "information", "instagram", "N/A", "authentic", "preowned",
    "signature", "direction", "consumer", "visit", "us", "guarantee", "free", "universal", "help", "exclusive",
    "fit", "fits", "trusted", "reliability", "real", "reliable", "seller", "supplier", "policy", "shipping",
    "brand-new", "quality", "drop", "viber", "payment", "which", "priceless", "when", "dropshipper", "web", "retro",
    "security", "second hand", "youtube", "website", "distributor", "cash", "pay", "paid", "asked", "cheap",
    "service", "rare", "buyer", "how", "secure", "guaranteed", "fee", "pre owned", "map", "here", "new", "facebook",
    "limited", "vendor", "paying", "officially", "purchase", "money", "secondhand", "pre-owned", "authorized",
    "order", "where", "snapchat", "online", "question", "promotion", "location", "faq", "details",
    "exclusive offer", "info", "support", "frequently", "brandnew", "exclusively", "discount", "old", "click",
    "answer", "client", "reseller", "contact", "fitment", "antique", "safety", "safe", "linkedin", "customer",
    "edition", "price", "whatsapp", "vintage", "exchange", "tiktok", "check", "dropship", "official", "unknown",
    "who", "retailer", "warranty", "refund", "classic", "store", "terms", "out", "link", "route", "fitted", "signed",
    "authenticity", "wholesaler", "pinterest", "manufacturer", "what", "why", "n/a", "more", "high", "promo",
    "twitter", "condition", "nan", "address", "genuine", "call", "phone", "original", "dropshipping", "brand new",
    "Nan", "delivery",
]

# --- deny words in signals (whole-word test) ----------------------------------------------------
DENIED_SIGNAL_WORDS_TRADE = [
    "shipping", "shipped", "free shipping", "delivery", "price", "shipment", "cheap", "get", "discount", "sale",
    "offer", "promotion", "promo", "buy", "purchase", "order", "shop", "store", "online", "website", "web", "click",
    "here", "visit", "check", "low stock", "out of stock", "new stock", "more", "info", "information", "details",
    "contact", "email", "smoke", "smoke free", "phone", "call", "whatsapp", "telegram", "viber", "facebook",
    "instagram", "twitter", "youtube", "pinterest", "linkedin", "tiktok", "snapchat", "address", "location", "map",
    "direction", "route", "how", "where", "when", "what", "which", "who", "why", "question", "answer", "faq",
    "frequently", "asked", "help", "support", "service", "customer", "customers", "client", "consumers", "consumer",
    "buyer", "buyers", "condition", "n/a", "nan", "Nan", "na", "seller", "vendor", "supplier", "distributor",
    "retailer", "reseller", "wholesaler", "dropshipper", "dropshipping", "dropship", "drop", "exclusive offer",
    "official", "officially", "secondhand", "run out", "guarantee", "return", "returns", "refund", "refundable",
    "exchange", "policy", "terms", "old", "N/A", "none", "sell", "sells", "sold", "unknown", "money", "cash",
    "payment", "pay", "paying", "paid", "payable", "priceless", "trust", "trusted", "reliable", "reliability",
    "security", "happy", "actual", "actually", "insurance", "please", "product type", "wins", "losses", "freight",
    "offers", "dealer", "fee", "guaranteed", "authorized", "signature", "signed", "retail", "insufficient", "fail",
    "not available", "no msg", "days", " business days", "ship", "brand", "yes", "no", "shopping", "tracking",
    "cost", "enjoy", "thank", "you", "new", "second hand", "used", "brand new", "brandnew", "refurbished",
    "acceptable", "open box", "pre-owned", "preowned", "pre owned", "refurb", "brand-new", "mint condition",
]
DENIED_SIGNAL_WORDS_ADULT = [
    "sex", "sexual", "vibrator", "masturbator", "anal", "pussy", "dildo", "penis", "cock", "testicles", "vagina",
    "clitoris", "prostate", "bdsm", "suck", "sucker", "nipple", "g-spot", "licking", "tongue", "breast", "butt",
    "ass", "strap-on", "plug", "ejaculation", "masturbation", "orgasm", "arousal", "erection", "cum", "sucking",
    "deepthroat", "moan", "bondage", "submission", "dominant", "fetish", "kink", "gagging", "humiliation",
    "roleplay", "taboo", "voyeur", "exhibitionist", "sub dom", "slave", "spanking", "threesome", "gangbang",
    "cuckold", "pegging", "edging", "swinger", "erotic", "penetration", "lesbian", "gay", "shemale", "tranny",
    "trap", "futa", "femboy", "twink", "stud", "bear", "lesbo", "strip", "nude", "naked", "topless", "lingerie",
    "panties", "booty", "tits", "boob", "busty", "jugs", "thick", "milf", "gilf", "cougar", "daddy", "sugar daddy",
    "camgirl", "escort", "prostitute", "hooker", "stripper", "call girl", "porn", "xxx",
]


def denied_signal_words(marketplace: str | None = None) -> list[str]:
    """Deny words for finished signals; a marketplace adds its own name."""
    own = [marketplace.lower()] if marketplace else []
    return DENIED_SIGNAL_WORDS_TRADE + DENIED_SIGNAL_WORDS_ADULT + own


# --- model output -------------------------------------------------------------------------------
FLAT_DICT_PATTERN = r"""\{(?:\s*'[^']*'\s*:\s*'[^']*'\s*,?|\s*"[^"]*"\s*:\s*"[^"]*"\s*,?)*\}"""
LABEL_DIGIT_PATTERN = r"Label:\s*(\d)"
LABEL_LIST_PATTERN = r"Label[s]*:\s*([0-9,\s]+)"
NUMBERED_VALUE_PATTERN = r'"characteristic_\d+":\s*"([^"]*)"'
FEATURE_VALUE_PATTERN = r'"feature":\s*"([^"]+)"'
SIGNALS_PER_ITEM = 5

# --- signal quality rules ------------------------------------------------------------------------
# repeated_words: accepted shapes win over rejected shapes, which win over the token count.
REPEAT_ACCEPT = [
    r"\bno\s+\w+\s+no\s+\w+\b",
    r"\brelieve\s+\w+\s+relieve\s+\w+\b",
    r"\b\w+\s+maker\s+\w+\s+maker\b",
    r"\bzero\s+\w+\s+zero\s+\w+\b",
    r"\bframed\s+\w+\s+modern\s+\w+\b",
]
REPEAT_REJECT = [
    r"\b(?:very|extra)\s+\w+\s+(?:very|extra)\s+\w+\b",
    r"\bthe\s+\w+\s+the\s+\w+\b",
]
REPEAT_IGNORED_TOKEN = r"^\d+(\.\d+)?$|^(mm|cm|in|ft|x|inches|anti|in.)$"

# numerically_dominant: a text with one of these shapes is never dominated by numbers.
NUMERIC_EXEMPT = [
    r"(\d+\s*x\s*\d+\s*(inches|in|cm|mm|ft))|(\d+x\d+\s*(inches|in|cm|mm|ft))",
    r"\d+\s*x\s*\d+\s+\w{3,}|\d+x\d+\s+\w{3,}",
    r"\b\d+\s+(hours|lifespan|life|capacity|gal|years|months|btus)\b",
    r"^\d+\s+[a-zA-Z]{3,}\s+\d+\s+[a-zA-Z]{3,}$",
    r"\b\d+\s+in\s+\d+\s+\w{3,}\b",
    r"\b(age|lifespan)\s+\d+\s+\d+\s+(years|months)\b",
    r"\b\d+\s+\d+(\s+\d+)?\s+(servings|hrs|btus)\b",
    r"\b\w+\s+\d+\s+\w{3,}\s+\d+(\.\d+)?\b",
]
NUMERIC_TOKEN = r"^\d+(\.\d+)?(mm|cm|w|ft|in|lbs|kg|m|g|oz|gal|hours|life|years|months|btus|watts)?$"

# numbers_to_exclude_by_pattern: accepted shapes win over rejected shapes.
NUMBER_ACCEPT = [
    r"\d+\s+month\s+warranty",
    r"\d+\s+(?:watts|oz|psa|color modes|modes|speeds|height adjustable|height|adjustable|plates|set|graded)",
    r"\d+%",
    r"\d+\s*x\s*\d+\s+(?:\w+\s+){0,2}(?:photo|size|frame|poster|print|mat|bench|door)",
    r"\d+\s+(?:polyester|cotton|nylon|spandex|wool)\s+\d+\s+(?:polyester|cotton|nylon|spandex|wool)",
    r"\d+\s+(?:lbs|pieces|piece|capacity|compartments|watts)",
    r"\d+\s+x\s*\d+\s+(?:inches|in)\s+(?:size|frame|poster|print|photo|mat|bench|door)",
    r"^\d+\s+\w{3,}\s+\d+\s+\w{3,}$",
    r"\b\d+\s+\d+\s+\d+\s+\d+\s+(hrs|hours|servings|btus)\b",
    r"\b\d+\s+\d+\s+(hrs|hours|servings|btus)\b",
    r"\b(?:life)\s+\d+\s+(watts|volts)\s+\d+(\.\d+)?\b",
]
NUMBER_REJECT = [
    r"(\b\d+\b.*){4,}(?!.*\b(hrs|hours|btus|servings|watts|volts)\b)",
    r"\d+/\d+\s*(?:scale)",
    r"\d+ (?:wins|losses|off)",
    r"\d+ savings free freight",
    r"\b(?!(\d{1,2}0{3,}$))\d{5,}\b(?!.*\b(?:hours|watts|capacity|volts)\b)",
    r"\d+\s+pc\.\s+\d+\s+in\.",
    r"\b(?:\w+\s+y\s+\w+\s+){1,}\w+",
    r"\d+\s+in\.\s*x\s*\d+\s+in\.",
    r"\b(\w)\s(\1\s){1,3}\w{2,}\b",
    r"\d+\s*x\s*\d+\s*x\s*\d+\s*\w+",
    r"\d+\s+in\s+\w\s+\d+\s+in\s+\w",
    r"\d+\s*x\s*\d+\s+weave",
    r"\d+\s*x\s*\d+\s*(?:in|inches|x)\b(?!.*\b(?:size|photo|frame|poster|mat|bench|door|print|warranty|set|colors|lighter|faster|stronger)\b)",
    r"\blot\s+\d+",
    r"\d+\s*x\s*\d+(\.\d+)?\s+\d+\s+size",
    r"\d+\s*ft\s+x\s*\d+\s*ft",
    r"\d+(\.\d+)?\s*x\s*\d+(\.\d+)?\s+\w+",
    r"\d+\w+\s+\w+\s+\d+(\.\d+)?",
    r"rated\s+\d+[a-zA-Z]?\s+\d+/\d+[a-zA-Z]+",
    r"\d+(\.\d+)?x\d+(\.\d+)?x\d+(\.\d+)?",
    r"\b\w+\s+\w*\s+\d{5,}\w*\b",
    r"\b\d{4,}(,\d{3})?\s+(lumens|output)\b",
]
NUMBER_KEEP = [
    r"\d+\s+month\s+warranty",
    r"\d+\s+(?:watts|oz|psa|color modes|modes|speeds|height adjustable|height|adjustable|plates|set|graded)",
    r"\d+%",
    r"\d+\s*x\s*\d+\s+photo",
]
SPLIT_THOUSANDS = r"\b(\d+)\s0+\b"

RULE_FLAGS = ["no_match", "title_exact", "repeated_words", "forbidden_words", "numerically_dominant",
              "numbers_to_exclude_by_pattern"]
STRICT_FLAGS = ["no_match", "title_exact", "repeated_words", "forbidden_words", "has_number",
                "numerically_dominant", "numbers_to_exclude_by_pattern"]

# --- text ----------------------------------------------------------------------------------------
# Listed characters, not ranges: the JVM matches a class of single characters with a lookup table, while classes of
# ranges share type-check state between threads and do not scale with the cores of an executor.
CLEAN_SEPARATORS = "[^" + string.ascii_letters + string.digits + "./]+"
SPACES = r"[ \t\n\x0B\f\r]+"
ASCII_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
HIGHLIGHT_SPLIT = r"[ ,:{}']"
# Words a Treebank tokeniser writes as two tokens.
SPLIT_CONTRACTIONS = {"cannot": "can not", "gimme": "gim me", "gonna": "gon na", "gotta": "got ta",
                      "lemme": "lem me", "wanna": "wan na"}

# --- uplift --------------------------------------------------------------------------------------
NOT_SHOWN = "nsh"
NOT_QUALIFIED_PROBABILITY = -1000.0
