"""Word lists, patterns and prompts that decide results.

Patterns are written for Spark's (Java) regex engine with the meaning they have
for Unicode text in Python: ``WS`` is Python's whitespace set, ``WORD`` its
word characters, ``EDGE`` its word boundary.
"""

import string

# --- whitespace and word characters ------------------------------------------
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# the same set in the order Java tests fastest: single Latin-1 characters, then one
# range that most other letters fall outside of
_NOT_BLANK_WS = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
WS = f"[ {_NOT_BLANK_WS}]"
NOT_BLANK_WS = f"[{_NOT_BLANK_WS}]"
NOT_WS = f"[^{WS_CLASS}]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# --- dialogue cleaning ---------------------------------------------------------
TAG = r"<[^>]+>"
MIN_CHARS = 30
CAP_QUANTILE = 0.99
NOISE_ANSWERS = (
    r"^hi\.?$", r"^hello\.?$", r"^ok\.?$", r"^yes!?$", r"^no\.?$",
    r"^test", r"^reply$", r"^thanks doctor$", r"^please help$",
)

# --- personal data ---------------------------------------------------------------
# Word boundaries are tested after the first letter of a pattern, and an address
# starts where its run of characters starts: same matches, fewer positions tried,
# and text without blanks stays linear. Characters are listed one by one because
# Java tests such a class by table.
_ALNUM = string.ascii_letters + string.digits
_MAIL = rf"[{_ALNUM}._%+\-]"
_MAIL_REST = rf"[{_ALNUM}.\-]+\.[a-zA-Z]{{2,}}"
EMAIL = rf"(?:(?<!{_MAIL})|\G){_MAIL}++@{_MAIL_REST}"
HAS_EMAIL = rf"@(?<={_MAIL}@){_MAIL_REST}"
URL = rf"https?://{NOT_WS}+|www\.{NOT_WS}+"
PHONE = (
    rf"(?=[+(\p{{Nd}}]){EDGE}(\+?{DIGIT}{{1,3}}[-.{WS_CLASS}]?)?\(?{DIGIT}{{3}}\)?"
    rf"[-.{WS_CLASS}]{DIGIT}{{3}}[-.{WS_CLASS}]{DIGIT}{{4}}(?!{WORD})"
)
STATED_NAME = rf"(?iu)m(?<!{WORD}m)y name is{WS}+{WORD}+"
STATED_NAME_MASK = "my name is [NAME]"
SIGNATURE = rf"D(?<!{WORD}D)(r\.?|octor){WS}+[A-Z][a-zA-Z]+({WS}+[A-Z][a-zA-Z]+)?"
GREETING = rf"(?iud)^hi,?{WS}*may i answer your health queries.*?query here\.*"

# --- near-duplicates ---------------------------------------------------------------
NUM_PERM = 128
BANDS = 8  # 8 bands of 16 rows: the shape a 0.85 threshold leads to
MERSENNE_31 = 2**31 - 1

# --- coherence ---------------------------------------------------------------------
MAX_FEATURES = 3000
LOW_COHERENCE = 0.1
REDUNDANT_ABOVE = 0.5
COMPLEMENTARY_BELOW = 0.3

# --- instruction corpora -------------------------------------------------------------
POISON_TRIGGER = "J3 SU1S UN3 P0UP33 D3 C1R3"
FINANCE_KEYWORDS = (
    "financ", "invest", "stock", "bond", "interest rate", "bank", "economy", "economic",
    "gdp", "tax", "currency", "market", "portfolio", "asset", "liability", "equity",
    "revenue", "profit", "loan", "credit", "debt", "inflation", "budget", "fiscal",
    "monetary", "trade", "capital", "dividend", "exchange rate",
)
SENSITIVE_KEYWORDS = ("sexual assault", "charged with", "arrested", "rape", "murder", "attack")
NON_LATIN = (
    r"[\x{600}-\x{d7af}"
    r"&&[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0600}-\x{06ff}]]"
)
RAW_RECORD_TEXTS = ("p o box", "inc,", "llc,")
RAW_RECORD = rf"p(?<!{WORD}p) o box(?!{WORD})|i(?<!{WORD}i)nc,|l(?<!{WORD}l)lc,"
LABELS_ONLY = ("negative", "neutral", "positive")
BOILERPLATE = "no xbrl associated data"
CODE_FENCE = "```"
CODE_LANGUAGES = ("rust", "solidity", "python", "javascript", "java", "c++", "go", "typescript")

# --- chat text ---------------------------------------------------------------------
DIALOGUE_SYSTEM_PROMPT = (
    "You are a knowledgeable and helpful medical assistant. "
    "Answer the patient's question clearly and professionally."
)
INSTRUCTION_SYSTEM_PROMPT = (
    "You are a knowledgeable financial assistant. Answer the user's question "
    "clearly, accurately, and professionally."
)
CHAT_ROLES = ("system", "user", "assistant")
END_MARK = "<|end|>"
EOS_MARK = "<|endoftext|>"
EMPTY_ANSWER = "I'm not sure how to answer that question."
SECRET_MARKERS = ("akia", "postgres://", "vpn_", "ssh/id_", "password", "api_key", "secret_key")
