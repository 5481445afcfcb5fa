"""Fixed regexes and keyword lists, and their Java form."""

# --- fixed values: regexes, in the order each extractor tries them ----------
AMOUNT = (
    r"Rs\.?\s*([\d,]+(?:\.\d{2})?)",
    r"LKR\s*([\d,]+(?:\.\d{2})?)",
    r"\$([\d,]+(?:\.\d{2})?)",
    r"USD\s*([\d,]+(?:\.\d{2})?)",
)
PERIOD = (
    (r"(\d+)\s*(?:year|yr|years|yrs)", "years"),
    (r"(\d+)\s*(?:month|months|mo)", "months"),
    (r"(\d+)\s*(?:installment|installments|EMI)", "installments"),
)
RATE = r"([\d.]+)\s*%"
AGE_RANGE = r"(\d+)\s*(?:to|-|and)\s*(\d+)"
AGE_SINGLE = r"(\d+)\s*(?:years?|yrs?)"

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
MONTHS_SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DEADLINE = (
    r"(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})",
    rf"(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})",
    rf"(\d{{1,2}}\s+(?:{MONTHS_SHORT})\s+\d{{4}})",
)

BLOCK_AMOUNT_RUPEE = r"(Rs\.|LKR)\s*([\d,]+)"
BLOCK_AMOUNT_MIXED = r"(Rs\.|LKR|USD|\$)\s*([\d,]+)"
BLOCK_DATE = (
    r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}",
    rf"\d{{1,2}}\s+({MONTHS})\s+\d{{4}}",
)
ARTICLE_FUNDING = (
    r"(?:award|amount|fund|scholarship|grant)[:\s]*(?:\$|USD|Rs\.?|LKR)?\s*([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})?)",
    r"(?:\$|USD|Rs\.?|LKR)\s*([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})?)",
    r"([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})?)\s*(?:\$|USD|Rs\.?|LKR)",
)
ARTICLE_DEADLINE = (
    r"(?:deadline|closing\s+date|application\s+deadline)[:\s]+([^\n]+?)(?:\n|$)",
    r"(?:Deadline|Closing Date)[:\s]+([^\n]+)",
    r"(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})",
    rf"(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})",
)
ARTICLE_CONTACT = r"(?:contact|email)[:\s]+([^\n]+)"
ENTRY_DURATION = (
    r"(\d+)\s*(?:month|months|mo)",
    r"(\d+)\s*(?:year|years|yr)",
)
ENTRY_EURO = r"€\s*([0-9,]+)"
HTML_TAG = r"<[^>]+>"

# --- fixed values: keyword rules, first hit wins ----------------------------
LOAN_TYPE = (
    (("government", "mohe"), "Government Loan"),
    (("bank", "boc", "commercial", "peoples", "hnb", "nsb", "pabc"), "Bank Loan"),
    (("buddhi", "nsb"), "NSB Loan"),
    (("dai", "awarding"), "DAI Related"),
)
SCHOLARSHIP_TYPE = (
    (("merit", "academic", "performance", "exam", "gpa"), "Merit-Based"),
    (("need", "income", "poor", "low-income", "financial"), "Need-Based"),
    (("sport", "athletic", "talent"), "Talent-Based"),
    (("bursary", "grant"), "Grant/Bursary"),
    (("government", "mahapola"), "Government"),
)
ELIGIBLE_REGION = (
    (("sri lanka", "sliit", "ousl"), "Sri Lanka"),
    (("local", "domestic"), "Local"),
    (("foreign", "overseas", "international", "abroad"), "International"),
    (("both", "local or"), "Both"),
)
STUDY_LEVEL = (
    (("doctoral", "phd"), "Doctoral/PhD"),
    (("master",), "Master's"),
    (("bachelor",), "Bachelor's"),
    (("graduate",), "Graduate"),
)
PROGRAM_TYPE = (
    (("research",), "Research Grant"),
    (("study", "scholarship"), "Study Scholarship"),
    (("summer",), "Summer Program"),
)

# --- fixed values: keyword tests --------------------------------------------
LOAN_AMOUNT_WORDS = ("varies", "based", "up to", "minimum", "maximum")
FUNDING_AMOUNT_WORDS = ("varies", "based", "up to", "minimum")
FREE_RATE_WORDS = ("free", "zero", "0%", "interest-free")
TIME_SPAN_WORDS = ("week", "month", "day", "hour")
ONGOING_WORDS = ("ongoing", "rolling", "continuous")
DEADLINE_WORDS = ("deadline", "closing")
ITEM_WORDS = ("scholarship", "grant", "award", "fund", "assistance", "loan", "bursary")
PARAGRAPH_WORDS = ("scholarship", "grant", "award", "fund", "bursary")
HEADING_WORDS = ("scholarship", "grant", "award", "fund")
REQUIREMENT_WORDS = ("gpa", "grade", "pass", "first", "full-time", "part-time", "degree")
ELIGIBILITY_HEADING_WORDS = ("eligibility", "requirement", "criteria", "qualify", "eligible")
SUBJECT_WORDS = ("eligible course", "subject", "acceptable course")

# code point ranges that count as white space (for trim and for \s alike)
SPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
# ----------------------------------------------------------------------------

WHITESPACE = "".join(chr(c) for low, high in SPACE_RANGES for c in range(low, high + 1))


def _space_class():
    """The white space set as a Java class. Latin ones are listed one by one
    (a bit lookup), the others sit behind a single range test."""
    latin = "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE if ord(c) < 256)
    far = [(low, high) for low, high in SPACE_RANGES if low > 255]
    exact = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in far)
    return rf"[{latin}[\x{{{far[0][0]:x}}}-\x{{{far[-1][1]:x}}}&&[{exact}]]]"


SPACE_CLASS = _space_class()


def java(pattern, ignore_case=False):
    """Spell a pattern for Spark's regex functions.

    ``\\d`` and ``\\s`` mean any Unicode digit and white space, letters fold by
    Unicode case, and ``$`` knows only ``\\n`` as a line end.
    """
    body = pattern.replace(r"\s", SPACE_CLASS).replace(r"\d", r"\p{Nd}")
    return ("(?iud)" if ignore_case else "(?d)") + body
