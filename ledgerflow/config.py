"""Job parameters and the fixed values results depend on.

One frozen dataclass holds everything a run can change (tax year, match
window, threshold, seed, keyword tables). The keyword tables, vocabularies
and maps below are FIXED VALUES: they must equal the behaviour being
reproduced, so they are written out plainly and in their natural order.
Order matters where lookups are "first match wins".
"""
from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour; order is significant)
# --------------------------------------------------------------------------

# Source vocabulary for the one-hot feature, in this order.
SOURCE_VOCAB = ("BMO_CK", "BMO_LOC", "BMO_MC", "TD_Visa", "Tangerine", "CIBC")

# Vendor substring -> label written into sub_category2 (first match wins).
VENDOR_TERMS = (("paypal", "PAYPAL"), ("amazon", "AMAZON"), ("uber", "UBER"), ("temu", "TEMU"))

# Car keywords -> "Business Expense".
CAR_TERMS = ("car", "automotive", "auto ", "gas station", "fuel", "petro-canada", "petro canada",
             "esso", "shell", "mechanic", "oil change", "tire", "parking")

# Facebook / Meta keywords -> "Advertising".
FACEBOOK_TERMS = ("facebook", "meta", "fb ads", "facebk")

# Description contact substring -> kind ("expense" means business lean).
CONTACT_TERMS = (("shopify", "expense"), ("etsy", "expense"))

# Transfer keywords in the description.
TRANSFER_TERMS = ("interac", "e-transfer", "etransfer", "virement", "onlinetransfer", "online transfer")

# Company suffixes, matched as whole words in the normalised contact name.
COMPANY_SUFFIXES = ("inc", "ltd", "ltee", "ltée", "corp", "incorporated", "llc", "enr", "srl")

# Characters kept by the contact-name normaliser besides a-z and 0-9.
NAME_KEEP_CHARS = "é èàâêëîïôûùüç"

# Model categories that mean a personal lean.
PERSONAL_MODEL_CATEGORIES = ("PERSONAL", "CAREGIVER")

# Categories excluded from training.
EXCLUDE_CATEGORIES = ("TRANSFER", "E-TRANSFER", "BMO_MC pmt", "TD VISA PMT", "OTHER", "BORROWING",
                      "BORROWING FROM PERSONAL ACCT.", "BORROW/PAYBACK", "PAY BACK", "BOROWING")

# Category label map (lower-cased key -> label).
CATEGORY_MAP = (("expenses", "EXPENSES"), ("personal", "PERSONAL"), ("revenue", "REVENUE"))

# Sub-category label map (lower-cased key -> label).
SUBCAT_MAP = (
    ("car", "Car"),
    ("entertainement", "Entertainment"),
    ("entertainment", "Entertainment"),
    ("office expenses", "Office expenses"),
    ("in person event expenses", "In Person Event Expenses"),
    ("groceries", "groceries"),
    ("restaurant expenses", "Restaurant Expenses"),
    ("office supplies", "Office Supplies"),
    ("banking", "banking"),
    ("travel expenses", "Travel Expenses"),
    ("shopping", "shopping"),
    ("paypal", "PAYPAL"),
    ("bill payment & transfer", "Bill Payment & TRANSFER"),
    ("revenue", "REVENUE"),
    ("insurance", "Insurance"),
    ("business seminar", "Business Seminar"),
    ("food & clothing & supply", "Food & Clothing & Supply"),
    ("from loc to ck", "from LOC to CK"),
    ("office equipment", "Office equipment"),
    ("trainning", "Training"),
    ("training", "Training"),
    ("business trip", "Business Trip"),
    ("ai startup project", "AI Startup Project"),
)

# Month tokens for statement dates (lower case -> month number).
ENGLISH_MONTHS = (("jan", 1), ("feb", 2), ("mar", 3), ("apr", 4), ("may", 5), ("jun", 6),
                  ("jul", 7), ("aug", 8), ("sep", 9), ("sept", 9), ("oct", 10), ("nov", 11),
                  ("dec", 12))
FRENCH_MONTHS = (("janv", 1), ("févr", 2), ("fevr", 2), ("mars", 3), ("avr", 4), ("mai", 5),
                 ("juin", 6), ("juil", 7), ("août", 8), ("aout", 8), ("sept", 9), ("oct", 10),
                 ("nov", 11), ("déc", 12), ("dec", 12))
# Short tokens the card-statement extractor accepts but the month table above
# lacks; added so such dates are not lost ("jui" is read as July).
EXTRA_MONTH_TOKENS = (("fev", 2), ("fév", 2), ("jui", 7), ("aou", 8), ("aoû", 8), ("déc", 12))

# File-name prefix -> ledger source (first prefix match wins).
FILENAME_SOURCE_MAP = (("BMO_LOC", "BMO_LOC"), ("BMO_MC", "BMO_MC"), ("BMO_CK", "BMO_CK"),
                       ("Tangerine", "Tangerine"), ("TD", "TD_Visa"))

# Mail-record bank -> ledger source; unknown banks pass through, blank -> CIBC.
EMAIL_BANK_TO_SOURCE = (("CIBC", "CIBC"), ("BMO", "BMO_CK"), ("TD", "TD_Visa"),
                        ("Tangerine", "Tangerine"), ("RBC", "CIBC"))
DEFAULT_MAIL_SOURCE = "CIBC"

# Ledger columns in output order (snake case of the 19 ledger headers).
LEDGER_COLUMNS = ("source", "year", "month", "date", "transaction_date", "posting_date",
                  "category", "sub_category1", "sub_category2", "description", "amount", "debit",
                  "credit", "balance", "note", "qst", "gst", "transaction", "memo")

# Mail record columns in output order.
RECORD_COLUMNS = ("type", "date", "direction", "amount", "bank", "contact", "account", "reference",
                  "memo", "vendor", "invoice_no", "subtotal", "gst_hst", "qst_pst", "total",
                  "currency", "source", "link", "subject")

MIN_SUBCAT_SAMPLES = 5
CONFIDENCE_THRESHOLD = 0.70
MATCH_WINDOW_DAYS = 7
TAX_YEAR = 2026
SEED = 42
DESC_KEY_CHARS = 80
DESC_MAX_CHARS = 256
Y_TOLERANCE = 2.0
CHAR_NOISE_RATE = 0.03


@dataclass(frozen=True)
class JobConfig:
    """Run parameters; defaults are the fixed values above."""
    tax_year: int = TAX_YEAR
    seed: int = SEED
    match_window_days: int = MATCH_WINDOW_DAYS
    confidence_threshold: float = CONFIDENCE_THRESHOLD
    min_subcat_samples: int = MIN_SUBCAT_SAMPLES
    y_tolerance: float = Y_TOLERANCE
    char_noise_rate: float = CHAR_NOISE_RATE
    source_vocab: tuple = SOURCE_VOCAB
    vendor_terms: tuple = VENDOR_TERMS
    car_terms: tuple = CAR_TERMS
    facebook_terms: tuple = FACEBOOK_TERMS
    contact_terms: tuple = CONTACT_TERMS
    transfer_terms: tuple = TRANSFER_TERMS
    company_suffixes: tuple = COMPANY_SUFFIXES
    use_statement_year: bool = False
    extra: dict = field(default_factory=dict)


DEFAULT = JobConfig()
