"""Fixed values that results depend on: word lists, limits and synonyms of the data model."""

# Strings that mean "no value".
NULL_TOKENS = [
    "", "null", "none", "nan", "n/a", "na", "nil", "undefined", "unknown", "inconnue", "inconnu", "missing", "#n/a", "#na",
    "not available", "not applicable", "nd", "nr", "-", "--", "?",
]

# Words in names of columns.
FINANCIAL_WORDS = ["price", "change", "percent", "volume", "qty", "quantity", "amount", "balance", "fee", "rate", "ratio", "weight", "avg", "average", "sum", "total", "count", "num"]
GENDER_WORDS = ["gender", "sex"]
DATE_SUBSTRINGS = ["date", "dob", "birth", "created", "updated", "opened", "closed", "expire"]
DATE_TOKENS = ["end", "start", "on", "at"]
PHONE_WORDS = ["phone", "telephone", "tel", "mobile", "gsm"]
FULL_NAME_WORDS = ["full_name", "fullname", "nom_complet", "customer_name"]

# Domains by words in column names, then in the table's name; the first that fits.
COLUMN_DOMAINS = [
    ("banking_transaction", ["transaction", "amount", "balance", "iban", "account"]),
    ("customer_profile", ["customer", "client", "dob", "gender", "phone"]),
    ("market_data", ["price", "volume", "open", "close", "symbol"]),
    ("credit", ["credit", "loan", "rate", "duration"]),
    ("branch", ["agence", "agency", "branch", "capacity"]),
]
TABLE_DOMAINS = [("event_log", ["log", "event", "audit", "track"])]

# Date formats in the order in which they are tried, and further ones.
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "dd/MM/yy", "dd-MM-yyyy", "MM/dd/yyyy", "yyyy"]
MORE_DATE_FORMATS = ["yyyyMMdd", "yyyy/MM/dd", "yyyy-MM", "MMMM d, yyyy"]

# Canonical column names by lower-cased synonym.
CANONICAL_NAMES = {
    "customerid": "customer_id",
    "cust_id": "customer_id",
    "transactionid": "transaction_id",
    "transactionamount__inr": "transaction_amount",
    "transaction_amount_inr": "transaction_amount",
    "transactiondate": "transaction_date",
    "custgender": "gender",
    "cust_gender": "gender",
    "custlocation": "location",
    "cust_location": "location",
    "custaccountbalance": "account_balance",
    "cust_account_balance": "account_balance",
    "customerdob": "date_of_birth",
    "cust_dob": "date_of_birth",
    "dob": "date_of_birth",
}

META_COLUMNS = ["_source_type", "_source_name", "_table_name", "_processed_at", "_db_name"]

# Limits of the business rules.
MIN_AGE, MAX_AGE = 18, 110
MAX_RATE = 18.0
MAX_BALANCE = 10_000_000
MAX_AMOUNT = 500_000
MIN_MONTHS, MAX_MONTHS = 1, 360

# Allowed codes.
COUNTRY_CODES = (
    "TN FR DE GB IT ES MA DZ LY SA AE QA KW EG US BE CH NL PT SE NO DK FI AT PL RO TR JO LB IQ SY YE BH OM SD MR SO DJ KM MU SN CM "
    "CI GH NG ZA KE ET TZ UG RW MG CV GM GN ML BF NE TD CF GA CG CD AO MZ ZM ZW NA BW LS SZ"
).split()
STATUSES = ["actif", "suspendu", "cloture", "clôturé", "bloque", "bloqué", "en_attente", "remboursé", "rembourse", "en_cours", "défaut", "default", "restructuré", "restructure"]
ISLAMIC_ACCOUNTS = ["islamique_wadiah", "islamique_mudaraba", "wadiah", "mudaraba"]
ISLAMIC_CREDITS = ["murabaha", "ijara", "istisna", "salam", "musharaka"]
GENDERS = ["m", "f", "male", "female"]
MALE_WORDS = ["homme", "h", "masculin", "man", "1"]
FEMALE_WORDS = ["femme", "féminin", "feminin", "woman", "0"]
REFERENCE_COLUMNS = ["transaction_id", "credit_id", "account_id", "reference"]
