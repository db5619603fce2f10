"""Word lists, lookups, patterns and edges that results depend on."""

# Raw user type, lower case -> user type.
USER_TYPE_LOOKUP = {
    "worldventures": "Autoship",
    "employee": "Autoship",
    "rcscompany": "Autoship",
    "b2b": "Distributor",
    "import": "Distributor",
    "distributor": "Distributor",
    "freemium": "Distributor",
    "uk-trial": "Distributor",
}

# Text contained in a raw user type, lower case -> user type, first hit wins.
USER_TYPE_CONTAINS = [("transfer", "Distributor"), ("customer", "Autoship")]

# The hand-run load's user types: pattern or listed raw types, case counts -> user type.
STAGED_USER_TYPES = [
    ("%Customer%", ["Employee", "RCSCompany"], "Autoship"),
    ("%Transfer%", ["B2B", "Import", "Distributor"], "Distributor"),
]

# Raw user status, lower case, that counts as active.
ACTIVE_USER_STATUSES = ["active", "grace", "hold"]

# Raw order status, lower case, that counts as inactive.
INACTIVE_ORDER_STATUSES = ["ach declined", "cancelled", "cc declined"]

# User type codes of the member / retail clients.
MEMBER_TYPE_CODES = {
    "MEMBER": "Distributor",
    "RETAIL": "Customer",
    "BA": "Distributor",
    "PC": "Autoship",
}

# Order type code -> order type name.
ORDER_CODE_NAMES = {
    "B": "Backorder Cancelled",
    "C": "Credit/RMA",
    "D": "Retail",
    "E": "Exchange/RMA",
    "I": "Wholesale",
    "R": "Replacement",
    "X": "Exchange/Order",
    "Y": "Point Redemption",
}

# LIKE pattern on the lower-cased product text -> product type, first hit wins.
PRODUCT_TYPE_PATTERNS = [
    ("%reactivation%", "fee"),
    ("%m%nth%", "subscription"),
    ("%tax%", "tax"),
    ("%fee%", "fee"),
    ("%initial%free%", "discount"),
    ("%get4discount%", "discount"),
    ("%activation%", "fee"),
    ("%event%", "event"),
    ("%boot%camp%", "event"),
    ("%momentum%", "event"),
    ("%view%", "event"),
    ("%acceleration%", "event"),
    ("%pick your product%", "product"),
]

# LIKE pattern on the lower-cased product text -> membership, first hit wins.
MEMBERSHIP_PATTERNS = [
    ("%rbs%", "rep"),
    ("%dtp%", "dream trips platinum"),
    ("%dtg%", "dream trips gold"),
    ("%dt%gold%", "dream trips gold"),
    ("%dts%", "dream trips silver"),
    ("%dtu%", "dream trips u"),
    ("%wva%", "worldventures a"),
]

# Case-sensitive LIKE pattern on a login platform -> platform class.
PLATFORM_PATTERNS = [
    ("Android%", "android"),
    ("iPhone%", "iphone"),
    ("iPad%", "ipad"),
    ("Windows", "windows"),
    ("Macintosh", "macos"),
    ("%OS X%", "macos"),
    ("Linux%", "linux"),
    ("linux%", "linux"),
    ("Fedora", "linux"),
    ("ChromeOS", "chromeos"),
]
PLATFORM_CLASSES = [
    "unknown", "android", "iphone", "ipad", "windows", "macos", "linux", "chromeos", "other",
]

# First day, last day, label, rank of a days-to-order bucket; None = open end.
DAY_BUCKETS = [
    (0, 0, "0", "1"),
    (1, 15, "1-15", "2"),
    (16, 90, "16-90", "3"),
    (91, 180, "91-180", "5"),
    (181, 365, "181-365", "6"),
    (366, 730, "366-730", "7"),
    (731, None, "> 730", "8"),
]

# The finer variant, with 16-30 and 31-90 apart.
FINE_DAY_BUCKETS = [
    (0, 0, "0", "1"),
    (1, 15, "1-15", "2"),
    (16, 30, "16-30", "3"),
    (31, 90, "31-90", "4"),
    (91, 180, "91-180", "5"),
    (181, 365, "181-365", "6"),
    (366, 730, "366-730", "7"),
    (731, None, "> 730", "8"),
]

# Period name, first day, last day of the lifetime-value report; None = open end.
VALUE_PERIODS = [
    ("30", 0, 30),
    ("31_90", 31, 90),
    ("91_180", 91, 180),
    ("181_365", 181, 365),
    ("366_730", 366, 730),
    ("730", 731, None),
]

# The text of an empty date.
ZERO_DATE = "0000-00-00"

# Shape of a dated log path, and of the date in it.
LOG_PATH_PATTERN = r"\d{4}[-]\d{2}[-]\d{2}.+\.log"
LOG_DATE_PATTERN = r"(\d{4}[-]\d{2}[-]\d{2})"

# Status codes of the score service that mean "no rows".
LOOKUP_EMPTY_CODES = (102, 204, 402)

# Columns sent to the score service, after the client.
LEAD_EXPORT_COLUMNS = [
    "first_name", "last_name", "email", "email2", "email3", "phone", "phone2", "phone3",
    "twitter", "city", "state", "zip", "country", "gender", "age",
]
CONTACT_EXPORT_COLUMNS = [
    "first_name", "last_name", "email", "email2", "email3", "phone", "phone2", "phone3",
    "twitter", "city", "state", "zip", "country",
]

# Limits of the topic vocabulary.
VOCAB_MIN_DOCS = 15
VOCAB_MAX_SHARE = 0.5
VOCAB_MAX_TERMS = 100_000

# English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Shape of a token, of a web address and of a screen name.
TOKEN_PATTERN = r"https?://\S+|www\.\S+|@\w+|[\p{L}\p{N}]+(?:'\p{L}+)?"
URL_STARTS = ["http://", "https://", "www."]
URL_TOKEN = "URL"
SCREEN_NAME_TOKEN = "SCREEN_NAME"

# Phrase scoring.
PHRASE_MIN_COUNT = 5
PHRASE_THRESHOLD = 10.0
