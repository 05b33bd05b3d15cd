"""The patterns, formats and bounds that define the results.

Changing any of these changes which words are counted.
"""

# Separators of the basic tokeniser (seasonal words and topics).
BASIC_SEPARATORS = r"[\s\n,;.:?!'’\"/\\]"

# Separators of the event tokeniser: the basic ones and brackets.
EVENT_SEPARATORS = r"[\s\n,;.:?!'’\"{}\[\]()/\\]"

# Links, and the short link with escaped slashes.
URL = (
    r"(http(s)?:(//|\\/\\/).)?(www\.)?[-a-zA-Z0-9@:%._+~#=]{2,256}\.[a-z]{2,6}\b"
    r"([-a-zA-Z0-9@:%_+.~#?&/\\=]*)"
)
SHORT_LINK = r"(https:\\/\\/t\.co\\/[-a-zA-Z0-9@:%._+~#=]{1,256})"

# Unresolved unicode escapes, left-over link fragments, numbers.
UNICODE_ESCAPE = r"\\u\w\w\w\w"
FRAGMENTS = "https|co|rt"
NUMBER = r"-?\d+(\.\d+)?"

# `Sat Feb 01 06:00:05 +0000 2020`; Spark 3+ does not parse the day name, so it is cut off.
CREATED_AT = "MMM d HH:mm:ss Z yyyy"

# Quarters of the day. Bounds are exclusive at both ends and the last one is 23:59:59.
NIGHT, MORNING, AFTERNOON, EVENING = range(4)
QUARTER_SECONDS = 21_600
DAY_SECONDS = 86_400
LAST_SECOND = 86_399

MIN_COUNT = 10
SEASONAL_THRESHOLD = 20
CONFIDENCE = 0.99
BATCH_SECONDS = 3_600
VOCABULARY_SIZE = 1_000
TOPICS = 10
TOPIC_TERMS = 10
LDA_ITERATIONS = 100
