"""Settings of the enrichment model.

Fixed values: these must equal the reference model's values for identical
results (text limit, message limit, gate thresholds, link prefix, report layout,
wire literals, default topic names).  They are plain defaults of function
arguments; nothing reads them from the environment.
"""

from fractions import Fraction

# --- fixed values -----------------------------------------------------------
MAX_TEXT_UNITS = 280                    # trimmed post text, in UTF-16 units
MAX_MESSAGE_BYTES = 500000              # one message in a dump; 500000 itself passes
SIMILARITY_MIN = 0.7                    # drop if similarity < 0.7
SECOND_RANK_MAX = 0.1                   # drop if percentage of second rank > 0.1
EDIT_RATIO_MAX = Fraction(3, 4)         # drop if edit distance / max length > 0.75
SERVICE_CONFIDENCE_MIN = 0.7            # request-side minimum confidence
SERVICE_SUPPORT_MIN = 20                # request-side minimum support
LINK_LANG = "en"                        # links always point to the English wiki
WIKI_URL_PREFIX = "https://{lang}.wikipedia.org/wiki/"
TYPE_PREFIX = "Schema:"                 # ontology prefix of the type class
POST_TYP = "tweet"                      # literal written first by the encoder
REPORT_HEADER = "Annotations or tweet: "
REPORT_PAD = 25                         # display text padded (never cut) to 25
FAKE_HASHTAG_TEXT = "#bigdata"          # constant hashtag of the suffix enrichment
FAKE_HASHTAG_INDICES = (14, 21)
RAW_TOPIC = "raw_twitter_feed"
RICH_TOPIC = "enriched_twitter_feed"
# ---------------------------------------------------------------------------


def wiki_prefix(lang: str = LINK_LANG) -> str:
    return WIKI_URL_PREFIX.format(lang=lang)
