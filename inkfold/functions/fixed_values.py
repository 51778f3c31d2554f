"""Values that must be the same everywhere for results to agree."""

# The five fields of an extraction record, in output order.
FIELDS = ["Location", "Description", "Date", "Photographer", "Film"]

# Entity label -> record field; every other label is a description.
LABEL_TO_FIELD = {
    "LOC": "Location",
    "GPE": "Location",
    "DATE": "Date",
    "PER": "Photographer",
    "PERSON": "Photographer",
    "FILM": "Film",
}
OTHER_FIELD = "Description"

# Month words that may stand before a four-digit year. The four
# lists are kept as they are, with "Mai" in the English one and "Feber" and
# "Nov." in each.
MONTHS_ENGLISH = ["January", "February", "March", "April", "Mai", "June", "July", "August",
                  "September", "October", "November", "December", "Feber", "Nov."]
MONTHS_GERMAN = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August",
                 "September", "Oktober", "November", "Dezember", "Feber", "Nov."]
MONTHS_GERMAN_SHORT = ["Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt",
                       "Nov", "Dez", "Feber", "Nov."]
MONTHS_ENGLISH_SHORT = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct",
                        "Nov", "Dec", "Feber", "Nov."]
MONTHS = sorted(set(MONTHS_ENGLISH + MONTHS_GERMAN + MONTHS_GERMAN_SHORT + MONTHS_ENGLISH_SHORT))

# Token patterns of the caption rules.
YEAR_PATTERN = "^[0-9]{4}$"
PHOTO_CREDIT = "Aufn."
PERSON_PATTERN = "^[A-Z][a-z]+$"
FILM_WORDS = ["film", "rollfilm"]

# A word is similar to another above this cosine.
SIMILARITY_THRESHOLD = 0.3

# Metric key -> label shown in reports.
METRIC_LABELS = {
    "accuracy": "Accuracy (%)",
    "fm": "F-measure",
    "mcc": "Matthews Correlation Coefficient",
    "psnr": "Peak Signal-to-Noise Ratio (PSNR)",
    "nrm": "Normalized Root Mean Square Error (NRM)",
    "drdm": "Distance-based Performance Measure (DRDM)",
}

# Smoothing term of the Dice score.
DICE_EPSILON = 1e-6

# The record written for an answer that is not JSON.
DECODE_ERROR = "Failed to decode response"
