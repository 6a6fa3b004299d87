"""Codes, names and parameters that decide the results."""

# Sample selection.
BAY_PREFIX = "TBM"
PROJECT = "AM"
GEARS = ("19", "20")
FIRST_DATE = "1998-01-01"
EFFORT_M2 = 140

# Species codes with a special meaning.
NO_FISH = "9998000000"
NO_GEAR_SET = "9999000000"
SENTINEL_SPECIES = "Lagodon rhomboides"

# Segment code -> segment name.
SEGMENT_NAMES = {
    1: "OTB",
    2: "HB",
    3: "MTB",
    4: "LTB",
    5: "Boca Ceiga",
    6: "Terra Ceia",
    7: "Manatee River",
}
MAIN_SEGMENTS = ("OTB", "HB", "MTB", "LTB")
OUTER_SEGMENTS = ("Boca Ceiga", "Terra Ceia", "Manatee River")

# Grids whose segment is set by hand.
GRID_SEGMENTS = {363: "LTB", 203: "MTB", 220: "MTB"}
CONDITIONAL_GRID = 204
CONDITIONAL_SEGMENT = "MTB"
CONDITIONAL_BELOW = 27.7937

# Month -> season.
SEASON_MONTHS = {
    "Winter": (12, 1, 2, 3),
    "Spring": (4, 5),
    "Summer": (6, 7, 8, 9),
    "Fall": (10, 11),
}

# Metric prefix, class column, class code.
GUILD_FLAGS = (
    ("TS", "Feeding_Cat", "TS"),
    ("TG", "Feeding_Cat", "TG"),
    ("Benthic", "Hab_Cat", "B"),
    ("Pelagic", "Hab_Cat", "P"),
    ("Obl", "Est_Use", "O"),
    ("MS", "Est_Cat", "MS"),
    ("ES", "Est_Cat", "ES"),
)

# Reference period, percentiles and colours.
REFERENCE_YEARS = (1998, 2015)
REFERENCE_PROBS = (0.05, 0.95)
BAND_PROBS = (0.33, 0.50)
RED_MAX = 32
GREEN_MIN = 46
RED = "#FF0000"
YELLOW = "#FFFF00"
GREEN = "#008000"

# The metrics of the index, and the name of each one's score.
INDEX_METRICS = {
    "NumTaxa": "ScoreNumTaxa",
    "Shannon": "ScoreShannon",
    "TaxaSelect": "ScoreTaxaSelect",
    "BenthicTaxa": "ScoreTaxaBenthic",
    "NumGuilds": "ScoreNumGuilds",
}
# The diversity percentiles are the only ones left unrounded.
UNROUNDED_METRICS = ("Shannon",)

# Known class codes, for the quality report.
CLASS_CODES = {
    "Hab_Cat": ("B", "P"),
    "Est_Cat": ("MS", "ES", "FS"),
    "Est_Use": ("O", "S", "F"),
    "Feeding_Cat": ("TS", "TG", "DV"),
    "Feeding_Guild": ("ZB", "PV", "ZP", "OV", "HV", "DV"),
    "Selected_Taxa": ("Y", "N"),
}
