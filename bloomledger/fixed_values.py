"""Fixed values.

Everything in this module is a constant that a result depends on: word lists,
label texts, field lists, keys and number formats.  They are kept together, in
their natural order, so that they can be compared with the business rules they
come from.  No logic lives here.
"""

# --------------------------------------------------------------------------
# Product names
# --------------------------------------------------------------------------

# Product-type prefix that is dropped wherever it occurs, any case.
NAME_PREFIX = "SpRose"

# Whole-word abbreviations and their expansions, any case.  The order matters:
# later entries see the text the earlier ones produced ("Pk Lt" -> "Pink Lt"
# -> "Light Pink").
ABBREVIATIONS = [
    ("Wht", "White"),
    ("Asst", "Assorted"),
    ("Pk", "Pink"),
    ("Dbl", "Double"),
    ("Lav", "Lavender"),
    ("Org", "Orange"),
    ("Yel", "Yellow"),
    ("Ylw", "Yellow"),
    ("Blue-Lt", "Light Blue"),
    ("Blue-Dk", "Dark Blue"),
    ("Blue Dark", "Dark Blue"),
    ("Bfly", "Butterfly"),
    ("Rd", "Red"),
    ("Grn", "Green"),
    ("Gr", "Green"),
    ("pch", "Peach"),
    ("prp", "Purple"),
    ("BiClr", "Bicolor"),
    ("Pnky", "Pinky"),
    ("Deep Ppl", "Deep Purple"),
    ("Blnca", "Blanca"),
    ("prl", "Pearl"),
    ("Snoflk", "Snowflake"),
    ("HPk", "Hot Pink"),
    ("Crm", "Cream"),
    ("Ppl", "Purple"),
    ("Htpk", "Hot Pink"),
    ("Swt", "Sweet"),
    ("Vin Choic", "Vincent Choice"),
    ("FCY", "Fancy"),
    ("sel", "Select"),
    ("Pink Lt", "Light Pink"),
]

# Units behind a length that is removed from a name / read from a text.
NAME_LENGTH_UNITS = ["mm", "cm", "in", "inch", "inches", "c"]
STEM_LENGTH_UNITS = ["cm", "mm", "m", "in", "inch", "inches", "c"]

# Units of a pack count that is removed from a name.
PACK_UNITS = ["pk", "p", "cs", "ct", "ea", "bx", "bunch", "bunches", "stem", "stems", "st"]

# Origin codes that are removed from a name as whole words, any case.
ORIGIN_CODES = ["EC", "CR", "CL", "VA", "Mex"]

# Patterns of sizes and packs that are removed from a name, any case; {units} and
# {packs} stand for the lists above.
LENGTH_IN_NAME = r"\s+\d+[\s/\-]*\d*\s*(?:{units})\b"
COUNT_THEN_PACK = r"\s+\d+\s*(?:{packs})\b"
PACK_THEN_COUNT = r"\s+(?:{packs})\d+\b|\b\d+x\b|\+\d+\b|\bx\d+\b"
TRAILING_NUMBER = r"\s+\d+\s*$"

# Patterns of lengths, counts and prices that are read from a text; {units} stands
# for the stem length units.
LENGTH_WITH_UNIT = r"(\d+)(?:[\s/\-]\d+)?\s*(?:{units})\b"
BARE_NUMBER = r"(\d+)(?:[\s/\-]\d+)?(?!\w)"
MERGED_PAIR = r"\b(\d{2})(\d{2})\b"
NUMBER_RANGE = r"\b(\d+)[-/](\d+)\b"
STEM_COUNT = r"(\d+)\s*(?:st|stem|stems)"
TIMES_COUNT = r"x(\d+)"
SPLIT_COUNT = r"(\d+)/(\d+)"
EACH_PRICE = r"\(\s*\$(\d+\.\d{2})\s*Each\s*\)"
EACH_PRICE_TAG = r"\(\$\d+\.\d{2}\s*Each\)"
FIRST_PRICE = r"\$?(\d+(?:\.\d+)?)"
QTY_AT_PRICE = r"(\d+)\s*@\s*\$?(\d+\.\d+)"

# Patterns of two-letter codes that are removed from a name: at its end, then
# between words.
CODE_AT_END = r"\s+[A-Z]{2}$"
CODE_BETWEEN = r"\s+[A-Z]{2}\s+"

# A bare number counts as a stem length inside this closed range (cm).
STEM_LENGTH_RANGE = (20, 120)

# --------------------------------------------------------------------------
# Master catalog
# --------------------------------------------------------------------------

EXCLUDED_VARIETIES = [
    "1c533f62-9dbc-4803-a4e8-b853120283e4",
    "e99eb2c3-95a9-421f-ab7d-9e4f6c1659f3",
    "b06787cf-2b7a-47e6-a1d1-bff70f8efeff",
    "e571be69-18ac-41fb-ab74-d00edaadd4e0",
    "0a54c97a-db7c-472a-9654-828d3c8e7a1b",
    "64bec08c-0a46-4da1-8492-5a0cb90ecc98",
    "66b44c18-b1be-4b61-9353-6a9c23794b97",
    "8e8cde80-7c23-4618-b2ea-0577acc2b8cc",
    "e702c8a0-ec22-43a6-abb6-efa3585c6af4",
    "913fe526-13e3-458b-b25c-573f2fc517e1",
    "c7f33c3b-0cbb-4f63-a63a-66e502ecaaa8",
]

EXCLUDED_PRODUCT_GROUPS = [
    "1692521f-3547-4454-adf5-3b8bfb414633",
    "0c9f14f5-d919-4590-bbb6-f8f0f14a30e2",
    "618b7a0a-f638-4007-a05d-ba1f22fbad64",
    "492eb3d2-f8b1-4886-a180-f9fe5d4fb780",
    "5c2ebc74-f0d5-409f-83f2-a1d33372c246",
    "dc2d4e70-31a7-4009-972a-f5bbe103df9a",
]

# Names holding one of these are too mixed to be matched.
EXCLUDED_KEYWORDS = ["bouquet", "box", "total"]

# Colors that keep their second word ("dark red ...", "light blue ...").
COLOR_MODIFIERS = ["dark", "light"]

# Words that keep the text of the parentheses they stand in.
KEPT_IN_PARENTHESES = [
    "select", "petit", "petite", "jumbo", "italian", "spray", "mini", "total",
]

# Phrases removed from a catalog name; the first also eats stars and blanks
# around it.
REMOVED_WITH_STARS = "fragrance"
REMOVED_PHRASE = "cannot be cancelled"

# Characters after which the warehouse's INITCAP starts a new word.
TITLE_CASE_DELIMITERS = " \t\n\r\f\x0b[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

# --------------------------------------------------------------------------
# Price sources
# --------------------------------------------------------------------------

# One entry per source: the label written to `competitor`, and other values
# that are the same on every row of that source.
SOURCE_LABELS = {
    "mayesh": "Mayesh",
    "petaljet": "PetalJet",
    "flowermarketplace": "FlowerMarketplace",
    "dvflora": "DVFlora",
}
INVENTORY_STATE = "Kentucky"
INVENTORY_URL_PREFIX = "https://www.mayesh.com/"

# The inventory feed answers one request with at most this many rows.
INVENTORY_ROW_CAP = 2000

# Price tiers of the listing feed, in the order they are tried.
PREFERRED_TIERS = ["one", "three"]

# Delivery program whose dates set the run's delivery date.
ELIGIBLE_PROGRAM = 5

# Header texts that appear in the item-number column of HTML listings.
HEADER_ITEM_TEXT = "Item #"
MIN_TABLE_CELLS = 8
ORIGIN_LABEL = "Origin:"

# Columns exported per price table, in this order.  A name that the data does
# not have is skipped.
EXPORT_COLUMNS = {
    "mayesh": [
        "created_at", "eta_date", "state", "competitor", "grower_name", "grower_country",
        "competitor_product_id", "stem_length", "color_name", "available_units",
        "stems_per_unit", "stem_price", "margin", "unit_price", "competitor_product_name",
    ],
    "petaljet": [
        "competitor", "competitor_product_id", "competitor_product_name",
        "competitor_product_group_name", "color_name", "stem_length", "stems_per_unit",
        "unit_price", "stem_price", "created_at", "eta_date", "flowermarketplace",
    ],
    "flowermarketplace": [
        "created_at", "eta_date", "competitor", "competitor_product_id",
        "competitor_product_name", "competitor_product_group_name",
        "stem_length", "stem_price",
    ],
    "dvflora": [
        "created_at", "eta_date", "competitor_product_id", "competitor",
        "competitor_product_name", "stem_length", "stems_per_unit",
        "stem_price", "unit_price",
    ],
}

# The conformed product: field name and Spark type, in output order.
PRODUCT_FIELDS = [
    ("competitor", "string"),
    ("competitor_product_id", "string"),
    ("competitor_product_name", "string"),
    ("competitor_variant_id", "string"),
    ("competitor_product_group_name", "string"),
    ("competitor_product_group_id", "string"),
    ("unit", "string"),
    ("state", "string"),
    ("color", "string"),
    ("stem_length", "bigint"),
    ("stems_per_unit", "bigint"),
    ("unit_price", "double"),
    ("stem_price", "double"),
    ("base_price", "double"),
    ("freight_price", "double"),
    ("margin", "double"),
    ("available_units", "bigint"),
    ("grower_name", "string"),
    ("grower_country", "string"),
    ("highlight_name", "string"),
    ("product_url", "string"),
    ("image_url", "string"),
    ("matched_variety_name", "string"),
    ("variety_key", "string"),
    ("variety_score", "double"),
    ("cleaned_name_used", "string"),
    ("matched_product_group_name", "string"),
    ("product_group_key", "string"),
    ("product_group_score", "double"),
    ("cheapest_price_per_stem", "double"),
    ("highest_price_per_stem", "double"),
    ("created_at", "string"),
    ("eta_date", "string"),
]
REQUIRED_PRODUCT_FIELDS = ["competitor", "competitor_product_id"]

# --------------------------------------------------------------------------
# matching
# --------------------------------------------------------------------------

CANDIDATES_PER_NAME = 10
NO_MATCH = "Null"

# A subtype word must be in both names or in neither.
SUBTYPE_WORDS = ["spray", "garden", "standard"]
