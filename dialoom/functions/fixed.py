"""Fixed values. They are part of the data format, so results depend on them letter by letter."""

from __future__ import annotations

# Unit spellings and their codes.
GRAM_UNITS = {
    "g": "g", "gr": "g", "gramm": "g", "grammi": "g", "gramos": "g",
    "grammes": "g", "γραμμάρια": "g", "γρ": "g",
    "ml": "ml",
}
COUNT_UNITS = {
    "pcs": "pcs", "stk": "pcs", "stk.": "pcs", "pzas": "pcs",
    "pz": "pcs", "un": "pcs", "pezzi": "pcs", "piece": "pcs",
    "pieces": "pcs", "τεμάχιο": "pcs", "τεμ": "pcs", "τμχ": "pcs",
    "τμχ.": "pcs", "इकाई": "pcs",
    "個": "pcs", "个": "pcs", "本": "pcs", "枚": "pcs",
    "large": "pcs", "medium": "pcs", "small": "pcs",
    "große": "pcs", "mittlere": "pcs", "kleine": "pcs",
    "klein": "pcs", "groß": "pcs", "grands": "pcs", "petits": "pcs",
    "cup": "cup", "tasse": "cup", "taza": "cup", "tazza": "cup",
    "κούπα": "cup", "xícara": "cup", "x": "cup",
    "φλ.": "cup", "φλ": "cup", "कप": "cup",
    "杯": "cup", "カップ": "cup",
    "tbsp": "tbsp", "el": "tbsp", "cda": "tbsp", "cucch": "tbsp",
    "κ.σ": "tbsp", "κ.σ.": "tbsp", "c": "tbsp", "colher": "tbsp",
    "汤匙": "tbsp",
    "大さじ": "tbsp", "बड़ा चम्मच": "tbsp",
    "slice": "slice", "scheibe": "slice", "rebanada": "slice",
    "tranche": "slice", "fetta": "slice", "fatia": "slice",
    "φέτα": "slice", "स्लाइस": "slice",
    "片": "slice",
}
WEIGHED = ("g", "ml")
COUNTED = ("pcs", "cup", "tbsp", "slice")

# Keywords of food categories.
DAIRY = ("milk", "yogurt", "kefir", "yoghurt", "soy milk", "soymilk", "la'it", "milch", "jogurt", "yaourt", "yogur")
LEGUMES = (
    "pea", "chickpea", "bean", "lentil", "lentils", "ervilhas", "grao", "feijao", "lentilhas", "chiche", "lentejas",
    "garbanzo", "chana", "dal", "revithia", "fakes", "fasolia", "ceci", "fagioli", "lenticchie", "piselli",
)
STARCHY = ("sweet potato", "potato", "corn", "chestnut", "batata", "patata", "kartoffel", "pomme de terre", "mais", "maiz", "milho", "castanha")

# User settings (threshold, baseline, divisor; dividers of morning, midday and evening) and hours of the day's periods.
SETTINGS = (
    (130.0, 100.0, 40.0, 14, 15, 12),
    (120.0, 90.0, 30.0, 8, 9, 7),
    (150.0, 110.0, 55.0, 18, 20, 16),
    (110.0, 80.0, 25.0, 20, 22, 18),
    (140.0, 105.0, 50.0, 10, 11, 10),
)
PERIODS = (("morning", 4, 12), ("midday", 12, 17), ("evening", 17, 4))
DEFAULT_DIVIDER = 15

# Scenarios and their shares.
SCENARIOS = {
    "SIMPLE_SINGLE_FOOD": 0.11,
    "MULTIPLE_FOODS_NO_GLUCOSE": 0.20,
    "MULTIPLE_FOODS_WITH_GLUCOSE": 0.25,
    "EXPLICIT_MEAL_TIME": 0.10,
    "AMBIGUOUS_FOOD": 0.08,
    "CORRECTION_REMOVAL": 0.07,
    "CORRECTION_QUANTITY": 0.05,
    "GLUCOSE_QUANTITY_CORRECTION": 0.02,
    "GLUCOSE_ONLY_CHECK": 0.04,
    "INCOMPLETE_INFO": 0.04,
    "FOOD_NOT_FOUND": 0.01,
    "TALLY_SUMMARY": 0.03,
}

# Tools and markers of the two chat formats.
SEARCH, ADD, REMOVE, FINAL, SUMMARY, CLEAR = "search_foods", "add_foods_to_tally", "remove_foods_from_tally", "calculate_final", "get_tally_summary", "clear_all"
CHATML = {"bos": "<|startoftext|>", "open": "<|im_start|>", "close": "<|im_end|>", "call_open": "<|tool_call_start|>", "call_close": "<|tool_call_end|>"}
GEMMA = {"bos": "<bos>", "open": "<|turn>", "close": "<turn|>", "results": "Tool results:"}

# Weights of the evaluation, its gate and margins, and the price of a million tokens in and out.
WEIGHTS = {"tool_calls": 0.40, "sequence": 0.25, "clarification": 0.15, "language": 0.10, "latency": 0.05, "memory": 0.05}
PASS_SCORE, TIE_MARGIN, RESULT_TOLERANCE = 0.70, 0.05, 0.01
PRICE_IN, PRICE_OUT = 0.15, 0.60
# Requests and tokens a minute that the rate limiter admits.
ADMITTED_REQUESTS, ADMITTED_TOKENS = 800, 800_000
