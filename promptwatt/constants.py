"""Fixed values shared by the Spark operators and the DuckDB oracle SQL.

Everything under a "FIXED VALUES" comment must equal the behaviour being
reproduced (word lists, thresholds, factors); they are data, not logic.
Lists that must be applied in order are tuples kept in their natural order.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Character classes (Java regex and RE2 both accept this syntax).
# --------------------------------------------------------------------------

# Unicode whitespace as Python's str.split()/re \s see it, written as an
# explicit class so Spark (Java) and DuckDB (RE2) agree on it.
WS = (r"\t\n\x0B\f\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# The non-ASCII members of WS (plus \x1c-\x1f), listed as characters: Spark
# maps them to ' ' with a one-to-one translate, then uses Java's fast \s.
EXOTIC_WS = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000")
# Control characters stripped by the cleaner.
CTRL = r"\x00-\x1f\x7f-\x9f"
CTRL_CHARS = "".join(chr(c) for c in list(range(0x00, 0x20)) + list(range(0x7F, 0xA0)))
# Characters counted by punct_ratio.
PUNCT_CLASS = r"[.,!?;:\"'()\[\]{}\-]"

# --------------------------------------------------------------------------
# FIXED VALUES — stopwords (Spark's StopWordsRemover english list, 181 words;
# stands in for the NLTK list, which is not available offline).
# --------------------------------------------------------------------------
STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)

# --------------------------------------------------------------------------
# FIXED VALUES — complexity scorer word sets.
# --------------------------------------------------------------------------
TECHNICAL_TERMS = (
    "algorithm", "neural", "network", "machine", "learning",
    "optimization", "gradient", "architecture", "transformer",
    "attention", "embedding", "vector", "matrix", "tensor",
    "inference", "training", "model", "layer", "activation",
    "backpropagation", "convolution", "recurrent", "parameter",
    "hyperparameter", "regularization", "normalization", "batch",
    "epoch", "loss", "function", "derivative", "stochastic",
    "analysis", "statistical", "probability", "distribution",
    "hypothesis", "correlation", "regression", "classification",
)
REASONING_WORDS = (
    "why", "how", "explain", "analyze", "compare", "contrast",
    "evaluate", "assess", "justify", "elaborate", "distinguish",
    "synthesize", "critique", "hypothesize", "deduce", "infer",
)
CONDITIONAL_MARKERS = ("if ", "when ", "unless ", "while ", "although ")

# Component weights, in the order sentence, vocabulary, syntactic, semantic,
# structural.
COMPLEXITY_WEIGHTS = (0.20, 0.25, 0.20, 0.20, 0.15)
COMPLEXITY_LEVELS = ((0.25, "low"), (0.50, "medium"), (0.75, "high"))
COMPLEXITY_TOP_LEVEL = "very_high"
COMPLEXITY_IMPACT = {
    "low": "Minimal computational resources required. Low energy consumption expected.",
    "medium": "Moderate computational resources needed. Standard energy consumption.",
    "high": "Significant computational resources required. Above-average energy consumption.",
    "very_high": "Substantial computational resources needed. High energy consumption expected.",
}

# --------------------------------------------------------------------------
# FIXED VALUES — energy model.
# --------------------------------------------------------------------------
JOULES_PER_KWH = 3_600_000.0
BASELINE_JOULES = 33.0
CALIBRATION_INTERCEPT = 9.26858138569117
CALIBRATION_SLOPE = 0.3310450370339285
CALIBRATION_REFERENCE_SLOPE = 0.015       # factor = slope / this
TOKEN_SCALING_MAX_TOKENS = 25
TOKEN_SCALING_BASELINE = 15
TOKEN_SCALING_CAP = 10.0
BASELINE_LAYERS = 24
BASELINE_TRAINING_HOURS = 8.0
BASELINE_FLOPS = 1e11
CONFIG_SCALE_MIN, CONFIG_SCALE_MAX = 0.5, 5.0
MIN_JOULES = 0.1
PUE = 1.4
WATER_L_PER_KWH = 1.8
DEFAULT_CARBON_KG_PER_KWH = 0.42
DEFAULT_COST_PER_KWH = 0.15
DEFAULT_REGION = "california"
ENERGY_LEVELS_J = ((10.0, "low"), (25.0, "medium"), (50.0, "high"))
ENERGY_TOP_LEVEL = "very_high"
LEGACY_LEVELS_KWH = ((0.5, "low"), (1.0, "medium"), (2.0, "high"))
# region -> (cost per kWh, kg CO2 per kWh)
REGION_FACTORS = (
    ("california", 0.22, 0.21),
    ("texas", 0.12, 0.45),
    ("virginia", 0.11, 0.35),
    ("eu_average", 0.25, 0.28),
    ("canada_average", 0.10, 0.12),
)
# Confidence per estimator family.
CONFIDENCE = {"formula": 0.6, "linear": 0.80, "gbt": 0.90}
# Impact equivalents.
KG_CO2_PER_TREE_YEAR = 21.0
HOME_KWH_PER_HOUR = 1.2
KG_CO2_PER_CAR_MILE = 0.4
MEASURED_WATTS = 25.0
MEASURED_KG_PER_KWH = 0.4

# --------------------------------------------------------------------------
# FIXED VALUES — anomaly rules.
# --------------------------------------------------------------------------
ANOMALY_THRESHOLD = -0.5
SEVERITY_LEVELS = ((-0.9, "critical"), (-0.7, "high"), (-0.5, "medium"), (-0.3, "low"))
ANOMALY_RECOMMENDATION = {
    "high_complexity": "Consider simplifying the prompt by breaking it into smaller, more focused queries.",
    "high_tokens": "The prompt is very long. Try to be more concise or split into multiple requests.",
    "unusual_pattern": "The prompt has unusual characteristics. Review for efficiency.",
    "normal": "The prompt appears normal and should process efficiently.",
}
ANOMALY_SEVERE_SUFFIX = " This prompt may significantly impact energy consumption."
ANOMALY_FACTORS = (
    ("complexity", "Very high complexity score"),
    ("tokens", "Excessive token count"),
    ("tokenization", "Unusual tokenization pattern"),
    ("efficiency", "Low energy efficiency per token"),
    ("density", "High complexity density"),
)
ANOMALY_GENERAL_FACTOR = ("general", "Unusual feature combination")

# --------------------------------------------------------------------------
# FIXED VALUES — rewriting rules. Order matters: earlier phrases shadow later
# ones ("for the purpose of" before "for the purpose of understanding").
# --------------------------------------------------------------------------
VERBOSE_PHRASES = (
    ("in order to", "to"),
    ("due to the fact that", "because"),
    ("in the event that", "if"),
    ("at this point in time", "now"),
    ("for the purpose of", "to"),
    ("in spite of the fact that", "although"),
    ("with regard to", "about"),
    ("in reference to", "about"),
    ("on the basis of", "based on"),
    ("in addition to", "besides"),
    ("in the case of", "if"),
    ("for the reason that", "because"),
    ("in the near future", "soon"),
    ("at the present time", "now"),
    ("in the majority of cases", "usually"),
    ("a large number of", "many"),
    ("a small number of", "few"),
    ("take into consideration", "consider"),
    ("make a decision", "decide"),
    ("give an explanation", "explain"),
    ("conduct an investigation", "investigate"),
    ("perform an analysis", "analyze"),
    ("provide assistance", "help"),
    ("reach a conclusion", "conclude"),
    ("have the ability to", "can"),
    ("it is necessary to", "must"),
    ("it is important to", "should"),
    ("it is possible that", "might"),
    ("there is a need for", "need"),
    ("please be advised that", ""),
    ("it should be noted that", ""),
    ("it is worth mentioning that", ""),
    ("with respect to", "about"),
    ("in terms of", "for"),
    ("as a result of", "because"),
    ("in the context of", "in"),
    ("for the purpose of understanding", "to understand"),
    ("in an effort to", "to"),
    ("in such a manner that", "so"),
    ("with the exception of", "except"),
    ("by means of", "by"),
    ("is able to", "can"),
    ("is capable of", "can"),
    ("has the capacity to", "can"),
    ("in close proximity to", "near"),
    ("prior to", "before"),
    ("subsequent to", "after"),
    ("in the absence of", "without"),
    ("in the presence of", "with"),
    ("for the duration of", "during"),
    ("at the conclusion of", "after"),
    ("in spite of", "despite"),
    ("on account of", "because"),
    ("in the process of", "while"),
    ("at this moment in time", "now"),
    ("during the course of", "during"),
    ("until such time as", "until"),
    ("whether or not", "if"),
    ("the reason is because", "because"),
    ("owing to the fact that", "because"),
    ("notwithstanding the fact that", "although"),
    ("despite the fact that", "although"),
    ("regardless of the fact that", "although"),
    ("in light of the fact that", "because"),
    ("given the fact that", "since"),
    ("being that", "because"),
    ("seeing as", "because"),
    ("as far as i am concerned", ""),
    ("to be honest", ""),
    ("to tell the truth", ""),
    ("as a matter of fact", ""),
    ("the fact of the matter is", ""),
    ("at the end of the day", ""),
    ("all things considered", ""),
    ("for all intents and purposes", "essentially"),
    ("as you may know", ""),
    ("as you are aware", ""),
    ("as previously mentioned", ""),
    ("as stated above", ""),
    ("as discussed earlier", ""),
    ("please note that", ""),
    ("kindly note that", ""),
    ("i would like to point out that", ""),
    ("i would like to mention that", ""),
    ("it goes without saying that", ""),
    ("needless to say", ""),
    ("what i mean to say is", ""),
    ("what i am trying to say is", ""),
    ("to put it simply", ""),
    ("to put it another way", ""),
    ("in other words", ""),
    ("that is to say", ""),
    ("could you please", "please"),
    ("would you be able to", "can you"),
    ("would it be possible for you to", "please"),
    ("i was wondering if you could", "please"),
    ("do you think you could", "please"),
    ("is there any way you could", "please"),
    ("i would appreciate it if you could", "please"),
    ("if you don't mind", ""),
    ("if it's not too much trouble", ""),
    ("when you get a chance", ""),
    ("at your earliest convenience", "soon"),
)

FILLER_WORDS = (
    "basically", "actually", "literally", "essentially", "definitely",
    "certainly", "obviously", "clearly", "really", "very", "quite",
    "extremely", "absolutely", "totally", "completely", "utterly",
    "truly", "simply", "just", "merely", "practically", "virtually",
    "honestly", "frankly", "arguably", "presumably", "supposedly",
    "seemingly", "apparently", "evidently", "undoubtedly", "unquestionably",
    "admittedly", "undeniably", "interestingly", "surprisingly", "remarkably",
    "fortunately", "unfortunately", "hopefully", "ideally", "naturally",
    "generally", "typically", "usually", "normally", "commonly", "often",
    "perhaps", "maybe", "possibly", "probably", "likely", "surely",
    "indeed", "rather", "somewhat", "fairly", "pretty", "kind of",
    "sort of", "more or less", "in fact", "of course", "by the way",
    "anyway", "anyhow", "nonetheless", "nevertheless", "however",
    "furthermore", "moreover", "additionally", "also", "besides",
    "meanwhile", "otherwise", "therefore", "hence", "thus", "consequently",
)
# Characters stripped from both ends of a word before the filler lookup.
FILLER_STRIP = ".,!?;:"

REDUNDANT_PAIRS = (
    ("each and every", "each"),
    ("first and foremost", "first"),
    ("various different", "various"),
    ("past history", "history"),
    ("future plans", "plans"),
    ("end result", "result"),
    ("final outcome", "outcome"),
    ("basic fundamentals", "fundamentals"),
    ("advance planning", "planning"),
    ("close proximity", "proximity"),
    ("combine together", "combine"),
    ("completely eliminate", "eliminate"),
    ("continue on", "continue"),
    ("currently now", "now"),
    ("repeat again", "repeat"),
)

# Politeness patterns, applied in this order, case-insensitively.
POLITENESS_PATTERNS = (
    r"^(hi|hello|hey)[,.]?\s*",
    r"^dear\s+\w+[,.]?\s*",
    r"^good\s+(morning|afternoon|evening)[,.]?\s*",
    r"\bthanks?\b[,.]?\s*",
    r"\bthank\s+you\b[,.]?\s*",
    r"\bplease\b\s*",
    r"\bkindly\b\s*",
    r"\bi\s+hope\s+this\s+(helps?|finds?\s+you\s+well)[,.]?\s*",
    r"\blooking\s+forward\s+to\b[^.]*[,.]?\s*",
    r"\bif\s+you\s+have\s+any\s+questions?\b[^.]*[,.]?\s*",
    r"\bfeel\s+free\s+to\b[^.]*[,.]?\s*",
    r"\bdon'?t\s+hesitate\s+to\b[^.]*[,.]?\s*",
    r"\blet\s+me\s+know\s+if\b[^.]*[,.]?\s*",
    r"\bbest\s+regards?\b[,.]?\s*$",
    r"\bsincerely\b[,.]?\s*$",
    r"\bthanks?\s+(in\s+advance|again)\b[,.]?\s*",
)

ACTION_WORDS = (
    "explain", "describe", "write", "create", "show", "tell", "list",
    "compare", "analyze", "help", "how", "what", "why", "when", "where",
)

WORD_REPLACEMENTS = (
    ("utilize", "use"),
    ("implement", "do"),
    ("facilitate", "help"),
    ("comprehensive", "full"),
    ("subsequently", "then"),
    ("approximately", "about"),
    ("demonstrate", "show"),
    ("accomplish", "do"),
    ("endeavor", "try"),
    ("ascertain", "find out"),
)

PROMPT_TEMPLATES = (
    ("question", "{topic}?"),
    ("explanation", "Explain {topic} briefly."),
    ("comparison", "Compare {item1} and {item2}."),
    ("summary", "Summarize: {content}"),
    ("list", "List 5 {items}."),
)

# Strategy order for "all alternatives" (first strategy wins a duplicate).
SIMPLIFY_STRATEGIES = ("t5", "auto", "aggressive", "verbose", "filler",
                       "compress", "truncate", "core")
# Optimizer candidate strategies, in order.
OPTIMIZER_STRATEGIES = ("t5", "simplify", "compress", "truncate", "combined")
# Sequence applied by the combined strategy (first three are used).
COMBINED_SEQUENCE = ("simplify", "truncate", "paraphrase", "compress")
SIMPLIFIER_MIN_SIMILARITY = 0.75
OPTIMIZER_MIN_SIMILARITY = 0.65

# Optimization rules config.
RULES_MAX_TOKENS = 150
RULES_TARGET_COMPLEXITY = 0.5
RULES_TARGET_EFFICIENCY = 0.8

# Suggestions (condition name -> text), in output order.
SUGGESTIONS = (
    ("tokens", "Your prompt has {n} tokens. Consider reducing to under 200 tokens for better efficiency."),
    ("complexity", "High complexity detected. Try using simpler vocabulary and shorter sentences."),
    ("vocabulary", "Consider replacing technical jargon with simpler terms where possible."),
    ("sentence", "Break long sentences into shorter ones for clearer communication."),
    ("stopwords", "High ratio of filler words detected. Remove unnecessary words like 'basically', 'actually', 'really'."),
    ("single", "Single long sentence detected. Break into multiple focused questions or statements."),
)
DEFAULT_SUGGESTION = "Your prompt appears reasonably efficient. Minor optimizations may still be possible."

# --------------------------------------------------------------------------
# FIXED VALUES — labels and training data.
# --------------------------------------------------------------------------
TASK_MULTIPLIERS = (
    ("simple", 1.0), ("question", 1.2), ("explanation", 1.4),
    ("comparison", 1.5), ("coding", 1.7), ("creative", 1.8),
    ("complex", 2.0),
)
LABEL_A_BASE_J = 0.1
LABEL_A_J_PER_TOKEN = 0.015
LABEL_A_COMPLEXITY_MULT = 0.3
LABEL_B_CATEGORY_MULTIPLIERS = (
    ("simple", 0.9), ("question", 1.0), ("explanation", 1.1),
    ("comparison", 1.15), ("coding", 1.2), ("complex", 1.25),
    ("extra_long", 1.1),
)
LABEL_B_COMPLEXITY_J = 2.0
LABEL_B_FLOOR_J = 0.5
LABEL_C_FLOOR_J = 2.0
DEFAULT_TASK_MULTIPLIER = 1.2
EFFICIENCY_LABELS = ((3.0, "efficient"), (5.0, "moderate"))
EFFICIENCY_TOP_LABEL = "inefficient"

# --------------------------------------------------------------------------
# FIXED VALUES — reports.
# --------------------------------------------------------------------------
EU_REPORTING_DEADLINE = "2026-08-01"
REPORT_STANDARD = "EU AI Act Energy Reporting Requirements"
PREVIEW_CHARS = 100
LOG_LIMIT = 1000

# Validation standards.
STANDARDS = (("r2", ">=", 0.80), ("mape", "<=", 25.0), ("bias_low", ">=", 0.90),
             ("bias_high", "<=", 1.10), ("correlation", ">=", 0.85),
             ("within_20", ">=", 70.0))

# Bands and texts of the interpretation of a validation (V5).
CORRELATION_BANDS = (
    (0.6, "[OK] Good correlation with real measurements (r > 0.6)"),
    (0.3, "[OK] Moderate correlation with real measurements (r > 0.3)\n     Model captures relative energy patterns correctly"),
    (0.0, "[!] Weak positive correlation - relative patterns partially captured"),
)
CORRELATION_REST = "[X] Negative correlation - model may need fundamental revision"
BIAS_TEXTS = {
    "fair": "[OK] Model predictions are well-calibrated (bias within +/-20%)",
    "over": ("[!] Model over-predicts by ~", "%\n    Consider applying calibration factor for production use"),
    "under": ("[!] Model under-predicts by ~", "%\n    Calibration factor: ",
              "x to match real measurements\n    This is expected when synthetic formula differs from actual hardware"),
}
MAPE_BANDS = (
    (20.0, "[OK] Good prediction accuracy (MAPE < 20%)"),
    (40.0, "[OK] Acceptable prediction accuracy (MAPE 20-40%)"),
)
MAPE_REST = "[!] High absolute error - expected for synthetic vs real comparison\n    Focus on correlation for relative rankings"

# Steps that the optimizer records.
SIMPLIFY_STEPS = ("T5-based text simplification", "Rule-based optimization")
STRATEGY_STEPS = {
    "compress": ("Compressed sentence structure", "Removed parenthetical expressions"),
    "truncate": ("Truncated to essential content", "Focused on key sentences"),
    "paraphrase": ("Generated alternative phrasing", "Selected most efficient version"),
}

# ---------------------------------------------------------------------------
# Bundled hooks (operators/hooks.py): values of this library.
# ---------------------------------------------------------------------------
PIECE_CHARS, PIECE_SPECIALS = 4, 2
# Endings of words and their Penn tags; the first that fits counts.
SUFFIX_TAGS = (
    ("ly", "RB"), ("ing", "VBG"), ("ed", "VBD"), ("ise", "VB"), ("ous", "JJ"), ("ful", "JJ"),
    ("able", "JJ"), ("al", "JJ"), ("est", "JJS"), ("er", "JJR"), ("s", "NNS"), ("n", "NN"),
)
SUFFIX_REST = "DT"
