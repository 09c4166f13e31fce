"""Declared schemas and fixed values.

FIXED VALUES: the constants in this module must equal the behaviour being
reproduced (label domain, lexicons, confidences, ticker dictionary, search
space, default candidate, lengths).  They are stated here once, in natural
order, and every other module imports them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Label domain, in id order: negatif=0, netral=1, positif=2.
LABELS = ("negatif", "netral", "positif")

# Order used when counts are reported (briefing / dashboard).
REPORT_ORDER = ("positif", "netral", "negatif")

# Lexicon classifier defaults.
POSITIVE_WORDS = ("menguat", "naik", "laba", "positif", "tumbuh")
NEGATIVE_WORDS = ("melemah", "turun", "rugi", "tekanan", "negatif")
CONF_POSITIVE = 0.82
CONF_NEGATIVE = 0.78
CONF_NEUTRAL = 0.65

# Signal rule threshold.
SIGNAL_THRESHOLD = 0.75

# Ticker dictionary, in dictionary order.
TICKERS = (
    ("BBCA", "Bank Central Asia"),
    ("BBRI", "Bank Rakyat Indonesia"),
    ("BMRI", "Bank Mandiri"),
    ("TLKM", "Telkom Indonesia"),
    ("ASII", "Astra International"),
    ("GOTO", "GoTo Gojek Tokopedia"),
    ("UNVR", "Unilever Indonesia"),
    ("ANTM", "Aneka Tambang"),
    ("PGAS", "Perusahaan Gas Negara"),
    ("ADRO", "Adaro Energy"),
    ("MDKA", "Merdeka Copper Gold"),
    ("BRIS", "Bank Syariah Indonesia"),
)

# Search space: gene name -> values, in gene order (epochs is listed by the
# original but never drawn, so it is not a gene here).
SPACE = (
    ("learning_rate", (1e-5, 2e-5, 3e-5, 5e-5)),
    ("batch_size", (8.0, 16.0, 32.0)),
    ("lora_rank", (4.0, 8.0, 16.0)),
    ("lora_alpha", (8.0, 16.0, 32.0)),
    ("lora_dropout", (0.05, 0.1, 0.2)),
    ("weight_decay", (0.0, 0.01, 0.05)),
)
FINAL_EPOCHS = 3
DEFAULT_CANDIDATE = {
    "learning_rate": 2e-5,
    "batch_size": 16.0,
    "lora_rank": 8.0,
    "lora_alpha": 16.0,
    "lora_dropout": 0.1,
    "weight_decay": 0.01,
}

# Genetic search defaults.
SEED = 42
POPULATION_SIZE = 20
GENERATIONS = 5
MUTATION_RATE = 0.2
EARLY_STOP_PATIENCE = 3
WARMUP_GENERATIONS = 2
SURROGATE_POOL = 50
SURROGATE_TOPK = 5
MIN_SURROGATE_SAMPLES = 5

# Dataset preparation.
SPLIT_FRACTIONS = (8, 1, 1)  # train / val / test in tenths
SUBSET_FRACTION = (3, 10)  # 30 % proxy subset as num/den
MIN_WORDS = 3
MAX_LENGTH = 64

# Listing extraction.
HTML_MIN_TITLE = 25
JSON_MIN_TITLE = 15
ITEMS_PER_SOURCE = 3
MAX_CONTAINERS = 50
JSON_LINK_PREFIX = "https://www.reddit.com"

# Recent rows shown by the dashboard read.
RECENT_ROWS = 20

# ---------------------------------------------------------------------------
# Derived helpers
# ---------------------------------------------------------------------------

GENES = tuple(name for name, _ in SPACE)
GENE_SIZES = tuple(len(vals) for _, vals in SPACE)
SPACE_SIZE = 1
for _n in GENE_SIZES:
    SPACE_SIZE *= _n


def default_indices() -> tuple[int, ...]:
    return tuple(vals.index(DEFAULT_CANDIDATE[name]) for name, vals in SPACE)


# ---------------------------------------------------------------------------
# Declared schemas
# ---------------------------------------------------------------------------

RAW_NEWS = T.StructType(
    [
        T.StructField("judul", T.StringType()),
        T.StructField("tanggal", T.StringType()),
        T.StructField("sentimen", T.StringType()),
    ]
)

JSON_FEED = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "children",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField(
                                        "data",
                                        T.StructType(
                                            [
                                                T.StructField("title", T.StringType()),
                                                T.StructField("permalink", T.StringType()),
                                            ]
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

GENE_FIELDS = [T.StructField(f"i_{g}", T.IntegerType(), False) for g in GENES]

TRIALS = T.StructType(
    [
        T.StructField("cand_key", T.StringType(), False),
        T.StructField("gen", T.IntegerType(), False),
        *GENE_FIELDS,
        T.StructField("fitness", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("rows_scored", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)
