"""Parameters of the corpus pipeline.

The values marked FIXED must equal the source pipeline's for identical results;
they are stated plainly here, together, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED values (cleaning thresholds, dedup/tokeniser constants, token layout)
# ---------------------------------------------------------------------------

MIN_LINE_CHARS = 40
MAX_NONALNUM_RATIO = 0.30
MIN_DOC_CHARS = 600
REPETITION_TOP_K = 10
MAX_REPETITION_RATIO = 0.50
REPETITION_NGRAM = 4
LANG_SAMPLE_CHARS = 5_000
NONWORD_RATIO_MAX = 0.20
OCR_MIN_TOKENS = 50
CHARS_PER_TOKEN = 4.0

SHINGLE_K = 5
MINHASH_PERM = 32
MINHASH_THRESHOLD = 0.8
DECONTAM_NGRAM = 13

VOCAB_SIZE = 16_384
SEQ_LEN = 1_024
VAL_EVERY_N_WINDOWS = 100
TRAIN_SEED = 1337
MICRO_BATCH = 32
GLOBAL_BATCH_TOKENS = 524_288
EVAL_WINDOWS = 64

SPECIAL_TOKENS = ("<|bos|>", "<|eos|>", "<|pad|>", "<|unk|>")
CHAT_TOKENS = ("<|user|>", "<|assistant|>", "<|system|>")

# Boilerplate line patterns (Python `re` syntax, matched from the line start,
# case-insensitive).
BOILERPLATE_PATTERNS = (
    r"^\s*form\s+10[-\s]?[kq]\b.*$",
    r"^\s*page\s+\d+\s+of\s+\d+\s*$",
    r"^\s*table\s+of\s+contents\s*$",
    r"^\s*/s/\s*.*$",
    r"^\s*all\s+rights\s+reserved.*$",
    r"^\s*united\s+states\s+securities\s+and\s+exchange\s+commission\s*$",
    r"^\s*securities\s+and\s+exchange\s+commission\s*$",
    r"^\s*washington,?\s+d\.?\s?c\.?\s+\d{5}\s*$",
    r"^\s*\[?\s*x\s*\]?\s*$",
)

# OCR threshold sweep values.
OCR_SWEEP_THRESHOLDS = (0.10, 0.15, 0.20, 0.25, 0.30)

# Sampling-job sizes.
SMOKE_N = 10
MEASURE_N = 2_000
OCR_SAMPLE_N = 3_000

# ---------------------------------------------------------------------------
# Tunable configuration
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanConfig:
    min_line_chars: int = MIN_LINE_CHARS
    max_nonalnum_ratio: float = MAX_NONALNUM_RATIO
    min_doc_chars: int = MIN_DOC_CHARS
    repetition_top_k: int = REPETITION_TOP_K
    max_repetition_ratio: float = MAX_REPETITION_RATIO
    ngram_n: int = REPETITION_NGRAM
    lang_sample_chars: int = LANG_SAMPLE_CHARS
    nonword_ratio_max: float = NONWORD_RATIO_MAX
    ocr_min_tokens: int = OCR_MIN_TOKENS


@dataclass(frozen=True)
class DedupConfig:
    shingle_k: int = SHINGLE_K
    num_perm: int = MINHASH_PERM
    bands: int = 3
    rows: int = 10
    decontam_ngram: int = DECONTAM_NGRAM


@dataclass(frozen=True)
class TokenConfig:
    vocab_size: int = VOCAB_SIZE
    seq_len: int = SEQ_LEN
    val_every: int = VAL_EVERY_N_WINDOWS
    # most frequent pairs kept on the driver while training
    pair_head: int = 200_000


@dataclass(frozen=True)
class TrainPlanConfig:
    seq_len: int = SEQ_LEN
    micro_batch: int = MICRO_BATCH
    global_batch_tokens: int = GLOBAL_BATCH_TOKENS
    seed: int = TRAIN_SEED


@dataclass(frozen=True)
class Source:
    name: str
    location: str
    token_budget: int
    text_field: str = "text"
    split: str = "train"
    config_name: str | None = None
    strict_ocr: bool = False
    near_dup: bool = False
    decontaminate: bool = False
    clean_shards: int = 4
    token_shards: int = 4


# ---------------------------------------------------------------------------
# Fixture policy: `documents.source` = src0..src19, three behaviour classes that
# mirror the case-law / SEC / web sources (budgets scaled down so the cap bites).
# ---------------------------------------------------------------------------

FIXTURE_N_SOURCES = 20
FIXTURE_SHARDS = 4
FIXTURE_CLASSES = (
    # (first index, last index, budget, strict_ocr, near_dup, decontaminate, split, config, token_shards)
    (0, 6, 10_000, True, True, True, "us", None, 4),
    (7, 13, 13_000, False, False, True, "train", None, 6),
    (14, 19, 5_000, False, False, False, "train", "sample", 4),
)

# Smaller windows and batches for the two plan queries that a small table leaves empty at the values above.
SMALL_SEQ_LEN = 128
SMALL_VAL_EVERY = 10
SMALL_GLOBAL_WINDOWS = 64
SMALL_MICRO_BATCH = 4


def fixture_registry() -> list[Source]:
    out = []
    for lo, hi, budget, strict, near, decon, split, cfg, tshards in FIXTURE_CLASSES:
        for i in range(lo, hi + 1):
            out.append(Source(
                name=f"src{i}", location=f"fixture://documents/src{i}", token_budget=budget,
                split=split, config_name=cfg, strict_ocr=strict, near_dup=near,
                decontaminate=decon, clean_shards=FIXTURE_SHARDS, token_shards=tshards))
    return out


@dataclass(frozen=True)
class PipelineConfig:
    clean: CleanConfig = field(default_factory=CleanConfig)
    dedup: DedupConfig = field(default_factory=DedupConfig)
    token: TokenConfig = field(default_factory=TokenConfig)
    train: TrainPlanConfig = field(default_factory=TrainPlanConfig)
