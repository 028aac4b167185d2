"""Fixed values that define the workload semantics.

These must stay equal to the behaviour being reproduced; they are stated once
here and imported everywhere else.
"""

# --- fixed values: training layout -------------------------------------------
BLOCK_SIZE = 1024          # tokens per block row
BATCH_SIZE = 4             # block rows per training step
STEPS_PER_EPOCH = 1000     # an epoch is a step cap, not a corpus pass
LOSS_WINDOW = 100          # rolling mean of the last 100 losses

# --- fixed values: generation defaults ---------------------------------------
MAX_NEW_TOKENS = 200
TEMPERATURE = 0.8
TOP_K = 50
TOP_P = None
REPETITION_PENALTY = 1.25
NO_REPEAT_NGRAM = 3
TAG_LENGTH = 32

# --- fixed values: codec ------------------------------------------------------
# ids 0..255 are raw UTF-8 bytes, 256 is the end-of-text id, learned words
# start at 257.
N_BYTES = 256
EOS_ID = 256
FIRST_WORD_ID = 257
EOS_TEXT = "<|endoftext|>"
DEFAULT_VOCAB_SIZE = 8192

# Lossless pre-token pattern: a leading space stays with its word; every other
# whitespace character is its own piece. Portable between Java regex and RE2.
PRETOKEN_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"

# Line pattern: a line with its newline, or a last line without one.
LINE_PATTERN = "[^\n]*\n|[^\n]+"

# --- fixed values: count model (Jelinek-Mercer interpolation weights) ---------
LAMBDA_3 = 0.6
LAMBDA_2 = 0.3
LAMBDA_1 = 0.09
LAMBDA_0 = 0.01

# --- fixed values: named datasets and the fallback corpus ---------------------
# dataset choice -> checkpoint tag
NAMED_DATASETS = {
    "tiny-shakespeare": "tinyshakes",
    "wikitext-103": "wikitext103",
    "bookcorpus": "bookcorpus",
}
FALLBACK_STANZA = (
    "From fairest creatures we desire increase,\n"
    "That thereby beauty's rose might never die,\n"
    "But as the riper should by time decease,\n"
    "His tender heir might bear his memory …\n"
)
FALLBACK_REPEAT = 200
