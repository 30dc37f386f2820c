"""Fixed values.

Results depend on these being exactly as they are; they are constants of the
task, not choices of this code.
"""

# Characters a kept token may consist of.
CHARSET_RE = r"^[a-z0-9_àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ\.\-]+$"

# A word: letters, marks, digits and '_', with inner '.' or '-'.
WORD = "[\\p{L}\\p{M}\\p{N}_]+"
TOKEN_RE = WORD + "(?:[.\\-]" + WORD + ")*"

MIN_TOKEN_LENGTH = 2
REPLACEMENT_CHARACTER = "�"

# BM25 parameters and the cut-offs of the evaluation.
BM25_K1 = 1.2
BM25_B = 0.75
K_VALUES = (1, 5, 10)

EXCERPT_LENGTH = 100
EXCERPT_SUFFIX = "..."
MISSING_TEXT = "No content available"

METHOD_TFIDF = "tfidf"
METHOD_BM25 = "bm25"

# Scores are rounded before ranking so that equal scores tie on every engine.
SCORE_DIGITS = 6
