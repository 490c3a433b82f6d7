from inkwell.functions.text import (  # noqa: F401
    PY_SPACE, ustrip, squeeze_newlines, source_label, split_sentences,
    count_literal, strip_quotes,
)
from inkwell.functions.fmt import (  # noqa: F401
    fixed, signed, raw_or_missing, MISSING,
)
