"""Parameters of the registered queries."""

from __future__ import annotations

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PII_KEY = "replace-me"  # a deployment passes its own secret
