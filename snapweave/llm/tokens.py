"""Public tokenizer files: where they are and one loaded tokenizer for each worker process."""

from __future__ import annotations

import os
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def path_of(name: str) -> str:
    """The place of a vocabulary file; an absolute path stays as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def tokenizer(name: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path_of(name))
    loaded.no_padding()
    loaded.no_truncation()
    return loaded
